"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, copyright lines left out, every
run of punctuation or white space one blank, equivalent spellings made equal.  Its
SHA-256 is hash-joined with the digests of the known licence texts, and so is that
of each of its lines, for notices.  The known texts are a fixed table of some
tens of rows, so their side is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm.common import text_or_empty
from tabula.llm.license_digests import WHOLE_DIGESTS
from tabula.llm.license_texts import FULL_TEXTS, notices, variants

# fixed values: equivalent spellings, applied in this order to the canonical words
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"), ("favour", "favor"),
    ("copyright owner", "copyright holder"), ("non infringement", "noninfringement"), ("per cent", "percent"),
    ("merchantibility", "merchantability"), ("http ", "https "), ("whilst", "while"), ("wilful", "willful"),
)
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
# lines that name a holder, but not wrapped lines of a licence that happen to begin with "copyright"
HOLDER_LINE = (r"(^|\n)[ \t]*(copyright[ \t]*(\(c\)|©|[\d<\[{])|\(c\)[ \t]*(copyright|[\d<\[{])|©"
               r"|all rights reserved[ \t\r.]*(?=\n|$))[^\n]*")
LEAD = 12  # characters
MOST_LEADS = 10_000  # beginnings that the plan lists
BREAKS = r"[^\p{L}\p{N}\n]+"


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): whole licences and one-line notices."""
    return [*FULL_TEXTS.items(), *notices()]


def spelled(words: Column) -> Column:
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(old), F.lit(new))
    return words


def canonical_lines(text: str | Column) -> Column:
    """The canonical form with its line breaks."""
    c = F.regexp_replace(F.lower(text_or_empty(text)), COPYRIGHT_LINE, "$1")
    return spelled(F.regexp_replace(c, BREAKS, " "))


def joined_lines(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def whole_form(text: str | Column) -> Column:
    """The canonical form that does not depend on where lines are wrapped: only lines
    that name a holder are left out, and lines of "All rights reserved"."""
    c = F.regexp_replace(F.lower(text_or_empty(text)), HOLDER_LINE, "$1")
    return F.trim(spelled(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")))


def catalogue(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """``digest, license, lead`` of the known texts and those of ``extra`` (``license, text``)."""
    rows = [*known_texts(), *variants()]
    texts = spark.range(1, numPartitions=1).select(F.inline(
        F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in rows])))
    if extra is not None:
        texts = texts.union(extra.select(F.col("license").cast("string"), F.col("text").cast("string")).filter("license is not null"))
    forms = texts.select("license", F.explode(F.array(joined_lines(canonical_lines("text")), whole_form("text"))).alias("form")) \
        .filter("form <> ''").select(F.sha2("form", 256).alias("digest"), "license", F.substring("form", 1, LEAD).alias("lead"))
    stored = F.array(*[F.struct(F.lit(digest).alias("digest"), F.lit(name).alias("license"), F.lit(lead).alias("lead"))
                       for name, found in WHOLE_DIGESTS.items() for lead, digest in found])
    return forms.union(spark.range(1, numPartitions=1).select(F.inline(stored))) \
        .groupBy("digest").agg(F.min("license").alias("license"), F.min("lead").alias("lead"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: DataFrame | None = None) -> DataFrame:
    """``doc_id, text_digest, license, notices``, one row per input row.

    ``license`` names the known text that the whole document equals in canonical
    form, else null; ``notices`` lists, sorted and comma-separated, the licences of
    which some line of the document is a known text.  ``extra`` has more known texts
    (``license, text``) and may have any size: the built-in catalogue, some hundreds of rows, is broadcast,
    with ``extra`` Spark joins by the sizes it finds.  Of several licences with one text
    the first by name counts.  Null text counts as empty,
    and an empty text matches nothing.  Repeated rows and null ids each give a row;
    other columns are ignored."""
    known = catalogue(docs.sparkSession, extra)
    leads = sorted(r[0] for r in known.select("lead").distinct().limit(MOST_LEADS + 1).collect())
    lines = F.transform(F.split("form", "\n"), lambda x: F.trim(x))
    # a line equal to a known text begins like one; the others need no digest.  Of too many leads none are used
    begins = (lambda x: F.substring(x, 1, LEAD).isin(leads)) if len(leads) <= MOST_LEADS else (lambda x: F.length(x) > 0)
    likely = F.filter(lines, begins)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), canonical_lines(text).alias("form"), whole_form(text).alias("whole")) \
        .select("doc_id", F.monotonically_increasing_id().alias("rid"), F.sha2(joined_lines(F.col("form")), 256).alias("text_digest"),
                F.when(begins(F.col("whole")), F.sha2("whole", 256)).alias("whole_digest"),
                F.array_distinct(likely).alias("lines")) \
        .select("doc_id", "rid", "text_digest", "whole_digest", F.explode_outer("lines").alias("line")) \
        .withColumn("line_digest", F.sha2("line", 256))
    text_known = known.select(F.col("digest").alias("text_digest"), F.col("license").alias("by_text"))
    whole_known = known.select(F.col("digest").alias("whole_digest"), F.col("license").alias("by_whole"))
    notice = known.select(F.col("digest").alias("line_digest"), F.col("license").alias("notice"))
    small = F.broadcast if extra is None else (lambda known: known)
    return rows.join(small(text_known), "text_digest", "left").join(small(whole_known), "whole_digest", "left") \
        .join(small(notice), "line_digest", "left") \
        .groupBy("rid", "doc_id", "text_digest") \
        .agg(F.max(F.coalesce("by_text", "by_whole")).alias("license"), F.collect_set("notice").alias("found")) \
        .select("doc_id", "text_digest", "license", F.concat_ws(",", F.array_sort("found")).alias("notices"))


def scan_sql() -> str:
    """The same scan as DuckDB SQL over ``documents``, with the texts of ``known_texts`` only."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    lines = "regexp_replace(regexp_replace(lower(coalesce({}, '')), {}, '\\1', 'g'), {}, ' ', 'g')".format(
        "{}", quote(COPYRIGHT_LINE), quote(BREAKS))
    for old, new in SPELLINGS:
        lines = f"replace({lines}, {quote(old)}, {quote(new)})"
    lines = lines.replace("{}", "T_E_X_T")
    joined = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'))"
    values = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in known_texts())
    return f"""
WITH known AS (SELECT DISTINCT license, sha256({joined.format(lines.replace('T_E_X_T', 't'))}) AS digest
               FROM (VALUES {values}) AS v(license, t)),
     docs AS (SELECT row_number() OVER () AS rid, doc_id, {lines.replace('T_E_X_T', 'text')} AS form FROM documents),
     lines AS (SELECT rid, sha256(trim(unnest(string_split(form, chr(10))))) AS digest FROM docs),
     found AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM lines JOIN known USING (digest) GROUP BY rid)
SELECT d.doc_id, sha256({joined.format('d.form')}) AS text_digest, k.license, coalesce(f.notices, '') AS notices
FROM docs d LEFT JOIN known k ON k.digest = sha256({joined.format('d.form')}) LEFT JOIN found f USING (rid)"""

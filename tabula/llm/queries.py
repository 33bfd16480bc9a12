"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import (bloom_lm, bpe_count, decontam, hash_tree, jaccard_join, lang_id, licenses, ordinal, packing,
                        prefix_trie, radix_dedup, warc, whitening)
from tabula.llm.common import read_table

WORD_BPE = "word_bpe_49k.json"


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_texts(read_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages carry no capture time; the id, in seconds, stands for it
    pages = read_table(spark, sf_dir, "pages").withColumn("captured", F.col("page_id").cast("timestamp"))
    return warc.capture_index(pages, time_col="captured") \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the ids of the test items found in it and the longest overlap."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.mark_overlaps(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", (F.size("spans") > 0).alias("contaminated"), F.col("spans.item_id").alias("item_ids"),
                        F.coalesce(F.array_max("spans.words"), F.lit(0)).alias("longest_overlap"), "spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify_languages(read_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), width=4, percent=85)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected grade (0 toxic, 1 poor, 2 good) and the decision."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = read_table(spark, sf_dir, "labels").withColumn("grade", ordinal.document_grade())
    return ordinal.grade_texts(docs, ordinal.fit_on_labels(docs, ratings), keep=["doc_id"])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


TREE = hash_tree.even_tree(8)


def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.numbered(read_table(spark, sf_dir, "documents"), TREE).withColumn("law", F.lit("key"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations beyond 64 bits, which need some 10^8 rows, are null."""
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {f.__name__: f for f in (op1_pack, op2_bloom_lm, op3_exact_dedup, op4_warc, op5_decontaminate, op6_language_id,
                                op7_jaccard_join, op8_token_counts, op9_license_scan, op10_quality, op11_prefix_trie,
                                op12_hash_tree, op13_whitening)}

# fixed value: DuckDB's RE2 pattern of the removed characters
_BLANK = r"[\x20\x09-\x0D]+"

# CRC-32 of text in DuckDB SQL: a table of one row with the 256 remainders, computed, and the fold over the bytes
CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text expression, where ``crc_table`` is joined."""
    pairs = f"string_split(rtrim(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')), ' ')"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({pairs},
       lambda h: CASE WHEN h = '' THEN -1 ELSE ('0x' || h)::BIGINT END)),
       lambda c, b: CASE WHEN b < 0 THEN c ELSE xor(c >> 8, tb[xor(c & 255, b) + 1]) END), 4294967295)"""


# turns are told apart by MD5 here, prefixes by the MD5 of all their turns' digests
TRIE_SQL = f"""
WITH {CRC_TABLE},
     t AS (SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
                  len(regexp_extract_all(coalesce(text, ''), '{prefix_trie.WORD}')) AS w FROM conversations WHERE conv_id IS NOT NULL),
     own AS (SELECT c, h, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, h) - 1 AS pos FROM t),
     k AS (SELECT c, CASE WHEN c % 20 = 0 THEN 0 ELSE {crc32_sql("c::VARCHAR")} % 4 END AS n
           FROM (SELECT DISTINCT c FROM t), crc_table),
     rebuilt AS (SELECT k.c, 0 AS own_part, pos, h, w FROM k JOIN own ON own.c = k.c - k.c % 20 AND pos < n
                 UNION ALL SELECT k.c, 1, pos, h, w FROM k JOIN own ON own.c = k.c AND pos >= n),
     e AS (SELECT c, row_number() OVER o AS depth, w, md5(string_agg(h, '') OVER o) AS path FROM rebuilt
           WINDOW o AS (PARTITION BY c ORDER BY own_part, pos)),
     ee AS (SELECT c, depth, w, path, coalesce(lag(path) OVER (PARTITION BY c ORDER BY depth), '') AS up FROM e
            UNION ALL SELECT c, 0, 0, '', NULL FROM k),
     ends AS (SELECT depth, path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
              FROM (SELECT c, depth, path FROM ee QUALIFY depth = max(depth) OVER (PARTITION BY c)) GROUP BY ALL),
     n AS (SELECT depth, path, min(up) AS up, min(c) AS c, count(*) AS members, max(w) AS w FROM ee GROUP BY depth, path),
     kids AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
     sums AS (SELECT a.depth, a.path, sum((kids.n_children IS NULL)::INT) AS n_leaves, sum((u.members - 1) * u.w) AS saved
              FROM n u LEFT JOIN kids ON kids.depth = u.depth AND kids.path = u.path
              JOIN ee a ON a.c = u.c AND a.depth <= u.depth GROUP BY ALL)
SELECT n.c AS conv_id, n.depth, p.c AS parent_conv_id, n.members AS n_convs, coalesce(kids.n_children, 0) AS n_children,
       sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM n JOIN sums USING (depth, path) LEFT JOIN kids USING (depth, path) LEFT JOIN ends USING (depth, path)
LEFT JOIN n p ON p.depth = n.depth - 1 AND p.path = n.up"""

SQL = {
    "op3_exact_dedup": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS norm FROM documents),
     r AS (SELECT doc_id, norm,
                  first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     m AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
                  max(page_id) OVER (PARTITION BY body) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND newest <> page_id THEN newest END AS refers_to
FROM m""",
    "op9_license_scan": licenses.scan_sql(),
    "op11_prefix_trie": TRIE_SQL,
    "op12_hash_tree": hash_tree.numbered_sql(TREE, hash_tree.grown(TREE), crc32_sql("t"), CRC_TABLE),
}

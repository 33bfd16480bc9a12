"""WARC archives with revisit records, and their capture index by external merge.

Writing: equal payloads of a minimum size are found by digest; the capture with the
largest id is stored whole, the others as revisits (HTTP head only, as usual for
identical payloads).  Records are rendered by SQL functions and written by
Spark's text writer with the blank lines that end a record as line separator, so
archives land on any store Spark can write, under its commit protocol.

Reading: each archive is inflated and parsed in pieces by Content-Length, and its
captures leave as one run sorted by URL key, time and id.  The index is merged
externally: range partitions of the global key order receive their slice of every
run (a URL with very many captures spans several partitions), and each merges its
slices with a loser tree.  Partition by partition the result is globally ordered.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import scratch_path, stored, text_or_empty

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
RECORDS_PER_FILE = 50_000
ENTRIES_PER_PARTITION = 100_000
READ_BYTES = 1 << 20

INDEX_SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("url_key", "captured_at", "url", "archive")],
    *[T.StructField(c, T.LongType()) for c in ("offset", "length", "page_id", "payload_bytes")],
    *[T.StructField(c, T.StringType()) for c in ("payload_digest", "record_type")],
    T.StructField("refers_to", T.LongType())])


def _header(value: str | Column) -> Column:
    """A header value keeps to one line."""
    c = F.col(value) if isinstance(value, str) else value
    return F.regexp_replace(c, r"[\x00-\x20\x7F]+", "%20")


def render(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, payload_col: str,
           time_col: str | None) -> DataFrame:
    """One ``record`` per row, without the blank lines that end it."""
    when = F.col(f"`{time_col}`").cast("timestamp") if time_col else F.lit(0).cast("timestamp")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        text_or_empty(f"`{payload_col}`").alias("body"), when.alias("at")) \
        .withColumns({"n": F.octet_length("body").cast("long"), "sha": F.sha1("body")})
    first = stored(rows.filter(F.col("n") >= min_bytes).groupBy("sha", "n").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("k"))
                   .filter("k > 1").drop("k"), "warc-equal")
    rows = rows.join(first.hint("merge"), ["sha", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    at = F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("id")),
        F.coalesce(line("WARC-Date", at), F.lit("")),
        F.coalesce(line("WARC-Target-URI", _header("url")), F.lit("")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("first")),
                                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
        .otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")))
    return rows.select(F.concat(head, F.lit(CRLF), block).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", time_col: str | None = None) -> None:
    """Gzip-compressed WARC files below ``path``, one record per row.

    Null payloads are empty; a null time leaves the date out, a null url the
    target.  Of equal payloads of at least ``min_bytes`` bytes the largest id is the
    response; rows repeating that id are responses too.  A row without an id
    revisits like any other and, having no name, is never referred to."""
    render(pages, min_bytes, id_col, url_col, payload_col, time_col) \
        .write.option("lineSep", RECORD_END).option("compression", "gzip") \
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, no scheme, ``www``, port or fragment."""
    if url is None:
        return ""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.strip().lower()).split("#")[0]
    host, slash, path = rest.partition("/")
    host = re.sub(r":\d+$", "", host.rpartition("@")[2])
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + ")" + (slash + path or "/")


def inflate(blob: bytes) -> Iterator[bytes]:
    """Pieces of a gzip file of one or more members."""
    view, at, member = memoryview(blob), 0, zlib.decompressobj(31)
    while at < len(view) or member.unconsumed_tail:
        piece = member.unconsumed_tail
        if not piece:
            piece = view[at:at + READ_BYTES]
            at += len(piece)
        out = member.decompress(piece, READ_BYTES)
        if out:
            yield out
        if member.eof:
            at -= len(member.unused_data)
            member = zlib.decompressobj(31)


class RecordReader:
    """Records of a WARC byte stream: (offset, length, headers, block)."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, bytearray(), 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def __iter__(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        while True:
            seen = 0
            while (end := self.held.find(b"\r\n\r\n", seen)) < 0:
                seen = max(0, len(self.held) - 3)
                if not self.more():
                    if self.held.strip():
                        raise ValueError(f"archive ends inside a record at byte {self.at}")
                    return
            lines = self.held[:end].decode().split(CRLF)
            head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = end + 4 + int(head["content-length"])
            while len(self.held) < size + 4:
                if not self.more():
                    raise ValueError(f"archive ends inside a record at byte {self.at}")
            block = bytes(self.held[end + 4:size])
            yield self.at, size, head, block
            del self.held[:size + 4]
            self.at += size + 4


def capture(archive: str, offset: int, length: int, head: dict[str, str], block: bytes) -> tuple:
    """Index entry of a record; a response's payload is checked against its digest."""
    named = lambda key: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(key, ""))) else None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{archive}, byte {offset}: the payload does not match its digest")
    url = head.get("warc-target-uri")
    return (url_key(url), head.get("warc-date", ""), url, archive, offset, length, named("warc-record-id"), size, digest,
            head["warc-type"], named("warc-refers-to"))


def _order(entry: Sequence) -> tuple:
    return entry[0], entry[1], -1 if entry[6] is None else entry[6], entry[3], entry[4]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of every archive below ``path``, one sorted run per archive."""
    schema = T.StructType([*INDEX_SCHEMA.fields, T.StructField("nth", T.LongType())])
    types = [pa.string()] * 4 + [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                archive = name.rpartition("/")[2]
                entries = [capture(archive, *r) for r in RecordReader(inflate(blob.as_py()))]
                entries.sort(key=_order)
                rows = [(*e, i) for i, e in enumerate(entries)]
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=schema.names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


class LoserTree:
    """Merges sorted runs; ``runs[i]`` lists (key, value) in key order.

    Inner nodes hold the run that lost there, the root the overall winner; taking
    an entry replays one path from its leaf."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = len(runs)
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        """Run a's next entry comes before run b's; -1 (not yet played) beats all."""
        if a < 0 or b < 0:
            return a < 0
        x, y = self.runs[a], self.runs[b]
        i, j = self.at[a], self.at[b]
        if i >= len(x) or j >= len(y):
            return i < len(x)
        return (x[i][0], a) < (y[j][0], b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        for _ in range(sum(map(len, self.runs))):
            w = self.tree[0]
            yield self.runs[w][self.at[w]][1]
            self.at[w] += 1
            self._replay(w)


def merge_runs(runs: DataFrame, per_partition: int = ENTRIES_PER_PARTITION) -> DataFrame:
    """The captures in global order of URL key, time and id: columns ``shard`` (range
    partition) and ``place`` (position inside it)."""
    runs = stored(runs, "warc-runs")
    shards = max(1, -(-runs.count() // per_partition))
    key = ["url_key", "captured_at", "page_id", "archive", "offset"]
    sliced = runs.repartitionByRange(shards, *key).sortWithinPartitions("archive", "nth")
    schema = T.StructType([*INDEX_SCHEMA.fields, T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        cols = [table[c].to_pylist() for c in key]
        cut = [0, *(i for i in range(1, table.num_rows) if cols[3][i] != cols[3][i - 1]), table.num_rows]
        entries = [((u, t, -1 if p is None else p, a, o), i) for i, (u, t, p, a, o) in enumerate(zip(*cols, strict=True))]
        order = list(LoserTree([entries[lo:hi] for lo, hi in zip(cut, cut[1:], strict=False)]))
        out = table.take(pa.array(order)).drop_columns(["nth"])
        shard = TaskContext.get().partitionId()
        out = out.append_column("shard", pa.array(np.full(len(order), shard, np.int32))) \
            .append_column("place", pa.array(np.arange(len(order), dtype=np.int64)))
        yield from out.combine_chunks().to_batches()

    return sliced.mapInArrow(merge, schema)


def capture_index(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write the archives (to ``path``, by default a new shared folder), read them
    back and return the merged index, one row per page.  See ``write_archives``
    for nulls and ties; an empty table gives an empty index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    return merge_runs(read_runs(spark, path))



"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

A row descends from the root: at each node every child draws ``-ln(u) / weight``,
``u`` uniform from a digest of (row id, child), and the least draw wins, so a child
is chosen in proportion to its weight and a row's draw for one child never depends on
the others.  A node weighs the sum of its leaves.  When a weight changes, only the
draws of the nodes above that leaf change: rows move into subtrees that gained or out
of subtrees that lost, and all others stay.  A shard that comes with a rack and a
region of its own (``grown``) therefore takes rows only into itself.

DataFrame functions only.  The tree is one literal, the rows are dealt without any
shuffle; ``numbered`` gives each row its place within its shard by range partitions and
offsets, since a shard is a hot key by nature."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import stored, text_or_empty
from tabula.operators.ordering import row_index

Leaf = tuple[str, str, str, float]  # region, rack, shard, weight; shards are numbered as listed
DIGITS = 13  # hexadecimal digits of a draw: 52 bits


def even_tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """``shards`` leaves of weight 1, ``per_rack`` to a rack and ``racks`` to a region."""
    return [(f"r{i // (per_rack * racks)}", f"k{i // per_rack}", f"s{i}", 1.0) for i in range(shards)]


def grown(leaves: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a rack and a region of its own."""
    n = len(leaves)
    return [*leaves, (f"r+{n}", f"k+{n}", f"s+{n}", weight)]


def children(leaves: Sequence[Leaf]) -> dict[str, dict[str, float]]:
    """Weights of the children of each inner node; nodes are named by their path."""
    out: dict[str, dict[str, float]] = {"": {}}
    if not any(leaf[3] > 0 for leaf in leaves):
        raise ValueError("a tree needs a leaf of positive weight")
    if len({leaf[:3] for leaf in leaves}) < len(leaves):
        raise ValueError("a shard is listed twice")
    for region, rack, shard, weight in leaves:
        if weight <= 0:
            continue  # an emptied shard keeps its number and is never drawn
        up = ""
        for name in (region, f"{region}/{rack}", f"{region}/{rack}/{shard}"):
            kids = out.setdefault(up, {})
            kids[name] = kids.get(name, 0.0) + weight
            up = name
    return out


def drawn_shard(row_id: Column, leaves: Sequence[Leaf]) -> Column:
    """Number of the shard that the id, written as text, descends to; a null id
    counts as the empty text."""
    tree = {up: [{"n": n, "w": w} for n, w in kids.items()] for up, kids in children(leaves).items()}
    nodes = F.from_json(F.lit(json.dumps(tree)), "map<string,array<struct<n:string,w:double>>>")
    numbers = F.from_json(F.lit(json.dumps({"/".join(leaf[:3]): i for i, leaf in enumerate(leaves)})), "map<string,int>")
    named = F.coalesce(row_id.cast("string"), F.lit(""))

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(named, F.lit("|"), child["n"]).cast("binary")), 1, DIGITS)
        u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16 ** DIGITS))
        return F.struct((-F.log(u) / child["w"]).alias("draw"), child["n"].alias("n"))

    at = F.lit("")
    for _ in range(3):
        at = F.array_min(F.transform(F.element_at(nodes, at), draw))["n"]
    return F.element_at(numbers, at)


def deal(docs: DataFrame, leaves: Sequence[Leaf], out: str = "shard", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the shard of each row in column ``out``, which replaces one of that name."""
    return docs.withColumn(out, drawn_shard(F.col(f"`{id_col}`"), leaves))


def write_shards(docs: DataFrame, leaves: Sequence[Leaf], path: str, id_col: str = "doc_id", files: int = 16) -> None:
    """Write the rows, all columns kept, as Parquet below ``path``, a folder
    ``shard=k`` each.  Ids spread a shard's rows over at most ``files`` files a folder;
    raise it with the data."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(files))
    deal(docs, leaves, "shard", id_col).repartition(F.col("shard"), spread).write.partitionBy("shard").parquet(path)


def numbered(docs: DataFrame, leaves: Sequence[Leaf], more: Sequence[Leaf] | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the whole text (null text: empty) plus 1, ``text_crc32``
    its unsigned CRC-32, ``slot`` the row's place in its shard, gapless from 0, in the order
    of the MD5 of the id (then id, CRC, size), so a shard is in shuffled order and the order does not
    depend on the input's files.  ``grown_shard`` is the shard in the tree ``more`` (default: ``leaves`` with
    one more shard).  Null ids are dealt as the empty text; rows repeated in id and text all
    stay, in slots of their own.  An empty table gives an empty result; other columns are
    ignored.  The text is read once; what is numbered are some 50 bytes a row."""
    text = text_or_empty(text_col).cast("binary")
    row_id = F.col(f"`{id_col}`")
    dealt = stored(docs.select(
        row_id.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), drawn_shard(row_id, leaves).alias("shard"),
        drawn_shard(row_id, more or grown(leaves)).alias("grown_shard")), "dealt")
    mixed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # ids of the stored rows split even a shard of one repeated row over range partitions
    keyed = dealt.withColumn("mixed", mixed).withColumn("row", F.monotonically_increasing_id())
    slots = row_index(keyed, ["shard"], ["mixed", "doc_id", "text_crc32", "size", "row"], out="slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def numbered_sql(leaves: Sequence[Leaf], more: Sequence[Leaf], crc32_sql: str, crc32_table: str) -> str:
    """DuckDB SQL for ``numbered`` with the column ``law``: the descent as three joins
    with the table of nodes, the least draw by window."""
    def rows(tree: Sequence[Leaf]) -> str:
        return ", ".join(f"('{up}', '{n}', {w!r})" for up, kids in children(tree).items() for n, w in kids.items())

    def numbers(tree: Sequence[Leaf]) -> str:
        return ", ".join(f"('{'/'.join(leaf[:3])}', {i})" for i, leaf in enumerate(tree))

    parts = []
    for name, tree in (("a", leaves), ("b", more)):
        parts.append(f"{name}nodes(up, child, w) AS (VALUES {rows(tree)})")
        parts.append(f"{name}numbers(child, k) AS (VALUES {numbers(tree)})")
        parts.append(f"{name}0 AS (SELECT rid, name, '' AS node FROM d)")
        for level in range(3):
            parts.append(f"""{name}{level + 1} AS (SELECT rid, name, child AS node FROM (
    SELECT rid, name, child, row_number() OVER (PARTITION BY rid ORDER BY
           -ln((('0x' || substr(md5(name || '|' || child), 1, {DIGITS}))::BIGINT + 0.5) / {float(16 ** DIGITS)!r}) / w, child) AS o
    FROM {name}{level} JOIN {name}nodes ON up = node) WHERE o = 1)""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id::VARCHAR, '') AS name, coalesce(text, '') AS t FROM documents),
     {crc32_table},
     c AS (SELECT rid, doc_id, name, strlen(t) + 1 AS size, {crc32_sql} AS text_crc32 FROM d, crc_table),
     {''', '''.join(parts)}
SELECT doc_id, size, text_crc32, 'key' AS law, x.k::INT AS shard,
       row_number() OVER (PARTITION BY x.k ORDER BY md5(c.name), doc_id, text_crc32, size) - 1 AS slot, y.k::INT AS grown_shard
FROM c JOIN a3 USING (rid) JOIN anumbers x ON x.child = a3.node JOIN b3 USING (rid) JOIN bnumbers y ON y.child = b3.node"""

"""Exact Jaccard join on word shingles: size-banded tiles, bitmap bounds, exact check.

* A document is the sorted set of 64-bit hashes of its shingles.  Equal sets
  become one node; the node id is the smallest document id of the set.
* Bands.  A size band is as wide as the threshold allows two sizes to differ, so
  partners lie in one band or in neighbouring ones; a set therefore enters the group
  of its own band and that of the next.
* Tiles.  Partners in a group differ in at most D shingles, D following from the
  threshold and the band.  A hash deals the shingles of each set to D + 3 segments; as a
  differing shingle spoils one segment, partners have at least three equal segments.
  A tile is the nodes of a group whose segment has the same content.  A segment
  holds about six shingles, so sets that merely share a passage rarely meet.  (Empty
  segments make tiles only for sets with three of them or more.)
* Segments that one set only has are told apart first and cheaply, so few are shuffled.
* Bounds.  Each set has a parity bitmap of at least as many bits as shingles.  Bits that
  differ between two bitmaps need as many shingles in only one of the sets, which
  bounds the overlap from above; only pairs that pass are intersected exactly.
* Links within a large group are not enumerated: only connectivity is returned.
  First every member of a tile meets the tile's smallest node; tiles still
  holding more than one component are then compared pair by pair, across components
  only, in numpy: blocks of bounded size of a tile's nodes outside its largest component
  and of all its nodes.  Every link between two components is therefore found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import SMALL_CHUNK, give_back, map_text, stored, text_chunks
from tabula.llm.filters import fixed_filter, maybe_in, probably_in
from tabula.llm.components import components
from tabula.llm.words import Words, hash_words, mix64, pack48, split_words, unpack48

LEAST_BITS = 1024  # sets of up to as many shingles, most of them, have bitmaps of one width
SPARE = 3          # equal segments that partners have at least
NODES_PER_CELL = 1024
MAX_CELL_BITS = 16
SIDE = 4096        # nodes of a side of a block of pairs
PAIRS_AT_ONCE = 1 << 15  # of bitmaps
FEW_PAIRS = 1 << 12      # compared in one expression
MULT = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, end to end, and their starts.

    A text of fewer than ``width`` words is one shingle; without words, none."""
    word = hash_words(words.vocab)[words.codes]
    lengths, n = words.lengths, len(words.starts) - 1
    full = np.zeros(max(0, len(word) - width + 1), np.uint64)
    for j in range(width):
        full = full * MULT + word[j:len(word) - width + 1 + j] if len(full) else full
    full = mix64(full)
    sets = []
    for i in range(n):
        s, size = words.starts[i], lengths[i]
        if size >= width:
            sets.append(np.unique(full[s:s + size - width + 1]))
        elif size:
            h = np.uint64(size)
            for x in word[s:s + size]:
                with np.errstate(over="ignore"):
                    h = h * MULT + x
            sets.append(mix64(np.array([h], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), starts


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[starts[1:]] - total[starts[:-1]]


def set_digests(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify a set."""
    return tuple(segment_sums(mix64(flat ^ np.uint64(c)), starts).view(np.int64)
                 for c in (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D))


def bitmap_bits(size: int) -> int:
    """Bits of the bitmap of a set: a power of two, at least its size."""
    return max(LEAST_BITS, 1 << max(0, int(size) - 1).bit_length())


def parity_bitmap(one: np.ndarray) -> np.ndarray:
    n = bitmap_bits(len(one))
    bits = (np.bincount((one & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def band_of(size: np.ndarray, percent: int) -> np.ndarray:
    return np.floor(np.log(np.maximum(size, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def segments_of(group: np.ndarray, percent: int) -> np.ndarray:
    """Segments in a group: SPARE more than two partners can differ in shingles."""
    largest = np.ceil((100 / percent) ** (group + 1.0) * (1 + 1e-9))
    return ((100 - percent) * 2 * largest // (100 + percent)).astype(np.int64) + SPARE


def segment_keys(flat: np.ndarray, starts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit tile keys of every set, and the number of the set they belong to."""
    size = np.diff(starts)
    content, keys, owners = mix64(flat ^ np.uint64(0xD6E8FEB86659FD93)), [], []
    for step in (0, 1):
        group = band_of(size, percent) + step
        count = np.where(size > 0, segments_of(group, percent), 0)
        base = np.concatenate([[0], np.cumsum(count)])
        owner = np.repeat(np.arange(len(size)), size)
        at = base[owner] + ((flat >> np.uint64(7)) % np.maximum(count, 1)[owner].astype(np.uint64)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, at, content)
        held = np.bincount(at, minlength=base[-1])
        of = np.repeat(np.arange(len(size)), count)
        empties = np.bincount(of, held == 0, len(size))
        place = np.arange(base[-1]) - base[:-1][of]
        key = mix64(total + mix64((group[of] << 32 | place).view(np.uint64) * MULT))
        use = (held > 0) | (empties >= SPARE)[of]
        keys.append(key[use])
        owners.append(of[use])
    return np.concatenate(keys), np.concatenate(owners)


def _digest_rows(docs: DataFrame, width: int) -> DataFrame:
    """Per document its set's size and digests."""
    fields = [T.StructField(c, T.LongType()) for c in ("size", "d1", "d2")]

    def make():
        def fn(text: pa.Array) -> dict:
            flat, starts = shingle_sets(split_words(text, lower=True), width)
            d1, d2 = set_digests(flat, starts)
            return {"size": np.diff(starts), "d1": d1, "d2": d2}

        return fn

    return map_text(docs, "text", fields, make, keep=["doc_id"], chunk=SMALL_CHUNK)


def _shared_keys(texts: DataFrame, width: int, percent: int, cell_bits: int) -> DataFrame:
    """Tile keys that two sets or more have: column ``key48`` (their high bits).

    A batch sends its keys as one binary row per cell, six bytes each, and a cell
    task keeps those that occur twice; the tiles decide exactly."""
    shift = np.uint64(64 - cell_bits - 48)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            keys = np.concatenate([segment_keys(*shingle_sets(split_words(text, lower=True), width), percent)[0]
                                   for text in text_chunks(batch.column(0), SMALL_CHUNK)])
            keys.sort()
            cell = (keys >> np.uint64(64 - cell_bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(cell)) + 1
            runs = list(zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]]), strict=True)) if len(keys) else []
            yield pa.RecordBatch.from_arrays([pa.array([int(cell[lo]) for lo, _ in runs], pa.int32()),
                                              pa.array([pack48(keys[lo:hi] >> shift) for lo, hi in runs], pa.binary())], names=["cell", "held"])
            del keys, cell, cut, runs
        give_back()

    def twice(table: pa.Table) -> pa.Table:
        held = np.sort(np.concatenate([unpack48(b) for b in table["held"].to_pylist()]))
        again = np.unique(held[1:][held[1:] == held[:-1]])
        return pa.table({"key48": (again | np.uint64(table["cell"][0].as_py()) << np.uint64(48)).view(np.int64)})

    return texts.select("text").mapInArrow(send, "cell int, held binary").groupBy("cell").applyInArrow(twice, "key48 long")


def _tile_rows(texts: DataFrame, width: int, percent: int, cell_bits: int, shared: Broadcast) -> DataFrame:
    """Per document: set size, the tile keys that may be shared, bitmap (null without such keys)."""
    shift = np.uint64(64 - cell_bits - 48)
    fields = [T.StructField("size", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
              T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("meets", T.BooleanType())]

    def make():
        held = shared.value

        def fn(text: pa.Array) -> dict:
            flat, starts = shingle_sets(split_words(text, lower=True), width)
            keys, owner = segment_keys(flat, starts, percent)
            may = probably_in(held, (keys >> shift).view(np.int64))
            keys, owner = keys[may], owner[may]
            order = np.argsort(owner, kind="stable")
            keys, per = keys[order], np.bincount(owner, minlength=len(text))
            ends = np.concatenate([[0], np.cumsum(per)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys.view(np.int64)))
            bits = [parity_bitmap(flat[s:e]) if n else None for s, e, n in zip(starts[:-1], starts[1:], per, strict=True)]
            return {"size": np.diff(starts), "keys": lists, "bits": pa.array(bits, pa.list_(pa.int64())), "meets": per > 0}

        return fn

    return map_text(texts, "text", fields, make, keep=["doc_id"], only="meets", chunk=SMALL_CHUNK)


def _may_link(percent: int) -> Column:
    """What sizes and bitmaps allow: differing bits bound the symmetric difference
    from below, and the overlap is (sizes - difference) / 2.  The wider of two bitmaps
    is folded to the width of the other."""
    def folded(one: str, other: str) -> Column:
        half = (F.size(one) / 2).cast("int")
        fold = F.zip_with(F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(one) == 2 * F.size(other), fold).otherwise(F.col(one))

    usual = LEAST_BITS // 64
    plain = sum((F.bit_count(F.get("abits", F.lit(i)).bitwiseXOR(F.get("bbits", F.lit(i)))) for i in range(usual)), F.lit(0))
    wide = F.aggregate(F.zip_with(folded("abits", "bbits"), folded("bbits", "abits"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                       F.lit(0), lambda acc, x: acc + x)
    # the usual width is compared in generated code, without functions on arrays
    differ = F.when((F.size("abits") == usual) & (F.size("bbits") == usual), plain).otherwise(wide)
    total = F.col("asize") + F.col("bsize")
    sizes = F.least("asize", "bsize") * 100 >= F.greatest("asize", "bsize") * percent
    # the bound is only read where the sizes agree, and then widths differ by a factor of two at most
    return F.when(sizes, (total - differ) * (100 + percent) >= total * 2 * percent).otherwise(F.lit(False))


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("size").alias(f"{name}size"), F.col("bits").alias(f"{name}bits"))


class _Nodes:
    """Rows of a block: sizes, components and bitmaps, by the width of these."""

    def __init__(self, batch: pa.RecordBatch):
        self.node, self.comp, self.size, self.main = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "comp", "size", "ismain"))
        bits = batch.column("bits")
        self.words, self.ends = bits.values.to_numpy().view(np.uint64), bits.offsets.to_numpy()

    def maps(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Width, rows and bitmaps of the rows of each width."""
        width = self.ends[rows + 1] - self.ends[rows]
        for w in np.unique(width):
            some = rows[width == w]
            yield int(w), some, self.words[self.ends[some][:, None] + np.arange(w)]


def _folded(maps: np.ndarray) -> np.ndarray:
    half = maps.shape[1] // 2
    return maps[:, :half] ^ maps[:, half:]


def _near_pairs(nodes: _Nodes, outer: np.ndarray, inner: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Pairs of ``outer`` (outside the tile's main component) and ``inner`` rows of different components that may
    link, as in ``_may_link``; two rows outside meet once."""
    for wa, rows, left in nodes.maps(outer):
        for wb, others, right in nodes.maps(inner):
            if wa not in (wb, 2 * wb) and wb != 2 * wa:
                continue  # sizes too far apart
            a, b = left if wa <= wb else _folded(left), np.ascontiguousarray((right if wb <= wa else _folded(right)).T)
            step = max(1, PAIRS_AT_ONCE // len(others))
            for lo in range(0, len(rows), step):
                mine = rows[lo:lo + step]
                if len(mine) * len(others) <= FEW_PAIRS:
                    differ = np.bitwise_count(a[lo:lo + step, None, :] ^ b.T[None, :, :]).sum(axis=2, dtype=np.int64)
                else:
                    differ = np.zeros((len(mine), len(others)), np.uint16 if len(b) <= 512 else np.uint32)
                    for one, words in zip(a[lo:lo + step].T, b, strict=True):
                        differ += np.bitwise_count(one[:, None] ^ words)
                sa, sb = nodes.size[mine][:, None], nodes.size[others][None, :]
                total = sa + sb
                good = ((total - differ.astype(np.int64)) * (100 + percent) >= total * 2 * percent) & (np.minimum(sa, sb) * 100 >= np.maximum(sa, sb) * percent)
                x, y = np.nonzero(good)
                x, y = mine[x], others[y]
                keep = (nodes.comp[x] != nodes.comp[y]) & (nodes.main[y] | (nodes.node[x] < nodes.node[y]))
                yield np.column_stack([nodes.node[x[keep]], nodes.node[y[keep]]])


def _across(open_rows: DataFrame, percent: int) -> DataFrame:
    """``a, b`` (a the smaller): pairs of nodes of a tile in different components that may link, repeated where they
    share several tiles.  ``open_rows`` has ``tile, node, comp, main, outer, n, size, bits``; a tile of more than
    ``SIDE`` nodes is dealt to blocks of (nodes outside the main component) x (all nodes)."""
    parts = lambda c: F.ceil(F.col(c) / SIDE).cast("int")
    rows = open_rows.select("tile", "node", "comp", "size", "bits", (F.col("comp") == F.col("main")).alias("ismain"),
                            parts("outer").alias("outers"), parts("n").alias("inners"))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    inner = rows.withColumns({"j": own("inners"), "side": F.lit(False)}).withColumn("i", upto("outers"))
    outer = rows.filter("inners > 1 and not ismain").withColumns({"i": own("outers"), "side": F.lit(True)}).withColumn("j", upto("inners"))
    rows = inner.unionByName(outer).withColumn("whole", F.col("inners") == 1).drop("outers", "inners")

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Of whole blocks, which lie one after the other."""
        nodes = _Nodes(batch)
        side, whole = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("side", "whole"))
        key = np.column_stack([batch.column(c).to_numpy() for c in ("tile", "i", "j")])
        ends = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        found = [np.zeros((0, 2), np.int64)]
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            at = np.arange(lo, hi)
            outside = at[~nodes.main[at].astype(bool)] if whole[lo] else at[side[at]]
            found += _near_pairs(nodes, outside, at[~side[at]], percent)
        found = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held: list[pa.RecordBatch] = []  # of the block that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("tile", "i", "j")]
            same = np.ones(batch.num_rows, bool)
            for c, v in zip(("tile", "i", "j"), last, strict=True):
                same &= batch.column(c).to_numpy() == v
            begin = int(np.argmax(same))  # rows of a block lie together
            if begin:
                yield pairs(_joined([*held, batch.slice(0, begin)]))
                held = [batch.slice(begin)]
            else:
                if held and [held[0].column(c)[0].as_py() for c in ("tile", "i", "j")] != last:
                    yield pairs(_joined(held))
                    held = []
                held.append(batch)
        if held:
            yield pairs(_joined(held))
        give_back()

    by = ["tile", "i", "j"]
    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _exact_links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that reach the threshold, by intersecting sorted arrays,
    which are made again from the texts of just these documents."""
    pairs = stored(pairs, "jaccard-pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "jaccard-wanted")
    chosen = maybe_in(texts, fixed_filter(wanted, "doc_id"), "doc_id").join(wanted, "doc_id", "left_semi")
    sets = stored(_sets(chosen, width), "jaccard-arrays")
    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b").select("a", "b", "ha", "hb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (fa, oa), (fb, ob) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in batch.columns[2:])
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = fa[oa[i]:oa[i + 1]], fb[ob[i]:ob[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good))

    return full.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Two documents link when ``100 * overlap >= percent * union`` of their sets of
    ``width``-word shingles (A-Z lower-cased).  Documents without words (null and
    empty texts too) have size 0 and link with nothing.  Ids are integers; rows
    repeated with one id are one document, a row with a null id has a null component and
    links nothing.  An empty table gives an empty result.  Equality of shingles is
    that of their 64-bit hashes."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = stored(_digest_rows(texts, width), "jaccard-digests")
    same = stored(rows.filter("size > 0 and doc_id is not null").groupBy("size", "d1", "d2")
                  .agg(F.min("doc_id").alias("node")), "jaccard-sets")
    cell_bits = min(MAX_CELL_BITS, max(8, (same.count() // NODES_PER_CELL).bit_length()))
    # one text per set goes on (a few copies may pass the filter; the join below is exact)
    first = maybe_in(texts, fixed_filter(same, "node"), "doc_id")
    shared = fixed_filter(_shared_keys(first, width, percent, cell_bits), "key48")
    found = _tile_rows(first, width, percent, cell_bits, shared).drop("meets").withColumnRenamed("doc_id", "node")
    found = found.join(same.select("node", F.col("size").alias("own")).hint("merge"), "node") \
        .filter("size = own").drop("own").dropDuplicates(["node"])
    nodes = stored(found, "jaccard-nodes")
    small = nodes.drop("keys")

    tile = nodes.select("node", F.explode("keys").alias("tile"))
    tiles = stored(tile.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).filter("n > 1"),
                   "jaccard-tiles")
    members = stored(tile.join(tiles.hint("merge"), "tile").select("tile", "n", "node", "hub"), "jaccard-members")
    star = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    star = stored(star.join(_side(small, "a"), "a").join(_side(small, "b"), "b").select("a", "b", _may_link(percent).alias("may")),
                  "jaccard-star")
    links = stored(_exact_links(star.filter("may").select("a", "b"), texts, width, percent), "jaccard-links")
    label = components(links)

    # tiles of three or more may still hold pairs that the star did not compare
    named = stored(members.filter("n > 2").join(label, "node", "left")
                   .select("tile", "node", F.coalesce("comp", "node").alias("comp")), "jaccard-named")
    per = named.groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = stored(per.groupBy("tile").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("most"), F.sum("k").alias("n"))
                   .filter("comps > 1").select("tile", F.col("most.comp").alias("main"), "n", (F.col("n") - F.col("most.k")).alias("outer")), "jaccard-mixed")
    open_rows = stored(named.join(mixed.hint("merge"), "tile").join(small, "node"), "jaccard-open")
    # a pair across components has a side outside the tile's largest one, which is large only
    # where its members are linked: the nodes outside meet all, and each other once
    across = _across(open_rows, percent).distinct().join(star.select("a", "b"), ["a", "b"], "left_anti")
    across = stored(across, "jaccard-across")
    more = stored(_exact_links(across, texts, width, percent), "jaccard-more")
    if not more.isEmpty():
        label = components(links.union(more))
    owner = same.join(label, "node", "left").select("size", "d1", "d2", F.coalesce("comp", "node").alias("comp"))
    owner = stored(owner, "jaccard-owner")
    out = rows.join(owner.hint("merge"), ["size", "d1", "d2"], "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.when(F.col("size") > 0, F.col("comp")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("size").alias("n_shingles"), comp.alias("component_id"))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    fields = [T.StructField("hashes", T.ArrayType(T.LongType()))]

    def make():
        def fn(text: pa.Array) -> dict:
            flat, starts = shingle_sets(split_words(text, lower=True), width)
            return {"hashes": pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.view(np.int64)))}

        return fn

    return map_text(texts, "text", fields, make, keep=["doc_id"], chunk=SMALL_CHUNK).withColumnRenamed("doc_id", "node")


def one_per_component(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component (and rows without an id)."""
    named = jaccard_components(docs, width, percent, id_col, text_col)
    gone = named.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"].cast("long") == gone["__gone"], "left_anti")

"""Prefix trie of rebuilt conversations from composable fingerprints.

A run of turns has the fingerprint (B^length, sum of digest_j * B^j) modulo four primes
below 2^31; two runs compose as (L, s) (M, t) = (L M, s + L t), and L has an inverse, so the
fingerprint of a rebuilt conversation's prefix, head of its base and then its own suffix,
follows from prefix sums of the two conversations as they are stored.  No rebuilt text or turn
list is made.

* Turns are range-partitioned by (conversation, turn); every task sums its own part, and what a
  long conversation carries from one part into the next is composed from one row a part.
* A node is a group of equal (depth, fingerprint).  Equality is proved, not assumed: each member
  of a node refers to its stored last turn and its parent node; a node whose members refer to
  unequal ones, or two unequal turns with one digest, repeat the run with other digests and bases.  By
  induction over the depth, nodes without such a fault hold equal prefixes only.
* Sums over subtrees need no walk: a node belongs to its smallest member, the nodes of a member
  are the lower end of its path, and so leaves and words below a node are sums over its members.

Every step is a grouping with partial sums or an equi-join; the member ids that end in a node
are hashed from sorted pieces, of which no task holds more than one batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import small_batches, stored, text_or_empty

# fixed values: the four largest primes below 2^31
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BITS, MASK = 31, (1 << 31) - 1
GROUP = 20  # conversations from one multiple of this to the next share the first one's head
HEADS = 4  # heads have 0 to HEADS - 1 turns
WORD = r"[^\x20\x09-\x0D]+"
PIECE = 1 << 20  # characters of a piece of joined ids
ATTEMPTS = 5
NODE = ["depth", "f0", "f1"]


def bases(attempt: int) -> list[int]:
    """One base a prime, from the number of the attempt."""
    return [int.from_bytes(hashlib.sha256(f"trie {attempt} {k}".encode()).digest()[:8], "little") % (p - 2) + 2
            for k, p in enumerate(PRIMES)]


def turn_digest(role: Column, text: Column, attempt: int) -> Column:
    """16 bytes for role and text; another function of them for each attempt."""
    return F.unhex(F.md5(F.concat(F.lit("x" * attempt), F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def head_length(conv: Column) -> Column:
    """Turns of the base's head: by CRC-32 of the decimal id, none for a base itself."""
    drawn = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    return F.when(conv % GROUP == 0, 0).otherwise(drawn)


def _powers(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    out, square, rest = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.astype(np.uint64)
    p = np.uint64(prime)
    while rest.any():
        out = np.where(rest & np.uint64(1), out * square % p, out)
        square = square * square % p
        rest = rest >> np.uint64(1)
    return out


def _pack(sums: Sequence[np.ndarray]) -> list[pa.Array]:
    return [pa.array((sums[k] << np.uint64(BITS) | sums[k + 1]).astype(np.int64)) for k in (0, 2)]


def _scan(attempt: int):
    """Positions, fingerprints before and after each turn and words up to it, by conversation, of one
    range partition, as if nothing came before the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId(), bases(attempt)
        conv, n, words, sums = None, 0, 0, [0] * len(PRIMES)  # of the open conversation
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column("conv").to_numpy(zero_copy_only=False)
            w = batch.column("words").to_numpy(zero_copy_only=False)
            rows = np.arange(len(c))
            start = np.maximum.accumulate(np.where(np.r_[True, c[1:] != c[:-1]], rows, 0))
            goes_on = (start == 0) & (c[0] == conv)  # rows of the conversation left open
            pos = rows - start + np.where(goes_on, n, 0)
            total = np.cumsum(w)
            cum = total - (total - w)[start] + np.where(goes_on, words, 0)
            digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u4").reshape(-1, len(PRIMES)).astype(np.uint64)
            before, after = [], []
            for k, p in enumerate(PRIMES):
                term = (digest[:, k] % np.uint64(p - 1) + np.uint64(1)) * _powers(base[k], p, pos) % np.uint64(p)
                run_sum = np.cumsum(term)
                inside = run_sum - (run_sum - term)[start] + np.where(goes_on, np.uint64(sums[k]), np.uint64(0))
                after.append(inside % np.uint64(p))
                before.append((inside - term) % np.uint64(p))
            conv, n, words, sums = c[-1], int(pos[-1]) + 1, int(cum[-1]), [int(s[-1]) for s in after]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(c), part), pa.int32()), batch.column("conv"), pa.array(pos, pa.int64()), *_pack(before),
                 *_pack(after), batch.column("words"), pa.array(cum, pa.int64()), batch.column("digest")], names=SCANNED.names)
    return run


SCANNED = T.StructType([T.StructField("part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in (
    "conv", "pos", "e0", "e1", "p0", "p1", "words", "cum")], T.StructField("digest", T.BinaryType())])


def _halves(packed: Column) -> tuple[Column, Column]:
    return F.shiftright(packed, BITS), packed.bitwiseAND(F.lit(MASK))


def _composed(first: Sequence[Column], factors: Sequence[Column], second: Sequence[Column],
              less: Sequence[Column] | None = None) -> list[Column]:
    """``first + factors * (second - less)`` of packed fingerprints."""
    out = []
    for j in (0, 1):
        fs, ss = _halves(first[j]), _halves(second[j])
        ls = _halves(less[j]) if less else (F.lit(0), F.lit(0))
        a, b = (F.pmod(fs[i] + factors[2 * j + i] * F.pmod(ss[i] - ls[i], F.lit(PRIMES[2 * j + i])), F.lit(PRIMES[2 * j + i]))
                for i in (0, 1))
        out.append(F.shiftleft(a, BITS).bitwiseOR(b))
    return out


def _numbered_turns(turns: DataFrame, attempt: int) -> DataFrame:
    """``conv, pos, e0, e1, p0, p1, words, cum, digest`` of every turn: its place, the
    fingerprints of its conversation before and after it, its words and those up to it."""
    spark = turns.sparkSession
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = turns.select("conv", "turn", "words", turn_digest(F.col("role"), F.col("text"), attempt).alias("digest"),
                          F.monotonically_increasing_id().alias("row")) \
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = stored(ranged.select("conv", "words", "digest").mapInArrow(_scan(attempt), SCANNED), "trie-turns")
    # the last row of each part is what a conversation carries on; a row a part comes to the driver
    ends = sorted(local.groupBy("part").agg(F.max(F.struct("conv", "pos", "p0", "p1", "cum")).alias("end")).collect())
    base, carried, held = bases(attempt), [], None
    for part, end in ends:
        if held is not None:
            carried.append((part, *held, *[pow(b, held[1], p) for b, p in zip(base, PRIMES, strict=True)]))
        n, sums, cum = end["pos"] + 1, [end["p0"] >> BITS, end["p0"] & MASK, end["p1"] >> BITS, end["p1"] & MASK], end["cum"]
        if held is not None and held[0] == end["conv"]:
            before = [held[2] >> BITS, held[2] & MASK, held[3] >> BITS, held[3] & MASK]
            sums = [(x + pow(b, held[1], p) * s) % p for x, b, s, p in zip(before, base, sums, PRIMES, strict=True)]
            n, cum = n + held[1], cum + held[4]
        held = (end["conv"], n, sums[0] << BITS | sums[1], sums[2] << BITS | sums[3], cum)
    carry = spark.createDataFrame(carried, "part int, conv long, c_n long, c0 long, c1 long, c_cum long, l0 long, l1 long, l2 long, l3 long")
    joined = local.join(carry, ["part", "conv"], "left")
    first, factors = [F.coalesce("c0", F.lit(0)), F.coalesce("c1", F.lit(0))], [F.coalesce(f"l{k}", F.lit(1)) for k in range(4)]
    e, p = ([*_composed(first, factors, [F.col(f"{x}0"), F.col(f"{x}1")])] for x in "ep")
    return joined.select("conv", (F.col("pos") + F.coalesce("c_n", F.lit(0))).alias("pos"), e[0].alias("e0"), e[1].alias("e1"),
                         p[0].alias("p0"), p[1].alias("p1"), "words", (F.col("cum") + F.coalesce("c_cum", F.lit(0))).alias("cum"), "digest")


def _plans(numbered: DataFrame) -> DataFrame:
    """One row per conversation: its own head length ``h``, the base's turns it takes (``head``, at
    most three), what they compose to (``given``) and what is skipped of its own (``skipped``), and
    turns and words of the rebuilt conversation."""
    h = head_length(F.col("conv"))
    whole = numbered.groupBy("conv").agg(
        (F.max("pos") + 1).alias("own"), F.max("cum").alias("own_words"),
        F.max(F.when(F.col("pos") == h - 1, F.struct("p0", "p1", "cum"))).alias("skipped"))
    heads = numbered.filter((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("conv").alias("base")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "e0", "e1", "p0", "p1", "words", "cum", "digest"))).alias("turns"))
    based = whole.withColumn("h", h).withColumn("base", F.when(F.col("h") > 0, F.col("conv") - F.col("conv") % GROUP))
    taken = based.join(heads, "base", "left") \
        .withColumn("head", F.when((F.col("h") > 0) & F.col("turns").isNotNull(), F.slice("turns", 1, F.greatest("h", F.lit(1))))) \
        .withColumn("n_head", F.coalesce(F.array_size("head"), F.lit(0)))
    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("p0"), zero.alias("p1"), zero.alias("cum"))
    last = F.element_at("head", -1)
    given = F.coalesce(F.struct(last["p0"].alias("p0"), last["p1"].alias("p1"), last["cum"].alias("cum")), none)
    given = F.when(F.col("n_head") > 0, given).otherwise(none)
    left = F.col("own") > F.col("h")
    return taken.withColumn("given", given).withColumn("skipped", F.coalesce("skipped", none)).select(
        "conv", "h", "head", "n_head", "given", "skipped",
        (F.col("n_head") + F.when(left, F.col("own") - F.col("h")).otherwise(0)).alias("length"),
        (F.col("given.cum") + F.when(left, F.col("own_words") - F.col("skipped.cum")).otherwise(0)).alias("total"))


def _entries(numbered: DataFrame, plans: DataFrame, attempt: int) -> DataFrame:
    """One row per rebuilt conversation and turn: fingerprints up to the turn and up to its parent, a
    reference to the turn (its digest) and its words, and the words up to it."""
    inverse = [[pow(b, -k, p) for k in range(HEADS)] for b, p in zip(bases(attempt), PRIMES, strict=True)]
    shift = F.col("h") - F.col("n_head") + 1  # own turns move up where the base had fewer turns
    factors = [F.element_at(F.array(*[F.lit(v).cast("long") for v in row]), shift) for row in inverse]
    own = numbered.join(plans.drop("head"), "conv").filter(F.col("pos") >= F.col("h"))
    first, less = [F.col("given.p0"), F.col("given.p1")], [F.col("skipped.p0"), F.col("skipped.p1")]
    p, e = (_composed(first, factors, [F.col(f"{x}0"), F.col(f"{x}1")], less) for x in "pe")
    depth = F.col("n_head") + F.col("pos") - F.col("h") + 1
    tail = own.select("conv", depth.cast("long").alias("depth"), p[0].alias("f0"), p[1].alias("f1"), e[0].alias("u0"), e[1].alias("u1"),
                      "digest", "words", (F.col("given.cum") + F.col("cum") - F.col("skipped.cum")).alias("cum"), "length", "total")
    head = plans.filter("n_head > 0").select("conv", "length", "total", F.explode("head").alias("t")).select(
        "conv", (F.col("t.pos") + 1).alias("depth"), F.col("t.p0").alias("f0"), F.col("t.p1").alias("f1"), F.col("t.e0").alias("u0"),
        F.col("t.e1").alias("u1"), F.col("t.digest").alias("digest"), F.col("t.words").alias("words"), F.col("t.cum").alias("cum"), "length", "total")
    return head.unionByName(tail)


def _unequal_turns(turns: DataFrame, numbered: DataFrame, attempt: int) -> bool:
    """Do two turns with one digest differ?  Only texts of digests that occur again are compared."""
    again = numbered.groupBy("digest").count().filter("count > 1").select("digest")
    texts = turns.select(turn_digest(F.col("role"), F.col("text"), attempt).alias("digest"), F.struct("role", "text").alias("t"))
    found = texts.join(again, "digest", "left_semi").groupBy("digest").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return not found.filter("a <> b").isEmpty()


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the joined ascending ids of each group in ``ends(depth, f0, f1, conv)``."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Joined ids of each run of equal groups, cut at about ``PIECE`` characters."""
        key, first, held, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (*key, first)] + [pa.array([",".join(held)])],
                                              names=[*NODE, "first", "ids"])
        for batch in batches:
            done: list[pa.RecordBatch] = []
            for *k, c in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if k != key or size > PIECE:
                    if held:
                        done.append(piece())
                    key, first, held, size = k, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if held:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def result(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3])], names=[*NODE, "ends_sha256"])
        for batch in batches:
            done = []
            for *k, ids in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if state:
                        done.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield result(done)
        if state:
            yield result([(*key, state.hexdigest())])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col(c) for c in NODE]
    cut = ends.select(*NODE, "conv").repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv") \
        .mapInArrow(pieces, "depth long, f0 long, f1 long, first long, ids string")
    return cut.repartition(parts, *key).sortWithinPartitions(*key, "first").select(*NODE, "ids") \
        .mapInArrow(hashed, "depth long, f0 long, f1 long, ends_sha256 string")


def _checked(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plans, entries and nodes of the first attempt in which every node was proved."""
    for attempt in range(ATTEMPTS):
        numbered = _numbered_turns(turns, attempt)
        plans = stored(_plans(numbered), "trie-plans")
        entries = stored(_entries(numbered, plans, attempt), "trie-entries")
        last = F.struct("u0", "u1", "digest")  # the parent and the turn that a member refers to
        nodes = stored(entries.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("words").alias("words"),
            F.min(last).alias("a"), F.max(last).alias("b")).select(
                *NODE, "n_convs", "conv", "words", "a.u0", "a.u1", (F.col("a") == F.col("b")).alias("proved")), "trie-nodes")
        if nodes.filter("not proved").isEmpty() and not _unequal_turns(turns, numbered, attempt):
            return plans, entries, nodes
    raise ArithmeticError("fingerprints collide in every attempt")


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversation c is the first ``head_length(c)`` turns of conversation c - c % 20 (all, if it has fewer;
    none, if there is none) and then its own turns after as many.  Turns go by number, null first; equal numbers
    by the digest of role and text, and repeated rows are turns of their own.  Null roles and texts
    are empty.  Rows without a conversation id belong to no conversation and are left out.  Texts of any length
    are read whole.  An empty table gives an empty result; other columns are ignored."""
    small_batches(df.sparkSession)
    text = text_or_empty(F.col(f"`{text_col}`"))
    turns = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                      text_or_empty(F.col(f"`{role_col}`")).alias("role"), text.alias("text"),
                      F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).filter("conv IS NOT NULL")
    plans, entries, nodes = _checked(turns)
    by_parent = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("u0").alias("f0"), F.col("u1").alias("f1")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.drop("proved").join(by_parent, NODE, "left")
                   .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    # the nodes of an owner are the lower end of its path, from its top node to its last turn
    owners = stored(nodes.groupBy("conv").agg(
        F.sum("words").alias("owned_words"), F.sum((F.col("n_convs") == 1).cast("long")).alias("alone"),
        F.max(F.struct("depth", "n_children")).alias("end"), F.min(F.struct("depth", "u0", "u1")).alias("top"))
        .withColumn("leaf", F.col("end.n_children") == 0), "trie-owners")
    # below a node with one member there is nothing to sum
    shared = entries.join(owners.select("conv", "owned_words", "alone", "leaf"), "conv", "left") \
        .filter(F.col("depth") <= F.col("length") - F.coalesce("alone", F.lit(0)))
    # each member has its words below the node, each owner those of its own nodes: the difference is saved
    others = F.col("total") - F.coalesce("owned_words", F.lit(0)) - (F.col("cum") - F.col("words"))
    sums = shared.groupBy(*NODE).agg(F.sum(F.coalesce("leaf", F.lit(False)).cast("long")).alias("n_leaves"),
                                     F.sum(F.greatest(others, F.lit(0))).alias("saved_tokens"))
    top_of_all = [F.lit(0).cast("long").alias(c) for c in NODE]
    ends = stored(_hashed_ends(entries.filter("depth = length").select(*NODE, "conv")
                               .unionByName(plans.filter("length = 0").select(*top_of_all, "conv"))), "trie-ends")
    # the parent of an owner's top node belongs to another, all its other nodes follow one of its own
    tops = owners.filter("top.depth > 1").select(F.col("conv").alias("child"), (F.col("top.depth") - 1).alias("depth"),
                                                 F.col("top.u0").alias("f0"), F.col("top.u1").alias("f1"))
    parents = tops.join(nodes.select(*NODE, "conv"), NODE).select(
        F.col("child").alias("conv"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("upper"))
    nothing = hashlib.sha256(b"").hexdigest()
    root = _root(plans, nodes, owners, ends, nothing)
    facts = nodes.join(sums, NODE, "left").join(ends, NODE, "left").join(parents, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == 1, F.lit(root[0] if root else None)).otherwise(F.coalesce("upper", "conv")).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
    return facts.unionByName(df.sparkSession.createDataFrame([root] if root else [], facts.schema))


def _root(plans: DataFrame, nodes: DataFrame, owners: DataFrame, ends: DataFrame, nothing: str) -> tuple | None:
    """The row of the root; None without conversations."""
    whole = plans.agg(F.count(F.lit(1)), F.min("conv")).first()
    if not whole[0]:
        return None
    below = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)), F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("words")), F.lit(0))).first()
    leaves = owners.filter("leaf").count() if below[0] else 1
    ended = ends.filter("depth = 0").first()
    return whole[1], 0, None, whole[0], below[0], leaves, below[1], ended["ends_sha256"] if ended else nothing

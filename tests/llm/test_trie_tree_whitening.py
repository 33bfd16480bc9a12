"""Prefix trie, hash tree and whitening against brute force, with the odd rows each must bear."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.llm import bidiagonal, hash_tree, prefix_trie, whitening

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, depth string, conv long, part int, words string"


def plain_trie(rows: list[tuple]) -> list[tuple]:
    """Nodes by rebuilding every conversation as a list of turns."""
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [v[3:] for v in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        over = abs(c) % 20 * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - over, [])[:h] + turns[h:]
    nodes = collections.defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].add(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        w = len(WORDS.findall(k[-1][1].encode())) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members) - 1) * w
    ends = {k: ",".join(map(str, sorted(c for c in m if len(full[c]) == len(k)))) for k, m in nodes.items()}
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in nodes.items()), key=lambda r: r[:2])


def conversations() -> list[tuple]:
    rng = random.Random(1)
    rows = []
    for c in [*range(-25, 60), 1000, 1007, 2005]:
        if c == 20:  # its followers have no base
            continue
        for turn in range(rng.choice([1, 2, 3, 4, 6]) if c != 1007 else 150):
            rows.append((c, rng.choice([None, turn, turn, turn, 1]), rng.choice(["user", "assistant", None, ""]),
                         rng.choice(["a b", "a b", "héllo wörld x", None, "", f"u{rng.randint(0, 3)} z"])))
    rows += [(None, 1, "a", "b"), (70, 1, "user", "long " * 700_000), *rows[:5]]
    rows += [(c, i, "u", "same text here") for c in range(3000, 3030) for i in range(3)]
    return [(*r, "x", 1, 2, "w") for r in rows]


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame(conversations(), TURNS).repartition(5)


def test_trie_equals_plain_version(talks):
    assert found(prefix_trie.prefix_trie(talks)) == plain_trie(conversations())


def test_trie_empty_and_single(spark):
    assert found(prefix_trie.prefix_trie(spark.createDataFrame([], TURNS))) == []
    turnless = [(1, 0, "u", "x", "", 0, 0, "")]  # head length 3, no base
    assert zlib.crc32(b"1") % 4 == 3
    got = found(prefix_trie.prefix_trie(spark.createDataFrame(turnless, TURNS)))
    assert got == plain_trie(turnless) and got[0][:6] == (1, 0, None, 1, 0, 1)


def test_trie_repeats_on_colliding_digests(spark, monkeypatch):
    rows = [r for r in conversations() if r[0] is not None and 0 <= r[0] < 30]
    whole, seen = prefix_trie.turn_digest, []

    def weak(role, text, attempt):
        seen.append(attempt)
        return whole(role, F.lit("") if attempt == 0 else text, attempt)

    monkeypatch.setattr(prefix_trie, "turn_digest", weak)
    rows = [(c, i, r, x, *rest) for i, (c, _, r, x, *rest) in enumerate(rows)]  # no ties, whose order is by digest
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)
    assert set(seen) == {0, 1}


def test_trie_repeats_on_colliding_fingerprints(spark, monkeypatch):
    rows = [(c, i, r, x, *rest) for i, (c, _, r, x, *rest) in enumerate(conversations()) if c is not None and 0 <= c < 30]
    whole, seen = prefix_trie.bases, []

    def weak(attempt):
        seen.append(attempt)
        return [0] * 4 if attempt == 0 else whole(attempt)  # only the first turn counts

    monkeypatch.setattr(prefix_trie, "bases", weak)
    monkeypatch.setattr(prefix_trie, "pow", lambda b, e, p: pow(b or 1, e, p), raising=False)
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)
    assert set(seen) == {0, 1}


def test_trie_pieces_of_long_member_lists(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    rows = [(20 * c, 0, "u", "same", "", 0, 0, "") for c in range(300)]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(4))) == plain_trie(rows)


DOCS = "doc_id long, text string, shard string, slot string, row int, mixed int, size string"


def dealt(spark, leaves, ids) -> dict:
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    return {r["doc_id"]: r["shard"] for r in hash_tree.deal(df, leaves).collect()}


def test_shards_are_numbered(spark):
    texts = [None, "", "ä" * 50, "日本語 text", "x" * (9 << 20)]
    rows = [(i, texts[i % 5] if i < 40 else f"t{i}", "s", "t", 1, 2, "z") for i in range(600)]
    rows += [rows[7]] * 400 + [(None, "null id", "s", "t", 1, 2, "z")] * 30
    tree = hash_tree.even_tree(8)
    got = hash_tree.numbered(spark.createDataFrame(rows, DOCS).repartition(6), tree).collect()
    plain = lambda t: (t or "").encode()
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) \
        == collections.Counter((i, len(plain(t)) + 1, zlib.crc32(plain(t))) for i, t, *_ in rows)
    by_shard, homes = collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
        homes[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert set(by_shard) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(h) == 1 and (a == b or b == 8) for h in homes.values() for a, b in h)
    assert 0.05 < np.mean([b == 8 for h in homes.values() for _, b in h]) < 0.2
    assert hash_tree.numbered(spark.createDataFrame([], DOCS), tree).collect() == []


def test_shards_follow_weights_and_subtrees(spark):
    ids = range(20_000)
    tree = [("a", "p", "0", 3.0), ("a", "p", "1", 1.0), ("a", "q", "2", 2.0), ("b", "p", "3", 2.0), ("b", "q", "4", 0.0)]
    before = dealt(spark, tree, ids)
    share = collections.Counter(before.values())
    assert [round(share[k] / len(ids), 2) for k in range(5)] == pytest.approx([.375, .125, .25, .25, 0], abs=0.015)
    more = [*tree[:1], ("a", "p", "1", 3.0), *tree[2:]]  # one shard of rack a/p gains
    after = dealt(spark, more, ids)
    moved = {(before[i], after[i]) for i in ids if before[i] != after[i]}
    # into region a from outside, into rack a/p from a/q, into shard 1 from its rack: nothing else moves
    assert moved == {(0, 1), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)}
    grown = dealt(spark, hash_tree.grown(tree, 2.0), ids)
    assert {grown[i] for i in ids if grown[i] != before[i]} == {5}
    with pytest.raises(ValueError):
        hash_tree.children([("a", "p", "0", 0.0)])


def test_shards_are_written(spark, tmp_path):
    rows = [(i, f"t{i}", "s", "t", 1, 2, "z") for i in range(200)]
    path = str(tmp_path / "shards")
    docs = spark.createDataFrame(rows, DOCS).drop("shard")
    hash_tree.write_shards(docs, hash_tree.even_tree(3), path)
    back = spark.read.parquet(path)
    assert sorted(r["doc_id"] for r in back.collect()) == list(range(200))
    want = {r["doc_id"]: r["shard"] for r in hash_tree.deal(docs, hash_tree.even_tree(3)).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == want


def square(rng, kind: str, d: int) -> np.ndarray:
    u, v = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in "uv")
    spectrum = {"plain": np.arange(d, 0, -1.0), "ties": np.repeat([5.0, 3.0, 1.0], [d // 3, d // 3, d - 2 * (d // 3)]),
                "close": 1 + 1e-6 * np.arange(d), "graded": 10.0 ** -np.arange(d), "rank": np.r_[np.ones(3), np.zeros(d - 3)]}[kind]
    return u @ np.diag(spectrum) @ v.T


@pytest.mark.parametrize("kind", ["plain", "ties", "close", "graded", "rank"])
@pytest.mark.parametrize("d", [3, 17, 64])
def test_bidiagonal_solver(kind, d):
    r = square(np.random.default_rng(d), kind, d)
    values, z = bidiagonal.right_singular(r, d)
    top = values[0]
    assert np.abs(values - np.linalg.svd(r, compute_uv=False) ** 2).max() < 1e-13 * top
    assert np.abs(r.T @ (r @ z) - z * values).max() < 1e-13 * top
    assert np.abs(z.T @ z - np.eye(d))[:, values > 1e-12 * top][values > 1e-12 * top].max() < 1e-9


def test_bidiagonal_small():
    assert bidiagonal.right_singular(np.array([[3.0]]), 8)[0].tolist() == [9.0]
    assert bidiagonal.right_singular(np.zeros((4, 4)), 8)[0].tolist() == [0.0] * 4


VECTORS = "vec_id long, embedding array<float>, n string, component string, id int, v string, label int"


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    c = (rng.normal(size=(900, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    c[200:500] = c[0]  # a third of the rows are copies
    rows = [(i, [float(x) for x in v], "n", "c", 1, "v", 0) for i, v in enumerate(c)]
    odd = [None, [], [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0] * 5, [1e30] * 12]
    rows += [(2000 + i, v, "n", "c", 1, "v", 0) for i, v in enumerate(odd)] + [(None, rows[3][1], "", "", 0, "", 0), rows[4]]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(7)).collect()
    good = [(r[0], r[1]) for r in rows if r[1] and len(r[1]) == 12 and r[0] not in range(2000, 2100)]
    x = np.floor(1024 * np.array([v for _, v in good])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    at = collections.defaultdict(list)
    for (i, _), w, dev in zip(good, want, ((n * x - sums) ** 2).sum(axis=1), strict=True):
        at[i].append((w, int(dev)))
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    signs = {}
    for r in got:
        w, dev = at[r["vec_id"]][0]
        assert int(r["deviation"]) == dev
        k = r["component"] - 1
        sign = signs.setdefault(k, np.sign(w[k] * r["whitened"]))
        assert r["whitened"] == pytest.approx(sign * w[k], abs=1e-9)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-10)
        assert r["identity_error"] < 1e-10


def test_whitening_exact_beyond_64_bits(spark):
    # entries of 2^42 make n * x - sums and its square larger than 64 bits
    c = [[2.0 ** 42, 1.0], [0.0, 2.0], [-2.0 ** 42, 5.0], [3.0, -2.0 ** 41]] * 200
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(c)], "vec_id long, embedding array<double>")).collect()
    x = [[int(v * 1024 // 1) + 100_000 for v in row] for row in c]
    sums = [sum(col) for col in zip(*x, strict=True)]
    for r in got:
        assert int(r["deviation"]) == sum((len(x) * v - s) ** 2 for v, s in zip(x[r["vec_id"]], sums, strict=True))
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-10


def test_whitening_without_variance(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None]):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
        assert whitening.whiten(df).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1.0)


def test_whitening_merges_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 40)
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(300)], "vec_id long, embedding array<double>").repartition(9)
    got = whitening.whiten(df, components=3).collect()
    assert len(got) == 900 and max(r["identity_error"] for r in got) < 1e-10

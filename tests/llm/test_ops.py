"""Operators against brute force on small tables, with the odd rows each must bear."""

from __future__ import annotations

import collections
import hashlib
import json
import math
import pathlib
import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import (bloom_lm, bpe_count, components, decontam, jaccard_join, lang_id, licenses, ordinal, packing,
                        radix_dedup, warc)

BPE = public_tokenizers.path("word_bpe_49k.json")
BLANK = re.compile(r"[\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# documents with a clashing extra column per operator's own output names
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("n", T.LongType()),
                     T.StructField("size", T.StringType()), T.StructField("keep", T.StringType()),
                     T.StructField("grp", T.StringType())])


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(n))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 4, 5, 40, 200, 900)]
    long = prose(rng, 9000)
    texts = [None, "", "  \t\n", *base, base[3], base[3].replace(" ", "  "), base[3].upper(), base[4] + " extra",
             base[5].replace("a", "b", 3), long, long, "Ünïcode naïve ǅ ﬁ Σ ΑΣ İ é é  x y", "x" * 500, "aaaa " * 50,
             "it's we'll 12345 !!! <|endoftext|> a<|startoftext|>b", "日本語のテキスト", "\x1c\x1d\x00 nul"]
    rows = [(i, t, None, 1, "s", "k", "g") for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, base[3], None, None, None, None, None), (None, None, None, None, None, None, None),
            (-4, base[4], "en", 0, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_groups(odd, empty):
    norm = lambda t: BLANK.sub("", t or "")
    groups = collections.defaultdict(list)
    for r in odd_rows():
        groups[norm(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] if r[0] is not None else 0))
    rows = radix_dedup.exact_groups(odd).collect()
    assert len(rows) == len(odd_rows())
    want = collections.Counter()
    for r in odd_rows():
        best = min(groups[norm(r[1])])
        want[(r[0], None if best[1] else best[2], len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert radix_dedup.exact_groups(empty).count() == 0
    kept = radix_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)


def test_radix_levels_agree_on_long_common_prefixes(spark):
    stem = "p" * 70 + "q" * 2000
    texts = [stem + "a", stem + "b", stem + "a", stem, "p" * 64, "p" * 64, "p" * 63, stem[:1088] + "x", stem[:1088] + "y"]
    rows = radix_dedup.exact_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {i: texts.index(t) for i, t in enumerate(texts)}


def test_token_counts_equal_the_library(odd, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    want = collections.Counter((r[0], len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows())
    rows = bpe_count.token_counts(odd, BPE, limit=100).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)
    assert bpe_count.token_counts(empty, BPE).count() == 0


def test_array_merging_on_random_words():
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_file(BPE), random.Random(3)
    words = ["".join(rng.choice("theanrsaaé漢'1!") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    counter = bpe_count.WordCounter(bpe_count.load_merge_table(BPE))
    got = counter.counts(words)
    assert got.tolist() == [len(e.ids) for e in tok.encode_batch(words, add_special_tokens=False)]


def test_words_go_to_the_tokenizer_many_to_a_text():
    with open(BPE, encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    inner, seen = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, add_special_tokens):
            seen.append(len(texts))
            return inner.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder.tokenizer = Counting()
    rng = random.Random(5)
    plain = ["".join(rng.choices("abcXYZ'09.,-\u00e9\u4e2d\u0308<|>", k=rng.randint(1, 9))) + str(i) for i in range(3000)]
    odd = ["a\x01b", "\x01", "\x02", "<|endoftext|>", "x<|startoftext|>y", "\u00a0", "don't", "\u0308e", "\u2028"]
    for words, most in ((plain, 3000 // packing.TEXT_WORDS), (odd, len(odd)), (odd[2:], 1)):
        del seen[:]
        flat, size = encoder.word_ids(words)
        assert sum(seen) <= most and len(size) == len(words)
        assert [p.tolist() for p in np.split(flat, np.cumsum(size)[:-1])] == [inner.encode(w, add_special_tokens=False).ids for w in words]
    encoder.mark = None
    assert [a.tolist() for a in encoder.word_ids(odd)] == [a.tolist() for a in (np.concatenate(
        [np.array(inner.encode(w, add_special_tokens=False).ids, np.uint32) for w in odd]), np.array([len(inner.encode(w, add_special_tokens=False).ids) for w in odd]))]


def test_parts_of_words_are_remembered_not_words():
    with open(BPE, encoding="utf-8") as f:
        spec = f.read()
    encoder = packing.Encoder(spec)
    tok, rng = encoder.tokenizer, random.Random(7)

    def same(texts):
        got = dict(encoder.encode(pa.array(texts, pa.string())))
        assert [got[i].tolist() for i in range(len(texts))] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]

    same(["Haus haus, HAUS!! (haus)", None, "\u00c9T\u00c9 \u00e9t\u00e9.,", " 2 haus22"])
    assert set(encoder.memo) == {"haus", ",", "!!", "(", ")", "\u00e9t\u00e9", ".,", "2"}
    for alphabet in ("".join(map(chr, [*range(1, 0x180), 0x308, 0x4e2d, 0x2028])), "aB'\u00c9\u00df\u00d7\u00f7\u00ff1.,<>| s", "</w> ab", "\u00c0Z "):
        same(["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(1000)])
    same(["<|endoftext|>", "a<|startoftext|>.", "don't it's .'s 's", "\x01", "", None, "x" * 70000 + " y" * 250000, "z"])
    other = json.loads(spec)  # a file that splits in another way: every word is one part
    other["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": r"[\p{L}]{1,2}|[^\s]"}
    encoder = packing.Encoder(json.dumps(other))
    tok = encoder.tokenizer
    same(["Haus haus, 22", "\u00e9t\u00e9. abc"])
    assert set(encoder.memo) == {"Haus", "haus,", "22", "\u00e9t\u00e9.", "abc"}


def check_packing(docs, rows, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    want, total = collections.Counter(), 0
    for r in docs:
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), capacity)):
            want[(r[0], k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins), -(-total // capacity)


def test_pack(odd, empty):
    for capacity in (64, 4096):
        used, bound = check_packing(odd_rows(), packing.pack(odd, BPE, capacity=capacity).collect(), capacity)
        assert used <= bound + 2
    assert packing.pack(empty, BPE).count() == 0


def test_fullest_is_optimal():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        room = rng.randint(1, 100)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
        used = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert all(used[k] <= counts[k] for k in used) and sum(k * n for k, n in used.items()) == max(sums)


def test_plan_bins_places_every_piece_once():
    rng = random.Random(2)
    hist = {rng.randint(1, 512): rng.randint(1, 2000) for _ in range(120)}
    runs = packing.plan_bins(hist, 512)
    fill = collections.Counter()
    for r in runs:
        for b in (r.bin0, r.bin0 + r.bins - 1):
            fill[b] += 0
        fill.update({r.bin0: r.each * r.length})
    for length, n in hist.items():
        mine = sorted((r.first, r.each * r.bins) for r in runs if r.length == length)
        at = 0
        for first, k in mine:
            assert first == at
            at += k
        assert at == n
    assert max(fill.values()) <= 512


def lm_brute(rows, mod):
    toks = [(r[0], (r[1] or "").encode().translate(LOWER).split() + [None]) for r in rows]
    train = [w for i, w in toks if i is not None and zlib.crc32(str(i).encode()) % mod]
    c, pairs = collections.Counter(), collections.Counter()
    for w in train:
        c.update(w)
        pairs.update(zip([None, *w[:-1]], w, strict=True))
    return toks, c, pairs


def test_language_model(odd, empty, spark):
    toks, c, pairs = lm_brute(odd_rows(), 4)
    n, v = sum(c.values()), len(c)
    p0 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    want = collections.Counter((i, len(w), sum(x in c for x in w), round(sum(math.log10(p0(x)) for x in w), 4)) for i, w in toks)
    rows = bloom_lm.score_texts(odd, held_out_mod=4).collect()
    assert {r.train_tokens for r in rows} == {n}
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == want
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 0) for r in rows)
    # several passes over blocks of words give the same sums
    again = bloom_lm.score_texts(odd, held_out_mod=4, max_broadcast=60_000).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    for a, b in zip(sorted(rows, key=key), sorted(again, key=key), strict=True):
        assert (a.doc_id, a.n_tokens, a.n_known) == (b.doc_id, b.n_tokens, b.n_known)
        assert abs(a.score - b.score) < 1e-6 * (1 + abs(a.score)) and abs(a.base_score - b.base_score) < 1e-6 * (1 + abs(a.base_score))
    # the model's score, with counts read at the foot of their level: false positives only raise it
    for (_, w), r in zip(sorted(toks, key=lambda x: (x[0] is None, x[0] or 0, len(x[1]))), sorted(rows, key=key), strict=True):
        exact = 0.0
        for a, b in zip([None, *w[:-1]], w, strict=True):
            low = float(bloom_lm.count_of(bloom_lm.level_of(np.array([pairs[a, b]])))[0])
            exact += math.log10((low + bloom_lm.MU * p0(b)) / (c[a] + bloom_lm.MU) if c[a] else p0(b))
        assert exact - 1e-6 * (1 + abs(exact)) <= r.score <= exact + 0.05 * len(w) + 1e-6
    assert bloom_lm.score_texts(empty).count() == 0
    none = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert bloom_lm.score_texts(none).first().base_score == 0


def test_count_levels():
    c = np.arange(0, 5000)
    foot = bloom_lm.count_of(bloom_lm.level_of(c))
    assert (foot <= c).all() and (foot >= c / math.sqrt(2) - 1).all() and foot[:4].tolist() == [0, 1, 2, 3]


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_corpus(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        words = prose(rng, rng.choice([3, 6, 30, 120, 400])).split()
        for _ in range(rng.choice([1, 2, 9])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
            rows.append(" ".join(w))
    line = prose(rng, 60)
    rows += [line + " " + prose(rng, rng.choice([2, 8, 300])) for _ in range(25)]
    rng.shuffle(rows)
    return list(enumerate([*rows, "", None, "one two", "one two", "ONE two"]))


@pytest.mark.parametrize(("width", "percent", "seed"), [(4, 85, 1), (5, 80, 2)])
def test_jaccard_components(spark, width, percent, seed):
    rows = near_corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x")).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, width, percent).collect()}
    assert got == brute_components(rows, width, percent)


def test_jaccard_odd_rows(odd, empty):
    got = jaccard_join.jaccard_components(odd, 4, 85).collect()
    assert len(got) == len(odd_rows())
    assert all(r.component_id is None for r in got if r.doc_id is None)
    want = brute_components([(r[0], r[1]) for r in odd_rows() if r[0] is not None], 4, 85)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert jaccard_join.jaccard_components(empty, 4, 85).count() == 0
    left = jaccard_join.one_per_component(odd, 4, 85)
    assert left.columns == odd.columns


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)] + [(7, 7)]
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100}


def test_parity_bound_never_understates():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 400, 200, dtype=np.uint64)) for _ in range(2))
        a, b = jaccard_join.mix64(a), jaccard_join.mix64(b)
        differ = sum((int(x) & (2 ** 64 - 1)).bit_count() for x in jaccard_join.parity_bitmap(a) ^ jaccard_join.parity_bitmap(b))
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) / 2


@pytest.mark.parametrize("percent", [80, 85])
def test_partners_share_a_segment(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        n = int(rng.integers(1, 120)) if rng.random() < 0.7 else int(rng.integers(120, 1500))
        a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        drop, add = (int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1)) for _ in range(2))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2 ** 63, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < percent * (len(a) + len(b) - both):
            continue
        keys, owner = jaccard_join.segment_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), percent)
        assert len(np.intersect1d(keys[owner == 0], keys[owner == 1]))


def pages(spark):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "http://www.B.com:80/x#f", big), (2, "https://a.b.com/", big), (3, None, "s"), (4, "u v\r\nw", "s"), (5, "http://c.org", other),
            (6, "http://c.org", None), (7, "http://c.org", "WARC/1.1\r\n\r\n" * 200), (8, "http://c.org", "WARC/1.1\r\n\r\n" * 200),
            (8, "http://c.org", "WARC/1.1\r\n\r\n" * 200), (None, "http://d.org", other), (9, "http://c.org", "y" * 3_000_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n", F.lit("clash"))


def test_warc_round_trip(spark):
    rows, df = pages(spark)
    got = warc.capture_index(df.withColumn("at", F.col("page_id").cast("timestamp")), time_col="at").collect()
    newest = {}
    for i, _, h in rows:
        if i is not None:
            newest[h or ""] = max(i, newest.get(h or "", i))
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and newest[h or ""] != i
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", newest[h or ""] if again else None)] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    in_order = sorted(got, key=lambda r: (r.shard, r.place))
    keys = [(r.url_key, r.captured_at, -1 if r.page_id is None else r.page_id) for r in in_order]
    assert keys == sorted(keys)
    assert {r.url_key for r in got if r.page_id == 1} == {"com,b)/x"}
    assert warc.capture_index(df.limit(0)).count() == 0


def test_merge_over_several_shards(spark):
    rows = [(f"k{i % 7}", f"{i % 13:02d}", "u", f"a{i % 5}", i, 1, i, 1, "d", "response", None) for i in range(500)]
    runs = collections.defaultdict(list)
    for r in sorted(rows, key=warc._order):
        runs[r[3]].append(r)
    df = spark.createDataFrame([(*r, n) for run in runs.values() for n, r in enumerate(run)],
                               T.StructType([*warc.INDEX_SCHEMA.fields, T.StructField("nth", T.LongType())]))
    got = sorted(warc.merge_runs(df, per_partition=80).collect(), key=lambda r: (r.shard, r.place))
    assert len({r.shard for r in got}) > 3
    assert [(r.url_key, r.captured_at, r.page_id) for r in got] == [warc._order(r)[:3] for r in sorted(rows, key=warc._order)]


def test_loser_tree():
    rng = random.Random(9)
    for k in range(1, 9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree([[(x, x) for x in r] for r in runs])) == sorted(x for r in runs for x in r)


def test_archives_without_their_end_are_refused():
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.RecordReader(iter([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"])))


def test_decontamination(spark, odd, empty):
    rng = random.Random(4)
    items = [prose(rng, n) for n in (14, 30, 60, 9, 8)]
    words = items[1].split()
    for k in (3, 9, 15, 21, 27):
        words[k] = "other"
    docs = [prose(rng, 50) + " " + items[0] + " " + prose(rng, 10), " ".join(words).upper().replace(" ", "!! "), prose(rng, 300),
            "x " + items[2][10:-60] + " y", items[3], items[4], " ".join(items[1].split()[:11]), " ".join(reversed(items[2].split())), None, "",
            items[0] + " " + items[1]]
    bench = spark.createDataFrame([*enumerate(items), (None, items[0]), (9, None), (10, "")], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    for block_bytes in (1 << 20, 150):
        found = decontam.mark_overlaps(df, bench, block_bytes=block_bytes)
        assert found.columns == [*df.columns, "spans"]
        got = {r.doc_id: sorted(s.item_id for s in r.spans) for r in found.collect()}
        assert got == {0: [0], 1: [1], 2: [], 3: [2], 4: [3], 5: [4], 6: [], 7: [], 8: [], 9: [], 10: [0, 1]}
    assert decontam.drop_contaminated(odd, bench).count() == len(odd_rows())
    assert decontam.drop_contaminated(empty, bench).count() == 0
    assert decontam.drop_contaminated(df, bench.limit(0)).count() == len(docs)


def test_short_and_unspaced_items_are_found():
    short = [" ".join(f"w{n}x{j}" for j in range(n)) for n in range(1, 9)]
    chinese = "今天天气很好我们去公园散步然后回家吃饭看书睡觉"
    items = [*short, chinese, "猫坐在垫子上", "ภาษาไทยไม่มีช่องว่างระหว่างคำ"]
    docs = [f"before {t} after" for t in short] + [f"他说{chinese}。", "标题：猫坐在垫子上！", "ก" + items[10] + "ข", "w8x0 w8x1 w8x2 other", chinese[::-1]]
    changed = chinese[:4] + "错" + chinese[5:]
    seeds = decontam.seed_table(list(range(len(items))), items)
    got = [[s[0] for s in f] for f in decontam.find_overlaps(seeds, *decontam.plain_words(pa.array([*docs, changed])), 12, 0.75)]
    assert got == [[i] for i in range(11)] + [[], [], [8]]


def test_overlaps_equal_a_scan_of_all_diagonals():
    rng = random.Random(8)
    items = [prose(rng, rng.randint(12, 40)).split() for _ in range(10)]
    texts = []
    for _ in range(60):
        w = prose(rng, 30).split()
        src = rng.choice(items)
        cut = [x if rng.random() > 0.12 else "qq" for x in src]
        texts.append(w[:10] + cut + w[10:])
    seeds = decontam.seed_table(list(range(len(items))), [" ".join(x) for x in items])
    got = decontam.find_overlaps(seeds, *decontam.plain_words(pa.array([" ".join(t) for t in texts])), 12, 0.75)
    missed = 0
    for t, found in zip(texts, got, strict=True):
        want = set()
        for i, item in enumerate(items):
            for shift in range(-len(item) + 1, len(t)):
                lo, hi = max(0, shift), min(len(t), shift + len(item))
                equal = np.array(t[lo:hi], object) == np.array(item[lo - shift:hi - shift], object)
                s, e = decontam.best_run(equal, 0.75)
                if e - s >= min(12, len(item)):
                    want.add(i)
        assert {f[0] for f in found} <= want
        missed += len(want - {f[0] for f in found})
    assert missed <= 1  # a seed of six equal places is needed


def test_every_long_enough_run_with_the_share_is_an_overlap():
    """Against an enumeration of all windows."""
    rng = random.Random(12)
    lost = 0
    for _ in range(300):
        n = rng.choice((9, 12, 15, 20, 40))
        item = [f"w{i}" for i in range(n)]
        doc = [w if rng.random() > 0.2 else "qq" for w in item]
        equal = [a == b for a, b in zip(doc, item, strict=True)]
        windows = [(e - s, s) for s in range(n) for e in range(s + 1, n + 1) if 4 * sum(equal[s:e]) >= 3 * (e - s)]
        long = [w for w in windows if w[0] >= min(12, n)]
        seeds = decontam.seed_table([0], [" ".join(item)])
        got = decontam.find_overlaps(seeds, *decontam.plain_words(pa.array([" ".join(doc)])), 12, 0.75)[0]
        assert bool(got) <= bool(long)
        if got:
            size = max(w[0] for w in long)
            start = min(s for w, s in long if w == size)
            assert got == [(0, start, size, sum(equal[start:start + size]))]
        hit = any(all(c == "0" or equal[p + j] for j, c in enumerate(m)) for m in decontam.MASKS for p in range(n - len(m) + 1))
        lost += bool(long) and hit and not got
    assert lost == 0
    item = [f"w{i}" for i in range(15)]
    for k in range(15):
        doc = " ".join([*item[:k], "qq", *item[k + 1:]])
        seeds = decontam.seed_table([7], [" ".join(item)])
        assert decontam.find_overlaps(seeds, *decontam.plain_words(pa.array([doc])), 12, 0.75) == [[(7, 0, 15, 14)]]


def test_language_id(spark, odd, empty):
    rng = random.Random(6)
    sound = {"aa": "bcd", "zz": "xyw"}
    rows = [(i, " ".join("".join(rng.choice(sound[g] + "ae") for _ in range(5)) for _ in range(rng.randint(3, 60))), g)
            for i in range(300) for g in [rng.choice(list(sound))]]
    extra = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "aa"), (None, "bcdae bcdae", "aa"), (1003, "xywae", None), rows[0]]
    df = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = lang_id.identify_languages(df).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert len(held) > 40 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and by[1000].score == 0 and by[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert lang_id.identify_languages(empty).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.identify_languages(unlabelled).collect()} == {"und"}


def test_license_scan(spark, odd, empty):
    mit = dict(licenses.FULL_TEXTS)["MIT"]
    docs = [mit, "Copyright (c) 2020 Someone\n" + mit.upper().replace(" ", "  ").replace("LICENSE", "LICENCE"), mit + " x", None, "",
            "text\nReleased under the MIT License.\nmore", "a\n  licensed under CC BY-NC 4.0 \nReleased under the MIT Licence",
            "not Released under the MIT License.", "© 2020 me"]
    df = spark.createDataFrame([*enumerate(docs), (5, docs[5])], "doc_id long, text string").withColumn("license", F.lit("clash"))
    rows = licenses.scan_licenses(df).collect()
    assert len(rows) == len(docs) + 1
    got = {r.doc_id: (r.license, r.notices) for r in rows}
    assert got == {0: ("MIT", ""), 1: ("MIT", ""), 2: (None, ""), 3: (None, ""), 4: (None, ""), 5: (None, "MIT"),
                   6: (None, "CC-BY-NC-4.0,MIT"), 7: (None, ""), 8: (None, "")}
    assert {r.text_digest for r in rows if r.doc_id in (0, 1)} == {rows_digest(rows, 0)}
    assert licenses.scan_licenses(odd).count() == len(odd_rows()) and licenses.scan_licenses(empty).count() == 0


def test_whole_licenses(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    found = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
             "CC0-1.0": "CC0-1.0"}
    docs = []
    for name, spdx in found.items():
        if (folder / name).exists():
            text = (folder / name).read_text()
            wrapped = [" ".join(x.split()) for x in text.split("\n\n") if "opyright (C)" not in x and "opyright [" not in x]
            docs += [(text, spdx), (text.replace("\n", "\r\n").upper(), spdx), (text + "\nadded", None),
                     (text.replace(" the ", " a ", 1), None)]
            if name in ("MPL-2.0", "CC0-1.0"):
                docs += [("\n".join(wrapped), spdx), ("\n".join(y for x in wrapped for y in textwrap.wrap(x, 50)), spdx)]
    mit, bsd2, bsd3 = (licenses.FULL_TEXTS[k].split("\n", 1)[1] for k in ("MIT", "BSD-2-Clause", "BSD-3-Clause"))
    holders = "Copyright (c) 2020 Some One\nAll rights reserved.\nCopyright (c) 2021 Other\nAll Rights Reserved\n\n"
    docs += [("Copyright 2020 Me\n\n" + mit, "MIT"), ("The MIT License (MIT)\n\nCopyright (c) 2020 Me\n\n" + mit, "MIT"),
             (holders + bsd2, "BSD-2-Clause"), (holders + bsd3, "BSD-3-Clause"), ("BSD 3-Clause License\n" + holders + bsd3, "BSD-3-Clause"),
             (holders + bsd3.replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* "), "BSD-3-Clause"),
             ("\n".join(textwrap.wrap(holders + "Do as you like with it. Copyright notices stay where they are.", 30)), None),
             ("All rights reserved.", None), ("House licence: you may read this\ntext on Mondays", "House"), (bsd2 + "All rights", None)]
    extra = spark.createDataFrame([("House", "House license\nyou may read this text on mondays"), ("None", ""), ("None", None), (None, "x"),
                                   ("Other", "House license you may read this text on mondays")], "license string, text string")
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(df, extra=extra).collect()}
    assert got == {i: x for i, (_, x) in enumerate(docs)}
    assert {r.license for r in licenses.scan_licenses(df).collect()} == {x for _, x in docs} - {"House"}


def rows_digest(rows, doc):
    return next(r.text_digest for r in rows if r.doc_id == doc)


def rated(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.choice([0, 1, 2, 2, 2])
        w = prose(rng, rng.randint(20, 120)).split()
        if g == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["rudeword", "badterm", "slur!"])
        if g == 1:
            w = [x + rng.choice(["%%%", "###"]) for x in w]
        rows.append((i, " ".join(w), g))
    return rows


def test_ordinal_grades(spark, odd, empty):
    rows = rated(1, 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("keep", F.lit("clash"))
    ratings = spark.createDataFrame([(r[0], r[2]) for r in rows[:600]] + [(None, 2), (3000, 1), (5, None), (6, 9)], "doc_id long, grade int")
    model = ordinal.fit_on_labels(docs, ratings)
    got = {r.doc_id: r for r in ordinal.grade_texts(docs.drop("keep"), model).collect()}
    test = rows[600:]
    assert np.mean([got[i].keep == (g == 2) for i, _, g in test]) > 0.97
    means = [np.mean([got[i].expected_grade for i, _, g in test if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    assert all(got[i].p_at_least_1 >= got[i].p_at_least_2 for i, _, _ in test)
    kept = ordinal.grade_texts(docs, model, only_kept=True)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}
    assert ordinal.grade_texts(odd.drop("keep"), model).count() == len(odd_rows())
    assert ordinal.grade_texts(empty.drop("keep"), model).count() == 0
    assert ordinal.fit_on_labels(docs, ratings.limit(0)) is None
    assert ordinal.grade_texts(odd, None, only_kept=True).count() == len(odd_rows())


def test_driver_gives_memory_back_after_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "fine words here " * 3 if i % 2 else "poor spam text") for i in range(40)], "doc_id long, text string")
    ratings = docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade"))
    given = []
    monkeypatch.setattr(ordinal, "give_back", lambda forget=True: given.append(forget))
    assert ordinal.fit_on_labels(docs, ratings) is not None and given == [False]


def test_ordinal_gradient_lowers_the_loss():
    rows = rated(2, 300)
    model = ordinal.fit([r[1] for r in rows], [r[2] for r in rows], 3)
    p = model.tails(pa.array([r[1] for r in rows]))
    y = np.array([r[2] for r in rows])
    full = np.concatenate([np.ones((len(y), 1)), p, np.zeros((len(y), 1))], axis=1)
    loss = -np.log(full[np.arange(len(y)), y] - full[np.arange(len(y)), y + 1]).mean()
    share = np.bincount(y) / len(y)
    assert loss < 0.2 * -(share * np.log(share)).sum()
    assert (np.diff(model.thresholds) > 0).all()


def test_drop_copies_keeps_the_row_that_exact_groups_keeps(spark):
    rows = [(1, "ab", "p"), (1, "a  b", "q"), (2, "ab", "r"), (2, "ab", "r"), (None, "c d", "s"), (None, "cd", "t"), (7, None, "u"), (7, "", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_row string").repartition(3)
    got = sorted(map(tuple, radix_dedup.drop_copies(docs).collect()), key=str)
    assert got == sorted([(1, "a  b", "q"), (None, "c d", "s"), got[[r[0] for r in got].index(7)]], key=str)
    kept = sorted((r["doc_id"], r["text_sha256"]) for r in radix_dedup.exact_groups(docs.filter("doc_id is not null")).filter("kept").collect())
    assert len(kept) == 2


def test_token_counts_of_all_code_points(spark):
    from tokenizers import Tokenizer
    points = [chr(c) for c in range(1, 0x32000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(points[i:i + 1]) + "\u0301 x" + points[i] + "y" for i in range(0x7F, len(points))]
    library = Tokenizer.from_file(BPE)
    want = [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert bpe_count.batch_counter(bpe_count.load_merge_table(BPE))(pa.array(texts)).tolist() == want


def test_samples_are_bounded_and_the_same_for_every_partitioning(spark):
    from tabula.llm.common import bounded_sample
    rows = [(i, "x" * (i % 50)) for i in range(400)] + [(5, "same")] * 300
    df = spark.createDataFrame(rows, "id long, text string")
    a, b = (sorted(map(tuple, bounded_sample(df.repartition(n), "id", "text", 60, 1000).collect())) for n in (1, 7))
    assert a == b and 0 < len(a) <= 60 and sum(len(t) for _, t in a) <= 1000
    assert len(bounded_sample(df, "id", "text", 10_000, 1 << 30).collect()) == 700
    assert bounded_sample(df.limit(0), "id", "text", 5, 5).count() == 0


def test_texts_beyond_one_chunk(spark, monkeypatch):
    """Every operator on texts that take many chunks gives what it gives in one."""
    from tabula.llm import common
    rng = random.Random(3)
    rows = [(i, prose(rng, 40 + 10 * (i % 5))) for i in range(40)] + [(100, prose(rng, 4000)), (101, prose(rng, 4000)), (102, None), (103, "")]
    rows += [(110, rows[40][1] + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    ratings = spark.createDataFrame([(i, i % 3) for i in range(40)], "doc_id long, grade int")
    bench = spark.createDataFrame([(1, " ".join(rows[40][1].split()[100:130]))], "item_id long, text string")

    def results():
        model = ordinal.fit_on_labels(docs, ratings)
        langs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
        frames = [bloom_lm.score_texts(docs), bpe_count.token_counts(docs, BPE), jaccard_join.jaccard_components(docs),
                  decontam.mark_overlaps(docs, bench, keep=["doc_id"]), ordinal.grade_texts(docs, model, keep=["doc_id"]),
                  lang_id.identify_languages(langs), packing.cut_pieces(docs, BPE, 64, 1, "doc_id", "text").drop("task", "nth")]
        return [sorted((str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in f.collect())) for f in frames]

    whole = results()
    for module in (common, bloom_lm, ordinal, jaccard_join):
        if hasattr(module, "SMALL_CHUNK"):
            monkeypatch.setattr(module, "SMALL_CHUNK", 700)
    monkeypatch.setattr(common, "CHUNK_BYTES", 700)
    monkeypatch.setattr(common.map_text, "__defaults__", tuple(700 if d == 8 << 20 else d for d in common.map_text.__defaults__))
    for name in ("text_chunks", "numbered_chunks"):
        monkeypatch.setattr(getattr(common, name), "__defaults__", (700,))
    assert results() == whole

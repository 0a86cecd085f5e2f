"""Each operator against a brute-force version, on small tables and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import bpe, components, decision_list, fair_mix, projected_ann, repeats, scan, simhash_dedup, sketch, subword_quality, substring_dedup, suffix_dedup, warc_revisit
from sluice.llm.common import TEXT_ROWS, merged_partitions, table, text_rows, text_weight

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, kept string, row string, spans string"
LONG = " ".join(f"w{i % 997}x{i % 61}" for i in range(9000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))


def odd_rows():
    """Nulls, empty, long, tied and repeated rows, passages shared within and across documents."""
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "one", "en", "b"), (5, LONG, "en", "b"), (6, LONG + " tail", None, "c"),
        (7, "x " + PASSAGE + " y", "en", None), (8, PASSAGE, "en", "c"), (8, PASSAGE, "en", "c"), (9, PASSAGE + " " + PASSAGE, "en", "b"),
        (None, PASSAGE + " é", "fr", "b"), (None, None, None, None), (10, "la " * 400, "fr", "a"), (11, "la " * 399, "fr", "é"), (12, "café   naïve\x0bword\x1f" * 30, "fr", "é"),
        (13, "zero\x00byte " * 60, "xx", "a"), (14, "0" * 700, "xx", "a"), (15, "a <|endoftext|> b", "en", "a"), (16, "Line\nLine\n\nLine \n", "en", "a"),
    ]
    return [(i, t, lang, s, None, None, 0.5, "k", "r", "s") for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts(df):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect()]


def same(df, expected):
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected)


# --- operator 2


def brute_windows(rows, size):
    words = [(math.inf if i is None else i, i, t.split()) for i, t in rows]
    first = {}
    for key, _, w in words:
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, math.inf), key)
    out = []
    for key, i, w in words:
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < key:
                gone.update(range(p, p + size))
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_dedup(docs, odd, empty):
    for df, size in ((docs, 50), (odd, 50), (docs, 12)):
        same(substring_dedup.dedup_substrings(df, size).drop("kept"), brute_windows(texts(df), size))
    same(substring_dedup.dedup_substrings(odd, most_blocks=0).drop("kept"), brute_windows(texts(odd), 50))
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 50_000, dtype=np.int64).astype(np.uint64)
    keys = np.concatenate([keys, keys[:500]])
    blocks = sketch.blocks_for(len(keys))
    assert blocks > 1
    block, inner = sketch.cells(keys, blocks)
    count = np.zeros(blocks * sketch.SPAN, dtype=np.int64)
    for c in inner:
        count += np.bincount(block * sketch.SPAN + c, minlength=len(count))
    found = sketch.maybe_repeated(np.packbits(count > 1, bitorder="little"), keys, blocks)
    assert found[:500].all() and found[-500:].all() and found.mean() < 0.1


def test_bitmap_holds_every_key(spark):
    rng = random.Random(5)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(20_000)]
    own = spark.createDataFrame([(k,) for k in keys[:9000]], "k long")
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    blocks = sketch.set_blocks(9000)
    table = sketch.bitmap(own, "k", blocks)
    flags = {r["k"]: r["may"] for r in sketch.in_bitmap(rows, "k", table, blocks, "may").collect()}
    held = sketch.in_held(sketch.held_set(table, blocks), np.array(keys, dtype=np.int64).view(np.uint64), blocks)
    assert [flags[k] for k in keys] == held.tolist()
    assert held[:9000].all() and held[9000:].mean() < 0.15
    assert sketch.maybe_among(rows, "k", own.limit(0), "k", 0).count() == 0


@pytest.mark.parametrize("worded", [True, False])
def test_pieces_have_every_window_once(worded):
    import pyarrow as pa

    rng = random.Random(2)
    window = 7
    texts = [b" ".join(bytes(rng.choices(b"ab\xc3", k=rng.randrange(1, 9))) for _ in range(n)) for n in (400, 3, 0, 900)]
    texts += [b"x" * 500 + b" " + b"y z " * 60, b" " * 300 + b"q w e r t y u i o p", b"u" * 700]
    seen = []
    for row, before, data, off in scan.pieces(pa.array(texts, pa.binary()), window, worded, 64):
        for i in range(len(off) - 1):
            t = data[off[i] : off[i + 1]].tobytes()
            t = t.split() if worded else t
            seen += [(row + i, before + p, b" ".join(t[p : p + window]) if worded else t[p : p + window]) for p in range(len(t) - window + 1)]
    want = []
    for r, t in enumerate(texts):
        t = t.split() if worded else t
        want += [(r, p, b" ".join(t[p : p + window]) if worded else t[p : p + window]) for p in range(len(t) - window + 1)]
    assert sorted(seen) == sorted(want) and len(seen) == len(set(seen))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    part = [rng.randrange(50) for _ in range(40)]
    seqs = [[rng.randrange(50) for _ in range(rng.randrange(60))] + part + [rng.randrange(50) for _ in range(9)] for _ in range(8)] + [[1] * 90, [], [2]]
    off = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    values = scan.mix(np.array([x for s in seqs for x in s], dtype=np.uint64))
    grams = scan.Roller(values, 9).grams(5)
    seen = {}
    count = 0
    for doc, first, n, at in zip(*scan.anchors(grams, 20, 5, off), strict=True):
        for s in range(first, first + n):
            assert off[doc] <= s and s + 20 <= off[doc + 1] and s <= at <= s + 15
            key = tuple(values[s : s + 20])
            assert seen.setdefault(key, (at - s, grams[at])) == (at - s, grams[at])
            count += 1
    assert count == sum(max(0, len(s) - 19) for s in seqs)


# --- operator 6


def brute_bytes(rows, size):
    seen = Counter(t[p : p + size] for _, t in rows for p in range(len(t) - size + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - size + 1):
            if seen[t[p : p + size]] > 1:
                gone[p : p + size] = True
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), len(repeats.runs_of(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def test_equal_rows_carry_their_spans_once(spark):
    """Copies of one row, under one doc_id or many, don't multiply what each of them carries."""
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(7, text)] * 60 + [(i, text) for i in range(100, 140)] + [(None, text)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(substring_dedup.dedup_substrings(df).drop("kept"), brute_windows(texts(df), 50))
    same(suffix_dedup.dedup_suffixes(df).drop("kept"), brute_bytes(texts(df), 200))
    keyed = repeats.keyed(df)
    for spans in (substring_dedup.removed_spans(keyed), suffix_dedup.removed_spans(keyed)):
        got = spans.select(F.size("spans").alias("n")).collect()
        assert len(got) <= 42 and max(r["n"] for r in got) < 150


def test_runs_are_joined_by_search():
    rng = random.Random(8)
    for size in (1, 3):
        runs = [np.sort(np.array([bytes(rng.choices(b"\x00ab", k=size)) for _ in range(rng.randrange(1, 12))], dtype=f"S{size}")) for _ in range(5)]
        every, count = suffix_dedup.joined_runs(runs)
        want = Counter(x for r in runs for x in set(r.tolist()))
        assert dict(zip(every.tolist(), count.tolist(), strict=True)) == want and every.tolist() == sorted(want)


def test_a_very_long_text(spark):
    """A text of some MB is scanned in pieces; copies of its passages far apart are found."""
    rng = random.Random(9)
    words = [f"{rng.randrange(10**6)}x" for _ in range(250_000)]
    passage = [f"p{i}" for i in range(80)]
    words[1000:1080] = words[200_000:200_080] = passage
    rows = [(1, " ".join(passage)), (2, " ".join(words)), (3, "q" * 700_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(df).collect()}
    assert got == {1: 0, 2: 160, 3: 0}
    gone = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.dedup_suffixes(df).collect()}
    size = len(" ".join(passage))
    assert gone[1] == (size, 1) and gone[2] == (2 * size + 6, 2) and gone[3] == (700_000, 1)


def test_suffix_dedup(docs, odd, empty):
    for df, options in ((docs, {}), (odd, {}), (docs, {"window": 40, "gram": 8, "shard_bytes": 4000, "hot": 2}), (odd, {"most_blocks": 0, "hot": 1})):
        same(suffix_dedup.dedup_suffixes(df, **options).drop("kept"), brute_bytes(texts(df), options.get("window", 200)))
    assert suffix_dedup.dedup_suffixes(empty).count() == 0


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"aaaaaaaaaaaaaaaaaaaaaaaa", b"\x00\x00a\x00\x00\x00a\x00" * 5, bytes(random.Random(5).choices(b"ab", k=700)), b"abcdefghij" * 30])
def test_suffix_array_and_prefixes(text):
    data = np.frombuffer(text, dtype=np.uint8)
    sa = suffix_dedup.suffix_array(data)
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    if len(text):
        lcp = suffix_dedup.common_prefixes(data, sa)
        for a, b in zip(sa[:-1], sa[1:], strict=True):
            x, y = text[a:], text[b:]
            assert lcp[b] == next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def shard_of(bodies, window, cuts):
    """Contexts of one shard, as ``_shard`` gets them; ``bodies`` has (anchor, text)."""
    cols = {"c1": list(range(len(bodies))), "c2": [0] * len(bodies), "n": [len(b) - window + 1 for _, b in bodies], "body": [b for _, b in bodies], "cuts": [cuts] * len(bodies), "group": [a for a, _ in bodies]}
    return pa.table(cols, schema=pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("n", pa.int32()), ("body", pa.binary()), ("cuts", pa.int64()), ("group", pa.int64())]))


def test_a_shard_takes_anchors_by_the_megabyte(monkeypatch):
    """What a hash deals to a shard has no bound; the text of which a suffix array is made at once has."""
    rng, sizes, sorted_ = random.Random(3), [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: sizes.append(len(text)) or sorted_(text))
    bodies = []
    for a in (rng.randrange(40) for _ in range(300)):  # letters of its own, since equal windows have one anchor
        two = [65 + 2 * a, 66 + 2 * a]
        bodies.append((a, bytes(rng.choices(two, k=12)) + bytes(two * 5) + bytes(rng.choices(two, k=3))))
    got = suffix_dedup._shard(10, 500)(shard_of(bodies, 10, 1)).to_pylist()
    assert sum(sizes) == 300 * 25 and max(sizes) <= 500 and len(sizes) < 40
    want = {}
    for i, (a, b) in enumerate(bodies):
        other = Counter(x[k : k + 10] for c, x in bodies if c == a for k in range(16))
        want[i] = [k for k in range(16) if other[b[k : k + 10]] > 1]
    flat = {r["c1"]: [k for a, b in zip(r["spans"][::2], r["spans"][1::2], strict=True) for k in range(a, b)] for r in got}
    assert flat == {i: x for i, x in want.items() if x}


def test_a_shard_sends_a_window_once():
    """Of windows that all contexts of a hot anchor have, each shard sends one, so a range grows with shards, not with contexts."""
    rng = random.Random(4)
    bodies = [(7, bytes(rng.choices(b"abcdefgh", k=9)) + b"shared-one") for _ in range(200)]
    sent = [r for r in suffix_dedup._shard(10, 1 << 20)(shard_of(bodies, 10, 2)).to_pylist() if r["cut"] is not None]
    strings = [r["strings"][k : k + 10] for r in sent for k in range(0, len(r["strings"]), 10)]
    assert len(strings) == len(set(strings)) and set(strings) == {b[k : k + 10] for _, b in bodies for k in range(10)}
    assert sum(len(r["places"]) for r in sent) == len(strings) * suffix_dedup._PLACE.itemsize


# --- operator 5


def brute_prints(rows, k=3):
    out = []
    for i, t in rows:
        w = t.lower().split()
        sh = [b" ".join(w[j : j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        out.append((i, sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))))
    return out


def brute_components(prints, bits=2):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(prints):
        if i is not None:
            least[find(a)].append(i)
    return [(i, f"{fp:016x}", min(least[find(a)], default=None)) for a, (i, fp) in enumerate(prints)]


def test_simhash(docs, odd, empty):
    for df in (docs, odd):
        same(simhash_dedup.near_duplicates(df), brute_components(brute_prints(texts(df))))
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_links_of_crowded_cells(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in ([rng.randrange(64) for _ in range(3)] for _ in range(250))} | {rng.getrandbits(64) for _ in range(100)}
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    frame = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in rows], "doc_id long, fp long")
    expected = {(i, c) for i, _, c in brute_components(rows)}
    for cell in (2, 10, 1000):
        assert {(r["doc_id"], r["component_id"]) for r in simhash_dedup.cluster(frame, cell).collect()} == expected
    found = {cell: {k: v.count() for k, v in simhash_dedup.routes(frame.select("fp"), len(rows), cell).items()} for cell in (2, 10, 1000)}
    assert all(found[2].values()) and found[10]["finer grid"] and not found[10]["hubs"]
    assert found[1000]["grid"] and not found[1000]["finer grid"] and not found[1000]["hubs"]


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(2)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(50)]
    e = [simhash_dedup.embedded(F.col(c)) for c in "ab"]
    for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.bit_count(e[0].bitwiseXOR(e[1])).alias("m")).collect():
        counts = [[(x >> 2 * s & 3).bit_count() for s in range(32)] for x in (r["a"], r["b"])]
        assert r["m"] == sum(abs(p - q) for p, q in zip(*counts, strict=True)) <= (r["a"] ^ r["b"]).bit_count()


@pytest.mark.parametrize("fit", [0, 1000])
def test_components_of_chains_and_hubs(spark, fit):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(-5, 2000), (2000, 2000), (3000, 3001), (3001, 3000)]
    random.Random(0).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long").repartition(7), fit=fit).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1400)}, -5: -5, 2000: -5, 3000: 3000, 3001: 3000}


# --- operator 7


def test_bpe_equals_library(docs, odd, empty):
    from tokenizers import Tokenizer

    path, pattern = bpe.default_vocabulary()
    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    for df in (docs, odd):
        expected = []
        for i, raw in texts(df):
            ids = t.encode(raw.decode(), add_special_tokens=False).ids
            sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            expected.append((i, len(ids), sha, hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        same(bpe.tokenise(df, path, pattern), expected)
    assert bpe.tokenise(empty, path, pattern).count() == 0


def test_bpe_splits_alike_and_keeps_frequent_pieces(monkeypatch):
    path, pattern = bpe.default_vocabulary()
    v = bpe.Vocabulary(path, pattern)
    for k in [*range(0x3100), *range(0xD7A0, 0xD800), *range(0xE000, 0x10000), 0x1D7D8, 0x1F600]:
        c = chr(k)
        text = f"a{c}{c} {c}1 {c}{c}  {c}'ll  "
        if not bpe.BEYOND.search(text):
            assert v.plain.findall(text) == v.pattern.findall(text), hex(k)
        assert b"".join(p[2] for p in v.said(text)).decode() == text
    assert bpe.plain(r"\d+|\p{L}") is None
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    made = []
    v.memory.clear()
    v.memory.old.clear()
    monkeypatch.setattr(v, "piece", lambda raw, piece=v.piece: made.append(raw) or piece(raw))
    for word in ("qa", "qb", "qc", "qd", "qe", "qf"):
        v.said("the")
        v.said(word)
    assert made.count(b"the") <= 1


def test_bpe_on_random_strings():
    from tokenizers import Tokenizer

    path, pattern = bpe.default_vocabulary()
    t, v = Tokenizer.from_file(path), bpe.vocabulary(path, pattern)
    rng = random.Random(4)
    alphabets = ["abcdefgh ", "aA1 .,!'\n\t", "éüß漢字かな🙂́‍ ", "\x00\x1c\x1f\x85\xa0 　᠎ x", "'stredm lv"]
    for _ in range(1500):
        s = "".join(rng.choices(rng.choice(alphabets), k=rng.randrange(40)))
        assert v.encode(s).tolist() == t.encode(s, add_special_tokens=False).ids, repr(s)
        assert v.decode(v.encode(s)) == t.decode(t.encode(s, add_special_tokens=False).ids, skip_special_tokens=False)
    for s in ("a" * 5000, " " * 3001, "ab" * 2000, "=-" * 999):
        assert v.encode(s).tolist() == t.encode(s, add_special_tokens=False).ids


# --- operator 9


def test_fair_mix(docs, odd, empty):
    for df in (docs, odd):
        rows = fair_mix.mix(df, range_rows=5).collect()
        assert [tuple(r) for r in sorted(rows)] == [tuple(r) for r in sorted(fair_mix.mix(df).collect())] if df is docs else True
        words = Counter((r["doc_id"], len((r["text"] or "").encode().split())) for r in df.collect())
        assert Counter((r["doc_id"], r["size"]) for r in rows) == words
        total = sum(r["size"] for r in rows)
        assert total >= sum(r["taken"] for r in rows) > total - max(r["size"] for r in rows) - 1
        assert all(0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
        by = defaultdict(list)
        source = {}
        for r in rows:
            by[r["source_size"], r["target"]].append(r)
        assert sum(k[1] for k in by) == pytest.approx(total)
        for (size, target), own in by.items():
            assert target <= 3 * size + 1e-9
            assert abs(sum(r["taken"] for r in own) - target) <= 2 * max(r["size"] for r in own)
    assert fair_mix.mix(empty).count() == 0


def test_fair_mix_reruns_agree_on_ties(spark):
    """Rows of one id and size, rows without id: whichever way they are dealt, the same texts are taken."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, None, None]), " ".join(rng.choices("abcdefgh", k=rng.choice([5, 5, 9]))), rng.choice("xyz")) for _ in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = [Counter(tuple(r) for r in fair_mix.mix(df.repartition(n), range_rows=20, keep=("text",)).select("text", "taken").collect()) for n in (1, 4, 7)]
    assert seen[0] == seen[1] == seen[2] and sum(k[1] == 0 for k in seen[0])
    keys = fair_mix.mix(df.where("doc_id is null"), keep=("text",)).count()
    assert keys == sum(i is None for i, _, _ in rows)


def test_fair_mix_finds_the_end_in_slices(docs, monkeypatch):
    whole = sorted(tuple(r) for r in fair_mix.mix(docs).collect())
    monkeypatch.setattr(fair_mix, "SLICES", 4)
    monkeypatch.setattr(fair_mix, "LAST_COPIES", 3)
    assert sorted(tuple(r) for r in fair_mix.mix(docs).collect()) == whole


def test_offsets_by_groups(spark):
    rng = random.Random(5)
    rows = [(s, r, rng.randrange(50)) for s in "ab" for r in range(64) if rng.random() < 0.7]
    want = [(s, r, sum(n for t, q, n in rows if t == s and q < r)) for s, r, _ in rows]
    df = spark.createDataFrame(rows, "sk string, range long, range_size long")
    for bits in (0, 3, 6):
        same(fair_mix.range_offsets(df, bits), want)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        for s in over or free:
            out[s] = 3 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(out[s] for s in over)
        free -= over
    return out


def test_targets(spark):
    sizes = {"b": 10, "a": 1000, "é": 30, "z": 5, None: 400, "ä": 0}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    got = fair_mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = brute_targets(sizes)
    assert {r["doc_id"]: r["target"] for r in got} == pytest.approx({i: want[s] for i, (_, _, s) in enumerate(rows)})


# --- operator 4


def test_warc(spark, sf, tmp_path):
    page = "<p>" + "x" * 1200
    rows = [(1, "u", page, 0), (2, "u\r\nX: 1", page, 0), (7, None, page, 0), (3, "u", "small", 0), (4, "u", "small", 0), (5, "u", None, 0), (6, "u", "", 0), (8, "é", "a\r\n\r\nWARC/1.1\r\n" + "é" * 600, 0), (None, "u", page, 0), (9, "u", "y" * 999, 0), (10, "u", "y" * 999, 0), (11, "u", "y" * 1000, 0), (12, "u", "y" * 1000, 0)]
    for df in (table(spark, sf, "pages"), spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(2), spark.createDataFrame([], "page_id long, url string, html string")):
        last = {}
        all_ = [(r["page_id"], (r["html"] or "").encode()) for r in df.collect()]
        for i, h in all_:
            last[h] = max(last.get(h, -1), -1 if i is None else i)
        want = [(i, len(h), hashlib.sha1(h).hexdigest(), *(("revisit", last[h]) if len(h) >= 1000 and last[h] != i else ("response", None))) for i, h in all_]
        same(warc_revisit.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), want)


def test_separators_within_payloads(spark, tmp_path):
    """Payloads that end in parts of the separator or hold it, cut into any pieces, come back whole."""
    tails = ["", "\r", "\n", "\r\n", "\r\n\r", "\r\n\r\n", "\r\n\r\n\r\n", "\r\n\r\n\r\n\r\n", "\r\r\n\r\n", "\n\r\n\r\n"]
    html = [t + "x" * n + t for t in tails for n in (0, 1, 999, 70_000)] + ["\r\n\r\n" * 3000, "é\r\n\r\n" * 40_000]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").selectExpr("page_id", "cast(null as string) as url", "html")
    path = f"file://{tmp_path}/warc"
    warc_revisit.write_archives(df.repartition(3), path, records=7)
    got = warc_revisit.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest")
    same(got, [(i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for i, h in enumerate(html)])


# --- operator 3


def brute_stats(text):
    raw = text.encode()
    w = raw.split()
    n = len(w)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i in range(n - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return n, sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cover)


def test_decision_list(spark, docs, odd, empty, sf):
    labels = table(spark, sf, "labels")
    for df in (docs, odd):
        got = decision_list.judge(df, labels).collect()
        want = []
        for r in df.select("doc_id", "text").collect():
            s = brute_stats(r["text"] or "")
            want.append((r["doc_id"], *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
        assert Counter(tuple(r)[:-1] for r in got) == Counter(want)
        assert not any(r["kept"] and r["base_failed"] for r in got)
    got = {r["doc_id"]: r["kept"] for r in decision_list.judge(docs, labels).collect()}
    right = [got[r["doc_id"]] == bool(r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    assert sum(right) > 0.85 * len(right)
    assert decision_list.judge(empty, labels).count() == 0
    assert decision_list.judge(docs, labels.limit(0)).count() == docs.count()


def test_rules_are_learned():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(900), "b": rng.random(900)}
    bad = ((x["a"] > 0.7) & (x["b"] <= 0.4)) | (x["b"] > 0.9)
    rules = decision_list.learn(x, bad, np.arange(900) % 3)
    hit = np.zeros(900, dtype=bool)
    for r in rules.rules:
        hit |= r.covers(x)
    assert (hit == bad).mean() > 0.97 and len(rules.rules) <= 6


def test_models_do_not_depend_on_the_order_of_rows(spark, docs, sf):
    """Ids that occur with two texts: the same row is learned from, however rows are dealt."""
    labels = table(spark, sf, "labels")
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.reverse("text"), F.lit(" # $ % *")))).select("doc_id", "text")
    rules = [decision_list.fit(decision_list.statistics(twice.repartition(k)), labels) for k in (1, 3, 5)]
    assert rules[0] == rules[1] == rules[2]
    models = [subword_quality.fit(twice.repartition(k), labels) for k in (1, 3, 5)]
    assert all((m.weight == models[0].weight).all() and m.bias == models[0].bias for m in models[1:])


# --- operator 10


def test_quality_classifier(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r["doc_id"]: r for r in subword_quality.classify(docs, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i]["score"], q) for i, q in truth.items() if i in got and got[i]["held_out"]]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9
    again = {r["doc_id"]: r["score"] for r in subword_quality.classify(docs.repartition(5), labels.repartition(3)).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-6 for i, r in got.items())
    rows = subword_quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert subword_quality.classify(empty, labels).count() == 0


def test_features_do_not_depend_on_the_block():
    import pyarrow as pa

    t = ["alpha beta beta gamma", "", "é à la carte", None, "x"]
    model = subword_quality.Model(np.random.default_rng(0).standard_normal(1 << 10), 0.1)
    assert model.score(pa.array(t)) == pytest.approx(np.concatenate([model.score(pa.array([x], pa.string())) for x in t]))


def plain_score(model, text):
    """The same features and sum, one text and one feature at a time."""
    buckets = len(model.weight)

    def at(h):
        return int(h) & (buckets - 1)

    def rolled(x):
        data = np.frombuffer(x, np.uint8)
        return scan.byte_roller(data).spans(np.array([0]), np.array([len(data)]))[0]

    mixed = lambda h: scan.mix(np.array([h], np.uint64))[0]
    words = (text or "").encode().split()
    found = [at(rolled(w)) for w in words]
    for a, b in zip(words, words[1:], strict=False):
        with np.errstate(over="ignore"):
            found.append(at(mixed(np.uint64(7) if rolled(a) == rolled(b) else rolled(a) * subword_quality._PAIR + rolled(b))))
    chars = text or ""
    for i in range(len(chars) - 3):
        piece = chars[i : i + 4]
        if not any(c in " \t\n\x0b\x0c\r" for c in piece[1:3]):  # a piece may start or end with the space beside its word
            found.append(at(mixed(rolled(piece.encode()))))
    return 1 / (1 + math.exp(-(model.bias + (sum(model.weight[f] for f in found) / len(found) if found else 0))))


def test_scores_of_a_trained_model_against_plain_sums(docs, odd, sf):
    model = subword_quality.fit(docs, table(docs.sparkSession, sf, "labels"))
    rows = [r for r in docs.orderBy("doc_id").limit(40).collect()] + [r for r in odd.collect() if len(r["text"] or "") < 9000]
    import pyarrow as pa

    got = model.score(pa.array([r["text"] for r in rows], pa.string()))
    assert got == pytest.approx([plain_score(model, r["text"]) for r in rows], abs=1e-9)


# --- operator 1


def test_ann(spark, sf):
    df = table(spark, sf, "embeddings")
    for frame, options in ((df, {}), (df, {"sample": 100}), (df, {"dim": 8, "confidence": 0.98})):
        check_ann(frame, projected_ann.search(frame, F.col("vec_id") % 20 == 0, **options).collect(), 0.95)
    nan, v = float("nan"), [1.0, 2.0]
    rows = [(0, [1.0, 0.0]), (20, v), (40, [0.0, 0.0]), (60, None), (80, [nan, 1.0]), (1, v), (2, v), (3, [None, 1.0]), (4, [1.0]), (5, [float("inf"), 0.0]), (None, v), (6, [-1.0, -2.0]), (1, v)]
    odd = spark.createDataFrame([(i, x, "c", 1.0) for i, x in rows], "vec_id long, embedding array<float>, leaf string, score double")
    got = projected_ann.search(odd, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 1.0), (0, 4, 6, -1.0), (20, 1, 1, 5.0), (20, 2, 2, 5.0), (20, 3, 0, 1.0), (20, 4, 6, -5.0)]
    assert projected_ann.search(odd.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def check_ann(frame, got, least):
    rows = [(r["vec_id"], np.asarray(r["embedding"], dtype=np.float64)) for r in frame.collect()]
    ids, m = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    found = defaultdict(dict)
    for r in got:
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for i, q in rows:
        if i % 20:
            continue
        s = m @ q
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:20]
        own = found[i]
        assert sorted(own) == list(range(1, len(own) + 1)) and len(own) == len(order)
        assert all(abs(score - m[list(ids).index(v)] @ q) < 1e-9 for v, score in own.values())
        hits += len({v for v, _ in own.values()} & {int(ids[j]) for j in order})
        total += len(order)
    assert hits / total >= least


def test_ann_leaves_out_over_half(spark, sf):
    """Even on vectors without structure the test by points stops before half of a block; in groups, long before."""
    m = np.vstack([r["embedding"] for r in table(spark, sf.replace("0.001", "0.1"), "embeddings").select("embedding").where("size(embedding) = 64").collect()]).astype(float)
    assert verified(m) < 0.5
    rng = np.random.default_rng(5)
    assert verified(rng.standard_normal((40, 64))[rng.integers(0, 40, 2000)] + rng.standard_normal((2000, 64)) / 20) < 0.1


def test_ann_routes_in_bounded_frames(monkeypatch):
    """A query that has to visit many leaves takes a row, with its vector, for each: a task holds some of them at a time."""
    monkeypatch.setattr(projected_ann, "ROUTED_ROWS", 50, raising=False)
    index = projected_ann.Index(2, 1.0, np.eye(3), None, 2.0)
    leaf = np.arange(30, dtype=np.int32)
    boxes = (leaf, np.full((30, 3), -1.0), np.full((30, 3), 1.0))
    queries = pd.DataFrame({"query_id": np.arange(40), "q": [np.array([0.5, 0.5])] * 40, "bound": [0.1] * 40, "home": np.arange(40, dtype=np.int32) % 30})
    got = list(projected_ann._others(SimpleNamespace(value=index), SimpleNamespace(value=boxes))(iter([queries, queries[:0]])))
    assert max(map(len, got)) < 50 + 30
    every = pd.concat(got)
    assert sorted(zip(every["query_id"], every["leaf"], strict=True)) == [(i, x) for i in range(40) for x in range(30) if x != i % 30]


def test_ann_leaves_grow_with_rows(spark):
    """What is sent grows with queries and leaves: ever more leaves of one size would be the square of the input."""
    rows = spark.range(20_000).select(F.col("id").alias("vec_id"), F.array(F.rand(1) - 0.5, F.rand(2) - 0.5).alias("v"))
    depth = lambda: projected_ann.build(rows, 2, sample=500)[0].tree.depth
    with pytest.MonkeyPatch.context() as m:
        m.setattr(projected_ann, "LEAF_ROWS", 20)
        assert depth() == 6
        m.setattr(projected_ann, "BLOCK_ROWS", 100)
        assert depth() == 8


def verified(m):
    top = float((m * m).sum(axis=1).max()) * (1 + 1e-12)
    planes = np.linalg.qr(np.random.default_rng(11).standard_normal((m.shape[1] + 1, projected_ann.DIM)))[0] * math.sqrt(m.shape[1] + 1)
    index = projected_ann.Index(m.shape[1], top, planes, None, projected_ann.chi2_quantile(projected_ann.CONFIDENCE, projected_ann.DIM))
    block = projected_ann.Block(np.arange(len(m)), m, index)
    some, seen = m[::20], 0
    for q, shadow in zip(some, index.project(some, True), strict=True):
        ids, scores, n = block.search(q, shadow, top, -math.inf, 21)
        assert (np.diff(scores) <= 0).all() and len(ids) == 21
        seen += n
    return seen / len(some) / len(m)


def test_partitions_follow_bytes(spark):
    """Few long texts are not merged into one task as many short ones are."""
    assert text_weight(10, 1000) == 10 and text_weight(0, 0) == 0
    long = spark.range(0, 16, 1, 16).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), 8 << 20).alias("text"))
    assert merged_partitions(long, text_rows(long), TEXT_ROWS).rdd.getNumPartitions() == 4
    short = spark.range(0, 16, 1, 16).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert merged_partitions(short, text_rows(short), TEXT_ROWS).rdd.getNumPartitions() == 1
    assert text_rows(short.limit(0)) == 0


def test_chi_square():
    assert projected_ann.chi2_quantile(0.95, 2) == pytest.approx(-2 * math.log(0.05))
    assert projected_ann.chi2_quantile(0.99, 8) == pytest.approx(20.090235, abs=1e-4)

"""Operators 11, 12 and 13 against brute force, on small tables and on odd rows."""

import datetime as dt
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import block_kmeans, golden, shards
from sluice.llm.common import table

from .test_operators import DOCS, odd_rows

# --- operator 11


def plain_least(sizes, k):
    """The smallest capacity, by trying every sum of a run."""
    sums = sorted({sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)})
    for c in sums:
        used, room = 0, 0
        for s in sizes:
            if s > c:
                used = math.inf
                break
            if s > room:
                used, room = used + 1, c
            room -= s
        if used <= k:
            return c
    return 0


def check_shards(rows, got, k):
    """``got``: doc_id, size, crc, shard, slot of every row; groups whole, slots gapless, shards as small as can be."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert all(r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < k for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    group = defaultdict(int)
    for _, t in rows:
        group[t] += len((t or "").encode()) + 1
    key = {t: -1 if t is None else int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in group}
    where = defaultdict(set)
    by_print = {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), i): t for i, t in rows}
    full = defaultdict(int)
    for r in got:
        full[r["shard"]] += r["size"]
        where[by_print[r["size"], r["text_crc32"], r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    left, alone = sum(group.values()), []
    for t in sorted(group, key=lambda t: (-group[t], key[t]))[: k - 1]:
        if group[t] * (k - len(alone)) <= left:
            break
        alone.append(t)
        left -= group[t]
    rest = sorted((t for t in group if t not in alone), key=key.get)
    assert [where[t] for t in alone] == [{i} for i in range(len(alone))]
    order = [next(iter(where[t])) for t in rest]
    assert order == sorted(order)
    if rest:
        assert max(full[s] for s in range(len(alone), k)) == plain_least([group[t] for t in rest], k - len(alone))


@pytest.mark.parametrize("k", [1, 3, 16])
def test_shards_of_odd_rows(spark, k):
    rows = [(r[0], r[1]) for r in odd_rows()]
    check_shards(rows, shards.assign(spark.createDataFrame(odd_rows(), DOCS), k).collect(), k)


def test_shards_in_many_rounds(spark, sf, monkeypatch):
    """With no groups fetched as they are, ends are found by longer and longer prefixes; the result is the same."""
    docs = table(spark, sf, "documents")
    plain = {tuple(r) for r in shards.assign(docs).collect()}
    monkeypatch.setattr(shards, "LEAVES", 0)
    monkeypatch.setattr(shards, "FIRST_BITS", 3)
    monkeypatch.setattr(shards, "SPLIT_BITS", 2)
    monkeypatch.setattr(shards, "RANGE_ROWS", 20)
    got = shards.assign(docs, range_rows=20).collect()
    assert {tuple(r) for r in got} == plain
    check_shards([(r["doc_id"], r["text"]) for r in docs.collect()], got, 16)


def test_one_text_holds_a_third_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(i, "the same text again") for i in range(400)] + [(i, " ".join(str(rng.random()) for _ in range(rng.randrange(1, 9)))) for i in range(400, 1200)]
    check_shards(rows, shards.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect(), 16)


def test_equal_rows_get_slots_in_runs(spark, monkeypatch):
    rows = [(None, "x")] * 90 + [(7, "x")] * 30 + [(1, None), (None, None)]
    placed = shards.assign(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    check_shards(rows, placed, 2)
    some = spark.createDataFrame([(1, 0, 5), (1, 5, 23), (2, 0, 1)], "shard int, slot long, n long")
    got = sorted((r["shard"], r["slot"]) for r in shards.copies(some, 4).collect())
    assert got == [(1, i) for i in range(28)] + [(2, 0)]


def test_no_documents_and_clashing_columns(spark):
    assert shards.assign(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, f"t{i}", i, "a", i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard long, key string, size long, slot long")
    check_shards([(r[0], r[1]) for r in rows], shards.assign(df, 4).collect(), 4)


def test_shards_are_written(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    shards.write_shards(docs, str(tmp_path / "s"), 8)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {(r["doc_id"], r["text"]) for r in back.select("doc_id", "text").collect()} == {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
    want = {(r["doc_id"], r["shard"]) for r in shards.assign(docs, 8).collect()}
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == want


@pytest.mark.parametrize("seed", range(30))
def test_cuts_against_every_capacity(seed):
    """The search by cells, on random sizes, against trying every capacity; cells open up by 2 bits a round."""
    rng = random.Random(seed)
    keys = sorted(rng.sample(range(1 << shards.KEY_BITS), rng.randrange(1, 60)))
    sizes = [rng.choice([1, 1, 2, 5, rng.randrange(1, 200)]) for _ in keys]
    k = rng.randrange(1, 9)

    def refine(cells):
        out = []
        for c in cells:
            bits = min(shards.KEY_BITS, c.bits + 2)
            parts = defaultdict(list)
            for key, s in zip(keys, sizes, strict=True):
                if key >> (shards.KEY_BITS - c.bits) == c.prefix:
                    parts[key >> (shards.KEY_BITS - bits)].append(s)
            out += [shards.Cell(p, bits, sum(x), max(x), len(x)) for p, x in parts.items()]
        return out

    capacity, begins = shards.smallest_cuts(shards.Cell(0, 0, sum(sizes), max(sizes), len(sizes)), k, refine)
    assert capacity == plain_least(sizes, k) and len(begins) == k - 1 and begins == sorted(begins)
    full = [0] * k
    for key, s in zip(keys, sizes, strict=True):
        full[sum(b <= key for b in begins)] += s
    assert max(full) == capacity
    if len(keys) >= k and max(sizes) * k <= sum(sizes):
        assert min(full) > 0


# --- operator 12


CLIENTS = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double, level string, latest long"
WHITE = set(" \t\n\x0b\x0c\r")


def plain_records(rows):
    out = []
    groups = defaultdict(list)
    for cid, mid, source, at, name, email, city, nation, segment, balance, *_ in rows:
        blank = lambda t: None if t is None or set(t) <= WHITE else t
        trust = {"crm": 0, "web": 1, "store": 2, "partner": 3}.get(blank(source), 4)
        money = balance if balance is not None and math.isfinite(balance) else None
        groups[cid if mid is None else mid].append({"id": cid, "trust": trust, "at": at, "name": blank(name), "email": blank(email), "city": blank(city), "nation": nation, "segment": blank(segment), "balance": money})
    for key, rs in groups.items():
        latest = max((r["at"] for r in rs if r["at"]), default=None)
        stale = lambda r: r["at"] is None or latest - r["at"] > dt.timedelta(hours=1440)  # noqa: E731,B023
        recent = lambda r: (-(r["at"] - dt.datetime(1970, 1, 1)).total_seconds() if r["at"] else math.inf, r["trust"], math.inf if r["id"] is None else r["id"])
        trusted = lambda r: (stale(r), r["trust"], recent(r))  # noqa: E731,B023
        pick = lambda f, order: min((r for r in rs if r[f] is not None), key=order, default=None)  # noqa: E731,B023
        seg, mail = pick("segment", recent), pick("email", trusted)
        name = pick("name", lambda r: (-len(r["name"]), trusted(r)))
        money = pick("balance", lambda r: (not (seg and r["segment"] == seg["segment"]), recent(r)))
        count = lambda r: (r["city"] is not None) + (r["nation"] is not None)
        home = min(rs, key=lambda r: (-count(r), trusted(r)))
        get = lambda r, f: r[f] if r else None
        out.append((
            key, len(rs), sum(map(stale, rs)), get(name, "name"), get(mail, "email"), get(seg, "segment"), home["city"], home["nation"], math.floor(100 * money["balance"] + 0.5) if money else None,
            get(name, "id"), get(mail, "id"), get(seg, "id"), get(money, "id"), home["id"] if count(home) else None,
        ))
    return out


def odd_clients(n, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    maybe = lambda x, p=0.25: None if rng.random() < p else x
    rows = []
    for i in range(n):
        at = start + dt.timedelta(hours=rng.randrange(0, 3000, 24), microseconds=rng.choice([0, 0, 1, 999_999]))
        rows.append((
            maybe(i, 0.02), maybe(rng.choice([0, 0, 0, rng.randrange(40), 60]), 0.3), maybe(rng.choice(["crm", "web", "store", "partner", "fax", " ", "CRM", ""])), maybe(at, 0.15),
            maybe(rng.choice(["", " \t", "Ann", "Änn", "Änne 𝄞", " Bo ", "x "])), maybe(rng.choice(["", "a@b", f"c{i}@d"])), maybe(rng.choice(["", "Ulm", "Rom", "\x0b\x0c"])),
            maybe(rng.randrange(4)), maybe(rng.choice(["", "a", "b", "a ", "\n"])), maybe(rng.choice([float("nan"), math.inf, 0.125, -0.005, 12.345, rng.random() * 1000])), "l", 5,
        ))
    return rows


def test_golden_records_of_odd_clients(spark, monkeypatch):
    rows = odd_clients(700) + [(1000 + i, None, None, None, None, None, None, None, None, None, None, None) for i in range(3)]
    rows.append((None, None, "web", None, "no one", None, None, None, None, None, None, None))
    ids = Counter(r[0] for r in rows)
    rows = [r for r in rows if r[0] is not None or r[4] == "no one"] if ids[None] > 1 else rows
    want = Counter(plain_records(rows))
    df = spark.createDataFrame(rows, CLIENTS).repartition(5)
    assert Counter(tuple(r) for r in golden.survivors(df).collect()) == want
    monkeypatch.setattr(golden, "HOT_ROWS", 3)  # clusters of over three times meet their latest time by broadcast
    assert Counter(tuple(r) for r in golden.survivors(df).collect()) == want


def test_golden_records_of_repeated_and_unnamed_rows(spark):
    rows = odd_clients(60, 5)
    df = spark.createDataFrame([*rows, *rows[:20], *[(None, *r[1:]) for r in rows[:20]]], CLIENTS)
    got, again = golden.survivors(df), golden.survivors(df.repartition(3))
    assert got.count() == got.select("cluster_id").distinct().count()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, again.collect()))
    assert got.agg(F.sum("n_records")).first()[0] == 100
    assert golden.survivors(spark.createDataFrame([], CLIENTS)).count() == 0


def test_sixty_days_to_the_microsecond(spark):
    last = dt.datetime(2024, 5, 1, 3)
    edge = last - dt.timedelta(hours=1440)
    rows = [(1, 1, "partner", last, None, "p", None, None, None, None, None, None), (2, 1, "crm", edge, None, "c", None, None, None, None, None, None)]
    assert golden.survivors(spark.createDataFrame(rows, CLIENTS)).select("email", "n_stale").first() == ("c", 0)
    rows[1] = (2, 1, "crm", edge - dt.timedelta(microseconds=1), None, "c", None, None, None, None, None, None)
    assert golden.survivors(spark.createDataFrame(rows, CLIENTS)).select("email", "n_stale").first() == ("p", 1)


# --- operator 13


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v in kept:
            mine[near(v)[1]].append(v)
        cs = [[sum(col) // len(mine[j]) for col in zip(*mine[j], strict=True)] if j in mine else c for j, c in enumerate(cs)]
    found = [(i, *near(v)) for i, v in kept]
    per = Counter()
    for _, d, j in found:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return Counter((i, j, d, per[j], sum(per.values()), sha[j]) for i, d, j in found)


KINDS = "vec_id long, embedding array<float>, label int, v string, q string"


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, 64))
    return [(i, [float(x) for x in (middle[i % 5] + rng.normal(size=64) * (0.3 if i % 3 else 3)).astype(np.float32)], 0, "v", "q") for i in range(n)]


def test_clusters_against_brute_force(spark):
    rows = vectors(150)
    odd = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 63 + [None]), (204, [math.nan] + [0.0] * 63), (205, [math.inf] + [0.0] * 63), (206, [0.0] * 64), (206, [0.0] * 64), (207, [-1e-9] * 64), (207, [5.0] * 64), (None, [0.5] * 64), (208, [1e30] * 64)]
    rows += [(i, e, 1, None, None) for i, e in odd] + rows[:7]
    got = block_kmeans.cluster(spark.createDataFrame(rows, KINDS).repartition(4))
    assert Counter(tuple(r) for r in got.collect()) == plain_clusters([(r[0], r[1]) for r in rows if r[0] != 208], 40, 5)


@pytest.mark.parametrize("n", [0, 1, 7])
def test_fewer_vectors_than_centroids(spark, n):
    rows = vectors(n)
    got = block_kmeans.cluster(spark.createDataFrame(rows, KINDS))
    assert Counter(tuple(r) for r in got.collect()) == plain_clusters([(r[0], r[1]) for r in rows], 40, 5)


def test_screening_is_exact_and_leaves_out_most(spark):
    """On vectors in groups few exact distances are made; ties go to the first of equal centroids."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * (rng.normal(size=(12, 64)) * rng.choice([0.2, 1, 4], size=(12, 8)).repeat(8, 1))[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 64)) * 20).astype(np.int64)
    c = np.concatenate([x[:38], x[:2]])
    q = (x.reshape(len(x), 8, 8) ** 2).sum(2)
    k, d, done = block_kmeans.nearest(x, q, c)
    whole = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (k == whole.argmin(1)).all() and (d == whole.min(1)).all()
    assert done < 0.4 * whole.size
    far = np.full((4, 64), block_kmeans.LIMIT - 1, dtype=np.int64) * np.array([[1], [-1], [1], [-1]])
    k, d, _ = block_kmeans.nearest(far, (far.reshape(4, 8, 8) ** 2).sum(2), far)
    assert k.tolist() == [0, 1, 0, 1] and d.tolist() == [0] * 4

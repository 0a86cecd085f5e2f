"""Operator 5, SimHash near-dedup through a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits and mapped to the vector of its segments' bit counts.
The Manhattan distance of two vectors is never above the Hamming distance of the fingerprints, so
fingerprints within ``BITS`` bits lie within that Manhattan distance too.  A grid range join finds those:
the axes form G groups; two points within distance 2 differ in at most two groups, so they share the
cell of at least one of the projections that leave two groups out.  Pairs in a cell are held to the
Manhattan bound, then verified exactly.  A bit count is kept as a thermometer code (both bits, or the
lower), so the Manhattan distance is one XOR and bit count, inside the join.

The groups' number follows the input, so that a cell of random fingerprints holds few.  A cell with more
than ``CELL`` members is split by the axes that its projection left out: those form ``FINER`` groups, of
which again all but two are kept, so points within distance 2 still share a cell.  What is crowded even
then, fingerprints that are alike in nearly all axes, forms no pairs: its members meet at hubs.  Two
fingerprints differ by at most two bits just if some value is within one bit of both, and a value has no
more than 65 such neighbours; so each member goes to its 65 hubs, and each hub links its members to the
least.  That finds every link of such a cell without forming pairs.

Defined results.  Null or wordless text: fingerprint zero, linked like any other.  Null doc_id: takes
part in linking, and a component's id is its least doc_id that is not null (null if there is none).
Repeated rows: one result each.  Empty table: no rows.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .common import TEXT_ROWS, if_small, materialise, take_worker, text_rows
from .components import components
from .repeats import keyed

SHINGLE = 3
SEED = 42
BITS = 2
CELL = 48
SEGMENTS = 32
#: Groups of the axes that a projection has left out, where its cells are crowded.
FINER = 8


def _shingles(raw: bytes, k: int) -> bytes:
    """The XXH64 digests of a text's k-word shingles, one after another."""
    w = raw.lower().split()
    digest = xxhash.xxh64_digest
    if len(w) < k:
        return digest(b" ".join(w), SEED) if w else b""
    return b"".join([digest(b" ".join(t), SEED) for t in zip(*(w[i:] for i in range(k)), strict=False)])


def fingerprints(texts: pa.Array, k: int = SHINGLE) -> np.ndarray:
    out = np.zeros(len(texts), dtype=np.uint64)
    weight = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for row, end, data, off in scan.blocks(texts, 1 << 19):
        raw = data.tobytes()
        parts = [_shingles(raw[off[i] : off[i + 1]], k) for i in range(end - row)]
        size = np.array([len(p) // 8 for p in parts])
        some = np.flatnonzero(size)
        if not len(some):
            continue
        bits = np.unpackbits(np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, 8), axis=1)
        heads = np.concatenate([[0], np.cumsum(size[some])[:-1]])
        ones = np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
        out[row + some] = ((ones * 2 > size[some][:, None]) * weight).sum(axis=1, dtype=np.uint64)
    return out


def _hash(k: int):
    def run(batches):
        take_worker("simhash")
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), b.column("rk"), pa.array(fingerprints(b.column("text"), k).view(np.int64))], names=["doc_id", "rk", "fp"])

    return run


def fingerprint(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, rk (tells apart rows of one doc_id with different texts), fp (the 64 bits as a signed long)."""
    return keyed(docs).mapInArrow(_hash(k), "doc_id long, rk long, fp long")


ODD = 0x5555555555555555


def embedded(fp: Column) -> Column:
    """The bit count of every two-bit segment, as thermometer code: 00, 01 or 11."""
    up = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(up).bitwiseAND(F.lit(ODD))
    both = fp.bitwiseAND(up).bitwiseAND(F.lit(ODD))
    return some.bitwiseOR(F.shiftleft(both, 1))


def groups_for(n: int) -> int:
    """Axis groups, so that random fingerprints share a cell about once in twenty: equal counts in a
    segment have probability 3/8, and a cell fixes the share (G - 2) / G of 32 segments."""
    for g in (4, 5, 6, 8, 11):
        if n * 0.375 ** (SEGMENTS * (g - 2) / g) <= 0.05:
            return g
    return 16


def _mask(axes) -> int:
    """The bits of these segments, as a signed long."""
    m = sum(3 << 2 * s for s in axes)
    return m - (1 << 64) if m >> 63 else m


def _split(axes: list[int], groups: int) -> list[list[int]]:
    edge = [round(i * len(axes) / groups) for i in range(groups + 1)]
    return [axes[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True) if a < b]


def projections(groups: int, leave: int = BITS) -> list[tuple[int, list[int]]]:
    """(mask of the axes that a projection keeps, the masks that split its cells further), for each projection."""
    every = list(range(SEGMENTS))
    out = []
    for left in combinations(_split(every, groups), leave):
        open_ = sorted(sum(left, []))
        fine = [_mask(set(every) - {*sum(pair, [])}) for pair in combinations(_split(open_, FINER), leave)]
        out.append((_mask(set(every) - {*open_}), fine))
    return out


def _shared(cells: DataFrame, rows: int, name: str) -> DataFrame:
    """fp, e, p, cell, members of the cells that have two members or more."""
    sizes = materialise(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), f"{name}-sizes", rows)
    return materialise(cells.join(if_small(sizes, sizes.count()), "cell"), f"{name}-shared", rows)


def routes(fps: DataFrame, n: int, cell: int = CELL) -> dict[str, DataFrame]:
    """The links of ``links`` by the way they were found: grid, finer grid, hubs."""
    both = projections(groups_for(n))
    masks = F.array(*[F.lit(m) for m, _ in both])
    points = fps.select("fp", embedded(F.col("fp")).alias("e"))
    rows = n * len(both)
    cells = points.select("fp", "e", F.posexplode(masks).alias("p", "mask")).select("fp", "e", "p", F.xxhash64("p", F.col("e").bitwiseAND(F.col("mask"))).alias("cell"))
    shared = _shared(materialise(cells, "cells", rows), rows, "cells")
    crowd = shared.where(F.col("members") > cell)
    more = crowd.count()
    finer = F.array(*[F.array(*[F.lit(m) for m in fine]) for _, fine in both])
    fine = crowd.select("fp", "e", F.explode(F.get(finer, F.col("p"))).alias("mask")).select("fp", "e", F.xxhash64("mask", F.col("e").bitwiseAND(F.col("mask"))).alias("cell")).distinct()
    fine = _shared(materialise(fine, "fine-cells", more * 28), more * 28, "fine-cells") if more else shared.limit(0)

    def paired(found: DataFrame) -> DataFrame:
        a = found.where(F.col("members") <= cell)
        b = a.select(F.col("cell").alias("cell2"), F.col("fp").alias("fp2"), F.col("e").alias("e2"))
        near = (F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("e").bitwiseXOR(F.col("e2"))) <= BITS) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= BITS)
        return a.join(b, (F.col("cell") == F.col("cell2")) & near).select(F.col("fp").alias("u"), F.col("fp2").alias("v"))

    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i) for i in range(64)])
    hubs = fine.where(F.col("members") > cell).select("fp").distinct().select("fp", F.explode(flips).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("hub"))
    # at most 65 fingerprints are within one bit of a hub
    met = hubs.groupBy("hub").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    stars = met.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u <> v")
    return {"grid": paired(shared), "finer grid": paired(fine), "hubs": stars}


def links(fps: DataFrame, n: int, cell: int = CELL) -> DataFrame:
    """u, v: links between different fingerprints (column fp, distinct), enough of them to connect all
    that are connected by steps of at most BITS bits."""
    grid, finer, hubs = routes(fps, n, cell).values()
    return grid.unionByName(finer).unionByName(hubs)


def cluster(prints: DataFrame, cell: int = CELL, rows: int | None = None) -> DataFrame:
    """A frame that has doc_id and fp, every row of it, with its component_id and the component's root (its
    least fingerprint, which tells apart components without any id)."""
    prints = materialise(prints, "fingerprints", rows, TEXT_ROWS)
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes", prints.count())
    n = nodes.count()
    parts = materialise(components(links(nodes.select("fp"), n, cell)), "parts", n)
    rooted = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "rooted", n)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(ids, "root").select("fp", "component_id", "root"), "named", n)
    return prints.join(named, "fp").select(*prints.columns, "component_id", "root")


def near_duplicates(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row of ``docs``."""
    out = cluster(fingerprint(docs), cell, text_rows(docs))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Count-min sketches over 64-bit keys: one per partition, merged by addition, kept as bitmaps by range.

A cell of the merged sketch counts every key that falls into it, so the estimate of a key - the least
of its cells - is never below its true count.  Only "once" and "twice or more" matter to a repeat
filter, so counts saturate at two, partitions send the cells they touched, and the merged sketch is
one bit a cell.

The key range is dealt to blocks by a key's hash; all ``DEPTH`` cells of a key lie in its block.  So a
sketch of any width is a table of blocks of 16 KB: partitions send a row for each block that they touch,
blocks are merged by as many tasks as there are, and keys meet the merged bits either in a broadcast
copy (``held``, while all blocks fit into the bound) or by a join on the block (``passing``), where no
executor holds more than the blocks that its tasks ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import take_worker
from .scan import mix

DEPTH = 2
#: Cells of a block for each of the DEPTH hashes.
BLOCK = 1 << 16
SPAN = DEPTH * BLOCK
#: Cells for each expected key.
ROOM = 6
#: Blocks that may be broadcast: 4,096 are 64 MB.
MOST_BLOCKS = 4096


def blocks_for(keys: int) -> int:
    """Blocks for about ``keys`` keys: six or more cells a key and hash, as a power of two."""
    return max(1, 1 << int(max(1, -(-ROOM * keys // BLOCK)) - 1).bit_length())


def cells(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(block, cell within the block for each of the DEPTH hashes) of keys."""
    where = mix(keys ^ np.uint64(0x5851F42D4C957F2D))
    inner = mix(keys ^ np.uint64(0xB0A3E85A992AFE5A))
    low = np.uint64(BLOCK - 1)
    return (where & np.uint64(blocks - 1)).astype(np.int64), [((inner >> np.uint64(16 * d)) & low).astype(np.int64) + d * BLOCK for d in range(DEPTH)]


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values of a sorted array start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def partition_sketches(texts: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], blocks: int) -> DataFrame:
    """One row (block, part, offsets, twice) for each block that the keys of a partition touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        take_worker("sketch")
        part = (ctx.partitionId() if (ctx := TaskContext.get()) else 0) // 256
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            block, inner = cells(keys, blocks)
            at = np.sort(np.concatenate([block * SPAN + c for c in inner]))
            head = _runs(at)
            n = np.diff(np.append(head, len(at)))
            at = at[head]
            block = at // SPAN
            head = _runs(block)
            ends = np.append(head, len(at))
            yield pa.record_batch(
                [
                    pa.array(block[head], pa.int64()),
                    pa.array(np.full(len(head), part), pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer((at % SPAN).astype(np.uint32))]),
                    pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer((n > 1).astype(np.uint8))]),
                ],
                names=["block", "part", "offsets", "twice"],
            )

        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size >= 1 << 20:
                    yield from flush()
                    size = 0
        yield from flush()

    return texts.mapInArrow(run, "block long, part long, offsets binary, twice binary")


def _added(rows: pa.Table) -> np.ndarray:
    """The cells of one block, added up and saturated at two."""
    total = np.zeros(SPAN, dtype=np.uint8)
    for at, twice in zip(rows["offsets"], rows["twice"], strict=True):
        i = np.frombuffer(at.as_buffer(), dtype=np.uint32)
        total[i] = np.minimum(2, total[i] + 1 + np.frombuffer(twice.as_buffer(), dtype=np.uint8))
    return total


def _merge_part(rows: pa.Table) -> pa.Table:
    total = _added(rows)
    at = np.flatnonzero(total)
    return pa.table({"block": [rows["block"][0].as_py()], "offsets": [at.astype(np.uint32).tobytes()], "twice": [(total[at] > 1).astype(np.uint8).tobytes()]}, schema=pa.schema([("block", pa.int64()), ("offsets", pa.binary()), ("twice", pa.binary())]))


def _merge_last(rows: pa.Table) -> pa.Table:
    words = np.packbits(_added(rows) > 1, bitorder="little").view(np.int64)
    return pa.table({"block": [rows["block"][0].as_py()], "bits": [words]}, schema=pa.schema([("block", pa.int64()), ("bits", pa.list_(pa.int64()))]))


def merged(sketches: DataFrame) -> DataFrame:
    """block, bits: for each block a bit a cell, set where the cell counts twice or more.

    Partitions are added in groups of 256 first, so no task meets more than 256 sketches of a block in
    the first round, and the second has one row for each such group.
    """
    part = sketches.groupBy("block", "part").applyInArrow(_merge_part, "block long, offsets binary, twice binary")
    return part.groupBy("block").applyInArrow(_merge_last, "block long, bits array<long>")


def held(table: DataFrame, blocks: int, span: int = SPAN) -> np.ndarray:
    """The bits of all blocks in one array of bytes; the caller has checked that ``blocks`` is small."""
    out = np.zeros((blocks, span // 64), dtype=np.int64)
    got = table.toArrow()
    for block, bits in zip(got["block"], got["bits"], strict=True):
        out[block.as_py()] = bits.values.to_numpy()
    return out.view(np.uint8).reshape(-1)


def maybe_repeated(bits: np.ndarray, keys: np.ndarray, blocks: int) -> np.ndarray:
    """Whether a key's estimate is two or more: true for every repeated key, and for few others."""
    found = np.ones(len(keys), dtype=bool)
    block, inner = cells(keys, blocks)
    for c in inner:
        at = block * SPAN + c
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def bit(bits: str | Column, at: str | Column) -> Column:
    """Whether bit ``at`` of an array of longs is set."""
    at = F.col(at) if isinstance(at, str) else at
    word = F.get(bits, F.shiftrightunsigned(at, 6).cast("int"))
    return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def passing(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows (columns block, cell0, cell1, ...) whose estimate is two or more, by a join on the block.

    A key that very many rows share makes its block hot; either side is a fresh exchange, which AQE splits.
    """
    table = table.withColumnRenamed("block", "of_block")
    hit = rows.join(table, rows["block"] == table["of_block"])
    for d in range(DEPTH):
        hit = hit.where(bit("bits", f"cell{d}"))
    return hit.drop("block", "of_block", "bits", *[f"cell{d}" for d in range(DEPTH)])


# --- sets of 64-bit keys as bitmaps: what is filtered by them before a shuffle only gets smaller

#: Bits of a set's block, and the most blocks that a set has: 32 MB.  With more keys, more other rows pass.
SET_BLOCK = 1 << 16
SET_BLOCKS = 4096


def _dense(rows: pa.Table) -> pa.Table:
    out = np.zeros(SET_BLOCK // 64, dtype=np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return pa.table({"block": [rows["block"][0].as_py()], "bits": [out]}, schema=pa.schema([("block", pa.int64()), ("bits", pa.list_(pa.int64()))]))


def set_blocks(keys: int) -> int:
    """Blocks of the bitmap of about ``keys`` keys: 16 bits a key, a power of two, SET_BLOCKS at most."""
    return min(SET_BLOCKS, max(1, 1 << int(max(1, -(-16 * keys // SET_BLOCK)) - 1).bit_length()))


def _place(key: Column, blocks: int) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 16).bitwiseAND(F.lit(blocks - 1)).alias("block"), key.bitwiseAND(F.lit(SET_BLOCK - 1)).alias("at")


def bitmap(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """block, bits: the set of the well-mixed 64-bit keys of a column; ``blocks`` rows of 8 KB at most."""
    block, at = _place(F.col(column), blocks)
    words = keys.select(block, at).select("block", F.shiftrightunsigned("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit"))
    return words.groupBy("block", "word").agg(F.bit_or("bit").alias("bits")).groupBy("block").applyInArrow(_dense, "block long, bits array<long>")


def in_bitmap(rows: DataFrame, column: str, table: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a boolean column: false only where the key of a row is not in the set."""
    block, at = _place(F.col(column), blocks)
    table = table.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    return rows.join(F.broadcast(table), block == F.col("__block"), "left").withColumn(flag, F.coalesce(bit("__bits", at), F.lit(False))).drop("__block", "__bits")


def maybe_among(rows: DataFrame, column: str, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose value in ``column`` is among the ``count`` keys, and a few others."""
    if not count:
        return rows.limit(0)
    blocks = set_blocks(count)
    return in_bitmap(rows, column, bitmap(keys, key, blocks), blocks, "__may").where("__may").drop("__may")


def held_set(table: DataFrame, blocks: int) -> np.ndarray:
    return held(table, blocks, SET_BLOCK)


def in_held(bits: np.ndarray, keys: np.ndarray, blocks: int) -> np.ndarray:
    at = (((keys >> np.uint64(16)) & np.uint64(blocks - 1)) * np.uint64(SET_BLOCK) + (keys & np.uint64(SET_BLOCK - 1))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def total_bytes(texts: DataFrame, column: str = "text") -> int:
    return int(texts.agg(F.sum(F.octet_length(column))).first()[0] or 0)

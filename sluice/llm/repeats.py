"""Repeated windows of a corpus: the first passes that word and byte dedup share.

Windows are too many to shuffle.  Each window of L tokens is represented by its anchor (``scan.anchors``),
a gram inside it that equal windows share; neighbouring windows mostly share one anchor, and the text
that the windows of one anchor span is its *context*.  A count-min sketch of all anchors tells which
can be repeated.  Only their contexts are written out, one short row for each document and distinct context:
its anchor, a 128-bit digest of its text, and the places where it starts.  Windows of contexts that never
get here occur once in the corpus.  Texts of contexts are fetched (``bodies``) only for the anchors that
turn out to have contexts that must be compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan, sketch
from .common import TEXT_ROWS, bounded_batches, materialise, merged_partitions, take_worker, text_rows, text_weight

OCCURRENCES = "id long, rk long, akey long, c1 long, c2 long, n int, starts array<int>"
#: What stands for a null doc_id in ``id``: larger than any other.
LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Unit:
    """What a window is made of: ``kind`` byte or word, its length and that of an anchor's gram."""

    kind: str
    window: int
    gram: int


@dataclass
class Found:
    """The contexts of a block: document, first window start, windows, anchor; and how to read their texts."""

    row: int
    before: int
    off: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray
    akey: np.ndarray
    data: np.ndarray
    words: tuple[np.ndarray, np.ndarray] | None

    def texts(self, unit: Unit, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends) of the texts of contexts; words are joined by one space."""
        first, last = self.first[at], self.first[at] + self.count[at] + unit.window - 1
        if self.words is None:
            return self.data, first, last
        # of the words, only those that some context has are joined
        used = np.zeros(len(self.words[0]) + 1, dtype=np.int64)
        np.add.at(used, first, 1)
        np.add.at(used, last, -1)
        used = np.flatnonzero(np.cumsum(used[:-1]) > 0)
        text, to = scan.joined(self.data, self.words[0][used], self.words[1][used])
        return text, to[np.searchsorted(used, first)], to[np.searchsorted(used, last - 1) + 1] - 1


def _find(unit: Unit, texts: pa.Array) -> Iterator[Found]:
    for row, before, data, off in scan.pieces(texts, unit.window, unit.kind == "word"):
        rolled, words = scan.byte_roller(data), None
        if unit.kind == "word":
            start, end, off = scan.words(data, off)
            words = (start, end)
            rolled = scan.Roller(rolled.spans(start, end), 3)
        grams = rolled.grams(unit.gram)
        doc, first, count, at = scan.anchors(grams, unit.window, unit.gram, off)
        yield Found(row, before, off, doc, first, count, grams[at], data, words)


def anchor_keys(unit: Unit, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for f in _find(unit, batch.column("text")):
        yield f.akey


def _digests(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One row (two longs) for each of these spans of bytes."""
    raw, digest = memoryview(np.ascontiguousarray(text)), xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]), dtype=np.int64).reshape(-1, 2)


def _rows(unit: Unit, batch: pa.RecordBatch, keep, cells: int = 0) -> Iterator[pa.RecordBatch]:
    """The contexts whose anchors ``keep`` lets pass, with their cells in a sketch of that many blocks."""
    ids = batch.column("id").to_numpy()
    rk = batch.column("rk").to_numpy()
    for f in _find(unit, batch.column("text")):
        at = np.flatnonzero(keep(f.akey))
        if not len(at):
            continue
        both = _digests(*f.texts(unit, at))
        doc, first, count, akey = f.doc[at], f.first[at], f.count[at], f.akey[at]
        order = np.lexsort((first, both[:, 1], both[:, 0], doc))
        doc, first, count, akey, both = doc[order], first[order], count[order], akey[order], both[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (both[1:] != both[:-1]).any(axis=1)
        head = np.flatnonzero(new)
        ends = np.append(head, len(doc)).astype(np.int32)
        who = f.row + doc[head]
        out = {
            "id": pa.array(ids[who]),
            "rk": pa.array(rk[who]),
            "akey": pa.array(akey[head].view(np.int64)),
            "c1": pa.array(both[head, 0]),
            "c2": pa.array(both[head, 1]),
            "n": pa.array(count[head], pa.int32()),
            "starts": pa.ListArray.from_arrays(pa.array(ends), pa.array((f.before + first - f.off[doc]).astype(np.int32))),
        }
        if cells:
            block, inner = sketch.cells(akey[head], cells)
            out |= {"block": pa.array(block)} | {f"cell{d}": pa.array(c) for d, c in enumerate(inner)}
        yield pa.record_batch(list(out.values()), names=list(out))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, rk, text: rk tells apart rows that have one doc_id and different texts."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("rk"), F.col("text").cast("string").alias("text"))


def row_id():
    """doc_id with null as LAST: with rk it names a row, and joins need no comparison of nulls."""
    return F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("id")


def occurrences(docs: DataFrame, unit: Unit, most_blocks: int = sketch.MOST_BLOCKS) -> DataFrame:
    """The contexts that can be repeated, written to the shared folder (columns OCCURRENCES).

    ``docs`` has doc_id, rk and text.  The sketch has six cells or more for each expected anchor, at any
    size of the input.  Up to ``most_blocks`` blocks of it are broadcast, and contexts are held to it where
    they are found; a larger one stays a table, and the contexts, which are digests only, meet it by a join.
    """
    spark = docs.sparkSession
    size = sketch.total_bytes(docs)
    number = text_weight(docs.count(), size)
    expected = 2 * size // (unit.window - unit.gram + 2) // (1 if unit.kind == "byte" else 4)
    blocks = sketch.blocks_for(expected)
    table = sketch.merged(sketch.partition_sketches(docs.select("text"), lambda b: anchor_keys(unit, b), blocks))
    rows = docs.select(row_id(), "rk", "text")
    if blocks <= most_blocks:
        sent = spark.sparkContext.broadcast(sketch.held(table, blocks))

        def some(batches):
            take_worker("contexts")
            for batch in batches:
                yield from _rows(unit, batch, lambda keys: sketch.maybe_repeated(sent.value, keys, blocks))

        return materialise(rows.mapInArrow(some, OCCURRENCES), f"contexts-{unit.kind}", number, TEXT_ROWS)

    def every(batches):
        take_worker("contexts")
        for batch in batches:
            yield from _rows(unit, batch, lambda keys: np.ones(len(keys), dtype=bool), blocks)

    kind = OCCURRENCES + ", block long" + "".join(f", cell{d} long" for d in range(sketch.DEPTH))
    return materialise(sketch.passing(rows.mapInArrow(every, kind), materialise(table, "sketch")), f"contexts-{unit.kind}")


def bodies(docs: DataFrame, unit: Unit, anchors: DataFrame, count: int) -> DataFrame:
    """akey, c1, c2, n, body of every context of ``count`` anchors (column akey), and of a few others.

    A task sends the text of a context once; several tasks may send it.
    """
    spark = docs.sparkSession
    kind = "akey long, c1 long, c2 long, n int, body binary"
    if not count:
        return spark.createDataFrame([], kind)
    blocks = sketch.set_blocks(count)
    sent = spark.sparkContext.broadcast(sketch.held_set(sketch.bitmap(anchors, "akey", blocks), blocks))

    def run(batches):
        take_worker("bodies")
        said: set[bytes] = set()
        for batch in batches:
            for f in _find(unit, batch.column("text")):
                at = np.flatnonzero(sketch.in_held(sent.value, f.akey, blocks))
                if not len(at):
                    continue
                text, start, end = f.texts(unit, at)
                both = _digests(text, start, end)
                new = []
                for i, d in enumerate(map(bytes, both.view("V16").ravel())):
                    if d not in said:
                        said.add(d)
                        new.append(i)
                if len(said) > 1 << 18:  # texts are sent again, that is all
                    said.clear()
                at, both = at[new], both[new]
                yield pa.record_batch(
                    [pa.array(f.akey[at].view(np.int64)), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(f.count[at], pa.int32()), scan.binary_rows(text, start[new], end[new])],
                    names=["akey", "c1", "c2", "n", "body"],
                )

    return docs.select("text").mapInArrow(run, kind)


def with_spans(docs: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text, spans and ``columns`` of every row of ``docs`` (doc_id, rk, text); ``spans`` (id, rk, spans)
    has the rows that lose something.  The texts of all others are not shuffled."""
    number = docs.count()
    spans = materialise(spans, "spans", 8 * number)
    count = spans.count()
    docs = docs.withColumn("id", row_id())
    if not count:
        return docs.select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), *columns)
    blocks = sketch.set_blocks(count)
    table = materialise(sketch.bitmap(spans, "rk", blocks), "losers", blocks)
    docs = sketch.in_bitmap(docs, "rk", table, blocks, "may")
    spans = spans.withColumnsRenamed({"id": "of_id", "rk": "of_rk"})
    some = docs.where("may")
    some = some.join(spans, (some["id"] == spans["of_id"]) & (some["rk"] == spans["of_rk"]), "left").select("doc_id", "text", "spans", *columns)
    rest = docs.where("not may").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), *columns)
    number = text_rows(docs)
    return merged_partitions(some, number, TEXT_ROWS).unionByName(merged_partitions(rest, number, TEXT_ROWS))


def merged(spans: np.ndarray) -> np.ndarray:
    """Half-open spans (rows of two) merged where they touch or overlap."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    head = np.flatnonzero(new)
    return np.stack([spans[head, 0], reach[np.append(head[1:], len(spans)) - 1]], axis=1)


def runs_of(flags: np.ndarray) -> np.ndarray:
    """Half-open spans of the true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)

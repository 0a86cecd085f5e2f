"""Operator 2, substring dedup: count-min prefilter, then exact grouping of the windows that remain.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a window that covers it also
starts in a document with a smaller doc_id.  Pass one sketches the windows' anchors in every partition
and adds the sketches up: the estimate of a window, its anchor's, is never below its count.  Pass two
writes the contexts of windows estimated repeated.  Equal contexts are grouped first; where an anchor
has different contexts, their windows are grouped exactly, by 128-bit digests of their text (XXH3), for the least doc_id.

Defined results.  Null text: no words.  Null doc_id: larger than any other, so its rows keep nothing
from other rows and lose what they repeat from rows that have an id.  Rows with one doc_id and different
texts are separate rows of one document; equal rows get equal results.  Empty table: no rows.  Columns
other than doc_id and text are neither read nor returned.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, scan, sketch
from .common import materialise, take_worker

WINDOW = 50
UNIT = repeats.Unit("word", WINDOW, 16)


def _windows(size: int):
    """One row for each window of a context: its digest, the context and the place in it."""

    def run(batches):
        take_worker("windows")
        for b in batches:
            for row, _, data, off in scan.blocks(b.column("body")):
                start, end, doc = scan.words(data, off)
                n = np.diff(doc) - size + 1
                first = np.arange(int(n.sum())) + np.repeat(doc[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                both = repeats._digests(data, start[first], end[first + size - 1])
                own = np.repeat(np.arange(len(n)), n)
                cols = [np.repeat(b.column(c).to_numpy()[row : row + len(n)], n) for c in ("c1", "c2", "owner")]
                yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1]), *map(pa.array, cols), pa.array((first - doc[own]).astype(np.int32))], names=["w1", "w2", "c1", "c2", "owner", "at"])

    return run


def removed_spans(docs: DataFrame, unit: repeats.Unit = UNIT, **sketching) -> DataFrame:
    """id, rk, spans: for every document that loses words, the half-open word spans that go."""
    found = repeats.occurrences(docs, unit, **sketching)
    # partial sums are made before the shuffle: a context in a third of all documents is one row a task
    context = materialise(found.groupBy("akey", "c1", "c2").agg(F.min("id").alias("owner"), F.count(F.lit(1)).alias("docs")), "word-contexts", found.count())
    number = context.count()
    varied = materialise(context.groupBy("akey").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("akey"), "word-anchors", number)
    # texts are fetched only for anchors that have different contexts
    some = varied.count()
    bodies = repeats.bodies(docs, unit, varied, some).groupBy("akey", "c1", "c2").agg(F.first("body").alias("body"))
    own = sketch.maybe_among(context, "akey", varied, "akey", some).withColumnsRenamed({"akey": "of_akey", "c1": "of1", "c2": "of2"})
    bodies = bodies.join(own, (F.col("akey") == F.col("of_akey")) & (F.col("c1") == F.col("of1")) & (F.col("c2") == F.col("of2"))).select("c1", "c2", "owner", "body")
    windows = materialise(bodies.mapInArrow(_windows(unit.window), "w1 long, w2 long, c1 long, c2 long, owner long, at int"), "word-windows")
    first = materialise(windows.groupBy("w1", "w2").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first < last").select("w1", "w2", "first"), "word-firsts", windows.count())
    shared = sketch.maybe_among(windows, "w1", first, "w1", first.count())
    lost = (
        shared.join(first, ["w1", "w2"]).where("first < owner")
        .groupBy("c1", "c2").agg(F.sort_array(F.collect_list("at")).alias("lost"))
    )  # at most one entry for each window of one context, of which there are under 40
    known = context.where("docs > 1").select("c1", "c2", "owner").join(lost, ["c1", "c2"], "full")
    # a context that one document has and no other window of which is elsewhere takes nothing away
    hit = found.join(materialise(known.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "owner", "lost"), "word-lost", number), (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")))
    gone = hit.select(
        "id", "rk",
        F.when(F.col("id") > F.col("owner"), F.transform("starts", lambda s: F.struct(s.alias("a"), (s + F.col("n") + F.lit(unit.window - 1)).alias("b"))))
        .otherwise(F.flatten(F.transform(F.col("starts"), lambda s: F.transform(F.col("lost"), lambda w: F.struct((s + w).alias("a"), (s + w + F.lit(unit.window)).alias("b")))))).alias("spans"),
    )
    # a set: equal rows of a document name the same spans
    return gone.where(F.size("spans") > 0).groupBy("id", "rk").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _cut(batches):
    take_worker("cut-words")
    for b in batches:
        out = []
        spans = b.column("spans")
        for row, end, data, off in scan.blocks(b.column("text")):
            start, stop, doc = scan.words(data, off)
            gone = [_spans(spans[r]) + doc[r - row] for r in range(row, end)]
            gone = np.concatenate(gone) if gone else np.zeros((0, 2), np.int64)
            lost = np.zeros(len(start) + 1, dtype=np.int32)
            np.add.at(lost, gone[:, 0], 1)
            np.add.at(lost, gone[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(lost)[:-1] == 0)
            text, to = scan.joined(data, start[kept], stop[kept])
            raw, at = memoryview(text), np.searchsorted(kept, doc)
            for r in range(end - row):
                n, k = int(doc[r + 1] - doc[r]), int(at[r + 1] - at[r])
                own = raw[to[at[r]] : to[at[r + 1]] - 1] if k else b""
                out.append((n, n - k, hashlib.sha256(own).hexdigest(), bytes(own).decode("utf-8", "replace")))
        n, gone, sha, text = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(text, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def _spans(value) -> np.ndarray:
    """The rows (a, b) of one list<struct<a, b>> value; none for null."""
    if not value.is_valid or not len(value.values):
        return np.zeros((0, 2), dtype=np.int64)
    return np.stack([x.to_numpy() for x in value.values.flatten()], axis=1).astype(np.int64)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, **sketching) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each document with its repeated words cut out."""
    docs = repeats.keyed(docs)
    spans = removed_spans(docs, repeats.Unit("word", window, max(1, window // 3)), **sketching)
    return repeats.with_spans(docs, spans).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")

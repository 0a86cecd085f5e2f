"""Operator 10, quality classifier: supervised subword embeddings.

A document's features are its words, pairs of neighbouring words (all pairs of one word twice share a
feature) and the four-character pieces of its words, with a space beside them or without, hashed to
``BUCKETS`` rows of an embedding table.  Their vectors are averaged and a softmax layer gives the class.  Table and layer are trained together by
numpy stochastic gradient descent on a bounded sample of labelled documents.  The layer is linear in the
average, so a trained model is one number a bucket: scoring a text is a sum over its features, in numpy,
over the bytes of a whole Arrow batch.

Defined results.  Null, empty or wordless text: the score of no features, the model's bias.  Null
doc_id: not held out (its checksum is null), scored like any other, never learned from.  Repeated rows:
one result each.  No labels of both kinds: a constant model.  Empty table: no rows.  Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .common import bounded_batches, take_worker

#: Labelled documents that the model is trained on: those whose ids have the least hashes.
SAMPLE = 6_000
BUCKETS = 1 << 18
DIM = 8
PIECE = 4
EPOCHS = 12
RATE = 0.6
THRESHOLD = 0.3
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def features(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, document offsets) of the words, the word pairs and the pieces of a block."""
    low = np.uint64(buckets - 1)
    rolled = scan.byte_roller(data)
    start, end, doc = scan.words(data, off)
    word = rolled.spans(start, end)
    which = np.repeat(np.arange(len(off) - 1), np.diff(doc))
    inner = np.flatnonzero(which[1:] == which[:-1])
    left, right = word[inner], word[inner + 1]
    pair = scan.mix(np.where(left == right, np.uint64(7), left * _PAIR + right))
    pair_off = np.searchsorted(inner, doc)
    at = np.flatnonzero(data & 0xC0 != 0x80)  # where characters start
    n = len(at)
    piece, piece_off = np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    if n >= PIECE:
        stop = np.append(at, len(data))
        gaps = np.concatenate([[0], np.cumsum(scan.SPACE[data[at]])])
        edge = np.searchsorted(at, off)  # characters before each document
        owner = np.repeat(np.arange(len(off) - 1), np.diff(edge))
        i = np.arange(n - PIECE + 1)
        ok = (gaps[i + PIECE - 1] - gaps[i + 1] == 0) & (owner[i] == owner[i + PIECE - 1])
        i = i[ok]
        piece = rolled.spans(at[i], stop[i + PIECE])
        piece_off = np.searchsorted(i, edge)
    return [((word & low).astype(np.int64), doc), ((pair & low).astype(np.int64), pair_off), ((scan.mix(piece) & low).astype(np.int64), piece_off)]


@dataclass
class Model:
    """score = sigmoid(bias + mean of weight over the features): the softmax of two classes."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for row, end, data, off in scan.blocks(texts):
            total, count = np.zeros(end - row), np.zeros(end - row)
            for bucket, o in features(data, off, len(self.weight)):
                sums = np.concatenate([[0.0], np.cumsum(self.weight[bucket])])
                total += sums[o[1:]] - sums[o[:-1]]
                count += np.diff(o)
            out[row:end] += total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-out))


def _sparse(batches):
    for b in batches:
        index, weight = [], []
        for row, end, data, off in scan.blocks(b.column("text")):
            three = features(data, off)
            for r in range(end - row):
                u, c = np.unique(np.concatenate([f[o[r] : o[r + 1]] for f, o in three]), return_counts=True)
                index.append(u.astype(np.int32))
                weight.append((c / max(1, c.sum())).astype(np.float32))
        yield pa.record_batch([b.column("doc_id"), b.column("quality"), pa.array(index, pa.list_(pa.int32())), pa.array(weight, pa.list_(pa.float32()))], names=["doc_id", "quality", "index", "weight"])


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, quality and sparse features of at most ``sample`` labelled documents that aren't held out; of rows that
    share an id, of the one whose text has the least hash (then the least text), so reruns learn the same."""
    bounded_batches(docs.sparkSession)
    labels = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    labels = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(labels), "doc_id")
    one = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    rows = one.select("doc_id", F.col("x.text").alias("text"), "quality").repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc_id")
    return rows.mapInArrow(_sparse, "doc_id long, quality int, index array<int>, weight array<float>")


def train(index: list[np.ndarray], weight: list[np.ndarray], label: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents in a seeded order; classes weigh the same in total."""
    rng = np.random.default_rng(seed)
    kinds = np.bincount(label, minlength=2)
    if not len(label) or not kinds.all():
        return Model(np.zeros(buckets), 0.0 if not len(label) else (3.0 if kinds[1] else -3.0))
    table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer = rng.uniform(-1 / dim, 1 / dim, (2, dim)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    share = (len(label) / (2 * kinds))[label]
    steps, done = epochs * len(label), 0
    for _ in range(epochs):
        for d in rng.permutation(len(label)):
            i, w = index[d], weight[d]
            lr = rate * (1 - done / steps)
            done += 1
            mean = w @ table[i]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[d]] -= 1
            p *= share[d] * lr
            table[i] -= (w / w.max())[:, None] * (p @ layer)[None, :] * 0.5 if len(i) else 0
            layer -= np.outer(p, mean)
            bias -= p * 0.1
    seen = np.zeros(buckets, dtype=bool)
    for i in index:
        seen[i] = True
    table[~seen] = 0  # a feature that was never trained says nothing
    both = layer[1] - layer[0]
    # the classes were made to weigh the same; the prior is put back
    return Model((table @ both).astype(np.float64), float(bias[1] - bias[0] + np.log(kinds[1] / kinds[0])))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    got = sample_of(docs, labels, sample).toArrow().to_pandas().sort_values("doc_id")
    return train([np.asarray(x) for x in got["index"]], [np.asarray(x) for x in got["weight"]], got["quality"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted; with ``keep`` also text and, as the struct ``row``, its columns."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    row = [F.struct(*keep).alias("row")] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"), *row)

    def run(batches):
        take_worker("quality")
        for b in batches:
            s = sent.value.score(b.column("text"))
            out = {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}
            if keep:
                out |= {"text": b.column("text"), "row": b.column("row")}
            yield pa.record_batch(list(out.values()), names=list(out))

    kind = f", text string, row {rows.schema['row'].dataType.simpleString()}" if keep else ""
    return rows.mapInArrow(run, f"doc_id long, held_out boolean, score double, predicted int{kind}")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels, sample), threshold)

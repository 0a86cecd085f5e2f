"""Operator 3, quality rules: decision lists learned by sequential covering.

Statistics of whole texts are computed once.  From a bounded sample of labelled documents an ordered
list of threshold conjunctions is learned in the manner of incremental reduced-error pruning: a rule is
grown on two thirds of what is left, one test at a time by information gain, cut back on the other third
while that does not make it worse, and accepted if it is right more often than not there; documents that
it covers are taken away, and the next rule is grown.  The list is emitted as one Spark conditional
expression over the statistics, so documents are judged inside the JVM.

Defined results.  Null text: no words, so it fails the base rule.  Null doc_id: kept as null and never
used for learning.  Repeated rows: one result each; repeated labels of a document count once, by the
least.  No labelled documents of both kinds: every document that passes the base rule is kept.  Empty
table: no rows.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .common import bounded_batches, materialise

#: Labelled documents that the list is learned from: those whose ids have the least hashes.
SAMPLE = 20_000
GRAM = 3
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def repeated_words(words: np.ndarray, off: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Per document, the words that lie in a k-word window found twice or more in it."""
    n = len(words)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= k:
        doc = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
        start = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
        key = scan.mix(scan.Roller(words, 5).grams(k)[start] + doc[start] * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        at = start[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + k, -1)
    return _sums(np.cumsum(covered)[:n] > 0, off)


def _stats(batches):
    for b in batches:
        parts = []
        for row, end, data, off in scan.blocks(b.column("text")):
            start, stop, doc = scan.words(data, off)
            raw = data.tobytes()
            dup = np.zeros(end - row, dtype=np.int64)
            for i in range(end - row):
                lines = [x for x in raw[off[i] : off[i + 1]].split(b"\n") if x.strip()]
                dup[i] = len(lines) - len(set(lines))
            hashes = scan.byte_roller(data).spans(start, stop)
            parts.append([np.diff(doc), _sums(~scan.SPACE[data] & (data & 0xC0 != 0x80), off), _sums(_SYMBOL[data], off), dup, repeated_words(hashes, doc)])
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5
        yield pa.record_batch([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", *STATS])


def statistics(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_stats, "doc_id long, " + ", ".join(f"{c} long" for c in STATS))


def features() -> dict[str, Column]:
    """What rules may test: figures of a text that has words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "repeat_ratio": F.col("n_repeat_words") / n,
        "dup_lines": F.col("n_dup_lines").cast("double"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        f = features()[self.feature]
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for t in self.tests:
            out &= t.holds(x)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))


@dataclass
class DecisionList:
    """Rules in order; a document that one covers is rejected, any other kept."""

    rules: list[Rule] = field(default_factory=list)

    def keeps(self) -> Column:
        out = F.when(F.lit(False), F.lit(False))
        for r in self.rules:
            out = out.when(r.column(), F.lit(False))
        return out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join([f"if {r}: reject" for r in self.rules] + ["else: keep"])


def _cuts(v: np.ndarray, most: int = 64) -> np.ndarray:
    u = np.unique(v)
    if len(u) > most:
        u = np.unique(np.quantile(v, np.linspace(0, 1, most + 1)))
    return (u[:-1] + u[1:]) / 2


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    tests: list[Test] = []
    live = np.ones(len(bad), dtype=bool)
    while (live & ~bad).any() and len(tests) < 6:
        p0, n0 = (live & bad).sum(), (live & ~bad).sum()
        best, gain = None, 1e-9
        for name, v in x.items():
            for cut in _cuts(v[live]):
                for above in (True, False):
                    hit = live & (v > cut if above else v <= cut)
                    p, n = (hit & bad).sum(), (hit & ~bad).sum()
                    if p and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Test(name, above, float(cut)), g
        if best is None:
            break
        tests.append(best)
        live &= best.holds(x)
    return Rule(tuple(tests))


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = rule.covers(x)
    p, n = (hit & bad).sum(), (hit & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, least: float = 0.5, rules: int = 16) -> DecisionList:
    """The list for labelled rows: x of features, whether a row is bad, and its fold (0, 1, 2; 2 prunes)."""
    out = DecisionList()
    left = np.ones(len(bad), dtype=bool)
    while (left & bad).any() and len(out.rules) < rules:
        take = lambda m: ({k: v[m] for k, v in x.items()}, bad[m])
        grow, prune = take(left & (fold != 2)), take(left & (fold == 2))
        if not grow[1].any() or grow[1].all() or not prune[1].any():
            break
        rule = _grow(*grow)
        if not rule.tests:
            break
        shorter = [Rule(rule.tests[:k]) for k in range(1, len(rule.tests) + 1)]
        rule = max(shorter, key=lambda r: (_worth(r, *prune), -len(r.tests)))
        if _worth(rule, *prune) < least:
            break
        out.rules.append(rule)
        left &= ~rule.covers(x)
    return out


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Learns from at most ``sample`` labelled documents that pass the base rule; of rows that share an id, from the
    one with the least statistics, so the rules don't depend on the order of rows."""
    labels = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    labels = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = stats.where(~base_failed()).join(F.broadcast(labels), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(*STATS)).alias("s")).select("doc_id", "quality", "s.*")
    got = rows.select("doc_id", "quality", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *[c.alias(k) for k, c in features().items()]).toPandas().sort_values("doc_id")
    return learn({k: got[k].to_numpy() for k in features()}, got["quality"].to_numpy() == 0, got["fold"].to_numpy())


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the five statistics, base_failed and kept of every row of ``docs``."""
    stats = materialise(statistics(docs), "statistics")
    rules = fit(stats, labels, sample)
    return stats.select("doc_id", *STATS, base_failed().alias("base_failed"), (~base_failed() & rules.keeps()).alias("kept"))

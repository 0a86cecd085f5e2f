"""The label log: events (seq, op, point_id, label) folded to the labels that stand, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(have: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``have`` with the rows of ``new`` in place of those with the same keys."""
    return have.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def last_labels(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of every key."""
    rest = [c for c in log.columns if c not in keys]
    g = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def undo(log: DataFrame, key: str, seq: str, op: str = "op") -> DataFrame:
    """The events that stand once each "undo" has taken back the last standing event before it.

    Undo acts within ``key``: the number of undos still owed, counted from the end, tells which events
    fall, so the fold is a window sum and its running maximum.
    """
    back = Window.partitionBy(key).orderBy(F.desc(seq)).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col(op) == "undo", 1).otherwise(-1)
    # owed after a row, read from the end = running sum less its least value so far, where that is below zero
    total = log.withColumn("_s", F.sum(step).over(back))
    floor = F.least(F.lit(0), F.min("_s").over(back))
    return total.withColumn("_f", floor).withColumn("_p", F.lag("_f", 1, 0).over(Window.partitionBy(key).orderBy(F.desc(seq)))).where((F.col(op) != "undo") & (F.col("_f") < F.col("_p"))).drop("_s", "_f", "_p")


def next_pending(queue: DataFrame, labels: DataFrame, key: str, seq: str) -> DataFrame:
    return queue.join(labels.select(key).distinct(), key, "left_anti").orderBy(seq).limit(1)


def validate(log: DataFrame, queue: DataFrame, key: str, classes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with a reason)."""
    ids = queue.select(F.col(key).alias("_q")).distinct()
    j = log.join(ids, F.col(key) == F.col("_q"), "left").withColumn("reason", F.when(F.col("_q").isNull(), "unknown id").when(~F.coalesce(F.col("label").isin(classes), F.lit(False)), "unknown class"))
    return j.where("reason is null").drop("_q", "reason"), j.where("reason is not null").drop("_q")


def progress(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def resume(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of ``todo``: every retry and every new run starts from here."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def stream_labels(log: DataFrame) -> DataFrame:
    """A streaming log (point_id, seq, op, label) to updates (point_id, label, seq): the last standing label.

    A key's state is the list of its standing labels, so an undo can go back to the one before.
    """

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        labels, seqs = (list(x) for x in state.get) if state.exists else ([], [])
        for row in pd.concat(list(frames)).sort_values("seq").itertuples():
            if row.op == "undo":
                labels, seqs = labels[:-1], seqs[:-1]
            else:
                labels.append(row.label)
                seqs.append(row.seq)
        state.update((labels, seqs))
        yield pd.DataFrame({"point_id": [key[0]], "label": [labels[-1] if labels else None], "seq": [seqs[-1] if seqs else None]})

    return log.groupBy("point_id").applyInPandasWithState(fold, "point_id string, label string, seq long", "labels array<string>, seqs array<long>", "update", "NoTimeout")

"""The stages as a plan: each is a function of tables, its result is kept, and a run can start anywhere."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.params import VALUES
from ..operators import economics, failure, graph, health, naming, spatial, supply, tree
from ..state import settle


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]


@dataclass
class Runner:
    """Runs stages in order; a stage whose table is there is skipped unless forced or after a forced one."""

    spark: SparkSession
    folder: str
    stages: list[Stage]
    done: list[tuple[str, str]] = field(default_factory=list)

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name) + "/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def __call__(self, inputs: dict[str, DataFrame], start: str | None = None, force: bool = False) -> dict[str, DataFrame]:
        """All tables by name.  A stage that fails raises, and what came before stays done."""
        have, waiting = dict(inputs), start is not None
        for s in self.stages:
            waiting = waiting and s.name != start
            if waiting or (self.exists(s.name) and not force and (start is None or s.name != start)):
                self.done.append((s.name, "skipped"))
            else:
                s.run(*[have[n] for n in s.needs]).write.mode("overwrite").parquet(self._path(s.name))
                self.done.append((s.name, "ran"))
            have[s.name] = self.table(s.name)
        return have


def analysis(budget: float = VALUES["budget"]) -> list[Stage]:
    """health -> command -> ranking -> paths -> plan -> failures -> names.

    Inputs: segments (seg_id, src, dst, length_m, can_type, can_name, prj_name, district), sources (node),
    points (seg_id, p_impaired, pred_class), cells (seg_id, district, crop_class, area_ha), economics
    (district, revenue_per_ha), multipliers (can_type, multiplier).
    """

    def local(segments, cells):
        a = cells.groupBy("seg_id").agg(F.sum("area_ha").alias("local_ha"))
        return segments.join(a, "seg_id", "left").withColumn("local_ha", F.coalesce("local_ha", F.lit(0.0)))

    def ranking(loc, h):
        command = graph.downstream_sum(loc, "local_ha").select("seg_id", F.col("total").alias("command_ha"))
        j = loc.join(command, "seg_id").join(graph.tree_betweenness(loc), "seg_id").join(h.select("seg_id", "health_score", "dominant_class"), "seg_id", "left")
        return supply.rank_segments(j)

    def plan(ranked, sources, multipliers):
        s = settle(economics.with_cost(ranked, multipliers))
        way = supply.routes(s, settle(graph.hops(s, sources, directed=True)))
        return supply.route_plan(s, way, s.sparkSession.createDataFrame([("default", float(budget))], "scenario string, budget double"))

    def failures(ranked, sources, cells, eco, multipliers):
        s = economics.with_cost(ranked, multipliers)
        counts, area = failure.single_failures(s, tree.dominators(s, sources), cells)
        return failure.records(counts, area, s.select("seg_id", "district", "cost_inr", "can_name", "can_type", "length_m"), eco)

    def names(segments, sources):
        up = segments.select("seg_id", F.col("src").alias("n")).join(segments.groupBy(F.col("dst").alias("n")).agg(F.min("seg_id").alias("up")), "n").select("seg_id", "up")
        return naming.reach_names(segments, graph.chainage(segments, sources), up)

    return [
        Stage("health", ("points",), health.segment_health),
        Stage("local", ("segments", "cells"), local),
        Stage("ranked", ("local", "health"), ranking),
        Stage("paths", ("segments", "sources"), lambda s, r: graph.supply_paths(s, graph.hops(s, r, directed=True))),
        Stage("plan", ("ranked", "sources", "multipliers"), plan),
        Stage("failures", ("ranked", "sources", "cells", "economics", "multipliers"), failures),
        Stage("names", ("segments", "sources"), names),
    ]


def allocate(cells: DataFrame, lines: DataFrame, mndwi: DataFrame | None = None) -> DataFrame:
    """The service stage: cells (id, x, y, area_ha) with the line that serves each, and their crop class."""
    out = spatial.serve(cells.where("area_ha > 0.05 * 4"), lines, VALUES["service_distance"])
    if mndwi is None:
        return out
    wet = F.coalesce(F.col("value") > 0, F.lit(False))
    return out.join(mndwi, "id", "left").withColumn("crop_class", F.when(wet, "paddy-like (inferred)").otherwise("other cropland (inferred)")).drop("value")

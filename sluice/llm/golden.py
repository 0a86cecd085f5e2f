"""Operator 12, golden record survivorship: pivot by source.

One conditional aggregation over a cluster keeps, for each trust level, its latest candidate with a value for
each field.  Whether a candidate is fresh is told afterwards, against the latest time of its cluster: the latest of
a level is fresh if any of the level is.  The record then takes the first of the levels' candidates down the
ladder, fresh ones before stale ones.

* RECENT: latest updated_at (null last), higher trust, smaller client_id.
* TRUSTED: fresh before stale, higher trust, then RECENT.
* segment by RECENT; email by TRUSTED; name by most code points, then TRUSTED; balance from records of the chosen
  segment before all others, then RECENT; city and nation_id from one record: most non-nulls of both, then TRUSTED.

Hot clusters.  Aggregations combine before they shuffle.  Stale records are counted from pre-aggregated
(cluster, time) counts; these are joined to their cluster's latest time, and clusters with very many times, of which
there can be no more than ``HOT_SHARE``, meet it by broadcast instead, so no cluster is ever brought into one task.

Defined results.  cluster_id is master_id, or client_id where that is null; rows with neither form one cluster of id
null.  Texts that are empty or hold only ASCII white space are null, sources too; others stay as they are.  Sources
outside the ladder, and null, are trusted least and alike.  A balance that is no finite number is null: it has no
cents.  Repeated client_ids: each row is a record; of rows that tie in every order the greatest value is taken.  A
null client_id comes last; a value from such a record has a null ``_from``.  Empty table: no rows.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small, materialise

LADDER = ("crm", "web", "store", "partner")
FRESH_HOURS = 60 * 24
#: A cluster with over ROWS and over one in HOT_SHARE of all (cluster, time) rows is hot: there are HOT_SHARE at most.
HOT_ROWS, HOT_SHARE = 10_000, 50_000
SPACE = " \t\n\x0b\x0c\r"


def filled(name: str) -> Column:
    """The text, or null where it is empty or only white space."""
    return F.when(F.trim(F.col(name), F.lit(SPACE)) != "", F.col(name))


def records(clients: DataFrame, ladder: Sequence[str] = LADDER) -> DataFrame:
    """cluster_id, client_id, updated_at, level (0 is trusted most), and the fields, blank ones null."""
    source = filled("source")
    level = reduce(lambda out, i: F.when(source == ladder[i], F.lit(i)).otherwise(out), range(len(ladder)), F.lit(len(ladder)))
    finite = F.col("balance").isNotNull() & ~F.isnan("balance") & (F.abs("balance") < float("inf"))
    return clients.select(
        F.coalesce("master_id", "client_id").alias("cluster_id"), "client_id", "updated_at", level.alias("level"),
        *[filled(c).alias(c) for c in ("name", "email", "city", "segment")], "nation_id", F.when(finite, F.col("balance")).alias("balance"),
    )


def _earlier_id() -> Column:
    """Greater for smaller ids, least for null."""
    return F.bitwise_not(F.col("client_id"))


def candidates(rows: DataFrame, levels: int) -> DataFrame:
    """One row a cluster: counts, the latest time, the latest segment and balance, and a candidate a level and field."""
    here = [F.col("updated_at").alias("at"), _earlier_id().alias("id")]
    recent = [F.col("updated_at").alias("at"), (-F.col("level")).alias("trust"), _earlier_id().alias("id")]
    both = F.col("city").isNotNull().cast("int") + F.col("nation_id").isNotNull().cast("int")
    out = [
        F.count(F.lit(1)).alias("n_records"), F.max("updated_at").alias("latest"),
        F.max(F.when(F.col("segment").isNotNull(), F.struct(*recent, "segment", "client_id"))).alias("segment"),
        F.max(F.when(F.col("balance").isNotNull(), F.struct(*recent, "balance", "client_id"))).alias("balance"),
    ]
    for k in range(levels):
        mine = F.col("level") == k
        out += [
            F.max(F.when(mine & F.col("email").isNotNull(), F.struct(*here, "email", "client_id"))).alias(f"email_{k}"),
            F.max(F.when(mine & F.col("name").isNotNull(), F.struct(F.length("name").alias("points"), *here, "name", "client_id"))).alias(f"name_{k}"),
            F.max(F.when(mine, F.struct(both.alias("filled"), *here, "city", "nation_id", "client_id"))).alias(f"address_{k}"),
        ]
    return rows.groupBy("cluster_id").agg(*out)


def stale_counts(rows: DataFrame, latest: DataFrame, fresh_hours: int = FRESH_HOURS) -> DataFrame:
    """cluster_id, n_stale: records without a time, or over ``fresh_hours`` before their cluster's latest one."""
    times = materialise(rows.groupBy("cluster_id", "updated_at").agg(F.count(F.lit(1)).alias("n")), "golden-times")
    least = max(HOT_ROWS, times.count() // HOT_SHARE)
    hot = materialise(times.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("hot_latest")).where(F.col("rows") > least), "golden-hot", HOT_SHARE)
    many = hot.count()  # HOT_SHARE at most, whatever the table's size
    marked = times.join(if_small(hot.select(F.col("cluster_id").alias("hot_id"), "hot_latest"), many), F.col("cluster_id").eqNullSafe(F.col("hot_id")), "left")
    rest = latest.select(F.col("cluster_id").alias("own_id"), "latest")
    cold = marked.where(F.col("hot_latest").isNull()).join(rest, F.col("cluster_id").eqNullSafe(F.col("own_id")), "left").select("cluster_id", "updated_at", "n", "latest")
    told = cold.unionByName(marked.where(F.col("hot_latest").isNotNull()).select("cluster_id", "updated_at", "n", F.col("hot_latest").alias("latest")))
    fresh = F.coalesce(is_fresh(F.col("updated_at"), F.col("latest"), fresh_hours), F.lit(False))
    return told.groupBy("cluster_id").agg(F.sum(F.when(fresh, F.lit(0)).otherwise(F.col("n"))).alias("n_stale"))


def is_fresh(at: Column, latest: Column, hours: int = FRESH_HOURS) -> Column:
    return at >= latest - F.make_dt_interval(F.lit(0), F.lit(hours))


def survivors(clients: DataFrame, ladder: Sequence[str] = LADDER, fresh_hours: int = FRESH_HOURS) -> DataFrame:
    """One golden record a cluster, with where each value is from."""
    levels = len(ladder) + 1
    rows = records(clients, ladder)
    each = materialise(candidates(rows, levels), "golden-candidates")
    latest = F.col("latest")

    def fresh(c: Column) -> Column:
        return F.coalesce(is_fresh(c["at"], latest, fresh_hours), F.lit(False))

    def ladder_first(field: str) -> Column:
        """The first candidate by TRUSTED: down the ladder among the fresh ones, then among all."""
        at = [F.col(f"{field}_{k}") for k in range(levels)]
        return F.coalesce(*[F.when(fresh(c), c) for c in at], *at)

    def most_first(field: str, measure: str) -> Column:
        """The candidate with the greatest measure, ties by TRUSTED."""
        at = [F.col(f"{field}_{k}") for k in range(levels)]
        top = F.greatest(*[c[measure] for c in at])
        at = [F.when(c[measure] == top, c) for c in at]
        return F.coalesce(*[F.when(fresh(c), c) for c in at], *at)

    chosen = each.select(
        "cluster_id", "n_records", "segment", "balance", ladder_first("email").alias("email"), most_first("name", "points").alias("name"), most_first("address", "filled").alias("address")
    )
    # the latest balance of each (cluster, segment); the join's keys are unique on either side
    of_segment = F.max(F.struct(F.col("updated_at").alias("at"), (-F.col("level")).alias("trust"), _earlier_id().alias("id"), "balance", "client_id"))
    inner = rows.where("balance is not null and segment is not null").groupBy(F.col("cluster_id").alias("own_id"), F.col("segment").alias("own_segment")).agg(of_segment.alias("own"))
    chosen = chosen.join(inner, F.col("cluster_id").eqNullSafe(F.col("own_id")) & (F.col("segment.segment") == F.col("own_segment")), "left").drop("own_id", "own_segment")
    stale = stale_counts(rows, each, fresh_hours).select(F.col("cluster_id").alias("stale_id"), "n_stale")
    chosen = chosen.join(stale, F.col("cluster_id").eqNullSafe(F.col("stale_id")), "left").withColumn("balance", F.coalesce("own", "balance"))
    address = F.col("address")
    return chosen.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "n_records", F.col("n_stale").cast("long").alias("n_stale"),
        F.col("name.name").alias("name"), F.col("email.email").alias("email"), F.col("segment.segment").alias("segment"), address["city"].alias("city"), address["nation_id"].alias("nation_id"),
        F.floor(F.col("balance.balance") * 100 + 0.5).cast("long").alias("balance_cents"),
        *[F.col(f"{c}.client_id").alias(f"{c}_from") for c in ("name", "email", "segment", "balance")],
        F.when(address["filled"] > 0, address["client_id"]).alias("address_from"),
    )


def _blank(name: str) -> str:
    return f"CASE WHEN regexp_full_match({name}, '[\\x20\\x09-\\x0D]*') THEN NULL ELSE {name} END AS {name}"


_LEVEL = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(LADDER)) + f" ELSE {len(LADDER)} END"
ORACLE = f"""
WITH r AS (SELECT coalesce(master_id, client_id) AS cluster_id, client_id, updated_at, {_blank('name')}, {_blank('email')}, {_blank('city')}, {_blank('segment')}, nation_id,
  CASE WHEN isfinite(balance) THEN balance END AS balance, {_LEVEL} AS level FROM clients),
m AS (SELECT *, max(updated_at) OVER (PARTITION BY cluster_id) AS latest FROM r),
s AS (SELECT *, coalesce(updated_at < latest - INTERVAL {FRESH_HOURS} HOUR, true) AS stale, (city IS NOT NULL)::INT + (nation_id IS NOT NULL)::INT AS filled FROM m),
o AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY updated_at DESC NULLS LAST, level, client_id NULLS LAST) AS recent,
  row_number() OVER (PARTITION BY cluster_id ORDER BY stale, level, updated_at DESC NULLS LAST, client_id NULLS LAST) AS trusted FROM s),
g AS (SELECT cluster_id, count(*)::BIGINT AS n_records, sum(stale::INT)::BIGINT AS n_stale,
  arg_min({{'v': segment, 'i': client_id}}, recent) FILTER (segment IS NOT NULL) AS se, arg_min({{'v': email, 'i': client_id}}, trusted) FILTER (email IS NOT NULL) AS em,
  arg_min({{'v': name, 'i': client_id}}, (-length(name), trusted)) FILTER (name IS NOT NULL) AS na, arg_min({{'c': city, 'n': nation_id, 'i': client_id, 'f': filled}}, (-filled, trusted)) AS ad FROM o GROUP BY 1),
b AS (SELECT o.cluster_id, arg_min({{'v': balance, 'i': client_id}}, (CASE WHEN segment = se.v THEN 0 ELSE 1 END, recent)) AS ba FROM o JOIN g ON o.cluster_id IS NOT DISTINCT FROM g.cluster_id WHERE balance IS NOT NULL GROUP BY 1)
SELECT g.cluster_id, n_records, n_stale, na.v AS name, em.v AS email, se.v AS segment, ad.c AS city, ad.n AS nation_id, floor(100 * ba.v + 0.5)::BIGINT AS balance_cents,
  na.i AS name_from, em.i AS email_from, se.i AS segment_from, ba.i AS balance_from, CASE WHEN ad.f > 0 THEN ad.i END AS address_from
FROM g LEFT JOIN b ON g.cluster_id IS NOT DISTINCT FROM b.cluster_id
"""

"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_kmeans, bpe, decision_list, fair_mix, golden, license_scan, projected_ann, shards, simhash_dedup, subword_quality, substring_dedup, suffix_dedup, warc_revisit
from .common import table

#: Rows of a search's query set: those whose id this divides.
EVERY = 20


def op1_projected_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents")).drop("kept")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenise(table(spark, sf_dir, "documents"), *bpe.default_vocabulary())


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(table(spark, sf_dir, "documents"))


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(table(spark, sf_dir, "documents"))


def op10_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op12_golden_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.survivors(table(spark, sf_dir, "clients"))


def op13_block_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_kmeans.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_projected_ann": op1_projected_ann,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decision_list": op3_decision_list,
    "op4_warc_revisit": op4_warc_revisit,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_bpe": op7_bpe,
    "op8_license_scan": op8_license_scan,
    "op9_fair_mix": op9_fair_mix,
    "op10_subword_quality": op10_subword_quality,
    "op11_minimax_shards": op11_minimax_shards,
    "op12_golden_record": op12_golden_record,
    "op13_block_kmeans": op13_block_kmeans,
}

ORACLES: dict[str, str] = {
    "op4_warc_revisit": warc_revisit.ORACLE,
    "op9_fair_mix": fair_mix.ORACLE,
    "op11_minimax_shards": shards.ORACLE,
    "op12_golden_record": golden.ORACLE,
    "op13_block_kmeans": block_kmeans.ORACLE,
    "op2_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)),
own AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS first FROM win),
hit AS (SELECT DISTINCT doc_id, p + o AS q FROM (SELECT doc_id, p, unnest(range(0, 50)) AS o FROM own WHERE first < doc_id)),
gone AS (SELECT doc_id, list(q) AS qs, count(*) AS n FROM hit GROUP BY doc_id),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS q, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN hit USING (doc_id, q) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}

"""The flagship query: all stages over the documents, summed up by shard and collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.curation import curate, item_features, shard_summary
from shelfmark.plans import bindings as B
from shelfmark.plans.relational import TARGET_MB
from shelfmark.plans.sequences import CONTEXT, FLAGGED, PRINT, SUMMARIES
from shelfmark.plans.verdicts import CONFIG, PARSED, RUBRIC


def _curated(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    labels = B.collection_labels(spark, sf_dir).select(
        F.col("collection_id").cast("bigint").alias("collection_id"), "album_score"
    )
    responses = B.verdict_texts(spark, sf_dir).select("item_id", "response", "error")
    no_stop = ~F.endswith(F.rtrim("text"), F.lit("."))
    features = item_features(B.items(spark, sf_dir), no_stop, F.col("lang"))
    return curate(features, responses, labels, CONFIG, TARGET_MB, **options)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_summary(_curated(spark, sf_dir))


def packed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every optional stage switched off."""
    return shard_summary(_curated(spark, sf_dir, run_sequence=False, run_scoring=False, run_quality=False))


QUERIES = {"flagship": flagship, "flagship_packed_only": packed_only}


def _shards(kept: str) -> str:
    return f"""kept AS ({kept}),
shuffled AS (SELECT *, row_number() OVER (ORDER BY md5('{B.SEED}:' || item_id), item_id) - 1 AS position FROM kept),
size AS (SELECT CAST(greatest(floor({TARGET_MB * 1024 * 1024} / (avg(bytes) + 2000)), 1) AS BIGINT) AS rows_per_shard FROM shuffled),
placed AS (SELECT *, position // (SELECT rows_per_shard FROM size) AS shard FROM shuffled)"""


_CLEAN = f"""SELECT collection_id, item_id, bytes FROM items WHERE right(rtrim(text), 1) = '.'
  QUALIFY row_number() OVER (PARTITION BY {PRINT} ORDER BY item_id) = 1"""

ORACLE = {
    "flagship": B.cte(
        B.ITEMS, B.COLLECTIONS, B.COLLECTION_LABELS, B.VERDICT_TEXTS, PARSED, FLAGGED, SUMMARIES, CONTEXT, RUBRIC, _shards(_CLEAN)
    )
    + """SELECT shard, p.collection_id, count(*) AS rows, round(CAST(sum(bytes) AS BIGINT) / 1048576.0, 6) AS mb, count(*) FILTER (is_key) AS keys,
           CAST(sum(ai_score) AS BIGINT) AS ai_score_sum, CAST(sum(CASE WHEN rubric_value IS NOT NULL THEN raw_score END) AS BIGINT) AS rubric_score_sum,
           max(album_score) AS album_score
         FROM placed p JOIN scored s USING (item_id) LEFT JOIN collection_labels l ON l.collection_id = p.collection_id
         GROUP BY shard, p.collection_id""",
    "flagship_packed_only": B.cte(B.ITEMS, B.COLLECTIONS, B.COLLECTION_LABELS, _shards("SELECT collection_id, item_id, bytes FROM items"))
    + """SELECT shard, p.collection_id, count(*) AS rows, round(CAST(sum(bytes) AS BIGINT) / 1048576.0, 6) AS mb, CAST(0 AS BIGINT) AS keys,
           CAST(NULL AS BIGINT) AS ai_score_sum, CAST(NULL AS BIGINT) AS rubric_score_sum, max(album_score) AS album_score
         FROM placed p LEFT JOIN collection_labels l ON l.collection_id = p.collection_id GROUP BY shard, p.collection_id""",
}

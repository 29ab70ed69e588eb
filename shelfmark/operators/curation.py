"""The stages put together: sequence context, scoring, quality routing and packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import SHARD_MB
from shelfmark.functions.vectors import letter_counts
from shelfmark.operators import packing, quality, sequence, verdicts
from shelfmark.scale import HOT_ROWS, SPAN, attach, largest_group
from shelfmark.storage import stage


def item_features(items: DataFrame, broken: Column, hash_column: Column) -> DataFrame:
    """Everything later stages need of an item's payload, from one pass over it, written once."""
    narrow = items.select(
        "collection_id",
        "item_id",
        "bytes",
        sequence.fingerprint(F.col("text")).alias("fingerprint"),
        broken.alias("broken"),
        hash_column.alias("hash"),
        "text",
    )
    return stage(letter_counts(narrow, "text"), "features")


def curate(
    features: DataFrame,
    responses: DataFrame,
    labels: DataFrame,
    config: dict,
    target_mb: float = SHARD_MB,
    run_sequence: bool = True,
    run_scoring: bool = True,
    run_quality: bool = True,
    span: int = SPAN,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Clean items with flags, scores, collection label and shard; each stage can be left out."""
    group, key = ["collection_id"], ["item_id"]
    keyed = features.select("collection_id", "item_id")
    biggest = largest_group(keyed, group)
    kept = features.select("collection_id", "item_id", "bytes")
    if run_quality:
        whole = features.filter(~F.col("broken")).select("collection_id", "item_id", "bytes", "fingerprint")
        first = quality.first_copies(whole, "fingerprint", "item_id").select("item_id")
        kept = stage(whole.join(first, "item_id", "left_semi").select("collection_id", "item_id", "bytes"), "kept")
    out = packing.assign_shards(kept, target_mb, span=span)
    if run_sequence:
        flags = sequence.sequence_flags(
            features.select("collection_id", "item_id", "hash", "hist"), group, key, [F.col("item_id")], span=span, biggest=biggest
        )
        gates = sequence.sequence_gates(features, group)
        analyzed = gates.filter(F.col("status") == "analyzed").select("collection_id", F.lit(True).alias("_ok"))
        labels = labels.join(analyzed, "collection_id", "full")
        out = out.join(flags.select("item_id", "is_key", "is_filler"), "item_id", "left")
    if run_scoring:
        parsed = verdicts.parse_lines(responses).select("item_id", "ai_score", "ai_factors")
        out = out.join(parsed, "item_id", "left")
    # One join brings all that is known of the collection: its label and whether it was analysed.
    out = attach(out, labels, group, key, "left", hot_rows, keyed, biggest)
    none = F.lit(False)
    if run_sequence:
        ok = F.coalesce("_ok", none)
        out = out.withColumns({"is_key": ok & F.coalesce("is_key", none), "is_filler": ok & F.coalesce("is_filler", none)})
    else:
        out = out.withColumns({"is_key": none, "is_filler": none})
    if run_scoring:
        _, score = verdicts.rubric_score(F.col("ai_factors"), F.col("is_key"), F.col("is_filler"), config)
        out = out.withColumn("rubric_score", score)
    else:
        out = out.withColumns({"ai_score": F.lit(None).cast("int"), "rubric_score": F.lit(None).cast("int")})
    return out.drop("_ok", "ai_factors")


def shard_summary(curated: DataFrame) -> DataFrame:
    """Rows, megabytes, flags and scores by shard and collection."""
    return curated.groupBy("shard", "collection_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("bytes") / 1048576.0, 6).alias("mb"),
        F.count_if("is_key").alias("keys"),
        F.sum("ai_score").alias("ai_score_sum"),
        F.sum("rubric_score").alias("rubric_score_sum"),
        F.max("album_score").alias("album_score"),
    )

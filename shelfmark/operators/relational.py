"""Collections, items and their labels: joins, filters, counts, order and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.constants import SAMPLE_COUNT
from shelfmark.functions.text import blank_to_null
from shelfmark.scale import HOT_ROWS, SPAN, attach, ordered_index


def pack_rows(items: DataFrame, collections: DataFrame, labels: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Items with their collection's metadata and label, with the packed row's defaults.

    Collections without items and items without a collection drop out. Missing scores and flags
    stay null, missing texts become empty. Ids are compared as numbers on every side.
    """
    as_id = F.col("collection_id").try_cast("bigint")
    attributes = (
        collections.withColumn("collection_id", as_id)
        .select("collection_id", "title", "creator_name", "tags")
        .join(labels.withColumn("collection_id", as_id), "collection_id", "left")
    )
    joined = attach(
        items.withColumn("collection_id", as_id), attributes, ["collection_id"], ["file_name"], "inner", hot_rows
    )
    return packed_columns(joined)


def packed_columns(joined: DataFrame) -> DataFrame:
    """The packed row of an item beside its collection and label."""
    empty = F.lit("")
    return joined.select(
        "item_id",
        "image",
        "file_name",
        F.coalesce("title", empty).alias("title"),
        F.coalesce("creator_name", empty).alias("model_name"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.col("collection_id").alias("album_id"),
        F.coalesce("text_en", empty).alias("text_en"),
        F.coalesce("text_cn", empty).alias("text_cn"),
        F.col("album_score").cast("tinyint").alias("album_score"),
        F.coalesce("album_reason", empty).alias("album_reason"),
        F.lit(None).cast("tinyint").alias("ai_score"),
        empty.alias("ai_reason"),
        "has_face",
        "has_fullbody",
    )


def with_item_labels(packed: DataFrame, item_labels: DataFrame) -> DataFrame:
    """Fill the item-level score and reason by (collection, item stem)."""
    labels = item_labels.select(
        F.col("collection_id").alias("album_id"), "stem", F.col("ai_score").alias("_score"), F.col("ai_reason").alias("_reason")
    )
    stem = F.regexp_replace("file_name", r"(?<=.)\.[^.]+$", "")
    return (
        packed.withColumn("stem", stem)
        .join(labels, ["album_id", "stem"], "left")
        .withColumn("ai_score", F.coalesce(F.col("_score").cast("tinyint"), "ai_score"))
        .withColumn("ai_reason", F.coalesce("_reason", "ai_reason"))
        .drop("_score", "_reason", "stem")
    )


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("collection_id").agg(F.count(F.lit(1)).alias("item_count"))


def collection_info(collections: DataFrame, items: DataFrame, labels: DataFrame) -> DataFrame:
    """Every collection with its item count (0 when empty) and whether it is labelled."""
    labeled = labels.select("collection_id").distinct().withColumn("labeled", F.lit(True))
    return (
        collections.select("collection_id", "name")
        .join(item_counts(items), "collection_id", "left")
        .join(labeled, "collection_id", "left")
        .select(
            "collection_id",
            "name",
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            F.coalesce("labeled", F.lit(False)).alias("labeled"),
        )
    )


def summary(info: DataFrame) -> DataFrame:
    return info.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("labeled").alias("labeled"),
        F.count_if(~F.col("labeled")).alias("unlabeled"),
    )


def labeled(collections: DataFrame, labels: DataFrame) -> DataFrame:
    return collections.join(labels, "collection_id", "left_semi")


def unlabeled(collections: DataFrame, labels: DataFrame) -> DataFrame:
    return collections.join(labels, "collection_id", "left_anti")


def missing_names(collections: DataFrame) -> DataFrame:
    return collections.filter(
        blank_to_null("creator_name").isNull() & F.col("creator_id").isNotNull() & (F.col("creator_id") != 0)
    )


def backfill_names(collections: DataFrame, creators: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fill empty creator names from the lookup; existing names stay."""
    names = creators.select("creator_id", F.col("name").alias("_name"))
    return (
        attach(collections, names, ["creator_id"], ["collection_id"], "left", hot_rows)
        .withColumn("creator_name", F.coalesce(blank_to_null("creator_name"), "_name", F.lit("")))
        .drop("_name")
    )


def completeness(collections: DataFrame, items: DataFrame) -> DataFrame:
    """Compare the expected count with the items present and mark complete collections."""
    present = F.coalesce("item_count", F.lit(0))
    return (
        collections.select("collection_id", "expected_count")
        .join(item_counts(items), "collection_id", "left")
        .select(
            "collection_id",
            "expected_count",
            present.alias("item_count"),
            F.coalesce(present >= F.col("expected_count"), F.lit(False)).alias("completed"),
        )
    )


def todo_items(items: DataFrame, verdicts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Items without a verdict that has a non-zero score."""
    done = verdicts.filter(F.coalesce("score", F.lit(0)) != 0).select(*key)
    return items.join(done, list(key), "left_anti")


def lookup(collections: DataFrame, name: str) -> DataFrame:
    """All collections of that name, or one row with ``found`` false."""
    hits = collections.filter(F.col("name") == name).withColumn("found", F.lit(True))
    missing = hits.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0").select(
        F.lit(name).alias("name"), F.lit(False).alias("found")
    )
    return hits.unionByName(missing, allowMissingColumns=True)


def seeded_order(key: Column, seed: str) -> Column:
    """Reproducible random order of a key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def shuffle_order(items: DataFrame, seed: str = "42", span: int = SPAN) -> DataFrame:
    """Position of every item in one seeded shuffle of all items."""
    keyed = items.select("item_id", seeded_order(F.col("item_id"), seed).alias("shuffle_key"))
    return ordered_index(keyed, [], [F.col("shuffle_key"), F.col("item_id")], "position", span)


def sample_per_group(items: DataFrame, group: str, count: int = SAMPLE_COUNT, seed: str = "42") -> DataFrame:
    """``count`` seeded random items of each group.

    Spark keeps only ``count`` rows per group in every map task before the shuffle.
    """
    keyed = items.select(group, "item_id", seeded_order(F.col("item_id"), seed).alias("_key"))
    window = Window.partitionBy(group).orderBy("_key", "item_id")
    return (
        keyed.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= count)
        .drop("_key")
    )


def items_sorted(items: DataFrame, span: int = SPAN) -> DataFrame:
    """Lexicographic position of every item inside its collection."""
    keyed = items.select("collection_id", "file_name", "item_id")
    return ordered_index(keyed, ["collection_id"], [F.col("file_name"), F.col("item_id")], "position", span)


def collections_zh(collections: DataFrame) -> DataFrame:
    """Place of every collection in the Chinese-locale order of their names."""
    return ordered_index(collections, [], [F.collate("name", "zh"), F.col("collection_id")], "position")


def offset_page(df: DataFrame, order: Sequence[str], offset: int, rows: int = 5) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(rows)


def presence_counts(items: DataFrame, detections: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of detections of each item and whether it has any."""
    counts = detections.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return items.join(counts, list(key), "left").select(*key, n.alias("detections"), (n > 0).alias("present"))

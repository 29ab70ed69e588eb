"""Shuffled, size-targeted shards and their way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import ROW_OVERHEAD_BYTES, SHARD_MB
from shelfmark.functions.text import blank_to_null, folder_name, stem_of
from shelfmark.operators.relational import seeded_order
from shelfmark.scale import HOT_ROWS, SPAN, attach, largest_group, ordered_index, running_sum
from shelfmark.storage import stage


def shard_size(items: DataFrame, target_mb: float = SHARD_MB) -> DataFrame:
    """Rows per shard from the mean size of all rows; one aggregate that combines map-side."""
    rows = F.floor(F.lit(float(target_mb * 1024 * 1024)) / (F.avg("bytes") + ROW_OVERHEAD_BYTES))
    return items.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.coalesce(F.greatest(rows, F.lit(1)), F.lit(1)).cast("bigint").alias("rows_per_shard"),
    )


def assign_shards(
    items: DataFrame, target_mb: float = SHARD_MB, seed: str = "42", span: int = SPAN
) -> DataFrame:
    """Add the position in the shuffle and the shard number; pass narrow rows with their ``bytes``."""
    size = shard_size(items, target_mb).select("rows_per_shard")
    keyed = items.withColumn("_key", seeded_order(F.col("item_id"), seed))
    placed = ordered_index(keyed, [], [F.col("_key"), F.col("item_id")], "position", span)
    return placed.withColumn("shard", F.floor(F.col("position") / size.scalar()).cast("bigint")).drop("_key")


def balance_shards(items: DataFrame, target_mb: float = SHARD_MB, seed: str = "42") -> DataFrame:
    """Add the position in the shuffle and the shard number, cut by bytes; pass narrow rows with their ``bytes``.

    A shard takes rows until their bytes, with the overhead of a row, reach the target, so none is larger than the target
    and its last row. Sums are taken over the seeded order by ranges; unknown sizes count as the overhead alone.
    """
    weight = F.coalesce("bytes", F.lit(0)) + ROW_OVERHEAD_BYTES
    keyed = items.withColumn("_key", seeded_order(F.col("item_id"), seed)).withColumn("_weight", weight)
    summed = running_sum(keyed, [F.col("_key"), F.col("item_id")], "_weight", "_before")
    target = max(int(target_mb * 1024 * 1024), 1)
    cut = stage(summed.withColumn("_cut", F.floor(F.col("_before") / target)).drop("_key", "_weight", "_before"), "cuts")
    # A row beyond the target skips numbers: number the shards that have rows.
    dense = ordered_index(cut.groupBy("_cut").agg(F.min("position").alias("_first")), [], [F.col("_first")], "shard")
    return cut.join(dense.select("_cut", "shard"), "_cut").drop("_cut")


def shard_manifest(assigned: DataFrame) -> DataFrame:
    """Final name, rows and megabytes of every shard."""
    shards = assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("bytes") / 1048576.0, 6).alias("mb")
    )
    total = shards.agg(F.count(F.lit(1)))
    return shards.select(
        "shard",
        F.format_string("train-%05d-of-%05d.parquet", F.col("shard"), total.scalar()).alias("name"),
        "rows",
        "mb",
    )


def name_shards(assigned: DataFrame, split: str = "train") -> DataFrame:
    """Add the final file name of each row's shard."""
    total = assigned.agg(F.max("shard") + 1)
    return assigned.withColumn(
        "file", F.format_string(f"{split}-%05d-of-%05d.parquet", F.col("shard"), total.scalar())
    )


def smoke_shard(assigned: DataFrame) -> DataFrame:
    return assigned.filter(F.col("shard") == 0)


def unpack_collections(packed: DataFrame) -> DataFrame:
    """One document per collection: attributes of its first row, item count, folder name.

    Needs ``position``, the row's place in the packed dataset. All aggregates combine map-side.
    """
    first = F.min_by(F.struct("title", "model_name", "tags"), F.col("position"))
    docs = packed.groupBy("album_id").agg(first.alias("d"), F.count(F.lit(1)).alias("image_count"))
    return docs.select(
        "album_id",
        "d.title",
        "d.model_name",
        "d.tags",
        "image_count",
        folder_name("album_id", "d.title").alias("folder"),
    )


def unpack_items(packed: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """Items of each collection in file-name order with their target path.

    The nested list of the unpacked form is kept flat, one row per item with its place, so that a
    collection never has to fit into one row.
    """
    keyed = packed.select("album_id", "item_id", "file_name")
    biggest = largest_group(keyed, ["album_id"])
    placed = ordered_index(keyed, ["album_id"], [F.col("file_name"), F.col("item_id")], "place", span, biggest)
    folders = unpack_collections(packed).select("album_id", "folder")
    joined = attach(placed, folders, ["album_id"], ["item_id"], "inner", hot_rows, keyed, biggest)
    return joined.select(
        "album_id", "item_id", "place", F.concat_ws("/", "folder", "file_name").alias("path")
    )


def unpack_item_labels(packed: DataFrame) -> DataFrame:
    """Label document of every item that has anything to say; absent fields are left out."""

    def text(name: str):
        return F.when(F.col(name) != "", F.col(name)).alias(name)

    document = F.to_json(
        F.struct(
            "album_score",
            text("album_reason"),
            "ai_score",
            text("ai_reason"),
            "has_face",
            "has_fullbody",
        )
    )
    return packed.select(
        "album_id",
        "item_id",
        F.concat(stem_of("file_name"), F.lit("_labels.json")).alias("label_file"),
        document.alias("document"),
    ).filter(F.col("document") != "{}")

"""Folding label edits into the current state.

Both folds are plain aggregates that combine map-side, so an item or collection with any number of
edits costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_aggregates() -> list[Column]:
    """Latest supplied value of each collection field.

    ``score`` counts as supplied when ``score_set`` is true, so it can be cleared or set to 0. An
    empty tag list replaces, empty notes do not. ``images`` is replaced as a whole.
    """

    def latest(value: str, supplied: Column) -> Column:
        boxed = F.when(supplied, F.struct(F.col(value).alias("v")))
        return F.max_by(boxed, F.when(supplied, F.col("seq")))["v"].alias(value)

    return [
        latest("score", F.coalesce("score_set", F.lit(False))),
        latest("tags", F.col("tags").isNotNull()),
        latest("notes", F.coalesce("notes", F.lit("")) != ""),
        latest("images", F.col("images").isNotNull()),
        F.max("seq").alias("last_seq"),
    ]


def merge_keep(edits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Collection policy: an edit overwrites only the fields it supplies."""
    return edits.groupBy(*key).agg(*keep_aggregates())


def merge_replace(edits: DataFrame, key: Sequence[str], verdicts: DataFrame | None = None) -> DataFrame:
    """Item policy: an edit replaces score, tags and notes together; verdict fields stay."""
    latest = edits.groupBy(*key).agg(
        F.max_by(F.struct("score", "tags", "notes"), "seq").alias("e"), F.max("seq").alias("last_seq")
    ).select(*key, "e.score", "e.tags", "e.notes", "last_seq")
    return latest if verdicts is None else verdicts.join(latest, list(key), "full")


def merge_text(labels: DataFrame, texts: DataFrame, key: str, fields: Sequence[str] = ("text_en", "text_cn")) -> DataFrame:
    """Take over new texts only where they are not empty."""
    fresh = texts.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    merged = labels.join(fresh, key, "full")
    for f in fields:
        merged = merged.withColumn(f, F.coalesce(F.nullif(F.col(f"_{f}"), F.lit("")), F.col(f)))
    return merged.drop(*[f"_{f}" for f in fields])


def upsert_missing(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old labels stay; new ones are added only where there was none."""
    return old.unionByName(new.join(old, list(key), "left_anti"))

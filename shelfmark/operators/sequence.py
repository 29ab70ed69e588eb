"""Change detection over the ordered items of a collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from shelfmark.constants import (
    ABRUPT_THRESHOLD,
    DEFAULT_SEQUENCE_TEXT,
    FILLER_RATIO,
    MIN_SEQUENCE_FEATURES,
    MIN_SEQUENCE_ITEMS,
    SEQUENCE_TEXT,
    SUSTAINED_THRESHOLD,
    SUSTAINED_WINDOW,
)
from shelfmark.functions.text import natural_order
from shelfmark.functions.vectors import dot
from shelfmark.scale import HOT_ROWS, SPAN, attach, ordered_index, windowed


def fingerprint(text: Column) -> Column:
    """MD5 of a text in lower case with its white space squeezed."""
    return F.md5(F.lower(F.btrim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))))


def sequence_index(items: DataFrame, group: Sequence[str], span: int = SPAN) -> DataFrame:
    """Place of each item in numeric-aware file order; needs columns ``stem`` and ``item_id``."""
    return ordered_index(items, group, [*natural_order("stem"), F.col("item_id")], "idx", span)


def sequence_flags(
    items: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    order: Sequence[Column],
    abrupt: float = ABRUPT_THRESHOLD,
    sustained: float = SUSTAINED_THRESHOLD,
    lookback: int = SUSTAINED_WINDOW,
    span: int = SPAN,
    narrow: DataFrame | None = None,
    biggest: int | None = None,
) -> DataFrame:
    """Per item: similarity to the one before and the three change flags.

    Needs ``hist`` (numeric array) and ``hash``. The first item is always a change. A missing
    feature gives no change and leaves the positions alone. Cosine does not depend on scale, so raw
    counts serve as histogram, and the similarity of integers is exact.
    """
    # Of the histogram, one copy goes through the shuffle.
    ready = items.withColumn("_h", F.col("hist").cast("array<double>")).drop("hist").withColumns(
        {"_norm": F.sqrt(dot(F.col("_h"), F.col("_h"))), "has_feature": F.col("_h").isNotNull()}
    )

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        first = F.col("idx") == 0
        scale = F.col("_norm") * F.col("_norm0")
        sim = F.when(scale == 0, F.lit(0.0)).otherwise(dot(F.col("_h"), F.col("_h0")) / scale)
        recent = F.avg("sim").over(w.rowsBetween(1 - lookback, 0))
        return (
            df.withColumn("_h0", F.lag("_h").over(w))
            .withColumn("_norm0", F.lag("_norm").over(w))
            .withColumn("hash_change", first | F.coalesce(F.col("hash") != F.lag("hash").over(w), F.lit(False)))
            .withColumn("sim", sim)
            .withColumn("recent_sim", F.when(F.col("idx") >= lookback, recent))
            .withColumn("abrupt", first | F.coalesce(F.col("sim") < abrupt, F.lit(False)))
            .withColumn("sustained", first | F.coalesce(F.col("recent_sim") < sustained, F.lit(False)))
            .withColumn("is_key", F.col("abrupt") | F.col("hash_change") | F.col("sustained"))
            .withColumn("is_filler", ~F.col("is_key"))
            .drop("_h", "_h0", "_norm", "_norm0")
        )

    return windowed(ready, group, order, key, lookback, build, span, narrow, biggest)


def sequence_type(
    total: Column,
    fillers: Column,
    keys: Column,
    filler_ratio: float = FILLER_RATIO,
    steps: Sequence[int] = (3, 8, 15),
) -> Column:
    """Type of a sequence from its number of items, fillers and key items."""
    return (
        F.when((total < 10) | (fillers / total > filler_ratio), "random")
        .when(keys <= steps[0], "minimal")
        .when(keys <= steps[1], "stepwise")
        .when(keys <= steps[2], "segmented")
        .otherwise("continuous")
    )


def sequence_text(kind: Column, total: Column, keys: Column) -> tuple[Column, Column]:
    """Two-language description of a sequence from the template of its type."""

    def fill(template: str) -> Column:
        with_n = F.replace(F.lit(template), F.lit("{n}"), total.cast("string"))
        return F.replace(with_n, F.lit("{k}"), keys.cast("string"))

    texts = []
    for language in (0, 1):
        text = fill(DEFAULT_SEQUENCE_TEXT[language])
        for name, templates in SEQUENCE_TEXT.items():
            text = F.when(kind == name, fill(templates[language])).otherwise(text)
        texts.append(text)
    return texts[0], texts[1]


def sequence_summary(
    flags: DataFrame,
    group: Sequence[str],
    min_items: int = MIN_SEQUENCE_ITEMS,
    min_features: int = MIN_SEQUENCE_FEATURES,
    filler_ratio: float = FILLER_RATIO,
) -> DataFrame:
    """One row per collection: counts, type and description; too small ones only get a status."""
    counted = flags.groupBy(*group).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_if("has_feature").alias("feature_count"),
        F.count_if("is_key").alias("_keys"),
        F.count_if("is_filler").alias("_fillers"),
        F.count_if("abrupt").alias("_abrupt"),
        F.count_if("hash_change").alias("_hash"),
        F.count_if("sustained").alias("_sustained"),
    )
    status = sequence_status(F.col("item_count"), F.col("feature_count"), min_items, min_features)
    typed = counted.withColumn("status", status).withColumn(
        "sequence_type",
        F.when(
            F.col("status") == "analyzed",
            sequence_type(F.col("item_count"), F.col("_fillers"), F.col("_keys"), filler_ratio),
        ).otherwise(F.col("status")),
    )
    done = F.col("status") == "analyzed"
    text_en, text_cn = sequence_text(F.col("sequence_type"), F.col("item_count"), F.col("_keys"))
    return typed.select(
        *group,
        "item_count",
        "status",
        "sequence_type",
        F.when(done, F.col("_keys")).alias("key_count"),
        F.when(done, F.col("_fillers")).alias("filler_count"),
        F.when(done, F.round(F.col("_fillers") / F.col("item_count"), 6)).alias("filler_ratio"),
        F.when(done, F.col("_abrupt")).alias("abrupt_count"),
        F.when(done, F.col("_hash")).alias("hash_change_count"),
        F.when(done, F.col("_sustained")).alias("sustained_count"),
        F.when(done, text_en).alias("text_en"),
        F.when(done, text_cn).alias("text_cn"),
    )


def sequence_status(
    items: Column, features: Column, min_items: int = MIN_SEQUENCE_ITEMS, min_features: int = MIN_SEQUENCE_FEATURES
) -> Column:
    return (
        F.when(items < min_items, "insufficient_frames")
        .when(features < min_features, "insufficient_data")
        .otherwise("analyzed")
    )


def sequence_gates(
    features: DataFrame,
    group: Sequence[str],
    feature: str = "hist",
    min_items: int = MIN_SEQUENCE_ITEMS,
    min_features: int = MIN_SEQUENCE_FEATURES,
) -> DataFrame:
    """Status of every collection from its counts alone, without looking at the sequence."""
    counted = features.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.count(feature).alias("_f"))
    return counted.select(*group, sequence_status(F.col("_n"), F.col("_f"), min_items, min_features).alias("status"))


def item_context(
    flags: DataFrame, gates: DataFrame, group: Sequence[str], key: Sequence[str],
    hot_rows: int = HOT_ROWS, measure: DataFrame | None = None,
) -> DataFrame:
    """Key and filler flag of every item by its key; items of unanalysed collections get neither."""
    analyzed = gates.select(*group, (F.col("status") == "analyzed").alias("_ok"))
    known = attach(flags.select(*group, *key, "is_key", "is_filler"), analyzed, group, key, "left", hot_rows, measure)
    ok = F.coalesce("_ok", F.lit(False))
    return known.select(*group, *key, (ok & F.col("is_key")).alias("is_key"), (ok & F.col("is_filler")).alias("is_filler"))

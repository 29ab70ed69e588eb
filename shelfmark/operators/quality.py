"""Detection of broken and duplicate items and their quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import CATEGORIES


#: Categories of the registry that have a detector, in order of precedence.
DETECTED = sorted(set(CATEGORIES) & {"broken", "duplicate", "non_main"})


def truncated_html(html: Column) -> Column:
    """A page without its closing tag; no page at all counts, too."""
    return ~F.coalesce(F.contains(F.lower(html), F.lit("</html>")), F.lit(False))


def first_copies(items: DataFrame, print_column: str, item: str) -> DataFrame:
    """First item of every fingerprint and the number of its copies; combines map-side.

    A null fingerprint belongs to a missing payload, which is broken and no copy of others.
    """
    return items.filter(F.col(print_column).isNotNull()).groupBy(print_column).agg(F.min(item).alias(item), F.count(F.lit(1)).alias("copies"))


def duplicates(items: DataFrame, print_column: str, item: str) -> DataFrame:
    """Items that are not the first of their fingerprint.

    The anti join is on the unique item key, so a fingerprint with very many copies is no hot key.
    """
    kept = first_copies(items, print_column, item).select(item)
    return items.filter(F.col(print_column).isNotNull()).join(kept, item, "left_anti")


def quarantine(broken: DataFrame, duplicate: DataFrame, non_main: DataFrame, key: list[str]) -> DataFrame:
    """One row per quarantined item; the first matching category in this order counts."""
    ranked = (
        broken.select(*key, F.lit(DETECTED.index("broken")).alias("_rank"))
        .unionByName(duplicate.select(*key, F.lit(DETECTED.index("duplicate")).alias("_rank")))
        .unionByName(non_main.select(*key, F.lit(DETECTED.index("non_main")).alias("_rank")))
    )
    names = F.array(*[F.lit(c) for c in DETECTED])
    return ranked.groupBy(*key).agg(F.min("_rank").alias("_rank")).select(
        *key, F.get(names, F.col("_rank")).alias("category")
    )


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("category", "collection_id").agg(F.count(F.lit(1)).alias("items"))


def clean(items: DataFrame, quarantined: DataFrame, item: str) -> DataFrame:
    return items.join(quarantined.select(item), item, "left_anti")

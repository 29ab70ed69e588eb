"""A table written for lookups by one key: sorted, with Bloom filters, in small row groups.

A lookup of a name reads the row groups whose range holds it and whose filter does not rule it out; all others are
skipped from the files' footers. The table is sorted by ranges, so a name lies in one or two files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.relational import lookup

#: Bytes of a row group, and distinct keys a filter is made for.
GROUP_BYTES, GROUP_KEYS = 1 << 20, 100_000


def write_lookup(
    df: DataFrame, path: str, key: str = "name", files: int | None = None, group_bytes: int = GROUP_BYTES, group_keys: int = GROUP_KEYS
) -> None:
    """Write ``df`` sorted by ``key``, replacing the target; ``files`` gives the number of ranges."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (
        ranged.sortWithinPartitions(key).write.mode("overwrite")
        .option("parquet.block.size", group_bytes)
        .option("parquet.page.size.row.check.min", 100)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", group_keys)
        .parquet(path)
    )


def look_up(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All rows of that name, or one row with ``found`` false."""
    return lookup(spark.read.parquet(path), name)

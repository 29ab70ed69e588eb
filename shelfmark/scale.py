"""Group-wise building blocks that stay bounded when one group holds most of the rows.

* ``largest_group`` / ``hot_keys``: measure skew on the key columns only.
* ``attach``: rows joined to one-row-per-key attributes, hot keys salted.
* ``ordered_index``: exact 0-based position inside each group.
* ``running_sum``: exact sum of all rows before a row, in one global order.
* ``windowed``: window expressions over ordered groups, in chunks with a halo of previous rows.

A group is only handed to one task as a whole after its size was measured to be at most ``span``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfmark.storage import stage

#: Most rows of one group that a single window task may see.
SPAN = 500_000
#: Rows of one join key beyond which the key is salted.
HOT_ROWS = 5_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; the keys come from ``left``."""
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return left.join(right.withColumnsRenamed(renamed), on, how).drop(*renamed.values())


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Size of the biggest group; one partially aggregated pass over the keys."""
    if not keys:
        return df.count()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of salts each needs.

    There are at most total_rows / hot_rows of them, which bounds the result's size.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts"))
    )


def attach(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    measure: DataFrame | None = None,
    biggest: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``dim`` (at most one row per key) without a hot key ending in one task.

    Rows of a hot key are spread over salts by ``spread_on``; only that key's single ``dim`` row
    is repeated, once per salt. AQE still turns the join into a broadcast when ``dim`` is
    measured to be below the session's broadcast threshold. ``measure`` is a cheaper frame with at
    least the same rows per key, for when ``rows`` is costly to compute; ``biggest`` is its largest
    group where the caller knows it already.
    """
    keys = list(keys)
    measure = rows if measure is None else measure
    if (largest_group(measure, keys) if biggest is None else biggest) <= hot_rows:
        return null_safe_join(rows, dim, keys, how)
    hot = hot_keys(measure, keys, hot_rows)
    salted = null_safe_join(rows, F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*spread_on), F.col("_salts")).cast("int")
        ),
    ).drop("_salts")
    repeated = null_safe_join(dim, F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return null_safe_join(salted, repeated, [*keys, "_salt"], how).drop("_salt")


def ordered_index(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "idx",
    span: int = SPAN,
    biggest: int | None = None,
) -> DataFrame:
    """Add the 0-based position of every row inside its group.

    ``order`` must be total. Pass narrow rows: when some group is larger than ``span`` they are
    range-sorted, written, and the positions put together from per-partition counts, so no task
    ever holds a group.
    """
    if group and (largest_group(df, group) if biggest is None else biggest) <= span:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(window) - 1).cast("bigint"))
    return _split_index(df, list(group), order, name)


def _split_index(df: DataFrame, group: list[str], order: Sequence[Column], name: str) -> DataFrame:
    range_sorted = df.orderBy(*[F.col(g) for g in group], *order)
    # The id counts up inside a sorted partition, and its upper bits are the partition number.
    numbered = stage(range_sorted.withColumn("_at", F.monotonically_increasing_id()), "order")
    numbered = numbered.withColumn("_part", F.shiftright("_at", 33))
    parts = numbered.groupBy(*group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    # One row per (group, partition that holds some of it): at most one per range partition.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    keyed = null_safe_join(numbered, starts, [*group, "_part"])
    return keyed.withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def running_sum(
    df: DataFrame, order: Sequence[Column], value: str, name: str = "before", index: str = "position"
) -> DataFrame:
    """Add the 0-based position of every row in the order, and the sum of ``value`` over the rows before it.

    ``order`` must be total. Pass narrow rows: they are range-sorted and written once; each range partition is summed
    by itself and shifted by the partitions before it, so no task sees more than one range.
    """
    numbered = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sums")
    numbered = numbered.withColumn("_part", F.shiftright("_at", 33))
    parts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"))
    # One row per range partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"),
    )
    within = Window.partitionBy("_part").orderBy("_at")
    summed = numbered.withColumn(
        name, F.coalesce(F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn(index, (F.row_number().over(within) - 1).cast("bigint"))
    return (
        summed.join(starts, "_part")
        .withColumn(name, F.col(name) + F.col("_shift"))
        .withColumn(index, F.col(index) + F.col("_rows"))
        .drop("_at", "_part", "_rows", "_shift")
    )


def windowed(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    key: Sequence[str],
    halo: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    span: int = SPAN,
    narrow: DataFrame | None = None,
    biggest: int | None = None,
) -> DataFrame:
    """Apply ``build(df, window)`` to every group in order; ``idx`` holds the position.

    ``build`` may look back at most ``halo`` rows. Groups of up to ``span`` rows take one shuffle.
    If any group is larger, only its keys are sorted globally, and the rows are windowed in chunks
    of ``span`` positions, each repeating the last ``halo`` rows of the chunk before. ``narrow``
    names a frame with the same rows but only the group, key and order columns, for when ``df``
    has columns that are costly to compute; ``biggest`` is the largest group where the caller knows it.
    """
    group, key = list(group), list(key)
    narrow = df if narrow is None else narrow
    if (largest_group(narrow, group) if biggest is None else biggest) <= span:
        window = Window.partitionBy(*group).orderBy(*order)
        return build(df.withColumn("idx", (F.row_number().over(window) - 1).cast("bigint")), window)
    # Keep only what the order needs, so that wide columns stay out of the global sort.
    tagged = narrow.select(*group, *key, *[o_col.alias(f"_o{i}") for i, o_col in enumerate(order)])
    index = _split_index(
        tagged, group, [F.col(f"_o{i}") for i in range(len(order))], "idx"
    ).select(*group, *key, "idx")
    placed = null_safe_join(df, index, [*group, *key])
    chunk = F.floor(F.col("idx") / F.lit(span))
    copies = F.array(F.struct(chunk.alias("chunk"), F.lit(False).alias("halo")))
    if halo:
        copies = F.when(
            F.col("idx") % span >= span - halo,
            F.array(
                F.struct(chunk.alias("chunk"), F.lit(False).alias("halo")),
                F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("halo")),
            ),
        ).otherwise(copies)
    spread = placed.withColumn("_c", F.explode(copies)).select(
        "*", F.col("_c.chunk").alias("_chunk"), F.col("_c.halo").alias("_halo")
    ).drop("_c")
    window = Window.partitionBy(*group, "_chunk").orderBy("idx")
    return build(spread, window).filter(~F.col("_halo")).drop("_chunk", "_halo")

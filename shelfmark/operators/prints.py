"""Fingerprints that tell how far items are apart, and items within a Hamming radius.

A fingerprint has 64 bits; a bit is set where most of an item's words have it set in their hash (sign sums). Items with
equal fingerprints are one representative and its members. Two fingerprints within ``radius`` bits, cut into ``blocks``
blocks, agree in at least ``blocks - radius`` of them, so every choice of that many blocks is a key; fingerprints that
share a key are compared by the number of bits in which they differ.

Data movement: words are counted where their item is read, one row an item crosses the network; then one narrow row
a key and distinct fingerprint. More blocks mean longer keys, hence fewer rows a key, and more keys. The rows of a key
are never broadcast: they are several times what the planner expects of them. A key of more than ``HOT_KEY`` rows is
compared in several tasks, each with its own share of the earlier rows. A pair that shares several keys is found by the
first of them, so pairs are distinct where they are made.

Defined results: an item without words, or without a payload, has no fingerprint and is near to nothing.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.scale import SPAN, attach, hot_keys, largest_group, null_safe_join, windowed

HALF = 32
RADIUS = 3
#: Rows of a key beyond which it is compared in several tasks.
HOT_KEY = 4096
SPACE = r"[ \t\n\r]+"


def item_prints(items: DataFrame, item: str, text: str, space: str = SPACE) -> DataFrame:
    """(item, print): the 64-bit fingerprint of every item that has words."""
    words = items.select(item, F.explode(F.split(text, space)).alias("_w")).filter("_w <> ''")
    digest = F.md5("_w")
    halves = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"_h{k}") for k in (0, 1)]
    bits = [F.sum(F.shiftright(f"_h{k}", b).bitwiseAND(F.lit(1))).alias(f"_b{k}_{b}") for k in (0, 1) for b in range(HALF)]
    counted = words.select(item, *halves).groupBy(item).agg(F.count(F.lit(1)).alias("_n"), *bits)

    def half(k: int) -> Column:
        return reduce(
            Column.__add__, [F.when(F.col(f"_b{k}_{b}") * 2 > F.col("_n"), F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint") for b in range(HALF)]
        )

    return counted.select(item, F.shiftleft(half(0), HALF).bitwiseOR(half(1)).alias("print"))


def distance(a: Column, b: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return F.bit_count(a.bitwiseXOR(b))


def representatives(prints: DataFrame, item: str, print_column: str = "print") -> DataFrame:
    """(item, representative, print) of every item: the smallest item with its fingerprint stands for it."""
    first = prints.groupBy(print_column).agg(F.min(item).alias("representative"))
    return attach(prints, first, [print_column], [item], "inner").select(item, "representative", print_column)


def block_masks(blocks: int) -> list[int]:
    """The bits of every block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]


def _signed(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("bigint")


def block_keys(print_column: Column, radius: int, blocks: int) -> Column:
    """One key for every choice of blocks that may agree; ``own`` has a bit for each of its blocks, ``upto`` for these and all before."""
    parts = [print_column.bitwiseAND(_signed(mask)) for mask in block_masks(blocks)]
    chosen = combinations(range(blocks), blocks - radius)
    return F.array(*[
        F.struct(
            F.lit(k).alias("choice"), F.xxhash64(*[parts[i] for i in own]).alias("value"),
            F.lit(sum(1 << i for i in own)).cast("bigint").alias("own"), F.lit((2 << max(own)) - 1).cast("bigint").alias("upto"),
        )
        for k, own in enumerate(chosen)
    ])


def _firsts(prints: DataFrame, item: str, print_column: str) -> DataFrame:
    """(_item, _p): the distinct fingerprints and their first items; a null is near to nothing."""
    first = prints.groupBy(F.col(print_column).alias("_p")).agg(F.min(item).alias("_item"))
    return first.filter("_p is not null and _item is not null")


def _pairs(first: DataFrame, radius: int, blocks: int, hot_rows: int) -> DataFrame:
    """(a, b, distance), one row for two fingerprints within ``radius``."""
    keyed = first.select("_item", "_p", F.inline(block_keys(F.col("_p"), radius, blocks)))
    # At most all keys / hot_rows of them.
    hot = F.broadcast(hot_keys(keyed, ["choice", "value"], hot_rows))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = null_safe_join(keyed, hot, ["choice", "value"], "left")
    left = dealt.withColumn("_salt", F.pmod(F.xxhash64("_item", "_p"), salts).cast("int")).drop("_salts")
    right = dealt.select(
        "choice", "value", F.col("_item").alias("b"), F.col("_p").alias("_q"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    )
    apart, bits = F.col("_p").bitwiseXOR(F.col("_q")), distance(F.col("_p"), F.col("_q"))
    alike = reduce(
        Column.bitwiseOR,
        [F.when(apart.bitwiseAND(_signed(mask)) == 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, mask in enumerate(block_masks(blocks))],
    )
    # The first key of a pair: its blocks agree, and none before its last one does besides.
    first_met = alike.bitwiseAND(F.col("upto")) == F.col("own")
    met = left.hint("merge").join(right, ["choice", "value", "_salt"]).filter(F.col("_item") < F.col("b"))
    near = met.filter(bits <= radius).filter(first_met)
    return near.select(F.col("_item").alias("a"), "b", bits.alias("distance"))


def print_pairs(
    prints: DataFrame, item: str, radius: int = RADIUS, blocks: int | None = None, print_column: str = "print", hot_rows: int = HOT_KEY
) -> DataFrame:
    """(a, b, distance): representatives within ``radius``, a before b; all items follow from ``representatives``."""
    first = _firsts(prints, item, print_column)
    pairs = _pairs(first, radius, blocks or radius + 2, hot_rows)
    # Only items with several fingerprints can make a row twice.
    return pairs if largest_group(first, ["_item"]) <= 1 else pairs.distinct()


def near_copies(
    prints: DataFrame, item: str, radius: int = RADIUS, blocks: int | None = None, print_column: str = "print", hot_rows: int = HOT_KEY
) -> DataFrame:
    """(item, near): items within ``radius`` of an earlier one, and the earliest of those that stand for others."""
    members = representatives(prints, item, print_column).select(item, "representative")
    pairs = _pairs(_firsts(prints, item, print_column), radius, blocks or radius + 2, hot_rows)
    # Combined where the pairs are made: a task sends each representative once.
    earlier = pairs.groupBy(F.col("b").alias("representative")).agg(F.min("a").alias("_near"))
    joined = attach(members, earlier, ["representative"], [item], "left")
    near = F.coalesce("_near", F.when(F.col(item) != F.col("representative"), F.col("representative")))
    return joined.select(item, near.alias("near")).filter("near is not null")


def print_changes(
    prints: DataFrame, group: list[str], order: list[Column], item: str, radius: int = RADIUS, print_column: str = "print", span: int = SPAN
) -> DataFrame:
    """(group, item, idx, distance, change): how far each item is from the one before it; the first is a change.

    An item without a fingerprint keeps its place and is no change; nor is the one after it.
    """

    def build(df: DataFrame, window) -> DataFrame:
        apart = distance(F.col(print_column), F.lag(print_column).over(window))
        rows = df.withColumn("distance", apart)
        return rows.withColumn("change", (F.col("idx") == 0) | F.coalesce(F.col("distance") > radius, F.lit(False)))

    found = windowed(prints, group, order, [item], 1, build, span)
    return found.select(*group, item, "idx", "distance", "change")

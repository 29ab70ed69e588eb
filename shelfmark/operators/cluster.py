"""Greedy leader clustering of embeddings and what is read off it.

Rows of a group are taken in order; a row joins the earliest leader at least ``threshold`` similar
to it, else it becomes a leader. Only row-to-leader similarities are ever computed, and no task
holds more than ``chunk`` rows of a group plus ``batch`` leaders. Leaders whose angles to a few pivots are too
different from a row's are left out by the triangle inequality. An item may have any number of
vectors, each a row of its own; null vectors take no part, and a null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.constants import CLUSTER_THRESHOLD, MIN_CLUSTER_ITEMS
from shelfmark.functions.vectors import unit
from shelfmark.scale import HOT_ROWS, attach, largest_group, null_safe_join, ordered_index
from shelfmark.storage import stage

BATCH = 16_384
CHUNK = 50_000
_BLOCK = 1024
#: Products this near the threshold are computed again by the one kernel that decides.
_NEAR = 1e-9
#: Leaders whose angles to all rows and leaders are taken, and the error of an angle (of arccos near 1).
PIVOTS, _NEAR_ANGLE = 8, 1e-6


def _matrix(column):
    import numpy as np

    import pyarrow.compute as pc

    flat = column.combine_chunks()
    sizes = pc.unique(pc.list_value_length(flat)).to_pylist()
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def _dot(x, y):
    """Row-wise products; a row's result does not depend on the rows beside it."""
    return (x * y).sum(axis=-1)


def _fits(likeness, x, seeds, threshold: float):
    """Where ``likeness``, products of ``x`` by ``seeds``, reaches the threshold by the exact kernel."""
    import numpy as np

    fits = likeness >= threshold
    for i, j in zip(*np.nonzero(np.abs(likeness - threshold) < _NEAR)):
        fits[i, j] = _dot(x[i], seeds[j]) >= threshold
    return fits


def _with_leader(table, leader, sim):
    import pyarrow as pa

    empty = leader < 0
    return table.append_column("leader", pa.array(leader, pa.int64(), mask=empty)).append_column(
        "leader_sim", pa.array(sim, pa.float64(), mask=empty)
    )


def _decide_batch(threshold: float):
    """Leaders and members among the first undecided rows of one group (at most ``batch``)."""

    def decide(table):
        import numpy as np

        table = table.sort_by("idx")
        if table.num_rows == 0:
            return _with_leader(table, np.empty(0, np.int64), np.empty(0))
        x = _matrix(table.column("vec"))
        idx = table.column("idx").to_numpy()
        n = len(x)
        leader, sim = np.full(n, -1, np.int64), np.zeros(n)
        for i in range(n):
            if leader[i] >= 0:
                continue
            leader[i], sim[i] = idx[i], 1.0
            rest = x[i + 1 :]
            fits = _fits((rest @ x[i])[:, None], rest, x[i : i + 1], threshold)[:, 0]
            hit = i + 1 + np.flatnonzero(fits & (leader[i + 1 :] < 0))
            leader[hit], sim[hit] = idx[i], _dot(x[hit], x[i])
        return _with_leader(table, leader, sim)

    return decide


def _angles(x, pivots):
    import numpy as np

    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def _pivots(seeds):
    """A few leaders far from each other: the first, then always the one farthest from those before."""
    import numpy as np

    chosen, nearest = [0], _angles(seeds, seeds[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(seeds)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _angles(seeds, seeds[chosen[-1:]])[:, 0])
    return seeds[chosen]


def _blocks(x, seeds, threshold: float):
    """(rows, leaders): blocks of rows that are near each other, with the leaders that may fit one of them, ascending.

    Of unit vectors within an angle of each other, the angles to any pivot differ by no more than that; so leaders
    outside the block's range of angles, widened by the threshold's angle, need no product.
    """
    import numpy as np

    every = np.arange(len(seeds))
    if threshold <= 0 or len(seeds) <= PIVOTS:  # a zero vector has no angle, and fits where the threshold is not positive
        yield from ((np.arange(at, min(at + _BLOCK, len(x))), every) for at in range(0, len(x), _BLOCK))
        return
    pivots = _pivots(seeds)
    of_rows, of_seeds = _angles(x, pivots), _angles(seeds, pivots)
    wide = np.arccos(min(threshold, 1.0)) + _NEAR_ANGLE
    # Rows by their nearest pivot and the angle to it, so that blocks are narrow.
    near = of_rows.argmin(axis=1)
    order = np.lexsort((of_rows[np.arange(len(x)), near], near))
    for at in range(0, len(x), _BLOCK):
        rows = order[at : at + _BLOCK]
        low, high = of_rows[rows].min(axis=0) - wide, of_rows[rows].max(axis=0) + wide
        yield rows, np.flatnonzero(((of_seeds >= low) & (of_seeds <= high)).all(axis=1))


def _match_leaders(threshold: float):
    """Earliest fitting leader of each row of one chunk, if any."""

    def match(rows, leaders):
        import numpy as np

        rows = rows.select(["_g", "idx", "item", "vec"])
        n = rows.num_rows
        found, sim = np.full(n, -1, np.int64), np.zeros(n)
        if n and leaders.num_rows:
            leaders = leaders.sort_by("idx")
            seeds, seed_idx = _matrix(leaders.column("vec")), leaders.column("idx").to_numpy()
            x = _matrix(rows.column("vec"))
            for own, near in _blocks(x, seeds, threshold):
                if len(near):
                    part, some = x[own], seeds[near]
                    fits = _fits(part @ some.T, part, some, threshold)
                    first = fits.argmax(axis=1)
                    at = np.flatnonzero(fits[np.arange(len(first)), first])
                    found[own[at]] = seed_idx[near[first[at]]]
                    sim[own[at]] = _dot(part[at], some[first[at]])
        return _with_leader(rows, found, sim)

    return match


def leader_clusters(
    rows: DataFrame,
    group: str,
    item: str,
    order: Sequence[Column],
    vector: str,
    threshold: float = CLUSTER_THRESHOLD,
    batch: int = BATCH,
    chunk: int = CHUNK,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cluster of every row with a vector: group, item, idx, leader (the leader's idx), leader_sim.

    Rows that ``order`` leaves tied are taken by their vectors, so ``order`` need not tell the vectors of
    an item apart. Vectors of different lengths are an error.

    Groups of up to ``batch`` rows are decided in one step. For larger ones the first ``batch``
    undecided rows of every group are decided together, all later rows are matched against the new
    leaders in chunks, and what found no leader goes into the next round. Each round is written, so
    a lost executor costs no more than the round's own tasks. The result is written, too: whatever
    is read off the clusters looks at it more than once.
    """
    whole = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())
    rows = rows.filter(whole)
    keyed = rows.select(
        F.col(group).alias("_g"), F.col(item).alias("item"), unit(vector).alias("vec"),
        *[o.alias(f"_o{i}") for i, o in enumerate([*order, F.xxhash64(vector)])],
    )
    order_names = [f"_o{i}" for i in range(len(order) + 1)]
    by_order = [F.col(o) for o in order_names]
    group_type = keyed.schema["_g"].dataType.simpleString()
    item_type = keyed.schema["item"].dataType.simpleString()
    schema = f"_g {group_type}, idx bigint, item {item_type}, vec array<double>"
    decided_schema = f"{schema}, leader bigint, leader_sim double"
    columns = ["_g", "idx", "item", "vec"]
    biggest = largest_group(rows, [group])
    if biggest <= batch:
        placed = ordered_index(keyed, ["_g"], by_order, biggest=biggest).select(*columns)
        decided = placed.groupBy("_g").applyInArrow(_decide_batch(threshold), decided_schema)
        return stage(_named(decided, group, item), "clusters")

    # Every vector gets a key of its own, written once, by which its position finds it again.
    keyed = stage(keyed.withColumn("_v", F.monotonically_increasing_id()), "vectors")
    index = ordered_index(keyed.select("_g", "_v", *order_names), ["_g"], by_order, span=chunk, biggest=biggest)
    undecided = stage(keyed.join(index.select("_v", "idx"), "_v").select(*columns), "cluster")
    parts = []
    while True:
        # Slices of the index hold at most ``batch`` rows; take as many as together stay within it.
        slices = undecided.groupBy("_g", F.floor(F.col("idx") / batch).alias("_slice")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        running = Window.partitionBy("_g").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
        cut = stage(
            slices.withColumn("_sum", F.sum("_n").over(running))
            .groupBy("_g")
            .agg(
                F.max(F.when(F.col("_sum") <= batch, (F.col("_slice") + 1) * batch)).alias("_end"),
                F.max("_slice").alias("_last"),
            ),
            "cut",
        )
        bounded = attach(undecided, cut, ["_g"], ["idx"], "inner", hot_rows)
        head = bounded.filter(F.col("idx") < F.col("_end")).select(*columns)
        decided = stage(head.groupBy("_g").applyInArrow(_decide_batch(threshold), decided_schema), "cluster")
        if decided.isEmpty():
            raise RuntimeError("a round decided nothing, but rows remain")
        parts.append(decided)

        place = F.floor(F.col("idx") / chunk).alias("_chunk")
        rest = bounded.filter(F.col("idx") >= F.col("_end")).select(*columns, place)
        leaders = null_safe_join(decided.filter(F.col("leader") == F.col("idx")).select(*columns), cut, ["_g"])
        chunks = F.sequence(F.floor(F.col("_end") / chunk), F.floor((F.col("_last") + 1) * batch / chunk))
        copies = leaders.repartition("_g", "idx").select(*columns, F.explode(chunks).alias("_chunk"))
        matched = stage(
            rest.groupBy("_g", "_chunk")
            .cogroup(copies.groupBy("_g", "_chunk"))
            .applyInArrow(_match_leaders(threshold), decided_schema),
            "cluster",
        )
        parts.append(matched.filter(F.col("leader").isNotNull()))
        undecided = matched.filter(F.col("leader").isNull()).select(*columns)
        if undecided.isEmpty():
            break
    clusters = parts[0]
    for part in parts[1:]:
        clusters = clusters.unionByName(part)
    return _named(clusters, group, item)


def _named(df: DataFrame, group: str, item: str) -> DataFrame:
    return df.select(F.col("_g").alias(group), F.col("item").alias(item), "idx", "leader", "leader_sim")


def main_clusters(members: DataFrame, group: str) -> DataFrame:
    """Largest cluster of each group, the earliest of equal ones, with the group's cluster figures."""
    sizes = members.groupBy(group, "leader").agg(F.count(F.lit(1)).alias("_n"))
    return sizes.groupBy(group).agg(
        F.max_by("leader", F.struct("_n", -F.col("leader"))).alias("main_leader"),
        F.max("_n").alias("main_size"),
        F.count(F.lit(1)).alias("cluster_count"),
        F.sum("_n").alias("embedding_count"),
    )


def with_main(members: DataFrame, group: str, item: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Members with the flag ``in_main``."""
    main = main_clusters(members, group).select(group, "main_leader")
    return attach(members, main, [group], [item], "inner", hot_rows).withColumn(
        "in_main", F.col("leader") == F.col("main_leader")
    )


def listed_members(rows: DataFrame, group: str, item: str, order: Sequence[Column], count: int | None = None) -> DataFrame:
    """Items of each group for its exported result, one row each with its place; ``count`` may cut the list."""
    placed = ordered_index(rows.select(group, item, *[o.alias(f"_o{i}") for i, o in enumerate(order)]), [group],
                           [F.col(f"_o{i}") for i in range(len(order))], "place")
    listed = placed.select(group, item, "place")
    return listed if count is None else listed.filter(F.col("place") < count)


def cluster_outliers(members: DataFrame, group: str, item: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Items with any embedding outside their group's main cluster."""
    return with_main(members, group, item, hot_rows).filter(~F.col("in_main")).select(group, item).distinct()


def cluster_summary(
    groups: DataFrame,
    members: DataFrame,
    group: str,
    item: str,
    score: str | None = None,
    min_items: int = MIN_CLUSTER_ITEMS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per collection of ``groups`` (with ``item_count``).

    ``has_main`` is false without any embedding; a single embedding is its own representative. The
    representative is the main cluster's first member and, when ``score`` names a column of
    ``members``, also its best-scored one.
    """
    flagged = with_main(members, group, item, hot_rows)
    in_main = F.col("in_main")
    best = F.max_by(F.when(in_main, F.col(item)), F.when(in_main, F.struct(F.col(score), -F.col("idx")))) if score else F.lit(None)
    figures = flagged.groupBy(group).agg(
        F.count(F.lit(1)).alias("embedding_count"),
        F.count_if(F.col("leader") == F.col("idx")).alias("cluster_count"),
        F.count_if(in_main).alias("main_size"),
        F.count_if(~in_main).alias("outlier_count"),
        F.min_by(F.when(in_main, F.col(item)), F.when(in_main, F.col("idx"))).alias("first_representative"),
        best.alias("best_representative"),
    )
    n = F.coalesce("embedding_count", F.lit(0))
    status = F.when(F.col("item_count") < min_items, "too_few_items").when(n == 0, "no_embedding").otherwise("analyzed")
    out = groups.join(figures, group, "left").withColumn("status", status)
    done = F.col("status") == "analyzed"
    return out.select(
        group,
        "status",
        (done & (n > 0)).alias("has_main"),
        F.when(done, n).alias("embedding_count"),
        F.when(done, F.col("cluster_count")).alias("cluster_count"),
        F.when(done, F.col("main_size")).alias("main_size"),
        F.when(done, F.col("outlier_count")).alias("outlier_count"),
        F.when(done, F.col("first_representative")).alias("first_representative"),
        *([F.when(done, F.col("best_representative")).alias("best_representative")] if score else []),
    )

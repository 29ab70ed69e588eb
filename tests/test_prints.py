"""Fingerprints within a Hamming radius, against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import prints

FULL = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def made_up(rng, n=400):
    """Numbers with neighbours at every distance, equal ones, and the extremes."""
    out = [0, FULL, 1, FULL ^ 1, 1 << 63]
    while len(out) < n:
        base = rng.getrandbits(64)
        out += [base, base]
        for _ in range(6):
            near = base
            for b in rng.sample(range(64), rng.randrange(1, 9)):
                near ^= 1 << b
            out.append(near)
    return out


@pytest.mark.parametrize("radius,blocks", [(0, None), (3, None), (3, 4), (6, 9), (1, 7)])
def test_pairs_are_all_pairs_within_the_radius(spark, radius, blocks):
    values = made_up(random.Random(radius))
    frame = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "id long, print long").repartition(5)
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i)
    wanted = {(a, b, (x ^ y).bit_count()) for x, a in first.items() for y, b in first.items() if a < b and (x ^ y).bit_count() <= radius}
    got = prints.print_pairs(frame, "id", radius, blocks).collect()
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted
    members = {r["id"]: r["representative"] for r in prints.representatives(frame, "id").collect()}
    assert members == {i: first[v] for i, v in enumerate(values)}
    near = {}
    for i, v in enumerate(values):
        earlier = [a for a, b, _ in wanted if b == first[v]]
        if earlier or first[v] != i:
            near[i] = min(earlier, default=first[v])
    assert {r["id"]: r["near"] for r in prints.near_copies(frame, "id", radius, blocks).collect()} == near


def test_prints_follow_the_words(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(300)]
    texts = {1: " ".join(words), 2: " \n".join(reversed(words)), 3: " ".join(words[:-2]), 4: " ".join(other), 5: "", 6: None, 7: " \t "}
    frame = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {r["id"]: r["print"] for r in prints.item_prints(frame, "id", "text").collect()}
    apart = lambda a, b: ((got[a] ^ got[b]) & FULL).bit_count()
    assert set(got) == {1, 2, 3, 4} and got[1] == got[2]
    assert apart(1, 3) <= 8 < 15 < apart(1, 4)


@pytest.mark.parametrize("span", [2, 1000])
def test_changes_along_a_sequence(spark, span):
    rows = [("a", 1, 0), ("a", 2, 1), ("a", 3, FULL), ("a", 4, None), ("a", 5, FULL), ("a", 6, FULL ^ 7), ("b", 1, 5), (None, 1, 5)]
    frame = spark.createDataFrame([(g, i, None if p is None else signed(p)) for g, i, p in rows], "g string, id long, print long")
    got = {(r["g"], r["id"]): (r["idx"], r["distance"], r["change"]) for r in prints.print_changes(frame, ["g"], [F.col("id")], "id", 2, span=span).collect()}
    assert got == {
        ("a", 1): (0, None, True), ("a", 2): (1, 1, False), ("a", 3): (2, 63, True), ("a", 4): (3, None, False),
        ("a", 5): (4, None, False), ("a", 6): (5, 3, True), ("b", 1): (0, None, True), (None, 1): (0, None, True),
    }


def test_keys_are_not_broadcast_and_hot_ones_are_split(spark, tmp_path):
    """A fingerprint has several keys, so their table is much larger than the planner expects."""
    values = [0b111 << 20 | i for i in range(64)] + [FULL ^ i for i in range(40)]
    path = str(tmp_path / "prints")
    spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "id long, print long").write.parquet(path)
    found = prints.print_pairs(spark.read.parquet(path), "id", 3, hot_rows=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [choice" in plan
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "choice" in line]
    assert all("_salts" not in line and "isnull(choice" in line for line in joins), joins  # the hot keys alone
    wanted = {(a, b, (x ^ y).bit_count()) for a, x in enumerate(values) for b, y in enumerate(values) if a < b and (x ^ y).bit_count() <= 3}
    got = found.collect()
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted
    near = {b: min(a for a, c, _ in wanted if c == b) for _, b, _ in wanted}
    assert {r["id"]: r["near"] for r in prints.near_copies(spark.read.parquet(path), "id", 3, hot_rows=5).collect()} == near


def test_an_item_with_several_fingerprints_makes_a_pair_once(spark):
    frame = spark.createDataFrame([(1, 0), (1, 3), (2, 1), (None, 5), (3, None)], "id long, print long")
    assert [tuple(r) for r in prints.print_pairs(frame, "id", 3).collect()] == [(1, 2, 1)]

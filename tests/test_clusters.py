"""Leader clustering of one large group, and the products that pivots save."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cluster


def vectors(n, groups, dims, noise, seed=1):
    """Unit vectors around some centres, with a few zero ones."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = centres[rng.integers(groups, size=n)] + noise * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[rng.integers(n, size=3)] = 0.0
    return x


def leaders_of(x, threshold):
    """Each row takes the earliest leader that fits, else it is one."""
    leader, seeds, at = np.full(len(x), -1), np.empty((0, x.shape[1])), []
    for start in range(0, len(x), 4096):
        part = x[start : start + 4096]
        fits = part @ seeds.T >= threshold if len(at) else np.zeros((len(part), 0), bool)
        known = len(at)
        for i in range(len(part)):
            hit = np.flatnonzero(fits[i]) if known else []
            if len(hit):
                leader[start + i] = at[hit[0]]
                continue
            new = np.flatnonzero(part[i] @ seeds[known:].T >= threshold) if len(at) > known else []
            if len(new):
                leader[start + i] = at[known + new[0]]
                continue
            leader[start + i] = start + i
            at.append(start + i)
            seeds = np.vstack([seeds, part[i]])
    return leader


@pytest.mark.parametrize("threshold,dims", [(0.9, 8), (0.5, 24), (0.2, 4), (0.0, 6), (-0.2, 6), (1.0, 5)])
def test_blocks_leave_out_no_leader_that_fits(threshold, dims):
    x, seeds = vectors(3000, 40, dims, 0.2), vectors(200, 40, dims, 0.2, seed=2)
    x[:200] = seeds
    fits = x @ seeds.T >= threshold
    seen = np.zeros(len(x), int)
    for rows, near in cluster._blocks(x, seeds, threshold):
        seen[rows] += 1
        assert (np.diff(near) > 0).all()
        left = np.setdiff1d(np.arange(len(seeds)), near)
        assert not fits[np.ix_(rows, left)].any()
    assert (seen == 1).all()


def test_one_group_of_a_hundred_thousand(spark, monkeypatch):
    x = vectors(100_000, 300, 12, 0.1)
    frame = spark.createDataFrame(pa.table({"g": np.ones(len(x), np.int32), "i": np.arange(len(x)), "v": x.tolist()})).repartition(8)
    got = cluster.leader_clusters(frame, "g", "i", [F.col("i")], "v", 0.8, batch=8192, chunk=20_000)
    found = got.select("i", "leader").toPandas().sort_values("i")["leader"].to_numpy()
    wanted = leaders_of(x, 0.8)
    assert (found == wanted).all()
    assert share_of_products(x, wanted, 0.8) < 0.85


def share_of_products(x, leaders, threshold):
    seeds = x[np.unique(leaders)]
    return sum(len(rows) * len(near) for rows, near in cluster._blocks(x, seeds, threshold)) / len(x) / len(seeds)


@pytest.mark.parametrize("dims,threshold,share", [(12, 0.8, 0.9), (4, 0.95, 0.4), (3, 0.98, 0.25)])
def test_products_that_pivots_leave(dims, threshold, share):
    """Measured shares: few are saved where angles are as wide as the spread, most where they are narrow."""
    x = vectors(20_000, 300, dims, 0.1)
    assert share_of_products(x, leaders_of(x, threshold), threshold) < share

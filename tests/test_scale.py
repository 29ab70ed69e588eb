"""The paths for large groups, forced by small limits, against plain results and brute force."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark import storage
from shelfmark.operators import cluster, packing, relational, sequence
from shelfmark.plans import bindings as B
from shelfmark.scale import attach, hot_keys, largest_group, ordered_index, windowed


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with two thirds of the rows, keys in no order."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50 + 1).alias("g"),
        (F.col("id") * 7919 % 3001).alias("k"),
        (F.col("id") * 31 % 97).alias("v"),
    )


def test_largest_group_and_hot_keys(skewed):
    assert largest_group(skewed, ["g"]) == 2000
    assert [tuple(r) for r in hot_keys(skewed, ["g"], 300).collect()] == [(0, 7)]


@pytest.mark.parametrize("group", [[], ["g"]])
def test_split_index_equals_window(skewed, group):
    split = ordered_index(skewed, group, [F.col("k")], span=10)
    window = Window.partitionBy(*group).orderBy("k")
    plain = skewed.withColumn("idx", (F.row_number().over(window) - 1).cast("bigint"))
    assert rows(split.select("g", "k", "v", "idx")) == rows(plain)


@pytest.mark.parametrize("span", [7, 64, 1999])
def test_windowed_in_chunks_equals_whole_window(skewed, span):
    def build(df, w):
        return (
            df.withColumn("before", F.lag("v").over(w))
            .withColumn("mean", F.avg("v").over(w.rowsBetween(-4, 0)))
            .select("g", "k", "idx", "before", F.when(F.col("idx") >= 4, F.round("mean", 9)).alias("mean"), *(["_halo"] if "_halo" in df.columns else []), *(["_chunk"] if "_chunk" in df.columns else []))
        )

    chunked = windowed(skewed, ["g"], [F.col("k")], ["k"], 5, build, span)
    plain = windowed(skewed, ["g"], [F.col("k")], ["k"], 5, build)
    assert rows(chunked) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_attach_equals_join(skewed, how):
    dim = skewed.filter("g <> 5").groupBy("g").agg(F.sum("v").alias("s"))
    salted = attach(skewed, dim, ["g"], ["k"], how, hot_rows=100)
    assert rows(salted.select("g", "k", "v", "s")) == rows(skewed.join(dim, "g", how).select("g", "k", "v", "s"))
    by_narrow = attach(skewed, dim, ["g"], ["k"], how, hot_rows=100, measure=skewed.select("g"))
    assert rows(by_narrow.select("g", "k", "v", "s")) == rows(salted.select("g", "k", "v", "s"))


def test_sequence_flags_in_chunks(spark, sf_dir):
    from shelfmark.functions.vectors import letter_counts

    items = B.items(spark, sf_dir).withColumn("collection_id", F.lit(1).cast("bigint"))
    narrow = items.select("collection_id", "item_id", F.col("lang").alias("hash"))
    featured = letter_counts(items.select("collection_id", "item_id", F.col("lang").alias("hash"), "text"), "text")
    args = (featured, ["collection_id"], ["item_id"], [F.col("item_id")])
    whole = sequence.sequence_flags(*args)
    parts = sequence.sequence_flags(*args, span=37, narrow=narrow)
    columns = ["item_id", "idx", F.round("sim", 9), F.round("recent_sim", 9), "abrupt", "hash_change", "sustained", "is_key"]
    assert rows(parts.select(*columns)) == rows(whole.select(*columns))


def greedy(vectors, threshold):
    """Leader of every vector, read straight off the definition."""
    leaders, out = [], []
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
    for i, v in enumerate(unit):
        hit = next((j for j in leaders if unit[j] @ v >= threshold), None)
        if hit is None:
            leaders.append(i)
        out.append(i if hit is None else hit)
    return out


@pytest.mark.parametrize("seed,batch,chunk", [(1, 8, 16), (2, 16, 8), (3, 5, 1000), (4, 4096, 10)])
def test_leader_clusters_against_brute_force(spark, seed, batch, chunk):
    rng = np.random.default_rng(seed)
    sizes = {1: 150, 2: 30, 3: 1}
    data, expected = [], {}
    for g, n in sizes.items():
        vectors = rng.normal(size=(n, 6))
        if n > 20:
            vectors[10] = 0
        order = rng.permutation(n)
        for place, at in enumerate(order):
            data.append((g, g * 1000 + int(at), int(place), vectors[at].tolist()))
        leaders = greedy(vectors[order], 0.4)
        expected.update({g * 1000 + int(at): (place, leaders[place]) for place, at in enumerate(order)})
    df = spark.createDataFrame(data, "g int, id int, place int, v array<double>")
    got = cluster.leader_clusters(df, "g", "id", [F.col("place")], "v", 0.4, batch, chunk, hot_rows=20)
    assert {r.id: (r.idx, r.leader) for r in got.collect()} == expected


def test_cluster_flags_with_hot_group(spark, sf_dir):
    vectors = B.embeddings(spark, sf_dir).withColumn("collection_id", F.lit(7).cast("bigint"))
    found = cluster.leader_clusters(vectors, "collection_id", "item_id", [F.col("item_id")], "embedding", 0.2, 64, 50)
    plain = cluster.cluster_outliers(found, "collection_id", "item_id")
    salted = cluster.cluster_outliers(found, "collection_id", "item_id", hot_rows=40)
    assert rows(plain) == rows(salted)
    again = cluster.leader_clusters(vectors, "collection_id", "item_id", [F.col("item_id")], "embedding", 0.2)
    assert rows(found.select("item_id", "idx", "leader")) == rows(again.select("item_id", "idx", "leader"))


def test_pack_and_unpack_with_hot_collection(spark, sf_dir):
    items = B.items(spark, sf_dir).select("collection_id", "item_id", "file_name", F.col("file_name").alias("image"))
    args = (items, B.collections(spark, sf_dir), B.collection_labels(spark, sf_dir))
    salted = relational.pack_rows(*args, hot_rows=9)
    assert rows(salted) == rows(relational.pack_rows(*args))
    placed = salted.withColumn("position", F.col("item_id"))
    assert rows(packing.unpack_items(placed, hot_rows=9, span=7)) == rows(packing.unpack_items(placed))


@pytest.mark.parametrize("partitions", ["1", "5", "40"])
def test_results_do_not_depend_on_partitioning(spark, sf_dir, partitions):
    from shelfmark.plans import catalog

    names = ["shard_assign", "seq_key_frames", "leader_clusters", "label_merge_keep"]
    expected = {n: rows(catalog.QUERIES[n](spark, sf_dir)) for n in names}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert {n: rows(catalog.QUERIES[n](spark, sf_dir)) for n in names} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_letter_counts_in_blocks(spark, monkeypatch):
    from shelfmark.constants import LETTERS
    from shelfmark.functions import vectors

    monkeypatch.setattr(vectors, "BLOCK_BYTES", 7)
    texts = ["", "é", "aÉéz" * 9, "x", None, "ab cé", "ÀÉÎ é", "abc" * 20, "é" * 15, "tail"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(2)
    got = {r.i: r.hist for r in vectors.letter_counts(df, "text").collect()}
    assert got == {i: None if t is None else [t.lower().count(c) for c in LETTERS] for i, t in enumerate(texts)}


def test_null_groups_keep_their_rows(spark):
    rows = spark.createDataFrame([(None if i % 4 == 0 else i % 2, i) for i in range(100)], "g int, k int")
    for span in (10, 1000):
        found = {(r.g, r.k): r.idx for r in ordered_index(rows, ["g"], [F.col("k")], "idx", span).collect()}
        assert len(found) == 100
        assert sorted(v for (g, _), v in found.items() if g is None) == list(range(25))
        looked = windowed(rows, ["g"], [F.col("k")], ["k"], 1, lambda d, w: d.withColumn("before", F.lag("k").over(w)), span)
        assert {(r.g, r.k, r.before) for r in looked.collect()} == {
            (None if k % 4 == 0 else k % 2, k, None if k < 4 and k != 3 else k - (4 if k % 2 == 0 else 2))
            for k in range(100)
        }


def test_clusters_of_several_null_and_uneven_vectors(spark):
    rng = random.Random(1)
    data = []
    for i in range(120):
        group = None if i % 3 == 0 else i % 2
        vector = None if i % 11 == 0 else [1.0, None, 2.0] if i % 13 == 0 else [rng.gauss(0, 1) for _ in range(3)]
        data.append((group, i // 2, i, vector))
    rows = spark.createDataFrame(data, "g int, item int, v int, vec array<double>")
    whole = sum(v is not None and None not in v for *_, v in data)
    results = []
    for batch, chunk in ((7, 10), (1000, 1000)):
        found = cluster.leader_clusters(rows, "g", "item", [F.col("v")], "vec", 0.7, batch, chunk)
        results.append(sorted(map(tuple, found.drop("leader_sim").collect()), key=repr))
    assert results[0] == results[1] and len(results[0]) == whole
    uneven = spark.createDataFrame([(1, 1, 1, [1.0, 2.0]), (1, 2, 2, [1.0])], rows.schema)
    with pytest.raises(Exception, match="different lengths"):
        cluster.leader_clusters(uneven, "g", "item", [F.col("v")], "vec").count()


def test_staged_folders_go(spark):
    before = storage.new_folder(spark, "probe")
    spark.range(3).write.parquet(before)
    assert storage.stage(spark.range(5), "probe").count() == 5
    assert storage.release(spark) >= 2 and not os.path.exists(before)

"""Merge policies, sequence classes, quality, clusters and streams on small cases."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cluster, labels, quality, relational, sequence
from shelfmark.streaming import keyed
from shelfmark.streaming.labels import compact_label_state, read_label_state, read_table_stream, read_todo, run_label_state, run_todo

EDIT = "k int, item string, seq int, score_set boolean, score int, tags array<string>, notes string, images string"


def edit(k, seq, **fields):
    row = {"item": "i", "score_set": "score" in fields, "score": None, "tags": None, "notes": None, "images": None} | fields
    return (k, row["item"], seq, row["score_set"], row["score"], row["tags"], row["notes"], row["images"])


EDITS = [
    edit(1, 2, notes="late"),
    edit(1, 1, score=7, tags=["a"], notes="early"),
    edit(2, 1, score=7, tags=["a"], notes="x"),
    edit(2, 2, tags=[], notes=""),
    edit(2, 3, score=None),
    edit(3, 1, score=4),
    edit(3, 2, score=0, images="{}"),
]
KEPT = {1: (7, ["a"], "late", None), 2: (None, [], "x", None), 3: (0, None, None, "{}")}


def test_keep_policy(spark):
    state = labels.merge_keep(spark.createDataFrame(EDITS, EDIT), ["k"])
    assert {r.k: (r.score, r.tags, r.notes, r.images) for r in state.collect()} == KEPT


def test_replace_policy(spark):
    verdicts = spark.createDataFrame([(1, "i", 5), (9, "i", 6)], "k int, item string, ai_score int")
    state = labels.merge_replace(spark.createDataFrame(EDITS, EDIT), ["k", "item"], verdicts)
    got = {r.k: (r.score, r.tags, r.notes, r.ai_score) for r in state.collect()}
    assert got == {1: (None, None, "late", 5), 2: (None, None, None, None), 3: (0, None, None, None), 9: (None, None, None, 6)}


def test_text_merge_and_upsert(spark):
    old = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "k int, text_en string, text_cn string")
    new = spark.createDataFrame([(1, "", None), (2, "n", "m"), (3, "x", "")], "k int, text_en string, text_cn string")
    got = {r.k: (r.text_en, r.text_cn) for r in labels.merge_text(old, new, "k").collect()}
    assert got == {1: ("a", "b"), 2: ("n", "m"), 3: ("x", None)}
    merged = labels.upsert_missing(old.select("k", "text_en"), new.select("k", "text_en"), ["k"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "c"), (3, "x")]


def test_stream_equals_batch_over_several_triggers(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "state", "cp"))
    frame = spark.createDataFrame(EDITS, EDIT)
    for part in (EDITS[:2], EDITS[2:4]):
        spark.createDataFrame(part, EDIT).coalesce(1).write.mode("append").parquet(source)
    stream = read_table_stream(spark, source, "*.parquet", frame.schema, files_per_trigger=1)
    run_label_state(stream, ["k"], target, checkpoint)
    spark.createDataFrame(EDITS[4:], EDIT).coalesce(1).write.mode("append").parquet(source)
    run_label_state(read_table_stream(spark, source, "*.parquet", frame.schema, 1), ["k"], target, checkpoint)
    shape = labels.merge_keep(frame, ["k"]).withColumn("batch", F.lit(0).cast("bigint")).schema
    state = read_label_state(spark, target, shape, ["k"])
    assert {r.k: (r.score, r.tags, r.notes, r.images) for r in state.collect()} == KEPT


def test_a_compacted_log_goes_on(spark, tmp_path):
    source, target, compacted, checkpoint = (str(tmp_path / n) for n in ("in", "state", "compact", "cp"))
    frame = spark.createDataFrame(EDITS, EDIT)
    shape = labels.merge_keep(frame, ["k"]).withColumn("batch", F.lit(0).cast("bigint")).schema
    for part, folder in ((EDITS[:4], target), (EDITS[4:], compacted)):
        spark.createDataFrame(part, EDIT).coalesce(1).write.mode("append").parquet(source)
        run_label_state(read_table_stream(spark, source, "*.parquet", frame.schema, 1), ["k"], folder, checkpoint)
        if folder == target:
            compact_label_state(spark, target, shape, ["k"], compacted)
            assert spark.read.parquet(compacted).count() == 2
    state = read_label_state(spark, compacted, shape, ["k"])
    assert {r.k: (r.score, r.tags, r.notes, r.images) for r in state.collect()} == KEPT


def test_keyed_state_equals_batch_over_several_triggers(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    frame = spark.createDataFrame(EDITS, EDIT)
    for part in (EDITS[:1], EDITS[1:4], EDITS[4:]):  # the later edit of key 1 comes first
        spark.createDataFrame(part, EDIT).coalesce(1).write.mode("append").parquet(source)
        keyed.run_keyed_state(read_table_stream(spark, source, "*.parquet", frame.schema, 1), ["k"], checkpoint)
    state = keyed.read_keyed_state(spark, checkpoint, ["k"], keyed.label_types(frame))
    assert {r.k: (r.score, r.tags, r.notes, r.images) for r in state.collect()} == KEPT
    assert {r.k: r.last_seq for r in state.collect()} == {1: 2, 2: 3, 3: 2}


def test_keys_without_edits_expire(spark, tmp_path):
    source, checkpoint, expired = (str(tmp_path / n) for n in ("in", "cp", "out"))
    schema = EDIT + ", ts timestamp"
    frame = spark.createDataFrame([], schema)
    minute = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    steps = [
        [(*edit(1, 1, score=3), minute(0)), (*edit(2, 1, notes="n"), minute(1))],
        [(*edit(1, 2, tags=["t"]), minute(8))],  # keeps key 1 alive
        [(*edit(3, 1, score=9), minute(14))],  # key 2 is old now
        [(*edit(3, 2, score=8), minute(15))],
    ]
    for part in steps:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = read_table_stream(spark, source, "*.parquet", frame.schema, 1)
        keyed.run_keyed_state(stream, ["k"], checkpoint, expired, keep_ms=600_000, time_col="ts")
    assert [(r.k, r.score, r.notes, r.last_seq) for r in spark.read.parquet(expired).collect()] == [(2, None, "n", 1)]
    state = keyed.read_keyed_state(spark, checkpoint, ["k"], keyed.label_types(frame))
    assert {r.k: (r.score, r.tags, r.last_seq) for r in state.collect()} == {1: (3, ["t"], 2), 3: (8, None, 2)}


def test_todo_stream_emits_each_item_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "todo", "cp"))
    verdicts = spark.createDataFrame([(1, 5), (2, 0)], "id int, score int")
    schema = spark.createDataFrame([], "id int").schema
    for ids in ([1, 2, 3], [3, 4, 4]):
        spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.mode("append").parquet(source)
        run_todo(read_table_stream(spark, source, "*.parquet", schema), verdicts, ["id"], target, checkpoint)
    got = read_todo(spark, target, schema)
    assert sorted(r.id for r in got.collect()) == [2, 3, 4]


@pytest.mark.parametrize(
    "total,fillers,keys,expected",
    [
        (9, 0, 9, "random"),
        (10, 7, 3, "minimal"),
        (10, 8, 2, "random"),
        (26, 18, 8, "stepwise"),
        (40, 27, 13, "segmented"),
        (40, 24, 16, "continuous"),
        (30, 21, 9, "segmented"),
    ],
)
def test_sequence_type(spark, total, fillers, keys, expected):
    kind = sequence.sequence_type(F.lit(total), F.lit(fillers), F.lit(keys))
    text_en, text_cn = sequence.sequence_text(kind, F.lit(total), F.lit(keys))
    row = spark.range(1).select(kind, text_en, text_cn).first()
    assert row[0] == expected and str(total) in row[1] and str(total) in row[2]


def test_missing_features_keep_positions(spark):
    rows = [(1, i, str(i), [1.0, 0.0] if i != 2 else None) for i in range(5)] + [(1, 5, "4", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "g int, k int, hash string, hist array<double>")
    flags = sequence.sequence_flags(df, ["g"], ["k"], [F.col("k")]).orderBy("idx").collect()
    assert [r.idx for r in flags] == list(range(6))
    assert [r.abrupt for r in flags] == [True, False, False, False, False, True]
    assert flags[5].hash_change is False and flags[4].hash_change is True
    summary = sequence.sequence_summary(spark.createDataFrame(flags), ["g"], min_items=3).first()
    assert summary.status == "insufficient_data"


def test_sequence_status(spark):
    cases = [(29, 29), (30, 9), (30, 10)]
    got = [spark.range(1).select(sequence.sequence_status(F.lit(n), F.lit(f))).first()[0] for n, f in cases]
    assert got == ["insufficient_frames", "insufficient_data", "analyzed"]


def test_main_cluster_tie_goes_to_first(spark):
    members = spark.createDataFrame(
        [(1, 10, 0, 0), (1, 11, 1, 1), (1, 12, 2, 1), (1, 13, 3, 0), (2, 20, 0, 0)], "g int, id int, idx bigint, leader bigint"
    )
    got = {r.g: (r.main_leader, r.main_size, r.cluster_count) for r in cluster.main_clusters(members, "g").collect()}
    assert got == {1: (0, 2, 2), 2: (0, 1, 1)}
    groups = spark.createDataFrame([(1, 4), (2, 4), (3, 4), (4, 2)], "g int, item_count int")
    summary = {r.g: r for r in cluster.cluster_summary(groups, members.withColumn("score", F.col("id") * 1.0), "g", "id", "score").collect()}
    assert (summary[1].first_representative, summary[1].best_representative, summary[1].outlier_count) == (10, 13, 2)
    assert [summary[g].has_main for g in (1, 2, 3, 4)] == [True, True, False, False]
    assert (summary[3].status, summary[4].status) == ("no_embedding", "too_few_items")


def test_quarantine(spark):
    def keys(ids):
        return spark.createDataFrame([(1, i) for i in ids], "collection_id int, item int")

    got = quality.quarantine(keys([1, 2]), keys([2, 3]), keys([3, 4]), ["collection_id", "item"])
    assert {r.item: r.category for r in got.collect()} == {1: "broken", 2: "broken", 3: "duplicate", 4: "non_main"}
    assert sorted(r.item for r in quality.clean(keys(range(6)), got, "item").collect()) == [0, 5]


def test_duplicates_of_a_hot_text(spark):
    items = spark.range(1000).select(F.col("id").alias("item"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("p"))
    got = {r.item for r in quality.duplicates(items, "p", "item").collect()}
    assert got == {i for i in range(3, 1000, 3)}


def test_backfill_and_completeness(spark):
    rows = spark.createDataFrame([(1, "", 5, 2), (2, "kept", 5, 1), (3, " ", None, 0), (4, None, 6, 1)], "collection_id int, creator_name string, creator_id int, expected_count int")
    lookup = spark.createDataFrame([(5, "E")], "creator_id int, name string")
    got = {r.collection_id: r.creator_name for r in relational.backfill_names(rows, lookup).collect()}
    assert got == {1: "E", 2: "kept", 3: "", 4: ""}
    assert sorted(r.collection_id for r in relational.missing_names(rows).collect()) == [1, 4]
    items = spark.createDataFrame([(1, 1), (1, 2), (4, 1)], "collection_id int, item_id int")
    done = {r.collection_id: r.completed for r in relational.completeness(rows, items).collect()}
    assert done == {1: True, 2: False, 3: True, 4: True}

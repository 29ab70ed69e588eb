"""Queries that fold label edits, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import labels as L
from shelfmark.plans import bindings as B
from shelfmark.plans.sequences import FLAGGED, SUMMARIES, summaries
from shelfmark.sources.files import explode_item_labels
from shelfmark.sources.open_labels import edit_fields, open_fields, scan_open_labels, write_open_labels
from shelfmark.storage import new_folder
from shelfmark.streaming.keyed import keyed_label_state as run_keyed
from shelfmark.streaming.labels import read_table_stream, stream_label_state as run_state, stream_todo as run_todo_list


def _edits(spark, sf_dir) -> DataFrame:
    return B.edits(B.table(spark, sf_dir, "events"))


def _tags_joined(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join("tags", ","))


def label_merge_keep(spark, sf_dir):
    return _tags_joined(L.merge_keep(_edits(spark, sf_dir), ["collection_id"]))


def label_merge_replace(spark, sf_dir):
    """Items with a verdict keep its fields; items without edits stay as they are."""
    verdicts = B.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS collection_id", "'view' AS item", "cast(c_custkey % 9 + 1 AS int) AS ai_score"
    )
    return _tags_joined(L.merge_replace(_edits(spark, sf_dir), ["collection_id", "item"], verdicts))


def text_merge(spark, sf_dir):
    """Sequence texts over stored label texts; every fourth new text is empty."""
    stored = B.collection_labels(spark, sf_dir).select(F.col("collection_id").cast("bigint").alias("collection_id"), "text_en", "text_cn")
    fresh = summaries(spark, sf_dir).selectExpr(
        "collection_id", "CASE WHEN collection_id % 4 = 0 THEN '' ELSE text_en END AS text_en", "CASE WHEN collection_id % 2 = 0 THEN NULL ELSE text_cn END AS text_cn"
    )
    return L.merge_text(stored, fresh, "collection_id")


def label_upsert(spark, sf_dir):
    old = explode_item_labels(B.item_labels(spark, sf_dir)).select("collection_id", "stem", "ai_score", "ai_reason")
    new = B.items(spark, sf_dir).select(
        "collection_id", "stem", F.lit(5).alias("ai_score"), F.lit("new").alias("ai_reason")
    )
    return L.upsert_missing(old, new, ["collection_id", "stem"])


def open_labels(spark, sf_dir):
    """Label documents with fields that no schema names: written, scanned, edited field by field, written and scanned again."""
    items = B.items(spark, sf_dir).filter("collection_id is not null")
    named = items.select(
        "collection_id", "stem", F.inline(F.array(
            F.struct(F.lit("written in").alias("field"), F.to_json(F.array("lang")).alias("value")),
            F.struct(F.lit("size").alias("field"), F.col("bytes").cast("string").alias("value")),
        ))
    )
    own = items.groupBy("collection_id").agg(F.count(F.lit(1)).cast("string").alias("value"))
    fields = named.unionByName(own.select("collection_id", F.lit(None).cast("string").alias("stem"), F.lit("members").alias("field"), "value"))
    edits = items.filter("item_id % 3 = 0").select(
        "collection_id", "stem", F.to_json(F.struct((F.col("item_id") % 9).alias("score"), F.lit(0).alias("size"))).alias("document"), F.col("item_id").alias("seq")
    )
    first, second = new_folder(spark, "open-labels"), new_folder(spark, "open-labels")
    write_open_labels(fields, first)
    write_open_labels(edit_fields(open_fields(scan_open_labels(spark, first)), edits), second)
    return open_fields(scan_open_labels(spark, second))


def stream_label_state(spark, sf_dir):
    schema = B.table(spark, sf_dir, "events").schema
    events = read_table_stream(spark, sf_dir, "events.parquet", schema)
    return _tags_joined(run_state(B.edits(events), ["collection_id"]))


def keyed_label_state(spark, sf_dir):
    """The same stream with state kept by key, read back from the state store."""
    schema = B.table(spark, sf_dir, "events").schema
    events = read_table_stream(spark, sf_dir, "events.parquet", schema)
    return _tags_joined(run_keyed(B.edits(events), ["collection_id"]))


def stream_todo(spark, sf_dir):
    schema = B.table(spark, sf_dir, "documents").schema
    documents = read_table_stream(spark, sf_dir, "documents.parquet", schema)
    done = B.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("score"))
    return run_todo_list(documents.select("doc_id"), done, ["doc_id"])


QUERIES = {
    "label_merge_keep": label_merge_keep,
    "label_merge_replace": label_merge_replace,
    "text_merge": text_merge,
    "label_upsert": label_upsert,
    "open_labels": open_labels,
    "stream_label_state": stream_label_state,
    "keyed_label_state": keyed_label_state,
    "stream_todo": stream_todo,
}

_KEEP = B.cte(B.EDITS) + """SELECT collection_id,
  (list(score ORDER BY seq DESC) FILTER (score_set))[1] AS score,
  array_to_string(arg_max(tags, seq) FILTER (tags IS NOT NULL), ',') AS tags,
  arg_max(notes, seq) FILTER (notes <> '') AS notes, arg_max(images, seq) FILTER (images IS NOT NULL) AS images,
  max(seq) AS last_seq FROM edits GROUP BY collection_id"""

ORACLE = {
    "label_merge_keep": _KEEP,
    "label_merge_replace": B.cte(B.EDITS)
    + """SELECT collection_id, item, ai_score, score, array_to_string(tags, ',') AS tags, notes, last_seq
         FROM (SELECT c_custkey AS collection_id, 'view' AS item, CAST(c_custkey % 9 + 1 AS INTEGER) AS ai_score FROM customer) v
         FULL JOIN (SELECT collection_id, item, score, tags, notes, seq AS last_seq FROM edits
           QUALIFY row_number() OVER (PARTITION BY collection_id, item ORDER BY seq DESC) = 1) e USING (collection_id, item)""",
    "text_merge": B.cte(B.ITEMS, B.COLLECTIONS, B.COLLECTION_LABELS, FLAGGED, SUMMARIES)
    + """SELECT s.collection_id, coalesce(CASE WHEN s.collection_id % 4 <> 0 THEN s.text_en END, l.text_en) AS text_en,
           coalesce(CASE WHEN s.collection_id % 2 <> 0 THEN s.text_cn END, l.text_cn) AS text_cn
         FROM summaries s LEFT JOIN collection_labels l ON l.collection_id = s.collection_id""",
    "label_upsert": B.cte(B.ITEMS, B.ITEM_LABELS)
    + """SELECT collection_id, stem, ai_score, ai_reason FROM item_labels
         UNION ALL SELECT collection_id, stem, 5, 'new' FROM items WHERE item_id NOT IN (SELECT doc_id FROM labels)""",
    "open_labels": B.cte(B.ITEMS)
    + """SELECT collection_id, stem, 'written in' AS field, '["' || lang || '"]' AS value FROM items WHERE collection_id IS NOT NULL
         UNION ALL SELECT collection_id, stem, 'size', CASE WHEN item_id % 3 = 0 THEN '0' ELSE CAST(bytes AS VARCHAR) END FROM items WHERE collection_id IS NOT NULL
         UNION ALL SELECT collection_id, stem, 'score', CAST(item_id % 9 AS VARCHAR) FROM items WHERE item_id % 3 = 0 AND collection_id IS NOT NULL
         UNION ALL SELECT collection_id, NULL, 'members', CAST(count(*) AS VARCHAR) FROM items WHERE collection_id IS NOT NULL GROUP BY collection_id""",
    "stream_label_state": _KEEP,
    "keyed_label_state": _KEEP,
    "stream_todo": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality <> 0)",
}

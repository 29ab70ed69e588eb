"""Label documents with fields nobody declared: read, edited field by field and written without losing any.

A document is a JSON object; its ``images`` is an object of items, each an object of fields. ``scan_open_labels`` keeps the
whole document as a VARIANT. ``open_fields`` gives one row a field, (collection_id, stem, field, value), with a null
stem for those of the collection itself; edits are rows of the same kind with a number, and a field's value is that
of its latest edit, else of the document. A field that no edit names stays as it is, whatever it is called.

Rows are fields, so no collection has to fit into a row, and a fold combines map-side. ``write_open_labels`` writes a
folder of JSON lines a collection, one for its own fields and one an item; a scan puts lines together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import id_from_folder

ITEMS = "images"


def scan_open_labels(spark: SparkSession, root: str) -> DataFrame:
    """(collection_id, document, at): every readable label document, whole or a line of one, as a VARIANT.

    ``at`` orders the documents of a collection by their time and path. Unreadable ones, and JSON that is no
    object, are skipped.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_time"))
    )
    name = F.regexp_extract("_path", r"/(?:[^/=]*=)?([^/]*_labels[^/]*\.json)(?:/part-[^/]*)?$", 1)
    part = F.contains("_path", F.lit("/part-"))
    # A part file has a document a line, a file of its own is one document.
    documents = F.when(part, F.split(F.rtrim("value"), "\n")).otherwise(F.array("value"))
    each = lines.filter(name != "").select(id_from_folder(name).alias("collection_id"), F.explode(documents).alias("json"), F.struct("_time", "_path").alias("at"))
    parsed = each.select("collection_id", F.try_parse_json("json").alias("document"), "at")
    return parsed.filter("collection_id is not null and schema_of_variant(document) like 'OBJECT%'")


def _entries(rows: DataFrame, value: str, *kept: str) -> DataFrame:
    """A row per entry of an object: the columns ``kept``, key and value."""
    return rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(value).outer())).select(*kept, "key", F.col("value").alias("_value"))


def open_fields(documents: DataFrame) -> DataFrame:
    """(collection_id, stem, field, value, at): a row per field; values are JSON text, those of newer documents win.

    A null ``at`` counts as the oldest.
    """
    top = _entries(documents, "document", "collection_id", "at")
    own = top.filter(F.col("key") != ITEMS).select("collection_id", F.lit(None).cast("string").alias("stem"), F.col("key").alias("field"), F.to_json("_value").alias("value"), "at")
    objects = top.filter((F.col("key") == ITEMS) & F.schema_of_variant("_value").startswith("OBJECT")).select("collection_id", "at", F.col("_value").alias("items"))
    items = _entries(objects, "items", "collection_id", "at").filter(F.schema_of_variant("_value").startswith("OBJECT"))
    named = items.select("collection_id", "at", F.col("key").alias("stem"), F.col("_value").alias("item"))
    fields = _entries(named, "item", "collection_id", "at", "stem").select("collection_id", "stem", F.col("key").alias("field"), F.to_json("_value").alias("value"), "at")
    return own.unionByName(fields).groupBy("collection_id", "stem", "field").agg(F.max_by("value", "at").alias("value"))


def edit_fields(fields: DataFrame, edits: DataFrame) -> DataFrame:
    """Fields after edits (collection_id, stem, document, seq), each a JSON object of the fields it sets; the largest seq wins."""
    parsed = edits.select("collection_id", "stem", "seq", F.try_parse_json("document").alias("document"))
    objects = parsed.filter(F.schema_of_variant("document").startswith("OBJECT"))
    set_fields = _entries(objects, "document", "collection_id", "stem", "seq")
    new = set_fields.select("collection_id", "stem", F.col("key").alias("field"), F.to_json("_value").alias("value"), F.col("seq").cast("bigint").alias("seq"))
    old = fields.select("collection_id", "stem", "field", "value", F.lit(-(2**63)).cast("bigint").alias("seq"))
    return old.unionByName(new).groupBy("collection_id", "stem", "field").agg(F.max_by("value", "seq").alias("value"))


def _quoted(text: Column) -> Column:
    """A JSON string."""
    written = F.to_json(F.array(text))
    return F.substring(written, F.lit(2), F.length(written) - 2)


def _object(entries: Column) -> Column:
    """A JSON object of (field, value) entries, whose values are JSON text."""
    pairs = F.transform(F.array_sort(entries), lambda e: F.concat(_quoted(e["field"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def write_open_labels(fields: DataFrame, path: str) -> None:
    """A folder of JSON lines per collection, replacing the target."""
    # The fields of one item, or of a collection itself, are as many as its document names.
    objects = fields.groupBy("collection_id", "stem").agg(_object(F.collect_list(F.struct("field", "value"))).alias("object"))
    item = F.concat(F.lit(f'{{"{ITEMS}":{{'), _quoted(F.col("stem")), F.lit(":"), F.col("object"), F.lit("}}"))
    lines = objects.select(
        F.when(F.col("stem").isNull(), F.col("object")).otherwise(item).alias("value"),
        F.concat(F.col("collection_id").cast("string"), F.lit("_labels.json")).alias("document"),
    )
    lines.hint("rebalance", "document").write.mode("overwrite").partitionBy("document").text(path)

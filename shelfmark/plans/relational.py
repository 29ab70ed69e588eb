"""Queries over items, collections and labels, and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.constants import CONTENT_TYPES
from shelfmark.functions import text as T
from shelfmark.operators import packing, relational
from shelfmark.plans import bindings as B
from shelfmark.sources import files, listing
from shelfmark.sources.buckets import pack_from_buckets, write_pack_buckets
from shelfmark.sources.creators import append_creators, load_creators
from shelfmark.schemas import LABEL_DOCUMENT, PACKED
from shelfmark.sources.lookup import look_up, write_lookup
from shelfmark.sources.packed import write_documents, write_files, write_label_documents, write_sidecar
from shelfmark.sources.publish import publish_shards, read_published
from shelfmark.storage import new_folder, stage

TARGET_MB = 1.0


def _image_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", F.lit("downloads"), F.col("collection_id").cast("string"), F.col("file_name"))
    return B.items(spark, sf_dir).select("collection_id", "item_id", "file_name", path.alias("image"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.pack_rows(
        _image_items(spark, sf_dir), B.collections(spark, sf_dir), B.collection_labels(spark, sf_dir)
    )


def _packed_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = files.explode_item_labels(B.item_labels(spark, sf_dir))
    return relational.with_item_labels(_packed(spark, sf_dir), labels)


def _tags_joined(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join("tags", ","))


def pack_rows(spark, sf_dir):
    return _tags_joined(_packed(spark, sf_dir))


def pack_buckets(spark, sf_dir):
    """The packed rows from buckets of the collection; a collection of more than 40 items is spread over several."""
    tables = write_pack_buckets(_image_items(spark, sf_dir), B.collections(spark, sf_dir), B.collection_labels(spark, sf_dir), 8, 40)
    return _tags_joined(pack_from_buckets(spark, tables))


def pack_item_labels(spark, sf_dir):
    return _packed_labeled(spark, sf_dir).select("album_id", "item_id", "ai_score", "ai_reason", "album_score")


def packed_head(spark, sf_dir):
    head = _packed(spark, sf_dir).orderBy("album_id", "file_name", "item_id").limit(100)
    return _tags_joined(head).select(
        "file_name", "title", "model_name", "tags", "album_id", "album_score", "ai_score", "has_face"
    )


def labeled(spark, sf_dir):
    return relational.labeled(B.collections(spark, sf_dir), B.collection_labels(spark, sf_dir)).select("collection_id", "name")


def unlabeled(spark, sf_dir):
    return relational.unlabeled(B.collections(spark, sf_dir), B.collection_labels(spark, sf_dir)).select("collection_id", "name")


def _registry(spark, sf_dir) -> DataFrame:
    """Collections with items and some that have none."""
    empty = B.table(spark, sf_dir, "nation").selectExpr(
        "cast(1000 + n_nationkey AS bigint) AS collection_id", "n_name AS name"
    )
    return B.collections(spark, sf_dir).select("collection_id", "name").unionByName(empty)


_REGISTRY = """registry AS (
  SELECT collection_id, name FROM collections
  UNION ALL SELECT CAST(1000 + n_nationkey AS BIGINT), n_name FROM nation)"""


def collection_info(spark, sf_dir):
    return relational.collection_info(
        _registry(spark, sf_dir), B.items(spark, sf_dir), B.collection_labels(spark, sf_dir)
    )


_INFO = """info AS (
  SELECT r.collection_id, r.name, coalesce(n, 0) AS item_count, l.collection_id IS NOT NULL AS labeled
  FROM registry r LEFT JOIN (SELECT collection_id, count(*) AS n FROM items GROUP BY 1) USING (collection_id)
  LEFT JOIN collection_labels l ON l.collection_id = r.collection_id)"""


def summary(spark, sf_dir):
    return relational.summary(collection_info(spark, sf_dir))


def collection_lookup(spark, sf_dir):
    info = collection_info(spark, sf_dir)
    return relational.lookup(info, "src7").unionByName(relational.lookup(info, "no such collection"))


def point_lookup(spark, sf_dir):
    """The same from a table that is written for lookups."""
    path = new_folder(spark, "lookup")
    write_lookup(collection_info(spark, sf_dir), path)
    return look_up(spark, path, "src7").unionByName(look_up(spark, path, "no such collection"))


def name_backfill(spark, sf_dir):
    """Names go through the stored lookup: a first batch, and a second one that may not replace it."""
    path, known = new_folder(spark, "creators"), B.creators(spark, sf_dir)
    append_creators(known.filter("creator_id % 2 = 0"), path, 0)
    append_creators(known.withColumn("name", F.when(F.col("creator_id") % 2 == 0, "late").otherwise(F.col("name"))), path, 1)
    return relational.backfill_names(B.collections(spark, sf_dir), load_creators(spark, path)).select(
        "collection_id", "creator_id", "creator_name"
    )


def missing_names(spark, sf_dir):
    return relational.missing_names(B.collections(spark, sf_dir)).select("collection_id", "creator_id")


def completeness(spark, sf_dir):
    return relational.completeness(B.collections(spark, sf_dir), B.items(spark, sf_dir))


def todo_items(spark, sf_dir):
    done = B.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), F.col("quality").alias("score"))
    return relational.todo_items(B.items(spark, sf_dir).select("collection_id", "item_id"), done, ["item_id"])


def group_counts(spark, sf_dir):
    return _packed(spark, sf_dir).agg(
        F.countDistinct("album_id").alias("collections"), F.count(F.lit(1)).alias("items")
    )


def presence_counts(spark, sf_dir):
    turns = B.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("item_id"))
    return relational.presence_counts(B.items(spark, sf_dir).select("item_id"), turns, ["item_id"])


def items_sorted(spark, sf_dir):
    return relational.items_sorted(B.items(spark, sf_dir))


def collections_zh(spark, sf_dir):
    named = B.collections(spark, sf_dir).withColumn("name", F.translate(F.expr("substring(name, 4)"), "0123456789", "零一二三四五六七八九"))
    return relational.collections_zh(named.select("collection_id", "name"))


def shuffle_order(spark, sf_dir):
    return relational.shuffle_order(B.items(spark, sf_dir))


def sample_per_group(spark, sf_dir):
    return relational.sample_per_group(B.items(spark, sf_dir), "collection_id")


def offset_page(spark, sf_dir):
    rows = B.items(spark, sf_dir).select("collection_id", "file_name", "item_id")
    return relational.offset_page(rows, ["collection_id", "file_name", "item_id"], 20)


def content_type(spark, sf_dir):
    name = F.expr("concat(stem, element_at(array('.jpg', '.JPEG', '.png', '.WebP', '.gif', '.bmp', '.txt', ''), cast(item_id % 8 AS int) + 1))")
    return B.items(spark, sf_dir).select("item_id", name.alias("name")).select(
        "item_id", T.content_type("name").alias("content_type")
    )


def name_decode(spark, sf_dir):
    pages = B.pages(spark, sf_dir).selectExpr("page_id", "concat('/data/downloads/', page_id, '/', url_encode(url), '+x%20y') AS path")
    relative = T.relative_path("path", "/data/downloads")
    return pages.select("page_id", T.percent_decode(relative).alias("name"))


def folder_name(spark, sf_dir):
    return B.collections(spark, sf_dir).select("collection_id", T.folder_name("collection_id", "title").alias("folder"))


def folder_id(spark, sf_dir):
    folder = F.expr("CASE WHEN collection_id % 6 = 5 THEN concat('x', collection_id, '_y') ELSE concat(collection_id, '_', title) END")
    rows = B.collections(spark, sf_dir).select("collection_id", folder.alias("folder"))
    stored = F.expr("CASE WHEN collection_id % 3 = 0 THEN collection_id + 500 END")
    return rows.select("collection_id", F.coalesce(stored, T.id_from_folder("folder")).alias("resolved_id"))


def _sized(spark, sf_dir) -> DataFrame:
    """Sizes are read off the texts, so they are written once and not computed at every use."""
    return stage(B.items(spark, sf_dir).select("item_id", "bytes"), "sizes")


def shard_size(spark, sf_dir):
    return packing.shard_size(B.items(spark, sf_dir), TARGET_MB)


def shard_assign(spark, sf_dir):
    return packing.assign_shards(_sized(spark, sf_dir), TARGET_MB)


def shard_balance(spark, sf_dir):
    return packing.balance_shards(_sized(spark, sf_dir), TARGET_MB)


def shard_manifest(spark, sf_dir):
    return packing.shard_manifest(packing.balance_shards(_sized(spark, sf_dir), TARGET_MB))


def smoke_shard(spark, sf_dir):
    return packing.smoke_shard(packing.assign_shards(_sized(spark, sf_dir), TARGET_MB)).select("item_id", "position")


def _written(spark, sf_dir, payload: bool = False) -> tuple[DataFrame, DataFrame]:
    """The packed rows published in shards, in the documented columns and their order, and read back; and each item's position."""
    assigned = packing.name_shards(packing.balance_shards(_sized(spark, sf_dir), TARGET_MB))
    assigned = stage(assigned.select("item_id", "position", "bytes", "file", "shard"), "assigned")
    shards = (assigned.agg(F.max("shard")).first()[0] or 0) + 1
    manifest = assigned.groupBy(F.col("file").alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("bytes") if payload else F.lit(0)).alias("bytes")
    )
    rows = _packed(spark, sf_dir).join(assigned.drop("shard", "bytes"), "item_id")
    image = F.struct(F.lit(None).cast("binary").alias("bytes"), F.col("image").alias("path"))
    if payload:  # here the payload is a column of a table; load_images reads it from files
        texts = B.items(spark, sf_dir).select("item_id", F.encode("text", "utf-8").alias("payload"))
        rows = rows.join(texts, "item_id")
        image = F.struct(F.col("payload").alias("bytes"), F.col("image").alias("path"))
    path, columns = new_folder(spark, "shards"), StructType.fromDDL(PACKED).fieldNames()
    # Rows of a collection differ in their title, so that it matters which one is first.
    rows = rows.withColumn("title", F.concat_ws(" #", "title", (F.col("item_id") % 3).cast("string")))
    publish_shards(rows.withColumn("image", image).select(*columns, "file", "position"), path, manifest, shards=shards)
    return read_published(spark, path), assigned.select("item_id", "position")


def write_shards_back(spark, sf_dir):
    """Write the packed rows with their payload, read the set back and look at the payload of every row."""
    return _written(spark, sf_dir, payload=True)[0].select(
        "album_id", "file_name", "title", F.md5("image.bytes").alias("payload_md5"), F.octet_length("image.bytes").cast("bigint").alias("bytes")
    )


def pack_files(spark, sf_dir):
    """Write every item to its file, scan the files, publish them in shards by their size, and read the set back."""
    root = new_folder(spark, "payloads")
    texts = B.items(spark, sf_dir).select(
        F.concat_ws("/", F.coalesce(F.col("collection_id").cast("string"), F.lit("none")), "file_name").alias("path"),
        F.encode("text", "utf-8").alias("payload"),
    )
    write_files(texts, root)
    # By tasks: a scan's plan has every file, at most 32 of them to a task.
    found = listing.list_items(spark, root, (".txt",)).select(
        F.col("path").alias("image"), "file_name", F.col("folder").try_cast("bigint").alias("album_id"), "bytes", F.col("path").alias("item_id")
    )
    sized = stage(found, "scanned")
    assigned = stage(packing.name_shards(packing.balance_shards(sized.select("item_id", "bytes"), TARGET_MB)), "assigned")
    manifest = assigned.groupBy(F.col("file").alias("name")).agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))
    rows = sized.drop("bytes").join(assigned.select("item_id", "file", "position"), "item_id").drop("item_id")
    path = new_folder(spark, "file-set")
    publish_shards(rows, path, manifest, payload="image", shards=assigned.select("shard").distinct().count())
    return read_published(spark, path).select(
        "album_id", "file_name", F.md5("image.bytes").alias("payload_md5"), F.octet_length("image.bytes").cast("bigint").alias("bytes")
    )


def sidecar_rows(spark, sf_dir):
    """Write the sidecar and read it back; the payload column is gone."""
    path = new_folder(spark, "sidecar")
    packed = _packed(spark, sf_dir)
    write_sidecar(packed, path)
    schema = packed.drop("image").schema
    return _tags_joined(spark.read.schema(schema).json(path))


def _read_back(spark, sf_dir) -> DataFrame:
    """The written set with each row's id and place; its narrow columns are staged, as they are used often."""
    item = F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint")
    back, order = _written(spark, sf_dir)
    rows = back.select("album_id", "file_name", "title", "model_name", "tags", item.alias("item_id"))
    return stage(rows.join(order, "item_id"), "read-back")


def unpack_collections(spark, sf_dir):
    return _tags_joined(packing.unpack_collections(_read_back(spark, sf_dir)))


def unpack_items(spark, sf_dir):
    return packing.unpack_items(_read_back(spark, sf_dir))


def label_documents(spark, sf_dir):
    """Write one folder of label documents per collection, and read the items out of them."""
    items = B.items(spark, sf_dir).select(
        "collection_id", "stem", (F.col("item_id") % 9 + 1).cast("byte").alias("score"), F.col("lang").alias("notes")
    )
    own = B.collection_labels(spark, sf_dir).select("collection_id", F.col("album_score").alias("albumScore"))
    path = new_folder(spark, "label-documents")
    write_label_documents(own, items.withColumn("collection_id", F.col("collection_id").cast("string")), path)
    lines = spark.read.schema(LABEL_DOCUMENT).option("basePath", path).json(path).filter("images is not null")
    ids = F.regexp_extract(F.input_file_name(), r"document=(\d+)_labels", 1).cast("bigint")
    each = lines.select(ids.alias("collection_id"), F.explode("images").alias("stem", "item"))
    return each.select("collection_id", "stem", F.col("item.score").cast("int").alias("score"), F.col("item.notes").alias("notes"))


def unpack_item_labels(spark, sf_dir):
    return packing.unpack_item_labels(_packed_labeled(spark, sf_dir))


def scan_items(spark, sf_dir):
    """Write a line per item into the folder of its collection, and scan the folders."""
    lines = B.items(spark, sf_dir).select(
        F.col("collection_id").alias("c"), F.concat_ws(" ", F.col("item_id").cast("string"), F.col("bytes").cast("string")).alias("value")
    )
    path = new_folder(spark, "items")
    lines.hint("rebalance", "c").write.partitionBy("c").text(path)
    found = files.scan_items(spark, path, (".txt",))
    return found.groupBy("folder", "extension").agg(F.sum("bytes").alias("bytes"))


def list_items(spark, sf_dir):
    """The same folders, listed by tasks."""
    lines = B.items(spark, sf_dir).select(
        F.col("collection_id").alias("c"), F.concat_ws(" ", F.col("item_id").cast("string"), F.col("bytes").cast("string")).alias("value")
    )
    path = new_folder(spark, "items")
    lines.hint("rebalance", "c").write.partitionBy("c").text(path)
    found = listing.list_items(spark, path, (".txt",))
    return found.groupBy("folder", "extension").agg(F.sum("bytes").alias("bytes"))


def scan_metadata(spark, sf_dir):
    """Write one metadata document per collection folder and scan the folders."""
    docs = B.collections(spark, sf_dir).selectExpr(
        "collection_id AS folder",
        "CASE WHEN collection_id % 4 <> 0 THEN cast(collection_id AS string) END AS album_id",
        "title",
        "creator_name AS model_name",
        "tags",
        "creator_id AS girl_id",
        "expected_count AS image_count",
    )
    path = new_folder(spark, "metadata")
    write_documents(docs, path, "folder")
    return _tags_joined(files.scan_metadata(spark, path, "*/part-*.json"))


def scan_labels(spark, sf_dir):
    """Write one label document per collection folder, some unreadable, and scan them."""
    document = F.to_json(
        F.struct(
            F.col("album_score").alias("albumScore"), F.col("album_reason").alias("albumNotes"), "text_en", "has_face"
        )
    )
    cut = F.when(F.col("collection_id").cast("bigint") % 7 == 3, F.substring(document, 1, 5)).otherwise(document)
    docs = B.collection_labels(spark, sf_dir).select(
        cut.alias("value"), F.concat("collection_id", F.lit("_labels.json")).alias("document")
    )
    path = new_folder(spark, "labels")
    docs.write.partitionBy("document").text(path)
    return files.scan_labels(spark, path).select(
        "collection_id", F.col("albumScore").cast("int").alias("album_score"), F.col("albumNotes").alias("notes"), "text_en", "has_face"
    )


QUERIES = {
    "pack_rows": pack_rows,
    "pack_buckets": pack_buckets,
    "pack_item_labels": pack_item_labels,
    "packed_head": packed_head,
    "labeled": labeled,
    "unlabeled": unlabeled,
    "collection_info": collection_info,
    "summary": summary,
    "collection_lookup": collection_lookup,
    "point_lookup": point_lookup,
    "name_backfill": name_backfill,
    "missing_names": missing_names,
    "completeness": completeness,
    "todo_items": todo_items,
    "group_counts": group_counts,
    "presence_counts": presence_counts,
    "items_sorted": items_sorted,
    "collections_zh": collections_zh,
    "shuffle_order": shuffle_order,
    "sample_per_group": sample_per_group,
    "offset_page": offset_page,
    "content_type": content_type,
    "name_decode": name_decode,
    "folder_name": folder_name,
    "folder_id": folder_id,
    "shard_size": shard_size,
    "shard_assign": shard_assign,
    "shard_balance": shard_balance,
    "shard_manifest": shard_manifest,
    "pack_files": pack_files,
    "smoke_shard": smoke_shard,
    "write_shards": write_shards_back,
    "sidecar_rows": sidecar_rows,
    "unpack_collections": unpack_collections,
    "unpack_items": unpack_items,
    "unpack_item_labels": unpack_item_labels,
    "label_documents": label_documents,
    "scan_items": scan_items,
    "list_items": list_items,
    "scan_metadata": scan_metadata,
    "scan_labels": scan_labels,
}

_BASE = (B.ITEMS, B.COLLECTIONS, B.COLLECTION_LABELS)
_PACKED = """packed AS (
  SELECT i.item_id, 'downloads/' || i.collection_id || '/' || i.file_name AS image, i.file_name, c.title,
         coalesce(c.creator_name, '') AS model_name, array_to_string(c.tags, ',') AS tags, i.collection_id AS album_id,
         coalesce(l.text_en, '') AS text_en, coalesce(l.text_cn, '') AS text_cn, CAST(l.album_score AS TINYINT) AS album_score,
         coalesce(l.album_reason, '') AS album_reason, CAST(NULL AS TINYINT) AS ai_score, '' AS ai_reason,
         l.has_face, l.has_fullbody
  FROM items i JOIN collections c USING (collection_id) LEFT JOIN collection_labels l USING (collection_id))"""
_PACKED_LABELED = """packed_labeled AS (
  SELECT p.* EXCLUDE (ai_score, ai_reason), CAST(l.ai_score AS TINYINT) AS ai_score, coalesce(l.ai_reason, '') AS ai_reason
  FROM packed p LEFT JOIN item_labels l ON l.collection_id = p.album_id AND l.stem = regexp_replace(p.file_name, '\\.txt$', ''))"""
_SHUFFLED = f"""shuffled AS (
  SELECT item_id, bytes, md5('{B.SEED}:' || item_id) AS shuffle_key,
         row_number() OVER (ORDER BY md5('{B.SEED}:' || item_id), item_id) - 1 AS position
  FROM items)"""
_SIZE = f"""size AS (
  SELECT count(*) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes,
         CAST(greatest(floor({TARGET_MB * 1024 * 1024} / (avg(bytes) + 2000)), 1) AS BIGINT) AS rows_per_shard
  FROM shuffled)"""
_ASSIGNED = """assigned AS (
  SELECT item_id, bytes, position, position // (SELECT rows_per_shard FROM size) AS shard FROM shuffled)"""
_BALANCED = f"""balanced AS (
  SELECT item_id, bytes, position, dense_rank() OVER (ORDER BY cut) - 1 AS shard FROM (
    SELECT item_id, bytes, position, CAST(coalesce(sum(coalesce(bytes, 0) + 2000) OVER (
      ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // {int(TARGET_MB * 1024 * 1024)} AS cut FROM shuffled))"""
_MIME = " ".join(f"WHEN '{ext}' THEN '{mime}'" for ext, mime in CONTENT_TYPES.items())
_FOLDER = "album_id || '_' || replace(substr(title, 1, 50), '/', '_')"

_TITLE = "title || ' #' || item_id % 3"
_FIRST = f"""first_rows AS (
  SELECT album_id, count(*) AS image_count, arg_min({{'title': {_TITLE}, 'model_name': model_name, 'tags': tags}}, position) AS f
  FROM packed JOIN (SELECT item_id, position FROM shuffled) USING (item_id) GROUP BY album_id)"""

_packed_sql = B.cte(*_BASE, _PACKED)
_labeled_sql = B.cte(*_BASE, B.ITEM_LABELS, _PACKED, _PACKED_LABELED)
_registry_sql = B.cte(*_BASE, _REGISTRY, _INFO)
_shard_sql = B.cte(B.ITEMS, _SHUFFLED, _SIZE, _ASSIGNED)
_balanced_sql = B.cte(B.ITEMS, _SHUFFLED, _BALANCED)

ORACLE = {
    "pack_rows": _packed_sql + "SELECT * FROM packed",
    "pack_buckets": _packed_sql + "SELECT * FROM packed",
    "pack_item_labels": _labeled_sql + "SELECT album_id, item_id, ai_score, ai_reason, album_score FROM packed_labeled",
    "packed_head": _packed_sql
    + "SELECT file_name, title, model_name, tags, album_id, album_score, ai_score, has_face FROM packed ORDER BY album_id, file_name, item_id LIMIT 100",
    "labeled": B.cte(*_BASE) + "SELECT collection_id, name FROM collections WHERE collection_id IN (SELECT collection_id FROM collection_labels)",
    "unlabeled": B.cte(*_BASE) + "SELECT collection_id, name FROM collections WHERE collection_id NOT IN (SELECT collection_id FROM collection_labels)",
    "collection_info": _registry_sql + "SELECT * FROM info",
    "summary": _registry_sql
    + "SELECT count(*) AS total, count(*) FILTER (labeled) AS labeled, count(*) FILTER (NOT labeled) AS unlabeled FROM info",
    "collection_lookup": _registry_sql
    + """SELECT w.name, collection_id, item_count, labeled, collection_id IS NOT NULL AS found
         FROM (VALUES ('src7'), ('no such collection')) w(name) LEFT JOIN info USING (name)""",
    "name_backfill": B.cte(*_BASE)
    + """SELECT collection_id, creator_id, coalesce(nullif(creator_name, ''), s_name, '') AS creator_name
         FROM collections LEFT JOIN supplier ON s_suppkey = creator_id""",
    "missing_names": B.cte(*_BASE)
    + "SELECT collection_id, creator_id FROM collections WHERE coalesce(creator_name, '') = '' AND creator_id IS NOT NULL AND creator_id <> 0",
    "completeness": B.cte(*_BASE)
    + """SELECT collection_id, expected_count, count(item_id) AS item_count, count(item_id) >= expected_count AS completed
         FROM collections LEFT JOIN items USING (collection_id) GROUP BY collection_id, expected_count""",
    "todo_items": B.cte(B.ITEMS)
    + "SELECT collection_id, item_id FROM items WHERE item_id NOT IN (SELECT doc_id FROM labels WHERE quality <> 0)",
    "group_counts": _packed_sql + "SELECT count(DISTINCT album_id) AS collections, count(*) AS items FROM packed",
    "presence_counts": B.cte(B.ITEMS)
    + """SELECT item_id, count(conv_id) AS detections, count(conv_id) > 0 AS present
         FROM items LEFT JOIN conversations ON conv_id = item_id GROUP BY item_id""",
    "items_sorted": B.cte(B.ITEMS)
    + "SELECT collection_id, file_name, item_id, row_number() OVER (PARTITION BY collection_id ORDER BY file_name, item_id) - 1 AS position FROM items",
    "collections_zh": B.cte(*_BASE)
    + """SELECT collection_id, name, row_number() OVER (ORDER BY name COLLATE zh, collection_id) - 1 AS position
         FROM (SELECT collection_id, translate(substr(name, 4), '0123456789', '零一二三四五六七八九') AS name FROM collections)""",
    "shuffle_order": B.cte(B.ITEMS, _SHUFFLED) + "SELECT item_id, shuffle_key, position FROM shuffled",
    "sample_per_group": B.cte(B.ITEMS)
    + f"""SELECT collection_id, item_id, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
          (PARTITION BY collection_id ORDER BY md5('{B.SEED}:' || item_id), item_id) AS r FROM items) WHERE r <= 8""",
    "offset_page": B.cte(B.ITEMS)
    + "SELECT collection_id, file_name, item_id FROM items ORDER BY collection_id, file_name, item_id LIMIT 5 OFFSET 20",
    "content_type": B.cte(B.ITEMS)
    + f"""SELECT item_id, CASE lower(['.jpg', '.JPEG', '.png', '.WebP', '.gif', '.bmp', '.txt', ''][item_id % 8 + 1])
          {_MIME} ELSE 'image/jpeg' END AS content_type FROM items""",
    "name_decode": "SELECT page_id, page_id || '/' || url || '+x y' AS name FROM pages",
    "folder_name": B.cte(*_BASE)
    + "SELECT collection_id, collection_id || '_' || replace(substr(title, 1, 50), '/', '_') AS folder FROM collections",
    "folder_id": B.cte(*_BASE)
    + """SELECT collection_id, CASE WHEN collection_id % 3 = 0 THEN collection_id + 500
         WHEN collection_id % 6 = 5 THEN NULL ELSE collection_id END AS resolved_id FROM collections""",
    "shard_size": _shard_sql + "SELECT * FROM size",
    "shard_assign": _shard_sql + "SELECT * FROM assigned",
    "shard_balance": _balanced_sql + "SELECT * FROM balanced",
    "shard_manifest": _balanced_sql
    + """SELECT shard, printf('train-%05d-of-%05d.parquet', shard, (SELECT count(DISTINCT shard) FROM balanced)) AS name,
         count(*) AS rows, round(CAST(sum(bytes) AS BIGINT) / 1048576.0, 6) AS mb FROM balanced GROUP BY shard""",
    "pack_files": B.cte(B.ITEMS)
    + """SELECT collection_id AS album_id, file_name, md5(text) AS payload_md5, CAST(strlen(text) AS BIGINT) AS bytes
         FROM items WHERE text IS NOT NULL""",
    "smoke_shard": _shard_sql + "SELECT item_id, position FROM assigned WHERE shard = 0",
    "write_shards": B.cte(*_BASE, _PACKED)
    + f"""SELECT album_id, file_name, {_TITLE} AS title, md5(text) AS payload_md5, CAST(strlen(text) AS BIGINT) AS bytes
         FROM packed JOIN (SELECT item_id, text FROM items) USING (item_id)""",
    "sidecar_rows": _packed_sql + "SELECT * EXCLUDE (image) FROM packed",
    "unpack_collections": B.cte(*_BASE, _PACKED, _SHUFFLED, _FIRST)
    + f"""SELECT album_id, f.title, f.model_name, f.tags, image_count, {_FOLDER} AS folder
          FROM (SELECT album_id, f, f.title AS title, image_count FROM first_rows)""",
    "unpack_items": B.cte(*_BASE, _PACKED, _SHUFFLED, _FIRST)
    + f"""SELECT p.album_id, item_id, row_number() OVER (PARTITION BY p.album_id ORDER BY file_name, item_id) - 1 AS place,
          {_FOLDER.replace("album_id", "p.album_id").replace("title", "f.title")} || '/' || file_name AS path
          FROM packed p JOIN first_rows USING (album_id)""",
    "label_documents": B.cte(B.ITEMS)
    + "SELECT collection_id, stem, CAST(item_id % 9 + 1 AS INTEGER) AS score, lang AS notes FROM items",
    "scan_items": B.cte(B.ITEMS)
    + """SELECT 'c=' || collection_id AS folder, '.txt' AS extension, CAST(sum(length(item_id || ' ' || bytes) + 1) AS BIGINT) AS bytes
         FROM items GROUP BY collection_id""",
    "unpack_item_labels": _labeled_sql
    + """SELECT album_id, item_id, label_file, document FROM (
           SELECT album_id, item_id, replace(file_name, '.txt', '_labels.json') AS label_file,
             '{' || concat_ws(',', '"album_score":' || album_score, '"album_reason":"' || nullif(album_reason, '') || '"',
                    '"ai_score":' || ai_score, '"ai_reason":"' || nullif(ai_reason, '') || '"',
                    '"has_face":' || has_face, '"has_fullbody":' || has_fullbody) || '}' AS document
           FROM packed_labeled) WHERE document <> '{}'""",
    "scan_metadata": B.cte(*_BASE)
    + """SELECT CAST(collection_id AS VARCHAR) AS folder, collection_id, title, coalesce(creator_name, '') AS creator_name,
         array_to_string(tags, ',') AS tags, creator_id, expected_count, false AS completed FROM collections""",
    "scan_labels": B.cte(*_BASE)
    + """SELECT collection_id, album_score, album_reason AS notes, text_en, has_face
         FROM collection_labels WHERE collection_id % 7 <> 3""",
}
ORACLE["list_items"] = ORACLE["scan_items"]
ORACLE["point_lookup"] = ORACLE["collection_lookup"]

"""Scans of item folders, collection metadata and label documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.constants import ITEM_EXTENSIONS
from shelfmark.functions.text import extension_of, id_from_folder, stem_of
from shelfmark.schemas import COLLECTION_METADATA, LABEL_DOCUMENT


def scan_items(
    spark: SparkSession, root: str | list[str], extensions: Sequence[str] = ITEM_EXTENSIONS, content: bool = False
) -> DataFrame:
    """One row per item file below ``root``; the folder it lies in is its collection.

    The extension filter is applied while listing. Bytes are read only when ``content`` is set.
    """
    letters = [
        "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions
    ]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{" + ",".join(letters) + "}")
        .load(root)
    )
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.element_at(F.split("path", "/"), -2)
    found = files.select(
        folder.alias("folder"),
        name.alias("file_name"),
        stem_of(name).alias("stem"),
        extension_of("path").alias("extension"),
        F.col("length").alias("bytes"),
        "path",
        *(["content"] if content else []),
    )
    return found.filter(F.col("extension").isin(*extensions))


def scan_metadata(spark: SparkSession, root: str, pattern: str = "*/metadata.json") -> DataFrame:
    """One row per collection folder that has a metadata document.

    The id falls back to the folder name's prefix. Ids written as text or as numbers are both read.
    """
    docs = (
        spark.read.schema(f"{COLLECTION_METADATA}, _corrupt_record string")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(f"{root.rstrip('/')}/{pattern}")
        .withColumn("_path", F.col("_metadata.file_path"))
    )
    folder = F.url_decode(F.replace(F.element_at(F.split("_path", "/"), -2), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(folder, "^[^=/]*=", "")
    return (
        docs.filter(F.col("_corrupt_record").isNull())
        .select(
            folder.alias("folder"),
            F.coalesce(F.col("album_id").try_cast("bigint"), id_from_folder(folder)).alias("collection_id"),
            F.coalesce("title", F.lit("")).alias("title"),
            F.coalesce("model_name", F.lit("")).alias("creator_name"),
            F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
            F.col("girl_id").alias("creator_id"),
            F.col("image_count").alias("expected_count"),
            F.coalesce("completed", F.lit(False)).alias("completed"),
        )
    )


def scan_labels(spark: SparkSession, root: str) -> DataFrame:
    """Latest readable label document of each collection.

    A document's name contains ``_labels`` and ends in ``.json``; its id is the part before the
    first underscore. The name is the file's or, for a folder of part files, the folder's.
    Unreadable documents are skipped; of several documents for one id the newest wins.
    """
    docs = (
        spark.read.schema(f"{LABEL_DOCUMENT}, _corrupt_record string")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", True)
        .json(root)
        .select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_at"))
    )
    name = F.regexp_extract("_path", r"/(?:[^/=]*=)?([^/]*_labels[^/]*\.json)(?:/part-[^/]*)?$", 1)
    fields = [c for c in docs.columns if c not in ("_corrupt_record", "_path", "_at")]
    return (
        docs.filter(F.col("_corrupt_record").isNull() & (name != ""))
        .withColumn("collection_id", id_from_folder(name))
        .filter(F.col("collection_id").isNotNull())
        .groupBy("collection_id")
        .agg(F.max_by(F.struct(*fields), F.struct("_at", "_path")).alias("d"))
        .select("collection_id", "d.*")
    )


def explode_item_labels(documents: DataFrame) -> DataFrame:
    """Nested item map of label documents → one row per (collection, item stem)."""
    return documents.select("collection_id", F.explode("images").alias("stem", "label")).select(
        "collection_id", "stem", "label.*"
    )

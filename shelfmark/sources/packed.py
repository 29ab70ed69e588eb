"""Packed dataset: reading splits, writing shards, manifests and sidecars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import PACKED
from shelfmark.storage import stage


#: Payload bytes handed on at a time while files are loaded.
LOAD_BYTES = 64 << 20


def read_packed(spark: SparkSession, root: str, split: str = "train", rows: int | None = None) -> DataFrame:
    """Shards of one split, as folders of part files or as single files; with ``rows``, the first ones in the order of the set."""
    df = spark.read.schema(PACKED).parquet(f"{root.rstrip('/')}/*{split}-*.parquet")
    if rows is None:
        return df
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return placed.orderBy("_file", "_row").limit(rows).drop("_file", "_row")


def load_images(df: DataFrame, path: str = "image") -> DataFrame:
    """Replace a path by the file's bytes and path, read where the row already is.

    Call it after the rows lie in their shards: payloads then go from storage to the shard file
    without crossing a shuffle. Bytes are null for a null path or a file that does not exist; any other
    failure of the storage fails the task, which Spark repeats.
    """
    image = "image struct<bytes: binary, path: string>"
    others = [f for f in df.schema if f.name != path]
    schema = ", ".join([image, *[f"`{f.name}` {f.dataType.simpleString()}" for f in others]])

    def load(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        def read(uri: str | None) -> bytes | None:
            if uri is None:
                return None
            system, name = fs.FileSystem.from_uri(uri)
            try:
                with system.open_input_stream(name) as f:
                    return f.read()
            except FileNotFoundError:
                return None

        for batch in batches:
            paths = batch.column(path).to_pylist()
            start, size, loaded = 0, 0, []
            for at, uri in enumerate(paths):
                loaded.append(read(uri))
                size += len(loaded[-1] or b"")
                if size >= LOAD_BYTES or at == len(paths) - 1:
                    part = batch.slice(start, len(loaded))
                    payload = pa.StructArray.from_arrays(
                        [pa.array(loaded, pa.binary()), pa.array(paths[start : at + 1], pa.string())], ["bytes", "path"]
                    )
                    columns = [payload, *[part.column(f.name) for f in others]]
                    yield pa.RecordBatch.from_arrays(columns, names=["image", *[f.name for f in others]])
                    start, size, loaded = at + 1, 0, []

    return df.mapInArrow(load, schema)


def write_shards(
    df: DataFrame,
    path: str,
    shard: str = "file",
    position: str = "position",
    payload: str | None = None,
    shards: int | None = None,
) -> None:
    """Write one folder of Parquet per shard, named like the shard's file, replacing the target.

    A shard has a fixed number of rows, so partitioning by it cannot skew, and one task writes a
    shard in shuffle order. ``payload`` names a path column whose files are loaded by that task. The
    commit protocol makes the write atomic. ``shards``, their number, gives as many tasks.
    """
    dealt = df.repartition(shards, shard) if shards else df.repartition(shard)
    placed = dealt.sortWithinPartitions(shard, position)
    ready = load_images(placed, payload) if payload else placed
    ready.write.mode("overwrite").partitionBy(shard).parquet(path)


def _by_folder(df: DataFrame, *folders: str) -> DataFrame:
    """Rows of a folder brought together, so that not every task writes a file of it.

    The adaptive plan splits a folder that is too large for a task, and joins small ones.
    """
    return df.hint("rebalance", *folders)


def write_files(df: DataFrame, root: str, name: str = "path", payload: str = "payload") -> DataFrame:
    """Write the bytes of every row to the file it names below ``root``; returns (path, bytes), written once.

    A file is written under another name and renamed, so that a task that is repeated or runs twice leaves whole files.
    Rows with a null payload write nothing. Names must not repeat.
    """

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, top = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            done, sizes = [], []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not data.is_valid:
                    continue
                folder = f"{top}/{path}".rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder)
                    made.add(folder)
                unfinished = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(unfinished, compression=None) as out:
                    out.write(data.as_buffer())
                system.move(unfinished, f"{top}/{path}")
                done.append(f"{root}/{path}")
                sizes.append(len(data.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    rows = df.select(F.col(name).cast("string"), F.col(payload).cast("binary"))
    return stage(rows.mapInArrow(write, "path string, bytes long"), "files")


def write_sidecar(df: DataFrame, path: str, payload: str = "image") -> None:
    """All columns but the payload as JSON lines."""
    df.drop(payload).write.mode("overwrite").json(path)


def write_documents(df: DataFrame, path: str, *folders: str) -> None:
    """One JSON folder per value of ``folders``, replacing the target."""
    _by_folder(df, *folders).write.mode("overwrite").partitionBy(*folders).json(path)


def write_label_documents(labels: DataFrame, items: DataFrame, path: str) -> None:
    """One folder of label documents per collection: its own fields, and a document for each item.

    ``labels`` has collection_id and the collection's fields, ``items`` collection_id, stem and the item's
    fields. The item map of a document holds one item, so that no collection has to fit into a row.
    """
    fields = [c for c in items.columns if c not in ("collection_id", "stem")]
    own = labels.select("collection_id", F.to_json(F.struct(*[c for c in labels.columns if c != "collection_id"])).alias("value"))
    each = items.select(
        "collection_id", F.to_json(F.struct(F.map_from_arrays(F.array("stem"), F.array(F.struct(*fields))).alias("images"))).alias("value")
    )
    named = own.unionByName(each).withColumn("document", F.concat(F.col("collection_id").cast("string"), F.lit("_labels.json")))
    _by_folder(named.select("value", "document"), "document").write.mode("overwrite").partitionBy("document").text(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Copies of quarantined items by category; the source is never changed."""
    _by_folder(df, "category").write.mode("overwrite").partitionBy("category").parquet(path)

"""Publishing shards in two phases: a whole new version beside the old one, then one pointer.

A set is a folder of versions and a folder of numbered pointers, each a small file that names a version; the largest
number counts. A version is written, read back and held against its manifest before its pointer is made, so readers see
the old set until the new one is whole, and a failed write changes nothing for them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.packed import read_packed, write_shards

POINTERS = "published"


class NotPublished(RuntimeError):
    """The written version differs from its manifest, or another one was published meanwhile."""


def _folder(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _pointers(spark: SparkSession, root: str) -> list[str]:
    files, path = _folder(spark, f"{root}/{POINTERS}")
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(n for n in names if n.isdigit())


def published(spark: SparkSession, root: str) -> str | None:
    """Folder of the version that readers see."""
    names = _pointers(spark, root)
    if not names:
        return None
    return f"{root}/{spark.read.text(f'{root}/{POINTERS}/{names[-1]}').first()[0]}"


def differing_shards(spark: SparkSession, version: str, manifest: DataFrame, shard: str = "file") -> DataFrame:
    """(name, rows, bytes, found_rows, found_bytes) of the shards whose rows or payload bytes are not those of the manifest."""
    found = spark.read.parquet(version).groupBy(F.col(shard).alias("name")).agg(
        F.count(F.lit(1)).alias("found_rows"), F.coalesce(F.sum(F.octet_length("image.bytes")), F.lit(0)).cast("bigint").alias("found_bytes")
    )
    both = manifest.select("name", "rows", F.col("bytes").cast("bigint").alias("bytes")).join(found, "name", "full")
    same = F.col("rows").eqNullSafe(F.col("found_rows")) & F.col("bytes").eqNullSafe(F.col("found_bytes"))
    return both.filter(~same)


def publish_shards(
    df: DataFrame, root: str, manifest: DataFrame, shard: str = "file", position: str = "position",
    payload: str | None = None, shards: int | None = None,
) -> str:
    """Write a new version of the set, hold it against ``manifest`` (name, rows, bytes) and make it the one that is read."""
    spark = df.sparkSession
    last = _pointers(spark, root)
    name = f"version-{uuid.uuid4().hex}"
    write_shards(df, f"{root}/{name}", shard, position, payload, shards)
    wrong = differing_shards(spark, f"{root}/{name}", manifest, shard).limit(5).collect()
    if wrong:
        raise NotPublished(f"shards differ from the manifest, such as {wrong[0].asDict()}")
    files, pointer = _folder(spark, f"{root}/{POINTERS}/{int(last[-1]) + 1 if last else 1:012d}")
    _, unfinished = _folder(spark, f"{root}/{POINTERS}/.{name}")
    out = files.create(unfinished, True)
    out.write(bytearray(name.encode()))
    out.close()
    if files.exists(pointer) or not files.rename(unfinished, pointer):
        raise NotPublished("another version was published meanwhile")
    return f"{root}/{name}"


def read_published(spark: SparkSession, root: str, split: str = "train", rows: int | None = None) -> DataFrame:
    version = published(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return read_packed(spark, version, split, rows)


def retire(spark: SparkSession, root: str) -> int:
    """Delete all versions but the one that is read, and their pointers; the number of versions deleted."""
    current = published(spark, root)
    if current is None:
        return 0
    files, path = _folder(spark, root)
    old = [f.getPath() for f in files.listStatus(path) if f.getPath().getName().startswith("version-") and not current.endswith(f.getPath().getName())]
    for version in old:
        files.delete(version, True)
    for name in _pointers(spark, root)[:-1]:
        files.delete(_folder(spark, f"{root}/{POINTERS}/{name}")[1], False)
    return len(old)

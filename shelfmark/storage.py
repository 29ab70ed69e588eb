"""Written intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A written Parquet table cuts lineage, survives the loss of executors and can be read back
column by column, so it is used wherever a result must be computed exactly once. Where the setting is
absent, the tables lie below the warehouse, which executors share, too. ``release`` removes what a
session has staged, once the results that read it are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DIR_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"

#: For rows of a MB or so. Pages and row groups are else measured at every hundredth row only, and whoever writes or reads
#: a page holds it whole, outside the heap too.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}

#: Folders handed out, by application.
_FOLDERS: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; the warehouse where that is unset, unless it is a local folder on a cluster."""
    named = spark.conf.get(DIR_KEY, None)
    if named:
        return named.rstrip("/")
    root = spark.conf.get(WAREHOUSE_KEY).rstrip("/")
    scheme = root.partition(":")[0] if ":" in root else "file"
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {DIR_KEY} to a folder that all executors share: {root} is local to one machine")
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/shelfmark/{label}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once and return a reader over the written table; ``options`` are those of its files."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables returned by ``stage`` once everything that reads them is written."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Delete all folders this application was given; call it when its results are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = _FOLDERS.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(folders)

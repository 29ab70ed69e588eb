"""Listing of item folders by tasks, level by level, so that no file is known to the driver.

The folders of a level are a written table; tasks list them and write what they find, files and folders; the folders
found are the next level. The driver only learns whether there is another one. A folder is listed by one task, the
folders of a level by as many as there are partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.constants import ITEM_EXTENSIONS
from shelfmark.functions.text import extension_of, stem_of
from shelfmark.storage import stage

#: Entries of a folder that are handed on at a time.
ENTRIES = 10_000
_FOUND = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("is_folder", pa.bool_())])


def _address(root: str, path: str) -> str:
    """The address of a path that pyarrow gives below ``root``, as Spark writes it."""
    scheme, mark, rest = root.partition("://")
    if not mark or scheme == "file":
        return f"file:{path}"
    return f"{scheme}://{rest.partition('/')[0] if path.startswith('/') else ''}{path}"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each folder; hidden ones, those of writers under way and a folder that is gone have none."""
    from pyarrow import fs

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            local = folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder
            system, path = fs.FileSystem.from_uri(local)
            found = system.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True))
            for at in range(0, len(found), ENTRIES):
                own = [i for i in found[at : at + ENTRIES] if not i.base_name.startswith((".", "_"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_address(folder, i.path) for i in own], pa.string()), pa.array([i.size for i in own], pa.int64()),
                        pa.array([i.type == fs.FileType.Directory for i in own], pa.bool_()),
                    ],
                    schema=_FOUND,
                )


def list_items(spark: SparkSession, root: str, extensions: Sequence[str] = ITEM_EXTENSIONS, tasks: int | None = None) -> DataFrame:
    """One row per item file below ``root``: folder, file_name, stem, extension, bytes, path, as ``files.scan_items``."""
    tasks = tasks or max(spark.sparkContext.defaultParallelism, 1)
    level = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    found = []
    while True:
        entries = level.repartition(tasks, "path").mapInArrow(_listed, "path string, bytes long, is_folder boolean")
        found.append(stage(entries, "listing"))
        level = found[-1].filter("is_folder").select("path")
        if level.isEmpty():
            break
    every = reduce(DataFrame.unionByName, found).filter("not is_folder")
    name = F.element_at(F.split("path", "/"), -1)
    items = every.select(
        F.element_at(F.split("path", "/"), -2).alias("folder"), name.alias("file_name"), stem_of(name).alias("stem"),
        extension_of("path").alias("extension"), "bytes", "path",
    )
    return items.filter(F.col("extension").isin(*extensions))

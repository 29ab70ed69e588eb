"""Items, collections and labels written in buckets of the collection, so that packing them moves nothing.

All three are bucketed and sorted by collection and salt; joins on both read bucket beside bucket. A collection of more
than ``hot_rows`` items has several salts, over which its items are spread by their name, and its one row of metadata
and of labels is repeated for each, so no bucket has to hold a collection of any size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.relational import packed_columns
from shelfmark.scale import HOT_ROWS, hot_keys
from shelfmark.storage import new_folder

KEY = ("collection_id", "salt")


class Buckets(NamedTuple):
    """Names of the tables."""

    items: str
    collections: str
    labels: str


def write_bucketed(df: DataFrame, key: Sequence[str], buckets: int, label: str) -> str:
    """Write a table of one sorted file a bucket in the shared folder; its name."""
    name = f"shelfmark_{label}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *key)
    dealt.write.bucketBy(buckets, *key).sortBy(*key).option("path", new_folder(df.sparkSession, label)).saveAsTable(name)
    return name


def write_pack_buckets(
    items: DataFrame, collections: DataFrame, labels: DataFrame, buckets: int, hot_rows: int = HOT_ROWS, spread_on: str = "file_name"
) -> Buckets:
    """Write the three tables; ids are compared as numbers, and rows without one take no part."""
    as_id = F.col("collection_id").try_cast("bigint")
    keyed = items.withColumn("collection_id", as_id).filter("collection_id is not null")
    hot = F.broadcast(hot_keys(keyed, ["collection_id"], hot_rows))  # at most rows / hot_rows of them
    salts = F.coalesce("_salts", F.lit(1))
    spread = keyed.join(hot, "collection_id", "left").withColumn("salt", F.pmod(F.xxhash64(spread_on), salts).cast("int")).drop("_salts")

    def repeated(df: DataFrame) -> DataFrame:
        rows = df.withColumn("collection_id", as_id).filter("collection_id is not null").join(hot, "collection_id", "left")
        return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")

    return Buckets(
        write_bucketed(spread, KEY, buckets, "items"), write_bucketed(repeated(collections), KEY, buckets, "collections"),
        write_bucketed(repeated(labels), KEY, buckets, "labels"),
    )


def pack_from_buckets(spark, tables: Buckets) -> DataFrame:
    """The packed rows, joined bucket by bucket: no row is moved."""
    items, collections, labels = (spark.table(name).hint("merge") for name in tables)
    named = collections.select(*KEY, "title", "creator_name", "tags").join(labels, list(KEY), "left")
    return packed_columns(items.join(named, list(KEY)))


def drop_buckets(spark, tables: Buckets) -> None:
    """Forget the tables; their files go with the session's other written tables."""
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

"""Session defaults. A cluster's own settings win over everything set here."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("SHELFMARK_DRIVER_MEMORY", "8g"))
        builder = builder.config("spark.ui.enabled", "false")
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        # State of streams lies on disk, not on the heap.
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

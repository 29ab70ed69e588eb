"""Label state kept by key: a value for each field, late edits by their number, expiry by a timer.

The state itself is the table: it lies in the checkpoint's state store and is read back from there, so no output log
grows with the edits. A field holds its value and the number of the edit that set it; an edit sets only the fields it
supplies, and only where its number is larger. With ``keep_ms``, a key that no edit has touched for so long (by the
edits' own time) is handed on as a last row and forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfmark.storage import new_folder

#: Fields of a label with the column that tells whether an edit supplies it.
FIELDS = {"score": "score_set", "tags": "tags_set", "notes": "notes_set", "images": "images_set"}
SEEN = "seen"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def supplied(edits: DataFrame) -> DataFrame:
    """Edits with one flag a field: a score by its own flag, tags and images unless null, notes unless empty."""
    return edits.withColumns({
        "score_set": F.coalesce("score_set", F.lit(False)),
        "tags_set": F.col("tags").isNotNull(),
        "notes_set": F.coalesce("notes", F.lit("")) != "",
        "images_set": F.col("images").isNotNull(),
    })


class LabelFold(StatefulProcessor):
    """One value state a field, and one for the largest number seen."""

    def __init__(self, key: Sequence[str], types: dict[str, T.DataType], keep_ms: int | None):
        self.key, self.types, self.keep_ms = list(key), types, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = {
            name: handle.getValueState(name, T.StructType([T.StructField("value", kind), T.StructField("seq", T.LongType())]))
            for name, kind in self.types.items()
        }
        self.seen = handle.getValueState(SEEN, T.StructType([T.StructField("last_seq", T.LongType()), T.StructField("timer", T.LongType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple] = {}
        last, latest = None, None
        for batch in rows:  # a batch at a time, whatever the number of edits
            if not len(batch):
                continue
            for name in self.types:
                own = batch[batch[FIELDS[name]]]
                if len(own):
                    top = own.loc[own["seq"].idxmax()]
                    if name not in best or top["seq"] > best[name][1]:
                        best[name] = (_plain(top[name], self.types[name]), int(top["seq"]))
            last = max(int(batch["seq"].max()), last if last is not None else -(2**63))
            if self.keep_ms is not None:
                latest = max(int(batch["at_ms"].max()), latest or 0)
        if last is None:
            return iter(())
        for name, (value, seq) in best.items():
            state = self.states[name]
            old = state.get() if state.exists() else None
            if old is None or old[1] is None or old[1] < seq:
                state.update((value, seq))
        before = self.seen.get() if self.seen.exists() else (None, None)
        timer = before[1]
        if self.keep_ms is not None and (timer is None or latest + self.keep_ms > timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = latest + self.keep_ms
            self.handle.registerTimer(timer)
        self.seen.update((max(last, before[0] if before[0] is not None else last), timer))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = dict(zip(self.key, key))
        for name, state in self.states.items():
            row[name] = state.get()[0] if state.exists() else None
            state.clear()
        row["last_seq"] = self.seen.get()[0]
        self.seen.clear()
        yield pd.DataFrame({name: pd.Series([value], dtype=object) for name, value in row.items()})

    def close(self) -> None:
        pass


def _plain(value, kind: T.DataType):
    """A value as the state takes it: pandas turns whole numbers beside nulls into floats, and lists into arrays."""
    if isinstance(kind, T.ArrayType):
        return None if value is None else list(value)
    if value is None or pd.isna(value):
        return None
    if isinstance(kind, T.IntegralType):
        return int(value)
    return value.item() if hasattr(value, "item") else value


def label_types(edits: DataFrame) -> dict[str, T.DataType]:
    return {name: edits.schema[name].dataType for name in FIELDS}


def run_keyed_state(
    edits: DataFrame, key: Sequence[str], checkpoint: str, expired: str | None = None,
    keep_ms: int | None = None, time_col: str | None = None, delay: str = "0 seconds",
) -> None:
    """Fold everything available of an edit stream into the state below ``checkpoint``.

    With ``keep_ms``, ``time_col`` is the edits' time, and the rows of expired keys are written to ``expired``.
    """
    types = label_types(edits)
    rows = supplied(edits)
    if keep_ms is not None:
        rows = rows.withWatermark(time_col, delay).withColumn("at_ms", (F.unix_micros(F.col(time_col).cast("timestamp")) / 1000).cast("long"))
    narrow = rows.select(*key, "seq", *types, *FIELDS.values(), *(["at_ms", time_col] if keep_ms is not None else []))
    out = T.StructType([*[edits.schema[k] for k in key], *[T.StructField(n, t) for n, t in types.items()], T.StructField("last_seq", T.LongType())])
    folded = narrow.groupBy(*key).transformWithStateInPandas(
        LabelFold(key, types, keep_ms), out, "Append" if expired else "Update", "EventTime" if keep_ms is not None else "None"
    )
    writer = folded.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    conf = edits.sparkSession.conf
    provider = conf.get(PROVIDER_KEY)
    conf.set(PROVIDER_KEY, PROVIDER)  # the only one that keeps several values a key; the checkpoint remembers it
    try:
        if expired:
            query = writer.outputMode("append").format("parquet").option("path", expired).start()
        else:
            query = writer.outputMode("update").format("noop").start()
        query.awaitTermination()
    finally:
        conf.set(PROVIDER_KEY, provider)


def read_keyed_state(spark: SparkSession, checkpoint: str, key: Sequence[str], types: dict[str, T.DataType]) -> DataFrame:
    """The state as a table: key, the fields' values, and last_seq."""

    def read(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    parts = None
    for name in (*types, SEEN):
        own = read(name).select(
            *[F.col(f"key.{k}").alias(k) for k in key],
            *[(F.col("value.value") if n == name else F.lit(None)).cast(t).alias(n) for n, t in types.items()],
            (F.col("value.last_seq") if name == SEEN else F.lit(None)).cast("long").alias("last_seq"),
        )
        parts = own if parts is None else parts.unionByName(own)
    # One row of each state by key: the first that is not null is the only one.
    return parts.groupBy(*key).agg(*[F.first(n, ignorenulls=True).alias(n) for n in (*types, "last_seq")])


def keyed_label_state(edits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Run the edit stream over everything available and return the state it leaves."""
    spark = edits.sparkSession
    checkpoint = new_folder(spark, "keyed-state")
    run_keyed_state(edits, key, checkpoint)
    return read_keyed_state(spark, checkpoint, key, label_types(edits))

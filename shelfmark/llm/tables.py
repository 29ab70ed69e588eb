"""Counters of fixed size, filled by tasks and summed in a tree of bounded fan-in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stage
from shelfmark.storage import LARGE_ROWS

#: Tables that are summed at once.
FAN_IN = 64


def added(tables: Iterable[np.ndarray]) -> np.ndarray:
    """Sum of arrays of one length."""
    tables = iter(tables)
    total = next(tables).copy()
    for one in tables:
        total += one
    return total


def sparse(table: np.ndarray) -> np.ndarray:
    """The places of an array that are not zero, then what is there."""
    places = np.flatnonzero(table)
    return np.concatenate([places, table[places]])


def sparse_added(tables: Iterable[np.ndarray]) -> np.ndarray:
    """Sum of arrays as ``sparse`` gives them."""
    places, counts = np.concatenate([t.reshape(2, -1) for t in tables], axis=1)
    places, where = np.unique(places, return_inverse=True)
    total = np.zeros(len(places), np.int64)
    np.add.at(total, where, counts)
    return np.concatenate([places, total])


def tree_sum(
    tables: DataFrame, keys: Sequence[str], label: str, fan_in: int = FAN_IN, add_up: Callable[[Iterable[np.ndarray]], np.ndarray] = added
) -> DataFrame:
    """Sum of the int64 arrays in ``counts`` by ``keys``; ``part`` (int) numbers the tasks they come from.

    A call adds at most ``fan_in`` arrays of one key, whatever the number of tasks.
    """
    keys = list(keys)
    width = len(keys)

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = add_up(np.frombuffer(data, np.int64) for data in rows["counts"])
        out = {name: [value] for name, value in zip(keys, key[:width])}
        return pd.DataFrame(out | {"part": [key[width]], "counts": [total.tobytes()]})

    tables = stage(tables.select(*keys, "part", "counts"), label, LARGE_ROWS)
    schema = tables.schema
    while (tables.agg(F.max("part")).first()[0] or 0) > 0:
        merged = tables.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        tables = stage(merged.groupBy(*keys, "part").applyInPandas(add, schema), label, LARGE_ROWS)
    return tables

"""Helpers shared by the corpus operators.

Documents are addressed by ``d`` (the id, ``NO_ID`` where it is null) and ``h`` (a hash of the text), so
that null ids and ids that occur with several texts stay apart. Rows that repeat both are one document
to the operators that decide about documents, and each of them gets its decision back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import stage

#: Stands for a null id inside the operators.
NO_ID = -(2**63)
#: White space of the word rules: space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["NO_ID", "WORD", "ascii_lower", "bounded_sample", "doc_key", "folder", "give_back", "id_of", "read", "stage", "text_hash"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(column: Column) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(NO_ID))


def id_of(key: Column) -> Column:
    return F.when(key != NO_ID, key)


def text_hash(column: Column) -> Column:
    return F.xxhash64(F.coalesce(column.cast("string"), F.lit("")))


def ascii_lower(column: Column) -> Column:
    """Lower-case A to Z only; plain lower() does where the text is ASCII."""
    plain = F.length(column) == F.octet_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


def give_back(docs: DataFrame, decisions: DataFrame, id_col: str, text_col: str, how: str = "inner") -> DataFrame:
    """Rows of ``docs``, whole, beside the decision of their document.

    ``decisions`` has one row per (d, h); its other columns must not occur in ``docs``.
    """
    rows = docs.select(
        F.struct("*").alias("_row"), doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h")
    )
    kept = [c for c in decisions.columns if c not in ("d", "h")]
    return rows.join(decisions, ["d", "h"], how).select("_row.*", *kept)


def fill(lengths: list[int], size: int) -> int:
    """The largest length to which all can be limited so that they sum to at most ``size``; at least 1."""
    left = size
    ordered = sorted(lengths)
    for i, n in enumerate(ordered):
        if n * (len(ordered) - i) > left:
            return max(left // (len(ordered) - i), 1)
        left -= n
    return max(ordered, default=1)


def windows(text: Column, seed: Column, cap: int, many: int = 8) -> Column:
    """Texts of at most ``cap`` characters; of longer ones a seeded window in each of ``many`` equal parts, by newlines."""
    many = min(many, cap)
    part, wide = F.floor(F.length(text) / many).cast("int"), cap // many
    starts = [part * j + F.pmod(F.xxhash64(F.lit(j), seed), part - wide + 1).cast("int") for j in range(many)]
    cut = F.concat_ws("\n", *[F.substring(text, at + 1, F.lit(wide)) for at in starts])
    return F.when(F.length(text) <= cap, text).otherwise(cut)


def bounded_sample(keys: DataFrame, texts: DataFrame, rows: int, size: int) -> DataFrame:
    """The first ``rows`` of ``keys`` (at, d, h, n, ...) in the order of at, d, h, with their ``text``.

    ``texts`` has (d, h, text), ``n`` is the length of the text. Every chosen document takes part, whatever the
    lengths: where the texts exceed ``size`` characters together, the longest ones give windows.
    """
    first = keys.dropDuplicates(["d", "h"]).orderBy("at", "d", "h").limit(rows).collect()  # narrow
    chosen = F.broadcast(keys.sparkSession.createDataFrame(first, keys.schema))
    cap = fill([r["n"] for r in first], size)
    found = texts.join(chosen, ["d", "h"])
    return found.withColumn("text", windows(F.col("text"), F.col("h"), cap)).dropDuplicates(["d", "h"])

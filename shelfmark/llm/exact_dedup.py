"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The blocks that occur more than once are sorted
and numbered, each hash partition by itself; then adjacent pairs of numbers are sorted and numbered, level by level, until a document
is one number. Two documents have the same number at the same level if and only if all their bytes are
equal: no hash decides. A block or a pair that occurs once proves its document unique, which then
leaves the recursion, so only repeated content is carried on.

Data movement: the blocks cross the network twice (counting, which combines map-side, and fetching
the numbers, where the large side may be split by AQE when one block is in a third of all texts).
All later levels move rows of a few numbers. Names are read from written tables, so that a recomputed
task sees the same ones. Nothing goes to the driver but the largest number of blocks.

Defined results: null text equals empty text; a null id is an id below all others; rows that repeat an
id and a text are rows of their own, counted and returned one by one, and all of them are kept where their id is
(``keep_one`` keeps one of them); an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import doc_key, give_back, id_of, stage, text_hash

#: Bytes of a block: long enough that most unique documents leave at the first level.
BLOCK_BYTES = 4096


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(d, h, nb, i, b): block ``i`` of ``nb``. Offsets are in bytes, so that cutting is direct."""
    rows = docs.select(
        doc_key(docs[id_col]).alias("d"),
        text_hash(docs[text_col]).alias("h"),
        F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "utf-8").alias("bytes"),
    )
    count = F.greatest(F.ceil(F.octet_length("bytes") / F.lit(block_bytes)), F.lit(1)).cast("int")
    at = rows.withColumn("nb", count).withColumn("i", F.explode_outer(F.sequence(F.lit(0), F.col("nb") - 1)))
    return at.select("d", "h", "nb", "i", F.substr("bytes", F.col("i") * block_bytes + 1, F.lit(block_bytes)).alias("b"))


def _numbered(repeated: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Sort the keys that occur more than once and number them.

    Keys are sorted where counting brought them, as any order gives names without collisions; a global order would
    sample whole blocks to the driver.
    """
    counted = repeated.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return stage(counted.select(*keys).sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), label)


def name_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(d, h, rows, level, name) of the documents whose text may occur again; all others are unique.

    ``rows`` counts the rows that repeat the id and the text.
    """
    blocks = _blocks(docs, id_col, text_col, block_bytes)
    names = _numbered(blocks, ["b"], "block-names")
    # Rows that repeat a document meet here, one number for each block.
    named = blocks.join(names, "b").groupBy("d", "h", "nb", "i").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("rows"))
    current = stage(named, "named-blocks")
    longest = current.agg(F.max("nb")).first()[0] or 1
    done = [current.filter("nb = 1").select("d", "h", "rows", F.lit(0).alias("level"), "name")]
    for level in range(1, (longest - 1).bit_length() + 1):
        # A pair whose left or right number is missing belongs to a unique document.
        half = F.floor(F.col("i") / 2).cast("int")
        pairs = (
            current.filter("nb > 1")
            .groupBy("d", "h", "nb", half.alias("i"))
            .agg(
                F.max("rows").alias("rows"),
                F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when(F.col("i") % 2 == 1, F.col("name"))).alias("right"),
            )
            .filter("left is not null and (right is not null or 2 * i + 1 = nb)")
            .select(
                "d", "h", "rows", F.ceil(F.col("nb") / 2).cast("int").alias("nb"), "i", "left",
                F.coalesce("right", F.lit(-1)).alias("right"),
            )
        )
        pairs = stage(pairs, f"pairs-{level}")
        # Rows that repeat a document make its blocks occur again, too, though it may be the only one.
        names = _numbered(pairs.select("left", "right", F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(2))))), ["left", "right"], f"pair-names-{level}")
        current = stage(pairs.join(names, ["left", "right"]).select("d", "h", "rows", "nb", "i", "name"), f"named-{level}")
        done.append(current.filter("nb = 1").select("d", "h", "rows", F.lit(level).alias("level"), "name"))
    return reduce(DataFrame.unionByName, done)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(d, h, rows, keep, group_size) of every document that has a copy; the largest id of a group stays."""
    identities = stage(name_texts(docs, id_col, text_col, block_bytes), "identities")
    groups = stage(
        identities.groupBy("level", "name")
        .agg(F.max("d").alias("keep"), F.sum("rows").alias("group_size"))
        .filter("group_size > 1"),
        "copy-groups",
    )
    return identities.join(groups, ["level", "name"]).select("d", "h", "rows", "keep", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    every = docs.select(
        doc_key(docs[id_col]).alias("d"),
        text_hash(docs[text_col]).alias("h"),
        F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256).alias("text_sha256"),
    )
    marked = every.join(copies(docs, id_col, text_col, block_bytes), ["d", "h"], "left")
    keep = F.coalesce("keep", "d")
    return marked.select(
        id_of(F.col("d")).alias("doc_id"),
        id_of(keep).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("d") == keep).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without the copies; a row that repeats a kept document goes, too."""
    found = stage(copies(docs, id_col, text_col).select("d", "h", (F.col("d") == F.col("keep")).alias("_kept"), F.col("rows").alias("_rows")), "copies")
    rows = give_back(docs, found, id_col, text_col, "left").filter(F.coalesce("_kept", F.lit(True)))
    if found.filter("_kept and _rows > 1").isEmpty():
        return rows.drop("_kept", "_rows")
    # Only rows that repeat a document have to meet once more.
    once = rows.filter(F.coalesce("_rows", F.lit(1)) == 1)
    return once.unionByName(rows.filter("_rows > 1").dropDuplicates([id_col, text_col])).drop("_kept", "_rows")

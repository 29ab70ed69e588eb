"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window is ``window`` consecutive words of an item (the whole item when it is shorter). A document
holds a window only if it holds all the window's shingles, so the prefix that must match is one
shingle: the rarest one, counted in the documents.

1. One pass over the texts finds every place whose shingle occurs in the benchmark, with the words
   around it. Words are compared by position inside one generated code span; nothing is shuffled.
2. Places are counted by shingle (combined map-side) and each window keeps its rarest shingle. A window
   with a shingle that occurs nowhere is dropped.
3. Places meet windows by that shingle only. The start must be at or after the first word, the end at or
   before the last one, and then all words of the window are compared.

The distinct shingles of the benchmark are broadcast while there are at most ``BROADCAST_KEYS`` of
them, which is counted first; beyond that the same join goes through a shuffle.

Defined results: null and empty texts have no words; an item without words has no window; items with
equal windows are all reported; a null item id is reported as the text ``null``; a document row that
repeats another one gets the same result; without items nothing is hit. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_lower, doc_key, give_back, id_of, stage, text_hash

#: Everything in ASCII that is neither a letter nor a digit parts words; other characters belong to them.
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 5
BROADCAST_KEYS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), PARTS), "")


def _shingle(words: str, at: Column, width: int) -> Column:
    """Hash of the ``width`` words from 0-based ``at``; null past the end."""
    inside = at + width <= F.size(words)
    return F.when(inside, F.xxhash64(F.lit(width), *[F.get(words, at + i) for i in range(width)]))


def windows_of(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(win, w, len) of the distinct windows, and (win, item) for every item that has them."""
    worded = items.select(
        F.coalesce(items[id_col].cast("string"), F.lit("null")).alias("item"), words_of(items[text_col]).alias("words")
    ).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = worded.withColumn("i", F.explode_outer(F.sequence(F.lit(0), last)))
    cut = cut.select("item", F.slice("words", F.col("i") + 1, F.lit(window)).alias("w"))
    # Words have no blank in them, so the joined text stands for the list.
    cut = stage(cut.withColumn("win", F.concat_ws(" ", "w")), "item-windows")
    return (
        cut.select("win", "w", F.size("w").alias("len")).dropDuplicates(["win"]),
        cut.select("win", "item").distinct(),
    )


def _places(docs: DataFrame, keys: DataFrame, width: int, window: int, small: bool) -> DataFrame:
    """(d, h, n, at, key, first, around): places of benchmark shingles and the words around them."""
    at = F.col("at")
    rows = docs.select("d", "h", "words", F.posexplode_outer("words").alias("at", "_word"))
    hashed = rows.select("d", "h", "words", "at", _shingle("words", at, width).alias("key"))
    keys = F.broadcast(keys) if small else keys
    if not small:  # only places cross the network, not the texts beside them
        first = F.greatest(at - (window - width), F.lit(0))
        hashed = hashed.select(
            "d", "h", F.size("words").alias("n"), "at", "key", first.alias("first"),
            F.slice("words", first + 1, F.lit(2 * window - width)).alias("around"),
        )
        return hashed.join(keys, "key")
    first = F.greatest(at - (window - width), F.lit(0))
    return hashed.join(keys, "key").select(
        "d", "h", F.size("words").alias("n"), "at", "key", first.alias("first"),
        F.slice("words", first + 1, F.lit(2 * window - width)).alias("around"),
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_keys: int = BROADCAST_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(d, h, start, len, win) of every window that a document holds, and (win, item)."""
    windows, owners = windows_of(items, item_id, item_text, window)
    widths = [r[0] for r in windows.select(F.least("len", F.lit(shingle))).distinct().collect()]  # at most `shingle`
    texts = docs.select(
        doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"), words_of(docs[text_col]).alias("words")
    )
    found = []
    for width in sorted(widths):
        own = windows.filter(F.least("len", F.lit(shingle)) == width)
        parts = own.withColumn("off", F.explode_outer(F.sequence(F.lit(0), F.col("len") - width)))
        parts = stage(parts.select("win", "w", "len", "off", _shingle("w", F.col("off"), width).alias("key")), "window-shingles")
        keys = stage(parts.select("key").distinct(), "shingle-keys")
        small = keys.count() <= broadcast_keys
        places = stage(_places(texts, keys, width, window, small), "shingle-places")
        counts = places.groupBy("key").agg(F.count(F.lit(1)).alias("places"))
        rated = parts.join(counts, "key", "left")  # null: the shingle occurs nowhere, nor does the window
        rarest = Window.partitionBy("win").orderBy(F.col("places").asc_nulls_first(), "key", "off")
        prefix = rated.withColumn("_n", F.row_number().over(rarest)).filter("_n = 1 and places is not null")
        prefix = stage(prefix.select("key", "win", "w", "len", "off"), "window-prefixes")
        start = F.col("at") - F.col("off")
        near = places.join(prefix, "key").filter((start >= 0) & (start + F.col("len") <= F.col("n")))
        same = F.slice("around", start - F.col("first") + 1, F.col("len")) == F.col("w")
        found.append(near.filter(same).select("d", "h", start.alias("start"), "len", "win").distinct())
    if not found:
        nothing = windows.select(F.lit(0).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("h"),
                                 F.lit(0).alias("start"), "len", "win")
        return nothing.filter(F.lit(False)), owners
    return stage(reduce(DataFrame.unionByName, found), "window-occurrences"), owners


def hit_words(found: DataFrame) -> DataFrame:
    """(d, h, n_hit): words inside any occurrence; overlaps count once. A window runs over one document."""
    spans = found.groupBy("d", "h", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("d", "h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    own = spans.withColumn("own", F.greatest(F.col("end") - covered, F.lit(0)))
    return own.groupBy("d", "h").agg(F.sum("own").cast("bigint").alias("n_hit"))


def hits(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(d, h, n_hit, items): per document that holds a window; ``items`` sorted as strings."""
    found, owners = occurrences(docs, items, **options)
    held = found.select("d", "h", "win").distinct().join(owners, "win").groupBy("d", "h")
    return hit_words(found).join(held.agg(F.array_sort(F.collect_set("item")).alias("items")), ["d", "h"])


def _judged(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """(d, h, n_words, n_hit, items, contaminated) of every row of ``docs``."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    every = docs.select(
        doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"),
        # Capitals part no words: both cases count as letters here.
        F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint").alias("n_words"),
    )
    marked = every.join(hits(docs, items, id_col=id_col, text_col=text_col, **options), ["d", "h"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return marked.select(
        "d", "h", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return _judged(docs, items, id_col, text_col, **options).select(
        id_of(F.col("d")).alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated."""
    judged = _judged(docs, items, id_col, text_col, **options)
    clean = judged.filter(~F.col("contaminated")).select("d", "h").distinct()
    return give_back(docs, clean, id_col, text_col)

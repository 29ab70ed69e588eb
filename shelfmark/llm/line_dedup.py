"""Line dedup: a line goes if an earlier one is equal to it or one edit away; the earliest stays.

Lines are ordered by document id and place. Equal lines meet by a 128-bit hash, and only their first occurrence goes
on. Near lines are found by deletion keys, over as little of a line as can hold the edit:

1. Two lines within one edit have the same first half or the same last half, so lines none of whose halves occurs in
   another line are done (halves are counted, combined map-side).
2. A line takes part as itself (``whole``) and as the one that a character is deleted from (``cut``). Both are split in
   two where the other would be: the edit is in one part, and the hash of the other joins the context. Parts whose
   context no other line has are done; the rest is split again, until a part has at most ``PART`` characters.
   So a line costs its length, whatever its length.
3. The parts that are left emit all variants with one character deleted, hashed with their context. Equal variants
   that were cut at the same place are a substitution, a cut and a whole one are an insertion or deletion.

A key needs its earliest line only, not its pairs: whoever shares a key with an earlier line has a witness for going.
The witness is verified on the whole texts: without the characters at the place of the edit they are equal.

Data movement: texts cross the network once, into buckets of the row's number, where both the lines that share a half
and the places that go are joined to them; otherwise narrow rows per line do. A written table goes when the next one is
written. The bound is one edit, for which the method has a key per character.

Defined results: a line is what newlines part; empty lines always stay; all others are compared, whatever their length,
so any two lines of one character are within one edit; a line goes for any earlier line within the bound, even one that
goes itself; null text is one empty line; null ids come first; rows that repeat a document are kept and cut alike; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import doc_key, id_of, stage, text_hash
from shelfmark.sources.buckets import write_bucketed
from shelfmark.storage import discard

#: Characters of a part that emits its variants.
PART = 32


def numbered_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, d, h, lines) of every row, in buckets of the row's number ``rid``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"),
        F.split(F.coalesce(docs[text_col].cast("string"), F.lit("")), "\n").alias("lines"),
    )
    return spark.table(write_bucketed(rows, ["rid"], int(spark.conf.get("spark.sql.shuffle.partitions")), "lines"))


def lines_of(rows: DataFrame) -> DataFrame:
    """(rid, d, h, i, line): all lines that are not empty, with their place."""
    return rows.select("rid", "d", "h", F.posexplode("lines").alias("i", "line")).filter("line <> ''")


def _keys() -> list[Column]:
    return [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2")]


def _halves(line: Column) -> Column:
    """Hashes of the first and last half, for a partner that is as long, or one longer or shorter."""
    n = F.length(line)
    keys = []
    for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys += [
            F.xxhash64(F.lit("first"), half, F.substring(line, F.lit(1), half)),
            F.xxhash64(F.lit("last"), half, F.substring(line, n - half + 1, half)),
        ]
    return F.array_distinct(F.array(*keys))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """(lid, k1, k2, first, halves) of every distinct line, written; ``lid`` is a number in no order."""
    keyed = lines_of(rows).select("d", "h", "i", "rid", *_keys(), _halves(F.col("line")).alias("halves"))
    grouped = keyed.groupBy("k1", "k2").agg(F.min(F.struct("d", "h", "i", "rid")).alias("first"), F.first("halves").alias("halves"))
    return stage(grouped.withColumn("lid", F.monotonically_increasing_id()), "distinct-lines")


def candidates(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """(no, k1, k2, line) of the lines that share a half with another one, numbered in order, written."""
    halves = distinct.select("lid", F.explode("halves").alias("half"))
    shared = stage(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("half"), "shared-halves")
    own = stage(halves.join(shared, "half").select("lid").distinct(), "candidate-lines")
    narrow = distinct.select("lid", "k1", "k2", "first").join(own, "lid").select("k1", "k2", "first")
    numbered = stage(narrow.orderBy("first").select("k1", "k2", "first.*", F.monotonically_increasing_id().alias("no")), "numbered-lines")
    # As many of a row as it has lines; the rows themselves lie in buckets of their number and are not moved.
    wanted = numbered.groupBy("rid").agg(F.collect_list(F.struct("no", "k1", "k2", "i")).alias("wanted"))
    taken = F.transform("wanted", lambda w: F.struct(w["no"].alias("no"), w["k1"].alias("k1"), w["k2"].alias("k2"), F.get("lines", w["i"]).alias("line")))
    found = stage(rows.select("rid", "lines").join(wanted, "rid").select(F.inline(taken)), "candidate-texts")
    discard(shared, own, numbered)
    return found


def _parts(rows: DataFrame) -> DataFrame:
    """Rows split in two: the part that may hold the edit, with the other part in the context.

    ``v`` is the length without the deleted character, from which both lines of a pair find the same middle.
    """
    half = F.floor(F.col("v") / 2).cast("int")
    size, more = F.length("part"), F.col("cut").cast("int")
    left = F.struct(
        F.col("off"), half.alias("v"), F.substring("part", F.lit(1), half + more).alias("part"),
        F.xxhash64("ctx", F.lit("left"), "v", F.substring(F.col("part"), half + more + 1, size)).alias("ctx"),
    )
    right = F.struct(
        (F.col("off") + half).alias("off"), (F.col("v") - half).alias("v"), F.substring(F.col("part"), half + 1, size).alias("part"),
        F.xxhash64("ctx", F.lit("right"), "v", F.substring("part", F.lit(1), half)).alias("ctx"),
    )
    return rows.select("no", "cut", F.inline(F.array(left, right)))


def _met(rows: DataFrame, label: str) -> DataFrame:
    """Rows whose context and length another line has, too, one of them cut, written."""
    rows = stage(rows, f"{label}-parts")
    keys = rows.groupBy("ctx", "v").agg(F.min("no").alias("least"), F.max("no").alias("most"), F.max("cut").alias("any_cut"))
    keys = stage(keys.filter("least < most and any_cut").select("ctx", "v"), f"{label}-contexts")
    found = stage(rows.join(keys, ["ctx", "v"]), f"{label}-met")
    discard(rows, keys)
    return found


def narrowed(texts: DataFrame, part: int = PART) -> DataFrame:
    """(no, cut, off, v, part, ctx): the parts of at most ``part`` characters that may hold an edit."""
    cut = texts.select("no", F.lit(True).alias("cut"), (F.length("line") - 1).alias("v"), "line")
    rows = cut.unionByName(texts.select("no", F.lit(False).alias("cut"), F.length("line").alias("v"), "line"))
    rows = rows.select("no", "cut", F.lit(0).alias("off"), "v", F.col("line").alias("part"), F.lit(0).cast("bigint").alias("ctx"))
    # Every line is split once, as most of them then are done.
    current = _met(_parts(rows.filter("v > 1")).unionByName(rows.filter("v <= 1").select("no", "cut", "off", "v", "part", "ctx")), "first")
    done = []
    while True:
        done.append(current.filter(F.col("v") <= part))
        longer = current.filter(F.col("v") > part)
        if longer.isEmpty():
            return reduce(DataFrame.unionByName, done)
        current = _met(_parts(longer), "next")


def _variants(parts: DataFrame) -> DataFrame:
    """(key, place, no): a row per deletion with its place in the line, and one with place -1 for a whole part."""
    places = F.when(F.col("cut"), F.sequence(F.lit(0), F.col("v"))).otherwise(F.array(F.lit(-1)))
    at = parts.select("no", "off", "v", "part", "ctx", F.explode(places).alias("p"))
    cut = F.concat(F.substring("part", F.lit(1), F.col("p")), F.substring("part", F.col("p") + 2, F.length("part")))
    whole = F.col("p") < 0
    key = F.xxhash64("ctx", "v", F.when(whole, F.col("part")).otherwise(cut))
    return at.select(key.alias("key"), F.when(whole, -1).otherwise(F.col("off") + F.col("p")).alias("place"), "no")


def _without(line: Column, place: Column) -> Column:
    """The line without the character at a place; whole for -1."""
    cut = F.concat(F.substring(line, F.lit(1), place), F.substring(line, place + 2, F.length(line)))
    return F.when(place < 0, line).otherwise(cut)


def near_lines(texts: DataFrame, part: int = PART) -> DataFrame:
    """(k1, k2) of the lines that have an earlier line within one edit, written."""
    variants = stage(_variants(narrowed(texts, part)), "variants")
    keys = variants.groupBy("key").agg(F.min("no").alias("least"), F.max("no").alias("most"))
    keys = stage(keys.filter("least < most").select("key"), "variant-keys")
    met = stage(variants.join(keys, "key"), "met-variants")
    discard(variants, keys)
    # Cut at one place: a substitution. A whole line and a cut one: an insertion or deletion.
    cuts, wholes = met.filter("place >= 0"), met.filter("place < 0")
    swaps = cuts.groupBy("key", "place").agg(F.min("no").alias("witness"), F.max("no").alias("most")).filter("witness < most")
    by_place = cuts.join(swaps.drop("most"), ["key", "place"]).select("no", "place", "witness", F.col("place").alias("cut_at"))
    whole = wholes.groupBy("key").agg(F.min("no").alias("witness"))
    shorter = cuts.join(whole, "key").select("no", "place", "witness", F.lit(-1).alias("cut_at"))
    longer = cuts.groupBy("key").agg(F.min(F.struct(F.col("no").alias("witness"), F.col("place").alias("cut_at"))).alias("w"))
    by_cut = wholes.join(longer, "key").select("no", "place", "w.witness", "w.cut_at")
    found = by_place.unionByName(shorter).unionByName(by_cut).filter(F.col("witness") < F.col("no")).distinct()
    found = stage(found, "witnesses")
    discard(met)
    right = texts.select(F.col("no").alias("witness"), F.col("line").alias("earlier"))
    pairs = found.join(texts, "no").join(right, "witness")
    near = pairs.filter(_without(F.col("line"), F.col("place")) == _without(F.col("earlier"), F.col("cut_at")))
    near = stage(near.select("k1", "k2").distinct(), "near-lines")
    discard(found)
    return near


def dropped_lines(rows: DataFrame, part: int = PART) -> DataFrame:
    """(rid, i) of the lines that go."""
    distinct = distinct_lines(rows)
    texts = candidates(rows, distinct)
    near = near_lines(texts, part)
    marked = stage(
        distinct.select("k1", "k2", F.struct("first.d", "first.h", "first.i").alias("first")).join(near.withColumn("near", F.lit(True)), ["k1", "k2"], "left"),
        "marked-lines",
    )
    discard(distinct, texts, near)
    every = lines_of(rows).select("rid", "d", "h", "i", *_keys())
    later = F.struct("d", "h", "i") != F.col("first")
    return every.join(marked, ["k1", "k2"]).filter(later | F.coalesce("near", F.lit(False))).select("rid", "i")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, text (what stays, by newlines)."""
    rows = numbered_rows(docs, id_col, text_col)
    gone = dropped_lines(rows, part).groupBy("rid").agg(F.collect_list("i").alias("gone"))
    count = F.coalesce(F.size("gone"), F.lit(0))
    # A set difference keeps the order; looking each line up in a list would be quadratic in a document.
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return rows.join(gone, "rid", "left").select(
        id_of(F.col("d")).alias("doc_id"), F.size("lines").cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(count).cast("bigint").alias("n_dropped"), text.alias("text"),
    )

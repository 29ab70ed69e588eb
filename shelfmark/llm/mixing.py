"""Mixing sources to target weights by a low-discrepancy schedule.

1. Sizes: words per document. Each source wants its weight's share of ``share`` times all words, at most
   ``max_repeats`` times its own size; what is above that is shared again by weight.
2. Blocks: the documents of a source are shuffled by a seeded hash and laid end to end ``max_repeats``
   times; the stream is cut into blocks of ``block_words`` words, the last one at the target.
3. Schedule: slot k gets the k-th point of the golden-ratio sequence; the cumulative block counts of the
   sources map it to a source. The r-th slot of a source takes its block r. Slots a source still lacks
   at the end of the sequence follow it, so that every source reaches its target to the word.

Data movement: texts are read once and only (id, source, size) goes on. A source may hold any share of
the rows: running sums and slot ranks are taken in chunks of bounded size and shifted by the sums of
the chunks before, the points meet the sources by buckets of the unit interval, and documents meet
slots by (source, block), which at most ``block_words`` documents share.

Defined results: null text and text without words have size 0 and are never taken; a null source is a
source of its own, sorted last; null ids are kept; repeated rows are separate material, each mixed by
itself; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import WORD, doc_key, id_of, stage, text_hash
from shelfmark.scale import ordered_index

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 1024
#: Points are multiples of 2^-31; the step is the odd number next to the golden ratio of that range.
POINTS = 1 << 31
GOLDEN = 1327217885
#: Buckets of the unit interval by which points meet sources, as a shift of the point.
BUCKET_SHIFT = 19
#: Slots per rank chunk, and the mean number of documents per chunk of a running sum.
SLOT_CHUNK = 1 << 16
DOC_CHUNK = 4096


def source_key(source: Column) -> Column:
    """The source, so that null sorts last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(rid, d, h, skey, source, size), written once; ``rid`` numbers the rows."""
    words = F.regexp_count(F.coalesce(docs[text_col].cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")
    return stage(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            doc_key(docs[id_col]).alias("d"),
            text_hash(docs[text_col]).alias("h"),
            source_key(docs[source_col]).alias("skey"),
            words.alias("size"),
        ),
        "mix-sizes",
    )


def targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """(skey, source_size, weight, target); one row per source, so single windows are small here.

    Filling by weight up to a limit has one level: sources sorted by limit / weight are at their limit
    as long as the level of the rest is above it. The level is the largest one that its source allows.
    """
    totals = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    by_name, by_ratio = Window.orderBy("skey"), Window.orderBy("ratio", "skey")
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    ranked = ranked.withColumn("limit", F.col("source_size") * F.lit(float(max_repeats)))
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    left = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / open_weight)
    level = F.coalesce(F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole), F.max("ratio").over(whole))
    ranked = ranked.withColumn("target", F.least("limit", F.col("weight") * level))
    return ranked.select("skey", "source_size", "weight", "target")


def schedule(plan: DataFrame, block_words: int) -> DataFrame:
    """(slot, skey, r): which block ``r`` of which source each slot of the mix takes.

    ``plan`` has (skey, blocks). Points beyond 2^31 repeat the sequence from its start.
    """
    spark = plan.sparkSession
    in_order = Window.orderBy("skey")
    upto = F.sum("blocks").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = plan.select(
        "skey", "blocks", upto.alias("upto"), F.sum("blocks").over(Window.partitionBy()).alias("all")
    ).filter("all > 0")

    def cut(at: Column) -> Column:
        return F.floor(at / F.col("all") * F.lit(float(POINTS))).cast("bigint")

    cuts = stage(cuts.select(
        "skey", "blocks", "all", cut(F.col("upto") - F.col("blocks")).alias("from"), cut(F.col("upto")).alias("to")
    ).filter("from < to"), "mix-cuts")
    needed = cuts.agg(F.max("all")).first()[0] or 0
    length = needed + needed // 100 + 64 if needed else 0
    points = spark.range(length).select(
        F.col("id").alias("slot"), (((F.col("id") + 1) % POINTS) * GOLDEN % POINTS).alias("point")
    )
    ranges = cuts.withColumn(
        "bucket", F.explode(F.sequence(F.shiftright("from", BUCKET_SHIFT), F.shiftright(F.col("to") - 1, BUCKET_SHIFT)))
    ).select("bucket", "skey", "blocks", "from", "to")
    hit = points.withColumn("bucket", F.shiftright("point", BUCKET_SHIFT)).join(ranges, "bucket")
    drawn = hit.filter("point >= from and point < to").select(
        "slot", "skey", "blocks", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk")
    )
    drawn = stage(drawn, "mix-drawn")
    counts = drawn.groupBy("skey", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("skey", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("skey", "chunk").orderBy("slot")
    ranked = drawn.join(shifts, ["skey", "chunk"]).withColumn("r", F.row_number().over(within) - 1 + F.col("shift"))
    taken = ranked.filter(F.col("r") < F.col("blocks")).select("slot", "skey", "r")
    have = counts.groupBy("skey").agg(F.sum("n").alias("have"))
    short = plan.filter("blocks > 0").join(have, "skey", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    late = short.filter(F.col("have") < F.col("blocks")).withColumn(
        "r", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1))
    )
    return taken.unionByName(late.select((F.lit(length) + F.col("r")).alias("slot"), "skey", "r"))


def placed(sizes: DataFrame, seed: int) -> DataFrame:
    """(rid, skey, size, start): where each document starts in its source's shuffled stream."""
    rows = sizes.filter("size > 0").withColumn("at", F.xxhash64(F.lit(seed), "d", "h"))
    bits = (rows.count() // DOC_CHUNK).bit_length()
    rows = rows.withColumn("chunk", F.shiftrightunsigned("at", 64 - bits) if bits else F.lit(0).cast("bigint"))
    sums = rows.groupBy("skey", "chunk").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("skey", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("skey", "chunk").orderBy("at", "d", "h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("shift")
    return rows.join(shifts, ["skey", "chunk"]).select("rid", "skey", "size", start.alias("start"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows, the targets, and the mix: (slot, skey, block, rid, word_from, word_to).

    The mix read in order of (slot, skey, word_from) is the training stream; the words are those
    numbered ``word_from`` to ``word_to`` (exclusive) in the document ``rid``.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    goals = targets(sizes, weights, share, max_repeats).withColumn(
        "words", F.least(F.round("target").cast("bigint"), F.col("source_size") * max_repeats)
    )
    goals = stage(goals.withColumn("blocks", F.ceil(F.col("words") / block_words).cast("bigint")), "mix-targets")
    slots = schedule(goals.select("skey", "blocks"), block_words)
    turns = placed(sizes, seed).join(goals.select("skey", "source_size", "words"), "skey")
    turns = turns.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    turns = turns.withColumn("begin", F.col("start") + F.col("turn") * F.col("source_size"))
    turns = turns.withColumn("end", F.least(F.col("begin") + F.col("size"), "words")).filter("begin < end")
    first, last = F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words)
    pieces = turns.withColumn("r", F.explode(F.sequence(first, last)))
    pieces = pieces.select(
        "skey", "r", "rid",
        (F.greatest("begin", F.col("r") * block_words) - F.col("begin")).alias("word_from"),
        (F.least("end", (F.col("r") + 1) * block_words) - F.col("begin")).alias("word_to"),
    )
    mixed = pieces.join(slots, ["skey", "r"]).select("slot", "skey", F.col("r").alias("block"), "rid", "word_from", "word_to")
    return sizes, goals, mixed


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per row of ``docs``: (d, h, skey, doc_id, size, source_size, target, taken, first_slot); d, h and skey address it."""
    sizes, goals, mixed = mix(docs, id_col, text_col, source_col, **options)
    taken = mixed.groupBy("rid").agg(
        F.sum(F.col("word_to") - F.col("word_from")).alias("taken"), F.min("slot").alias("first_slot")
    )
    known = sizes.join(goals.select("skey", "source_size", "target"), "skey", "left")
    return known.join(taken, "rid", "left").select(
        "d", "h", "skey", id_of(F.col("d")).alias("doc_id"), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot",
    )


def keep_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Rows of ``docs`` that the mix takes words of, with size, source_size, target, taken and first_slot.

    Of columns that ``docs`` has already, those of the mix win. A text in two sources is a row of each. Rows that repeat an
    id, a text and a source are alike to the mix: what it takes of them is dealt out evenly, row by row.
    """
    own = ["size", "source_size", "target", "taken", "first_slot"]
    mixed = mix_documents(docs, id_col, text_col, source_col, **options)
    found = stage(
        mixed.groupBy("d", "h", "skey").agg(
            *[F.max(c).alias(c) for c in own[:3]], F.sum("taken").alias("taken"), F.min("first_slot").alias("first_slot"), F.count(F.lit(1)).alias("_n")
        ).filter("taken > 0"),
        "mix-taken",
    )
    bare = docs.drop(*[c for c in own if c not in (id_col, text_col, source_col)])
    rows = bare.select(
        F.struct("*").alias("_row"), doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"), source_key(docs[source_col]).alias("skey")
    ).join(found, ["d", "h", "skey"])
    once = rows.filter("_n = 1").select("_row.*", *own)
    if found.filter("_n > 1").isEmpty():
        return once
    repeated = stage(rows.filter("_n > 1").withColumn("_rid", F.monotonically_increasing_id()), "mix-repeated")
    place = ordered_index(repeated.select("d", "h", "skey", "_rid"), ["d", "h", "skey"], [F.col("_rid")], "_i")
    dealt = F.floor(F.col("taken") / F.col("_n")) + (F.col("_i") < F.col("taken") % F.col("_n")).cast("bigint")
    shared = repeated.join(place.select("_rid", "_i"), "_rid").withColumn("taken", dealt).filter("taken > 0")
    return once.unionByName(shared.select("_row.*", *own))

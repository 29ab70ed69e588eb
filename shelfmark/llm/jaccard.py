"""Near duplicates: grouped prefix join on word shingles.

Two documents link when ``100 * |x and y| >= percent * |x or y|`` over their sets of word shingles.

1. One pass counts shingles in a table of fixed size (``SKETCH`` counters, summed over all documents in a
   tree of bounded fan-in). The counts only fix an order of the shingles, rare ones first, and any
   order gives right results.
2. One pass gives each document the hash of its set, its prefix (the first shingles in that order, of
   which a linked pair shares at least one) and a parity bitmap. Equal sets become one set.
3. Sets with the same size and prefix become one group. Groups meet by prefix shingle, under bounds on
   size and position.
4. In each list of groups that share a shingle, and in each group, all are first compared with one
   pivot: the group whose prefix has the least before the shingle, such as the text the others are
   copies of. Components of these links come from joins. Then groups are expanded, and pairs that may
   link two different components are compared: no link between components is lost, and those within
   one component need no look. Neither is capped.
5. A pair is verified on the whole sets, after a bound from the bitmaps, which is exact, too.

Shingles are 64-bit hashes; two different shingles of one pair of documents collide with a chance of
about size^2 / 2^64. Sets are told apart by 128 bits and their size. Texts do not cross the network:
only prefixes do, and the sets of documents that have a candidate.

Defined results: null text and text without words have an empty set and link with nothing; a text of
fewer words than a shingle is one shingle; a null id is below all others; a row that repeats another
gets the same result; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import doc_key, give_back, id_of, stage, text_hash
from shelfmark.llm.components import components
from shelfmark.llm.tables import tree_sum

SHINGLE = 4
PERCENT = 85
#: Counters of the order, in blocks of BLOCK.
SKETCH, BLOCK = 1 << 20, 1 << 16
#: Bits of the parity bitmap, and of the one that tells which texts are wanted.
BITS, WANTED_BITS = 2048, 1 << 23
#: Bytes of text that are taken apart at once.
CHUNK = 1 << 21


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. bytes.split() parts at space and 9 to 13."""
    worded = [t.lower().split() for t in texts]
    ends = np.cumsum([len(w) for w in worded])
    words = np.array([w for ws in worded for w in ws] + [b""], dtype=object)[:-1]
    codes = pd.util.hash_array(words, categorize=True).astype(np.uint64) if len(words) else np.empty(0, np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for end, ws in zip(ends, worded):
            own = codes[end - len(ws) : end]
            size = min(width, len(ws))
            h = np.full(max(len(ws) - size + 1, 0) if size else 0, size, np.uint64)
            for i in range(size):
                h = _mix(h ^ own[i : i + len(h)]) + np.uint64(i)
            out.append(np.unique(h))
    return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Parts of a batch whose texts are about CHUNK bytes, with the place of the first one."""
    start, size, part = 0, 0, []
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if part and size + len(data) > CHUNK:
            yield start, part
            start, size, part = i, 0, []
        part.append(data)
        size += len(data)
    if part:
        yield start, part


def count_shingles(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Documents per counter. The tables of the tasks are summed block by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, texts in _chunks(batch.column(0).to_pylist()):
                sets = shingle_hashes(texts, width)
                total += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        blocks = [total[i : i + BLOCK].tobytes() for i in range(0, SKETCH, BLOCK)]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([task] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
            names=["block", "part", "counts"],
        )

    schema = "block int, part int, counts binary"
    tables = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(count, schema)
    rows = tree_sum(tables, ["block"], "shingle-counts").orderBy("block").collect()  # SKETCH counters, whatever the input
    return np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows]) if rows else np.zeros(SKETCH, np.int64)


def _as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def prefixes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(d, h, n, f1, f2, prefix, bits) of every row, written."""
    counts = docs.sparkSession.sparkContext.broadcast(count_shingles(docs, text_col, width))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = counts.value
        for batch in batches:
            for start, texts in _chunks(batch.column(2).to_pylist()):
                sets = shingle_hashes(texts, width)
                sizes, firsts, f1, f2, bits = [], [], [], [], []
                for s in sets:
                    n = len(s)
                    with np.errstate(over="ignore"):
                        f1.append(s.sum(dtype=np.uint64))
                        f2.append(_mix(s).sum(dtype=np.uint64))
                    order = np.lexsort((s, load[(s & np.uint64(SKETCH - 1)).astype(np.int64)]))
                    firsts.append(_as_signed(s[order[: n - (percent * n + 99) // 100 + 1]] if n else s))
                    odd = np.bincount((s >> np.uint64(40)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
                    bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                    sizes.append(n)
                here = batch.slice(start, len(texts))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32()), pa.array(np.concatenate(firsts), pa.int64())
                )
                marks = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(bits) + 1) * (BITS // 64), pa.int32()), pa.array(np.concatenate(bits), pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        here.column(0), here.column(1), pa.array(sizes, pa.int64()),
                        pa.array(_as_signed(np.array(f1, np.uint64))), pa.array(_as_signed(np.array(f2, np.uint64))), lists, marks,
                    ],
                    names=["d", "h", "n", "f1", "f2", "prefix", "bits"],
                )

    rows = docs.select(
        doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"), docs[text_col].cast("string").alias("text")
    )
    schema = "d long, h long, n long, f1 long, f2 long, prefix array<long>, bits array<long>"
    return stage(rows.mapInArrow(describe, schema), "prefixes")


def _wanted_bits(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the hashes of the wanted texts: WANTED_BITS / 64 numbers at most."""
    at = F.pmod("h", F.lit(WANTED_BITS))
    words = wanted.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {WANTED_BITS}) % 64 as int))")).alias("bits")
    )
    found = words.toPandas()
    bits = np.zeros(WANTED_BITS // 64, np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


def _whole_sets(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(sid, shingles) of the sets in ``wanted`` (sid, d, h), from the texts.

    Texts that are surely not wanted stop at a bitmap, before anything is read or sent.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_wanted_bits(wanted))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy() % WANTED_BITS
            near = (bits.value[at >> 6] >> (at & 63)) & 1
            batch = batch.filter(pa.array(near.astype(bool)))
            for start, texts in _chunks(batch.column(2).to_pylist()):
                sets = [_as_signed(s) for s in shingle_hashes(texts, width)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets), pa.int64())
                )
                here = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([here.column(0), here.column(1), lists], names=["d", "h", "shingles"])

    rows = docs.select(
        doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"), docs[text_col].cast("string").alias("text")
    )
    found = rows.mapInArrow(read, "d long, h long, shingles array<long>").join(wanted, ["d", "h"])
    return found.select("sid", "shingles").dropDuplicates(["sid"])


def _needed(n: str, m: str, percent: int) -> Column:
    """The least overlap of two linked sets of these sizes."""
    return F.ceil((F.col(n) + F.col(m)) * percent / F.lit(100 + percent))


def _may_link(percent: int) -> Column:
    """Bounds on two sets that share a shingle at positions ``pos`` and ``qos`` of their orders."""
    sizes = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    return sizes & (F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("qos")) >= _needed("n", "m", percent))


def verify(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int
) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    of = lambda s, *names: sets.select(F.col("sid").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names])
    both = pairs.join(of("a", "n", "bits"), "a").join(of("b", "n", "bits"), "b")
    apart = F.aggregate(
        F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    near = both.filter(F.col("a_n") + F.col("b_n") - apart >= 2 * _needed("a_n", "b_n", percent))
    near = stage(near.select("a", "b", "a_n", "b_n"), "near-pairs")
    wanted = near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid"))).distinct()
    wanted = stage(wanted.join(sets, "sid").select("sid", "d", "h"), "wanted-sets")
    whole = stage(_whole_sets(wanted, docs, id_col, text_col, width), "whole-sets")
    left = whole.select(F.col("sid").alias("a"), F.col("shingles").alias("a_set"))
    right = whole.select(F.col("sid").alias("b"), F.col("shingles").alias("b_set"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    compared = near.join(left, "a").join(right, "b")
    return stage(compared.filter(shared >= _needed("a_n", "b_n", percent)).select("a", "b"), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: (d, h, n, root, component).

    ``component`` is the smallest linked id key, ``root`` the component itself; null where n = 0.
    """
    described = prefixes(docs, id_col, text_col, width, percent)
    filled = described.filter("n > 0")
    # Equal sets become one, named by the smallest document that has it.
    first = F.min(F.struct("d", "h", "prefix", "bits")).alias("doc")
    sets = filled.groupBy("f1", "f2", "n").agg(first).select(
        F.monotonically_increasing_id().alias("sid"), "f1", "f2", "n", "doc.*", F.xxhash64("n", "doc.prefix").alias("p")
    )
    sets = stage(sets, "sets")
    # Sets of one size and prefix become one group, named by its smallest set.
    groups = sets.groupBy("n", "p").agg(F.min("sid").alias("gid"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = sets.select("sid", "n", "p").join(stage(groups.select("n", "p", "gid"), "groups"), ["n", "p"])
    members = stage(members.select("gid", "sid", "n"), "members")
    # Shingles that one set alone has in its prefix end here; the others stand for their groups.
    every = sets.select("sid", "n", F.posexplode("prefix").alias("pos", "shingle"))
    counts = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("lists"), F.min("n").alias("least"))
    common = stage(counts.filter("lists > 1").select("shingle", "least"), "common-shingles")
    fits = F.col("n") - F.col("pos") >= _needed("n", "least", percent)
    postings = every.join(common, "shingle").filter(fits).join(members.select("sid", "gid"), "sid", "left")
    postings = postings.select("shingle", F.coalesce("gid", "sid").alias("sid"), "n", "pos").dropDuplicates(["shingle", "sid"])
    postings = stage(postings, "postings")

    # Pivots: everyone in a list, or in a group, with one of them.
    pivots = stage(
        postings.groupBy("shingle").agg(F.min(F.struct("pos", "sid", "n")).alias("q"))
        .select("shingle", F.col("q.sid").alias("pivot"), F.col("q.n").alias("m"), F.col("q.pos").alias("qos")),
        "pivots",
    )
    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    by_list = postings.join(pivots, "shingle").filter(F.col("sid") != F.col("pivot")).filter(_may_link(percent))
    by_group = members.filter("sid <> gid").select(*ordered("gid", "sid"))
    pairs = stage(by_list.select(*ordered("sid", "pivot")).unionByName(by_group).distinct(), "pivot-pairs")
    links = verify(pairs, sets, docs, id_col, text_col, width, percent)

    # What may still join two components: groups expanded, and all pairs of different components.
    roots = stage(components(links), "pivot-roots")
    expanded = postings.join(members.select(F.col("gid").alias("sid"), F.col("sid").alias("member")), "sid", "left")
    expanded = expanded.select(F.col("shingle").alias("key"), F.coalesce("member", "sid").alias("sid"), "n", "pos")
    listed = expanded.select(F.lit(0).alias("kind"), "*").unionByName(
        members.select(F.lit(1).alias("kind"), F.col("gid").alias("key"), "sid", "n", F.lit(0).alias("pos"))
    )
    listed = listed.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    listed = stage(listed, "listed")
    sizes = listed.groupBy("kind", "key", "root").agg(F.count(F.lit(1)).alias("size"))
    mains = sizes.groupBy("kind", "key").agg(F.max(F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    mains = stage(mains.filter("roots > 1").select("kind", "key", F.col("main.root").alias("main")), "open-lists")
    still = stage(listed.join(mains, ["kind", "key"]), "still-open")
    other = still.select(
        "kind", "key", F.col("sid").alias("other"), F.col("n").alias("m"), F.col("pos").alias("qos"), F.col("root").alias("other_root"),
    )
    apart = (
        (F.col("root") != F.col("other_root"))
        & ((F.col("other_root") == F.col("main")) | (F.col("sid") < F.col("other")))
        & _may_link(percent)
    )
    strays = still.filter("root <> main").join(other, ["kind", "key"]).filter(apart)
    rest = strays.select(*ordered("sid", "other")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = verify(stage(rest, "stray-pairs"), sets, docs, id_col, text_col, width, percent)
    more_by_root = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("a_root")), "a", "left").join(
        roots.select(F.col("node").alias("b"), F.col("root").alias("b_root")), "b", "left"
    ).select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    if more.isEmpty():
        final = roots
    else:
        hung = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        final = stage(components(hung.unionByName(more_by_root)), "roots")

    rooted = sets.join(final.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = stage(rooted.select("f1", "f2", "n", "d", "root"), "rooted-sets")
    smallest = stage(rooted.groupBy("root").agg(F.min("d").alias("component")), "smallest")
    by_set = stage(rooted.join(smallest, "root").select("f1", "f2", "n", "root", "component"), "set-components")
    found = described.select("d", "h", "n", "f1", "f2").join(by_set, ["f1", "f2", "n"], "left")
    return found.select("d", "h", "n", "root", F.coalesce("component", "d").alias("component"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    return near_duplicates(docs, id_col, text_col, **options).select(
        id_of(F.col("d")).alias("doc_id"), F.col("n").alias("n_shingles"), id_of(F.col("component")).alias("component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without near duplicates: of a component, the smallest (id, text hash) stays.

    Unlinked texts that share an id, or have none, are components of their own, and so all stay.
    """
    found = stage(near_duplicates(docs, id_col, text_col, **options).select("d", "h", "n", "root"), "near-duplicates")
    first = found.filter("n > 0").groupBy("root").agg(F.min(F.struct("d", "h")).alias("kept"))
    empty = found.filter("n = 0").select("d", "h").distinct()
    return give_back(docs, first.select("kept.d", "kept.h").unionByName(empty), id_col, text_col)

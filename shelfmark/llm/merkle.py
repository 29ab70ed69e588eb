"""Merkle manifest of a dataset: leaves by row, a tree by source, a tree over the sources, and proofs.

Nodes of a group (a source) are numbered by the order of their leaves. An aligned block of ``arity`` to the power
``levels`` nodes keeps each of its levels as one string of hex digests; the parents of a level are the hashes of
its substrings of fixed width, and the siblings of a node are the substrings that flank it in its run. A block that is
not its group's only one is hashed up to one node, the next round's node, which has the block's number; so a group takes
as many rounds as its size has powers of the block. The roots of the groups are the nodes of one more group.

A proof is the list of flanking segments (left, right) from the leaf up. The upper segments of a block are the
same for all its nodes, so they are joined once a block. Folding hashes left, node, right again and again.

Data movement: texts are read once and become two digests a row, written. Digests are numbered by a range sort,
whatever the size of their group, then gathered by block, at most ``arity ** levels`` of them. Proofs are joined to
blocks, and a source with very many blocks is salted (``attach``). Nothing but the number of rounds is collected.

Defined results: a null field is ``-``; a null id is before all others of its source; rows that repeat an id are ordered
by their leaf, so equal rows are interchangeable; a null source is a source of its own, before all others; a group of one
has no siblings, and the proof of a lone row is the hash of the empty string; an empty table gives an empty result.
Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stage
from shelfmark.scale import attach, ordered_index

ARITY = 3
#: Levels of a block: 729 nodes, 47 KB of digests at its lowest level.
LEVELS = 6
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def is_tampered(doc_id: Column) -> Column:
    """Whether the text is read back without its line ends: the CRC-32 of the decimal id is even."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, source_col: str = "source") -> DataFrame:
    """(g, doc_id, node, seen): the leaf of every row, and the leaf of what is read back where it differs, written."""
    own = [docs[c] for c in fields]
    text = docs[fields[-1]].cast("string")
    broken = is_tampered(docs[fields[0]]) & F.contains(text, F.lit("\n"))
    group = F.coalesce(F.concat(F.lit("s"), docs[source_col].cast("string")), F.lit(""))  # null sorts first
    return stage(
        docs.select(
            group.alias("g"), docs[fields[0]].cast("bigint").alias("doc_id"), F.unhex(leaf(own)).alias("node"),
            F.when(broken, F.unhex(leaf([*own[:-1], F.translate(text, "\n", "")]))).alias("seen"),
        ),
        "leaves",
    )


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node))


def _cut(level: Column, at: Column, size: Column | int) -> Column:
    """``size`` digests of a level from the one numbered ``at``; of bytes, as those are cut directly."""
    many = F.lit(size * HEX) if isinstance(size, int) else size * HEX
    return F.substring(level, (at * HEX + 1).cast("int"), many.cast("int"))


def _parents(level: Column, arity: int) -> Column:
    runs = F.ceil(F.octet_length(level) / F.lit(HEX * arity)).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_cut(level, i * arity, arity), 256))
    return F.array_join(hashed, "").cast("binary")


def _segments(levels: Column, place: Column, arity: int) -> Column:
    """What flanks a node in its run, level by level; a block's last level is its root, which has no siblings in it."""

    def flank(level: Column, j: Column) -> Column:
        node = F.floor(place / F.pow(F.lit(float(arity)), j)).cast("int")
        run = F.floor(node / F.lit(arity)).cast("int") * arity
        end = F.least(run + arity, (F.octet_length(level) / F.lit(HEX)).cast("int"))
        left, right = _cut(level, run, node - run), _cut(level, node + 1, end - node - 1)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flank)


def blocks(nodes: DataFrame, extra: Sequence[str], arity: int, levels: int) -> DataFrame:
    """(g, block, lone, items, levels), written: the nodes of each block, and its levels up to its root.

    ``nodes`` has g, idx, node (32 bytes) and the columns ``extra``. ``lone`` tells that a group has no other block.
    """
    wide = arity**levels
    placed = nodes.select(
        "g", F.floor(F.col("idx") / F.lit(wide)).alias("block"),
        F.struct((F.col("idx") % wide).cast("int").alias("place"), "node", *extra).alias("item"),
    )
    gathered = stage(placed.groupBy("g", "block").agg(F.array_sort(F.collect_list("item")).alias("items")), "block-items")
    last = gathered.groupBy("g").agg((F.max("block") == 0).alias("lone"))
    current = attach(gathered, last, ["g"], ["g", "block"], how="inner")
    current = current.withColumn("level0", F.array_join(F.transform("items", lambda x: _hex(x["node"])), "").cast("binary"))
    for j in range(levels):
        below = F.col(f"level{j}")
        # A lone block ends at one node; others are hashed through all levels, even where one node is left.
        more = below.isNotNull() & (~F.col("lone") | (F.octet_length(below) > HEX))
        current = current.withColumn(f"level{j + 1}", F.when(more, _parents(below, arity)))
    every = F.filter(F.array(*[F.col(f"level{j}") for j in range(levels + 1)]), lambda x: x.isNotNull())
    return stage(current.select("g", "block", "lone", "items", every.alias("levels")), "blocks")


def _root(table: DataFrame, *columns: Column) -> DataFrame:
    return table.select("g", *columns, F.unhex(F.element_at("levels", -1).cast("string")).alias("node"))


def climb(nodes: DataFrame, extra: Sequence[str], arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and (g, node) of the groups' roots, written."""
    rounds = [blocks(nodes, extra, arity, levels)]
    while not (open_blocks := rounds[-1].filter("not lone")).isEmpty():
        rounds.append(blocks(_root(open_blocks, F.col("block").alias("idx")), [], arity, levels))
    roots = reduce(DataFrame.unionByName, [_root(table.filter("lone")) for table in rounds])
    return rounds, stage(roots, "group-roots")


def _climbed(kept: list[str], arity: int) -> Column:
    """The nodes of a block with the segments from each of them up to the root."""

    def one(x: Column) -> Column:
        segments = F.concat(_segments(F.col("levels"), x["place"], arity), F.col("upper"))
        return F.struct(x["place"].alias("place"), segments.alias("segments"), *[x[c].alias(c) for c in kept])

    return F.transform("items", one)


def paths(rounds: list[DataFrame], top: DataFrame, extra: Sequence[str], arity: int, levels: int) -> DataFrame:
    """(g, subroot, root, node, segments, extra) of the first round's nodes; ``top`` has (g, subroot, root, upper)."""
    above, out = None, ["g", "block", "items", "levels", "subroot", "root", "upper"]
    for i in range(len(rounds) - 1, -1, -1):
        joined = attach(rounds[i].filter("lone"), top, ["g"], ["g", "block"], how="inner").select(*out)
        if above is not None:
            joined = joined.unionByName(rounds[i].filter("not lone").join(above, ["g", "block"]).select(*out))
        kept = ["node", *extra] if i == 0 else []
        # The segments are cut inside the block's row, so that its levels are not repeated by node.
        each = joined.select("g", "block", "subroot", "root", F.explode(_climbed(kept, arity)).alias("item"))
        if i == 0:
            return each.select("g", "subroot", "root", "item.segments", *[f"item.{c}" for c in kept])
        number = F.col("block") * arity**levels + F.col("item.place")
        above = stage(each.select("g", "subroot", "root", number.alias("block"), F.col("item.segments").alias("upper")), "upper-paths")


def merkle_manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, source_col: str = "source", arity: int = ARITY, levels: int = LEVELS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, seen_leaf, subroot, root (hex) and segments (left, right) from the leaf up."""
    order = [F.col("doc_id"), F.col("node")]
    rows = ordered_index(leaves(docs, fields, source_col), ["g"], order, span=0)
    rounds, subroots = climb(rows, ["doc_id", "seen"], arity, levels)
    sources = ordered_index(subroots.select(F.lit("").alias("g"), F.col("g").alias("source"), "node"), ["g"], [F.col("source")], span=0)
    tops, root = climb(sources, ["source"], arity, levels)
    none = F.array().cast("array<struct<left:string,right:string>>")
    # One row per source: its root and what flanks it in the tree of the sources.
    over = stage(
        paths(tops, root.select("g", F.lit("").alias("subroot"), _hex(F.col("node")).alias("root"), none.alias("upper")), ["source"], arity, levels)
        .select(F.col("source").alias("g"), _hex(F.col("node")).alias("subroot"), "root", F.col("segments").alias("upper")),
        "source-paths",
    )
    proved = paths(rounds, over, ["doc_id", "seen"], arity, levels)
    own = _hex(F.col("node"))
    return proved.select("doc_id", own.alias("leaf"), F.coalesce(_hex(F.col("seen")), own).alias("seen_leaf"), "subroot", "root", "segments")


def proof_digest(segments: Column) -> Column:
    """Hash of all siblings from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(segments, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf_hex: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(segments, leaf_hex, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def verify_manifest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``."""
    manifest = merkle_manifest(docs, **options).withColumn("folded_root", fold(F.col("seen_leaf"), F.col("segments")))
    return manifest.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("segments")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

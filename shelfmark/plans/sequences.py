"""Queries over ordered items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import DEFAULT_SEQUENCE_TEXT, LETTERS, SEQUENCE_TEXT
from shelfmark.functions.vectors import letter_counts, normalised
from shelfmark.operators import prints, quality, sequence
from shelfmark.plans import bindings as B
from shelfmark.sources.packed import write_documents
from shelfmark.storage import new_folder, stage

GROUP = ["collection_id"]
KEY = ["item_id"]
#: Bits within which texts are near: made-up near copies differ in a few words.
WITHIN = 6


def flags(spark, sf_dir, hash_column="lang", abrupt=0.85) -> DataFrame:
    """Change flags over letter histograms; the language stands for the frame hash."""
    items = B.items(spark, sf_dir).withColumn("hash", F.expr(hash_column).cast("string"))
    columns = ["collection_id", "item_id", "hash"]
    featured = letter_counts(items.select(*columns, "text"), "text")
    return sequence.sequence_flags(
        featured, GROUP, KEY, [F.col("item_id")], abrupt=abrupt, narrow=items.select(*columns)
    )


def summaries(spark, sf_dir) -> DataFrame:
    return sequence.sequence_summary(flags(spark, sf_dir), GROUP)


def text_histogram(spark, sf_dir):
    counted = letter_counts(B.items(spark, sf_dir).select("item_id", "text"), "text")
    share = normalised("hist")
    return counted.select(
        "item_id",
        F.array_join(F.col("hist").cast("array<string>"), ",").alias("counts"),
        F.round(F.get(share, F.lit(4)), 9).alias("share_e"),
        F.round(F.get(share, F.lit(26)), 9).alias("share_accent"),
    )


def item_fingerprint(spark, sf_dir):
    return B.items(spark, sf_dir).select("item_id", sequence.fingerprint(F.col("text")).alias("fingerprint"))


def _prints(spark, sf_dir):
    return prints.item_prints(B.items(spark, sf_dir), "item_id", "text")


def item_prints(spark, sf_dir):
    """Fingerprint of every item, and the first item that has the same."""
    return prints.representatives(_prints(spark, sf_dir), "item_id").withColumn("print", F.lower(F.lpad(F.hex("print"), 16, "0")))


def print_pairs(spark, sf_dir):
    return prints.print_pairs(stage(_prints(spark, sf_dir), "prints"), "item_id", WITHIN)


def near_copies(spark, sf_dir):
    return prints.near_copies(stage(_prints(spark, sf_dir), "prints"), "item_id", WITHIN)


def seq_print_change(spark, sf_dir):
    """Neighbours in a collection that are more than half the bits apart count as changes."""
    rows = B.items(spark, sf_dir).select("collection_id", "item_id")
    marked = stage(rows.join(_prints(spark, sf_dir), "item_id", "left"), "item-prints")
    return prints.print_changes(marked, ["collection_id"], [F.col("item_id")], "item_id", 20)


def seq_index(spark, sf_dir):
    """Stems of three kinds: padded numbers, plain numbers and text."""
    stem = F.expr("CASE item_id % 3 WHEN 0 THEN stem WHEN 1 THEN cast(item_id * 7 % 100 AS string) ELSE concat('a', item_id) END")
    rows = B.items(spark, sf_dir).select("collection_id", "item_id", stem.alias("stem"))
    return sequence.sequence_index(rows, GROUP)


def seq_adjacent_sim(spark, sf_dir):
    return flags(spark, sf_dir).select("collection_id", "item_id", "idx", F.round("sim", 6).alias("sim"))


def seq_abrupt(spark, sf_dir):
    return flags(spark, sf_dir).filter("abrupt").select("collection_id", "item_id", "idx")


def seq_hash_change(spark, sf_dir):
    return flags(spark, sf_dir).filter("hash_change").select("collection_id", "item_id", "idx")


def seq_sustained(spark, sf_dir):
    return flags(spark, sf_dir).select(
        "collection_id", "item_id", "idx", F.round("recent_sim", 6).alias("recent_sim"), "sustained"
    )


def seq_key_frames(spark, sf_dir):
    return flags(spark, sf_dir).select("collection_id", "item_id", "idx", "is_key", "is_filler")


def seq_type(spark, sf_dir):
    typed = sequence.sequence_summary(flags(spark, sf_dir, "lang = 'de'", 0.7), GROUP)
    return typed.select("collection_id", "item_count", "key_count", "filler_count", "sequence_type")


def seq_status(spark, sf_dir):
    """Conversations are mostly too short to be analysed; the gates are set to show all results."""
    turns = B.table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "length(text) > 120 AS f")
    counted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("f").alias("features"))
    status = sequence.sequence_status(F.col("n"), F.col("features"), 6, 3)
    return counted.select("conv_id", "n", status.alias("status"))


def seq_summary(spark, sf_dir):
    return summaries(spark, sf_dir)


def seq_turns(spark, sf_dir):
    """The same flags over conversation turns, with the length bucket as hash."""
    turns = B.table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "cast(length(text) > 120 AS string) AS hash", "text"
    )
    featured = letter_counts(turns, "text")
    marked = sequence.sequence_flags(
        featured, ["conv_id"], ["turn"], [F.col("turn")], narrow=turns.select("conv_id", "turn", "hash")
    )
    return marked.select("conv_id", "turn", "idx", "abrupt", "hash_change", "sustained")


def seq_text(spark, sf_dir):
    return summaries(spark, sf_dir).select("collection_id", "sequence_type", "text_en", "text_cn")


def context(spark, sf_dir) -> DataFrame:
    narrow = B.items(spark, sf_dir).select("collection_id", "item_id", F.col("lang").alias("hash"))
    gates = sequence.sequence_gates(narrow, GROUP, "hash")
    return sequence.item_context(flags(spark, sf_dir), gates, GROUP, KEY, measure=narrow)


def item_context(spark, sf_dir):
    return context(spark, sf_dir)


def duplicates(spark, sf_dir):
    prints = stage(
        B.items(spark, sf_dir).select("item_id", sequence.fingerprint(F.col("text")).alias("fingerprint")), "prints"
    )
    return quality.duplicates(prints, "fingerprint", "item_id")


def export_results(spark, sf_dir):
    """Write one result document per collection and read the documents back."""
    done = summaries(spark, sf_dir).select("collection_id", "status", "sequence_type", "key_count", "filler_count")
    path = new_folder(spark, "results")
    write_documents(done, path, "collection_id")
    return spark.read.schema(done.schema).json(path).select(done.columns)


QUERIES = {
    "text_histogram": text_histogram,
    "item_fingerprint": item_fingerprint,
    "item_prints": item_prints,
    "print_pairs": print_pairs,
    "near_copies": near_copies,
    "seq_print_change": seq_print_change,
    "seq_index": seq_index,
    "seq_adjacent_sim": seq_adjacent_sim,
    "seq_abrupt": seq_abrupt,
    "seq_hash_change": seq_hash_change,
    "seq_sustained": seq_sustained,
    "seq_key_frames": seq_key_frames,
    "seq_type": seq_type,
    "seq_status": seq_status,
    "seq_summary": seq_summary,
    "seq_turns": seq_turns,
    "seq_text": seq_text,
    "item_context": item_context,
    "duplicates": duplicates,
    "export_results": export_results,
}

_LETTERS = "[" + ", ".join(f"'{c}'" for c in LETTERS) + "]"
HIST = f"list_transform({_LETTERS}, lambda c: CAST(length(lower(text)) - length(replace(lower(text), c, '')) AS DOUBLE))"


def flags_sql(source: str, group: str, key: str, hash_sql: str, abrupt: float = 0.85) -> str:
    return f"""featured AS (
  SELECT {group}, {key}, row_number() OVER (PARTITION BY {group} ORDER BY {key}) - 1 AS idx, {hash_sql} AS hash, {HIST} AS h FROM {source}),
lagged AS (
  SELECT *, lag(h) OVER w AS h0, lag(hash) OVER w AS hash0 FROM featured WINDOW w AS (PARTITION BY {group} ORDER BY idx)),
compared AS (
  SELECT *, CASE WHEN h0 IS NULL THEN NULL
       WHEN list_inner_product(h, h) * list_inner_product(h0, h0) = 0 THEN 0
       ELSE list_inner_product(h, h0) / (sqrt(list_inner_product(h, h)) * sqrt(list_inner_product(h0, h0))) END AS sim FROM lagged),
averaged AS (
  SELECT *, CASE WHEN idx >= 5 THEN avg(sim) OVER (PARTITION BY {group} ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS recent_sim
  FROM compared),
marked AS (
  SELECT {group}, {key}, idx, sim, recent_sim, idx = 0 OR coalesce(sim < {abrupt}, false) AS abrupt,
         idx = 0 OR coalesce(hash <> hash0, false) AS hash_change, idx = 0 OR coalesce(recent_sim < 0.7, false) AS sustained FROM averaged),
flagged AS (
  SELECT *, abrupt OR hash_change OR sustained AS is_key, NOT (abrupt OR hash_change OR sustained) AS is_filler FROM marked)"""


def _fill(template: str) -> str:
    return f"replace(replace('{template}', '{{n}}', CAST(item_count AS VARCHAR)), '{{k}}', CAST(keys AS VARCHAR))"


def _text_sql(language: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {_fill(t[language])}" for name, t in SEQUENCE_TEXT.items())
    return f"CASE sequence_type {cases} ELSE {_fill(DEFAULT_SEQUENCE_TEXT[language])} END"


SUMMARIES = """counted AS (
  SELECT collection_id, count(*) AS item_count, count(*) FILTER (is_key) AS keys, count(*) FILTER (is_filler) AS fillers,
         count(*) FILTER (abrupt) AS abrupt_count, count(*) FILTER (hash_change) AS hash_change_count, count(*) FILTER (sustained) AS sustained_count
  FROM flagged GROUP BY collection_id),
typed AS (
  SELECT *, CASE WHEN item_count < 30 THEN 'insufficient_frames' ELSE 'analyzed' END AS status,
         CASE WHEN item_count < 30 THEN 'insufficient_frames' WHEN item_count < 10 OR fillers / item_count > 0.7 THEN 'random'
              WHEN keys <= 3 THEN 'minimal' WHEN keys <= 8 THEN 'stepwise' WHEN keys <= 15 THEN 'segmented' ELSE 'continuous' END AS sequence_type
  FROM counted),
summaries AS (
  SELECT collection_id, item_count, status, sequence_type,
         CASE WHEN status = 'analyzed' THEN keys END AS key_count, CASE WHEN status = 'analyzed' THEN fillers END AS filler_count,
         CASE WHEN status = 'analyzed' THEN round(fillers / item_count, 6) END AS filler_ratio,
         CASE WHEN status = 'analyzed' THEN abrupt_count END AS abrupt_count,
         CASE WHEN status = 'analyzed' THEN hash_change_count END AS hash_change_count,
         CASE WHEN status = 'analyzed' THEN sustained_count END AS sustained_count,
         CASE WHEN status = 'analyzed' THEN {en} END AS text_en, CASE WHEN status = 'analyzed' THEN {cn} END AS text_cn
  FROM typed)""".format(en=_text_sql(0), cn=_text_sql(1))
FLAGGED = flags_sql("items", "collection_id", "item_id", "lang")
CONTEXT = """context AS (
  SELECT collection_id, item_id, status = 'analyzed' AND is_key AS is_key, status = 'analyzed' AND is_filler AS is_filler
  FROM flagged JOIN summaries USING (collection_id))"""
PRINT = "md5(lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))))"

_flags = B.cte(B.ITEMS, FLAGGED)
_summary = B.cte(B.ITEMS, FLAGGED, SUMMARIES)
_STEMS = """stems AS (
  SELECT collection_id, item_id, CASE item_id % 3 WHEN 0 THEN stem WHEN 1 THEN CAST(item_id * 7 % 100 AS VARCHAR) ELSE 'a' || item_id END AS stem FROM items)"""

def _half(column: str) -> str:
    return " + ".join(f"CASE WHEN 2 * sum(({column} >> {b}) & 1) > count(*) THEN {1 << b} ELSE 0 END" for b in range(32))


_PRINTS = f"""words AS (
  SELECT item_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS hi, CAST('0x' || substr(md5(w), 9, 8) AS BIGINT) AS lo
  FROM (SELECT item_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS w FROM items) WHERE w <> ''),
prints AS (SELECT item_id, CAST({_half("hi")} AS BIGINT) AS p, CAST({_half("lo")} AS BIGINT) AS q FROM words GROUP BY item_id),
firsts AS (SELECT p, q, min(item_id) AS item_id FROM prints GROUP BY p, q),
near AS (
  SELECT a.item_id AS a, b.item_id AS b, bit_count(xor(a.p, b.p)) + bit_count(xor(a.q, b.q)) AS distance FROM firsts a JOIN firsts b ON a.item_id < b.item_id
  WHERE bit_count(xor(a.p, b.p)) + bit_count(xor(a.q, b.q)) <= {WITHIN})"""
_prints_sql = B.cte(B.ITEMS, _PRINTS)

ORACLE = {
    "text_histogram": B.cte(B.ITEMS)
    + f"""SELECT item_id, array_to_string(list_transform(h, lambda x: CAST(x AS BIGINT)), ',') AS counts,
          round(h[5] / (list_sum(h) + 1e-7), 9) AS share_e, round(h[27] / (list_sum(h) + 1e-7), 9) AS share_accent
          FROM (SELECT item_id, {HIST} AS h FROM items)""",
    "item_fingerprint": B.cte(B.ITEMS) + f"SELECT item_id, {PRINT} AS fingerprint FROM items",
    "item_prints": _prints_sql
    + "SELECT i.item_id, f.item_id AS representative, printf('%08x%08x', i.p, i.q) AS print FROM prints i JOIN firsts f USING (p, q)",
    "print_pairs": _prints_sql + "SELECT a, b, CAST(distance AS INTEGER) AS distance FROM near",
    "near_copies": _prints_sql
    + """SELECT i.item_id, coalesce(n.a, CASE WHEN i.item_id <> f.item_id THEN f.item_id END) AS near
         FROM prints i JOIN firsts f USING (p, q) LEFT JOIN (SELECT b, min(a) AS a FROM near GROUP BY b) n ON n.b = f.item_id
         WHERE n.a IS NOT NULL OR i.item_id <> f.item_id""",
    "seq_print_change": _prints_sql
    + """SELECT collection_id, item_id, idx, CAST(distance AS INTEGER) AS distance, idx = 0 OR coalesce(distance > 20, FALSE) AS change FROM (
           SELECT collection_id, item_id, row_number() OVER w - 1 AS idx, bit_count(xor(p, lag(p) OVER w)) + bit_count(xor(q, lag(q) OVER w)) AS distance
           FROM items LEFT JOIN prints USING (item_id) WINDOW w AS (PARTITION BY collection_id ORDER BY item_id))""",
    "seq_index": B.cte(B.ITEMS, _STEMS)
    + """SELECT collection_id, item_id, stem, row_number() OVER (PARTITION BY collection_id ORDER BY
           NOT regexp_full_match(stem, '[0-9]+'), CASE WHEN regexp_full_match(stem, '[0-9]+') THEN CAST(stem AS BIGINT) END, stem, item_id) - 1 AS idx
         FROM stems""",
    "seq_adjacent_sim": _flags + "SELECT collection_id, item_id, idx, round(sim, 6) AS sim FROM flagged",
    "seq_abrupt": _flags + "SELECT collection_id, item_id, idx FROM flagged WHERE abrupt",
    "seq_hash_change": _flags + "SELECT collection_id, item_id, idx FROM flagged WHERE hash_change",
    "seq_sustained": _flags + "SELECT collection_id, item_id, idx, round(recent_sim, 6) AS recent_sim, sustained FROM flagged",
    "seq_key_frames": _flags + "SELECT collection_id, item_id, idx, is_key, is_filler FROM flagged",
    "seq_type": B.cte(B.ITEMS, flags_sql("items", "collection_id", "item_id", "lang = 'de'", 0.7), SUMMARIES)
    + "SELECT collection_id, item_count, key_count, filler_count, sequence_type FROM summaries",
    "seq_status": """SELECT conv_id, count(*) AS n, CASE WHEN count(*) < 6 THEN 'insufficient_frames'
        WHEN count(*) FILTER (length(text) > 120) < 3 THEN 'insufficient_data' ELSE 'analyzed' END AS status FROM conversations GROUP BY conv_id""",
    "seq_summary": _summary + "SELECT * FROM summaries",
    "seq_turns": B.cte(flags_sql("conversations", "conv_id", "turn", "length(text) > 120"))
    + "SELECT conv_id, turn, idx, abrupt, hash_change, sustained FROM flagged",
    "seq_text": _summary + "SELECT collection_id, sequence_type, text_en, text_cn FROM summaries",
    "item_context": B.cte(B.ITEMS, FLAGGED, SUMMARIES, CONTEXT) + "SELECT * FROM context",
    "duplicates": B.cte(B.ITEMS)
    + f"""SELECT item_id, fingerprint FROM (SELECT item_id, {PRINT} AS fingerprint FROM items)
          QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY item_id) > 1""",
    "export_results": _summary + "SELECT collection_id, status, sequence_type, key_count, filler_count FROM summaries",
}

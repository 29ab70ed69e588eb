"""Items, collections, labels, edits and verdicts read off the given tables.

The SQL fragments next to the frames say the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = "42"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items of the collection named by their source."""
    return table(spark, sf_dir, "documents").select(
        F.expr("try_cast(substring(source, 4) AS bigint)").alias("collection_id"),
        F.col("doc_id").alias("item_id"),
        F.format_string("%03d", "doc_id").alias("stem"),
        F.format_string("%03d.txt", "doc_id").alias("file_name"),
        "lang",
        F.octet_length("text").cast("bigint").alias("bytes"),
        "text",
    )


ITEMS = """items AS (
  SELECT try_cast(substr(source, 4) AS BIGINT) AS collection_id, doc_id AS item_id,
         printf('%03d', doc_id) AS stem, printf('%03d.txt', doc_id) AS file_name, lang,
         CAST(strlen(text) AS BIGINT) AS bytes, text
  FROM documents)"""


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per collection; names, creators and expected counts have gaps by rule."""
    docs = items(spark, sf_dir)
    title = F.substring_index("text", "\n", 1)
    grouped = docs.groupBy("collection_id").agg(
        F.min_by(title, "item_id").alias("title"),
        F.array_sort(F.collect_set("lang")).alias("tags"),
        F.count(F.lit(1)).alias("_n"),
    )
    return grouped.selectExpr(
        "collection_id",
        "concat('src', collection_id) AS name",
        "title",
        "tags",
        "CASE WHEN collection_id % 3 = 0 THEN '' WHEN collection_id % 3 = 2 THEN concat('Creator ', collection_id) END AS creator_name",
        "CASE WHEN collection_id % 5 <> 0 THEN collection_id * 7 % 100 END AS creator_id",
        "_n + collection_id % 3 AS expected_count",
    )


COLLECTIONS = """collections AS (
  SELECT collection_id, 'src' || collection_id AS name, title, tags,
         CASE WHEN collection_id % 3 = 0 THEN '' WHEN collection_id % 3 = 2 THEN 'Creator ' || collection_id END AS creator_name,
         CASE WHEN collection_id % 5 <> 0 THEN collection_id * 7 % 100 END AS creator_id,
         n + collection_id % 3 AS expected_count
  FROM (SELECT collection_id, arg_min(split_part(text, chr(10), 1), item_id) AS title,
               list_sort(list_distinct(list(lang))) AS tags, count(*) AS n
        FROM items GROUP BY collection_id))"""


def collection_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label document of every collection with a flagged item; the id is text, as in file names."""
    flagged = table(spark, sf_dir, "labels").filter("toxic = 1").join(
        items(spark, sf_dir).select(F.col("item_id").alias("doc_id"), "collection_id"), "doc_id"
    )
    return flagged.groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("q")
    ).selectExpr(
        "cast(collection_id AS string) AS collection_id",
        "CASE WHEN collection_id % 4 <> 1 THEN cast(1 + q % 9 AS int) END AS album_score",
        "CASE WHEN collection_id % 2 = 0 THEN concat('note ', n) END AS album_reason",
        "CASE WHEN collection_id % 3 <> 0 THEN concat('text ', collection_id) END AS text_en",
        "cast(NULL AS string) AS text_cn",
        "n % 2 = 0 AS has_face",
        "cast(NULL AS boolean) AS has_fullbody",
    )


COLLECTION_LABELS = """collection_labels AS (
  SELECT collection_id, CASE WHEN collection_id % 4 <> 1 THEN CAST(1 + q % 9 AS INTEGER) END AS album_score,
         CASE WHEN collection_id % 2 = 0 THEN 'note ' || n END AS album_reason,
         CASE WHEN collection_id % 3 <> 0 THEN 'text ' || collection_id END AS text_en,
         CAST(NULL AS VARCHAR) AS text_cn, n % 2 = 0 AS has_face, CAST(NULL AS BOOLEAN) AS has_fullbody
  FROM (SELECT collection_id, count(*) AS n, CAST(sum(quality) AS BIGINT) AS q
        FROM labels JOIN items ON doc_id = item_id WHERE toxic = 1 GROUP BY collection_id))"""


def item_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label documents whose item map holds one item each."""
    docs = items(spark, sf_dir).select("item_id", "collection_id", "stem")
    return table(spark, sf_dir, "labels").join(docs, F.col("doc_id") == F.col("item_id")).selectExpr(
        "collection_id",
        """map(stem, named_struct(
             'ai_score', CASE WHEN quality = 1 THEN cast(1 + item_id % 9 AS int) END,
             'ai_reason', concat('quality ', quality, ' flag ', toxic))) AS images""",
    )


ITEM_LABELS = """item_labels AS (
  SELECT collection_id, stem, CASE WHEN quality = 1 THEN CAST(1 + item_id % 9 AS INTEGER) END AS ai_score,
         'quality ' || quality || ' flag ' || toxic AS ai_reason
  FROM labels JOIN items ON doc_id = item_id)"""


def creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("creator_id"), F.col("s_name").alias("name"))


def edits(events: DataFrame) -> DataFrame:
    """Events as label edits; works on a batch or a streaming frame."""
    return events.selectExpr(
        "user_id AS collection_id",
        "event_type AS item",
        "event_id AS seq",
        "event_id % 3 = 0 AS score_set",
        "CASE WHEN event_id % 3 = 0 AND event_id % 11 <> 0 THEN cast(cast(floor(value) AS bigint) % 10 AS int) END AS score",
        """CASE WHEN event_id % 3 = 1 THEN
             CASE WHEN event_id % 10 = 1 THEN cast(array() AS array<string>) ELSE array(event_type, concat('t', event_id % 7)) END
           END AS tags""",
        "CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 5 = 2 THEN '' ELSE props END END AS notes",
        "CASE WHEN event_id % 31 = 0 THEN concat('{\"', event_type, '\":', event_id, '}') END AS images",
    )


EDITS = """edits AS (
  SELECT user_id AS collection_id, event_type AS item, event_id AS seq, event_id % 3 = 0 AS score_set,
         CASE WHEN event_id % 3 = 0 AND event_id % 11 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) % 10 AS INTEGER) END AS score,
         CASE WHEN event_id % 3 = 1 THEN
           CASE WHEN event_id % 10 = 1 THEN CAST([] AS VARCHAR[]) ELSE [event_type, 't' || event_id % 7] END
         END AS tags,
         CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 5 = 2 THEN '' ELSE props END END AS notes,
         CASE WHEN event_id % 31 = 0 THEN '{"' || event_type || '":' || event_id || '}' END AS images
  FROM events)"""

FACTOR_PRIMES = (("clarity", 3), ("lighting", 7), ("composition", 11), ("background", 13), ("relevance", 17))


def verdict_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-form, comma and fenced-JSON replies of a made-up model, by rule from the document id."""
    docs = items(spark, sf_dir).select("collection_id", "item_id")
    parts = ", ".join(
        f"'{name}=0.', lpad(cast(item_id * {p} % 100 AS string), 2, '0'), ' '" for name, p in FACTOR_PRIMES
    )
    return docs.selectExpr(
        "collection_id",
        "item_id",
        f"""CASE WHEN item_id % 23 <> 0 THEN concat(
              'ai_score: ', CASE WHEN item_id % 19 = 0 THEN '7.5' ELSE cast(1 + item_id % 11 AS string) END, '\n',
              '  ai_factors: ', {parts}, CASE WHEN item_id % 17 = 0 THEN 'clarity=x' ELSE '' END, '\n',
              'reason: first\n', 'ai_reason: because: ', item_id % 5, ' ') END AS response""",
        "CASE WHEN item_id % 23 = 0 THEN 'timeout' END AS error",
        "concat('warm, ,cool,tag', item_id % 4, ',', CASE WHEN item_id % 2 = 0 THEN 'street,' ELSE ' , ' END, ' vivid,indoor , soft') AS tag_text",
        """concat('Verdict\n',
             CASE WHEN item_id % 7 = 0 THEN '' ELSE concat('```json\n{"score": ', item_id % 10, ', "tags": ["t', item_id % 3, '", "x"], "reasoning": "r', item_id % 6, '", "is_relevant": ', CASE WHEN item_id % 2 = 0 THEN 'true' ELSE 'false' END, '}\n```\n') END,
             CASE WHEN item_id % 5 = 0 THEN concat('text ```JSON {"score": ', item_id % 4, '}``` more\n') ELSE '' END,
             CASE WHEN item_id % 13 = 0 THEN '```json\n{"score": }\n```' ELSE '' END) AS markdown""",
    )


_SQL_PARTS = " || ".join(
    f"'{name}=0.' || lpad(CAST(item_id * {p} % 100 AS VARCHAR), 2, '0') || ' '" for name, p in FACTOR_PRIMES
)
VERDICT_TEXTS = f"""verdict_texts AS (
  SELECT collection_id, item_id,
         CASE WHEN item_id % 23 <> 0 THEN
           'ai_score: ' || CASE WHEN item_id % 19 = 0 THEN '7.5' ELSE CAST(1 + item_id % 11 AS VARCHAR) END || chr(10) ||
           '  ai_factors: ' || {_SQL_PARTS} || CASE WHEN item_id % 17 = 0 THEN 'clarity=x' ELSE '' END || chr(10) ||
           'reason: first' || chr(10) || 'ai_reason: because: ' || item_id % 5 || ' ' END AS response,
         CASE WHEN item_id % 23 = 0 THEN 'timeout' END AS error,
         'warm, ,cool,tag' || item_id % 4 || ',' || CASE WHEN item_id % 2 = 0 THEN 'street,' ELSE ' , ' END || ' vivid,indoor , soft' AS tag_text,
         'Verdict' || chr(10) ||
           CASE WHEN item_id % 7 = 0 THEN '' ELSE '```json' || chr(10) || '{{"score": ' || item_id % 10 || ', "tags": ["t' || item_id % 3 || '", "x"], "reasoning": "r' || item_id % 6 || '", "is_relevant": ' || CASE WHEN item_id % 2 = 0 THEN 'true' ELSE 'false' END || '}}' || chr(10) || '```' || chr(10) END ||
           CASE WHEN item_id % 5 = 0 THEN 'text ```JSON {{"score": ' || item_id % 4 || '}}``` more' || chr(10) ELSE '' END ||
           CASE WHEN item_id % 13 = 0 THEN '```json' || chr(10) || '{{"score": }}' || chr(10) || '```' ELSE '' END AS markdown
  FROM items)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors grouped by label, two to an item, with a made-up detection score."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("collection_id"),
        F.expr("vec_id div 2").alias("item_id"),
        "vec_id",
        "embedding",
        F.expr("(vec_id * 37 % 101) / 100.0D").alias("score"),
    )


def cte(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"

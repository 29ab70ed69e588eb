"""Queries over embeddings, and quarantine.

No made-up pair of vectors reaches the default threshold, so a lower one is used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.vectors import cosine
from shelfmark.operators import cluster, quality
from shelfmark.operators.sequence import fingerprint
from shelfmark.plans import bindings as B
from shelfmark.plans.sequences import PRINT
from shelfmark.scale import attach
from shelfmark.sources import packed
from shelfmark.sources.packed import write_documents
from shelfmark.storage import new_folder, stage

THRESHOLD = 0.2
GROUP, ITEM = "collection_id", "item_id"
#: The added collection of one vector.
SINGLE = 1000


def members(spark, sf_dir) -> DataFrame:
    return cluster.leader_clusters(
        B.embeddings(spark, sf_dir), GROUP, ITEM, [F.col("vec_id")], "embedding", THRESHOLD
    )


def leader_clusters(spark, sf_dir):
    return members(spark, sf_dir).select(GROUP, ITEM, "idx", "leader")


def similar_pairs(spark, sf_dir):
    """Pairs the clustering rests on: a leader and each later row that joined it."""
    return members(spark, sf_dir).filter(F.col("idx") != F.col("leader")).select(
        GROUP, F.col("leader").alias("leader_idx"), ITEM, F.round("leader_sim", 6).alias("similarity")
    )


def pairwise_similarity(spark, sf_dir):
    """Similarity of every row to the first row of its group: one pair per row."""
    rows = B.embeddings(spark, sf_dir)
    first = rows.groupBy(GROUP).agg(F.min_by("embedding", "vec_id").alias("reference"), F.min("vec_id").alias("reference_vec"))
    paired = attach(rows, first, [GROUP], ["vec_id"], "inner")
    return paired.select(GROUP, "vec_id", "reference_vec", F.round(cosine("embedding", "reference"), 6).alias("similarity"))


def main_cluster(spark, sf_dir):
    return cluster.main_clusters(members(spark, sf_dir), GROUP)


def cluster_outliers(spark, sf_dir):
    return cluster.cluster_outliers(members(spark, sf_dir), GROUP, ITEM)


def cluster_members(spark, sf_dir):
    return cluster.listed_members(B.embeddings(spark, sf_dir), GROUP, ITEM, [F.col("vec_id")])


def cluster_summary(spark, sf_dir):
    """All labels with all their vectors, a collection of one vector beside them, and nations that have none.

    Counts of items are made up, so that some collections have too few. The one vector is the first of label 3 again.
    """
    rows = B.embeddings(spark, sf_dir)
    single = rows.filter(F.col(GROUP) == 3).orderBy("vec_id").limit(1)
    rows = rows.unionByName(single.withColumn(GROUP, F.lit(SINGLE).cast("bigint")))
    found = cluster.leader_clusters(rows, GROUP, ITEM, [F.col("vec_id")], "embedding", THRESHOLD)
    found = found.withColumn("score", F.expr("(item_id * 37 % 101) / 100.0D"))
    labels = rows.select(GROUP).unionByName(
        B.table(spark, sf_dir, "nation").select((F.col("n_nationkey").cast("bigint") + 100).alias(GROUP))
    ).distinct()
    groups = labels.withColumn("item_count", F.when(F.col(GROUP) == SINGLE, 3).otherwise(F.col(GROUP) % 6 + 1).cast("bigint"))
    return cluster.cluster_summary(groups, found, GROUP, ITEM, "score")


def export_clusters(spark, sf_dir):
    """Write one result document per collection and read the documents back."""
    done = cluster_summary(spark, sf_dir)
    path = new_folder(spark, "clusters")
    write_documents(done, path, GROUP)
    return spark.read.schema(done.schema).json(path).select(done.columns)


def _quarantined(spark, sf_dir) -> DataFrame:
    """Documents without a final stop count as broken; vectors share the documents' ids."""
    no_stop = ~F.endswith(F.rtrim("text"), F.lit("."))
    keyed = stage(
        B.items(spark, sf_dir).select(GROUP, ITEM, fingerprint(F.col("text")).alias("fingerprint"), no_stop.alias("broken")),
        "checked",
    )
    broken = keyed.filter("broken").select(GROUP, ITEM)
    copies = quality.duplicates(keyed, "fingerprint", ITEM).select(GROUP, ITEM)
    outside = cluster.cluster_outliers(members(spark, sf_dir), GROUP, ITEM).select(ITEM)
    non_main = keyed.select(GROUP, ITEM).join(outside, ITEM, "left_semi")
    return quality.quarantine(broken, copies, non_main, [GROUP, ITEM])


def quarantine_counts(spark, sf_dir):
    return quality.quarantine_counts(_quarantined(spark, sf_dir))


def quarantine_items(spark, sf_dir):
    return _quarantined(spark, sf_dir)


def write_quarantine(spark, sf_dir):
    """Write the quarantined items by category, payload included, and look at what lies there."""
    texts = B.items(spark, sf_dir).select(ITEM, "text")
    path = new_folder(spark, "quarantine")
    packed.write_quarantine(_quarantined(spark, sf_dir).join(texts, ITEM), path)
    return spark.read.parquet(path).select("category", ITEM, F.md5("text").alias("payload_md5"))


def clean_items(spark, sf_dir):
    items = B.items(spark, sf_dir).select(GROUP, ITEM)
    return quality.clean(items, _quarantined(spark, sf_dir), ITEM)


QUERIES = {
    "leader_clusters": leader_clusters,
    "similar_pairs": similar_pairs,
    "pairwise_similarity": pairwise_similarity,
    "main_cluster": main_cluster,
    "cluster_outliers": cluster_outliers,
    "cluster_summary": cluster_summary,
    "cluster_members": cluster_members,
    "quarantine_counts": quarantine_counts,
    "quarantine_items": quarantine_items,
    "write_quarantine": write_quarantine,
    "export_clusters": export_clusters,
    "clean_items": clean_items,
}

_MEMBERS = f"""ordered AS (
  SELECT CAST(label AS BIGINT) AS collection_id, vec_id // 2 AS item_id, CAST(embedding AS DOUBLE[]) AS e,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx FROM embeddings),
walk(collection_id, item_id, idx, leader, sim, seeds) AS (
  SELECT collection_id, item_id, idx, idx, CAST(1 AS DOUBLE), [{{'i': idx, 'e': e}}] FROM ordered WHERE idx = 0
  UNION ALL
  SELECT o.collection_id, o.item_id, o.idx, coalesce(m.s.i, o.idx),
         CASE WHEN m.s IS NULL THEN 1 ELSE list_cosine_similarity(m.s.e, o.e) END,
         CASE WHEN m.s IS NULL THEN list_append(w.seeds, {{'i': o.idx, 'e': o.e}}) ELSE w.seeds END
  FROM walk w JOIN ordered o ON o.collection_id = w.collection_id AND o.idx = w.idx + 1,
       LATERAL (SELECT list_filter(w.seeds, lambda s: list_cosine_similarity(s.e, o.e) >= {THRESHOLD})[1] AS s) m),
members AS (SELECT collection_id, item_id, idx, leader, sim FROM walk),
sizes AS (SELECT collection_id, leader, count(*) AS n FROM members GROUP BY ALL),
main AS (SELECT collection_id, leader AS main_leader, n AS main_size FROM sizes
         QUALIFY row_number() OVER (PARTITION BY collection_id ORDER BY n DESC, leader) = 1),
flagged AS (SELECT m.*, leader = main_leader AS in_main, (item_id * 37 % 101) / 100.0 AS score FROM members m JOIN main USING (collection_id))"""
_QUARANTINED = f"""ranked AS (
  SELECT collection_id, item_id, 0 AS r FROM items WHERE right(rtrim(text), 1) <> '.'
  UNION ALL SELECT collection_id, item_id, 1 FROM (SELECT collection_id, item_id, {PRINT} AS p FROM items)
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY item_id) > 1
  UNION ALL SELECT collection_id, item_id, 2 FROM items WHERE item_id IN (SELECT item_id FROM flagged WHERE NOT in_main)),
quarantined AS (
  SELECT collection_id, item_id, ['broken', 'duplicate', 'non_main'][min(r) + 1] AS category FROM ranked GROUP BY collection_id, item_id)"""
_members = B.cte(_MEMBERS, recursive=True)
_VECTORS = f"""vectors AS (
  SELECT label, vec_id, embedding FROM embeddings
  UNION ALL SELECT {SINGLE}, vec_id, embedding FROM embeddings WHERE label = 3 AND vec_id = (SELECT min(vec_id) FROM embeddings WHERE label = 3))"""
_single = B.cte(_VECTORS, _MEMBERS.replace("FROM embeddings)", "FROM vectors)"), recursive=True)
_quarantine = B.cte(B.ITEMS, _MEMBERS, _QUARANTINED, recursive=True)

ORACLE = {
    "leader_clusters": _members + "SELECT collection_id, item_id, idx, leader FROM members",
    "similar_pairs": _members
    + "SELECT collection_id, leader AS leader_idx, item_id, round(sim, 6) AS similarity FROM members WHERE idx <> leader",
    "pairwise_similarity": """WITH v AS (SELECT CAST(label AS BIGINT) AS collection_id, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        f AS (SELECT collection_id, arg_min(e, vec_id) AS e0, min(vec_id) AS reference_vec FROM v GROUP BY collection_id)
        SELECT collection_id, vec_id, reference_vec, round(list_cosine_similarity(e, e0), 6) AS similarity FROM v JOIN f USING (collection_id)""",
    "main_cluster": _members
    + """SELECT collection_id, main_leader, main_size, count(*) AS cluster_count, CAST(sum(n) AS BIGINT) AS embedding_count
         FROM sizes JOIN main USING (collection_id) GROUP BY ALL""",
    "cluster_outliers": _members + "SELECT DISTINCT collection_id, item_id FROM flagged WHERE NOT in_main",
    "cluster_members": """SELECT CAST(label AS BIGINT) AS collection_id, vec_id // 2 AS item_id,
        row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS place FROM embeddings""",
    "cluster_summary": _single
    + f"""SELECT collection_id, status, status = 'analyzed' AND n > 0 AS has_main,
           CASE WHEN status = 'analyzed' THEN n END AS embedding_count, CASE WHEN status = 'analyzed' THEN cluster_count END AS cluster_count,
           CASE WHEN status = 'analyzed' THEN main_size END AS main_size, CASE WHEN status = 'analyzed' THEN outlier_count END AS outlier_count,
           CASE WHEN status = 'analyzed' THEN first_representative END AS first_representative,
           CASE WHEN status = 'analyzed' THEN best_representative END AS best_representative
         FROM (SELECT c.collection_id, coalesce(f.n, 0) AS n, f.* EXCLUDE (collection_id, n),
                 CASE WHEN item_count < 3 THEN 'too_few_items' WHEN f.n IS NULL THEN 'no_embedding' ELSE 'analyzed' END AS status
               FROM (SELECT collection_id, CASE WHEN collection_id = {SINGLE} THEN 3 ELSE collection_id % 6 + 1 END AS item_count FROM (
                   SELECT CAST(label AS BIGINT) AS collection_id FROM vectors UNION SELECT CAST(n_nationkey AS BIGINT) + 100 FROM nation)) c
               LEFT JOIN (SELECT collection_id, count(*) AS n, count(*) FILTER (leader = idx) AS cluster_count,
                   count(*) FILTER (in_main) AS main_size, count(*) FILTER (NOT in_main) AS outlier_count,
                   arg_min(item_id, idx) FILTER (in_main) AS first_representative,
                   (list(item_id ORDER BY score DESC, idx) FILTER (in_main))[1] AS best_representative
                 FROM flagged GROUP BY collection_id) f USING (collection_id))""",
    "quarantine_counts": _quarantine + "SELECT category, collection_id, count(*) AS items FROM quarantined GROUP BY ALL",
    "quarantine_items": _quarantine + "SELECT * FROM quarantined",
    "write_quarantine": _quarantine
    + "SELECT category, item_id, md5(text) AS payload_md5 FROM quarantined JOIN (SELECT item_id, text FROM items) USING (item_id)",
    "clean_items": _quarantine
    + "SELECT collection_id, item_id FROM items WHERE item_id NOT IN (SELECT item_id FROM quarantined)",
}
# The exported documents say what the summary says.
ORACLE["export_clusters"] = ORACLE["cluster_summary"]

"""The corpus operators bound to the given tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm.common import read
from shelfmark.llm.decontaminate import decontaminate
from shelfmark.llm.exact_dedup import exact_dedup
from shelfmark.llm.infill import fill_in_middle_digests
from shelfmark.llm.jaccard import jaccard_join
from shelfmark.llm.language import language_table
from shelfmark.llm.line_dedup import dedup_lines
from shelfmark.llm.merkle import verify_manifest
from shelfmark.llm.mixing import mix_documents
from shelfmark.llm.personal import find_personal
from shelfmark.llm.scoring import score_texts
from shelfmark.llm.secrets import find_secrets
from shelfmark.llm.toxicity import score_toxicity
from shelfmark.llm.warc import archive_round_trip


def op1_grouped_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


def op2_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read(spark, sf_dir, "pages"))


def op3_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op4_slot_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read(spark, sf_dir, "documents")).drop("d", "h", "skey")


def op5_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(read(spark, sf_dir, "documents"))


def op7_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))


def op8_rare_shingle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_subword_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_deletion_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that remain are given by their digest."""
    cut = dedup_lines(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op11_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(read(spark, sf_dir, "documents"))


def op12_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(read(spark, sf_dir, "documents"))


def op13_level_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_manifest(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_grouped_prefix": op1_grouped_prefix,
    "op2_chunk_table": op2_chunk_table,
    "op3_attention": op3_attention,
    "op4_slot_schedule": op4_slot_schedule,
    "op5_block_naming": op5_block_naming,
    "op6_mixture": op6_mixture,
    "op7_field": op7_field,
    "op8_rare_shingle": op8_rare_shingle,
    "op9_subword_bag": op9_subword_bag,
    "op10_deletion_keys": op10_deletion_keys,
    "op11_weak_labels": op11_weak_labels,
    "op12_rotation": op12_rotation,
    "op13_level_strings": op13_level_strings,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op5_block_naming": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_rare_shingle": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                lambda w: w <> '') AS w FROM documents),
        b AS (
            SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                lambda w: w <> '') AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS k, list_slice(w, i, i + least(len(w), 13) - 1) AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        lens AS (SELECT DISTINCT k FROM bw),
        dw AS (
            SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS win
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)),
        hit AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN bw USING (k, win)),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l
               FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(l, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
    """,
    "op10_deletion_keys": r"""
        WITH l AS (
            SELECT doc_id, i, s[i] AS line, len(s) AS n_lines
            FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
        u AS (SELECT line, min((doc_id, i)) AS first, length(line) AS n FROM l WHERE line <> '' GROUP BY line),
        pairs AS (
            SELECT a.line AS a, a.n AS n, b.line AS b, b.n AS m FROM u a JOIN u b ON b.n BETWEEN a.n - 1 AND a.n + 1
                AND b.first < a.first AND (left(a.line, least(a.n, b.n) // 2) = left(b.line, least(a.n, b.n) // 2)
                    OR right(a.line, least(a.n, b.n) // 2) = right(b.line, least(a.n, b.n) // 2))),
        near AS (
            SELECT DISTINCT a AS line FROM pairs WHERE CASE
                WHEN n = m THEN len(list_filter(range(1, n + 1), lambda p: substr(a, p, 1) <> substr(b, p, 1))) = 1
                WHEN n > m THEN len(list_filter(range(0, n), lambda p: left(a, p) || substr(a, p + 2) = b)) > 0
                ELSE len(list_filter(range(0, m), lambda p: left(b, p) || substr(b, p + 2) = a)) > 0 END),
        k AS (
            SELECT doc_id, i, l.line, n_lines, u.line IS NOT NULL AND (near.line IS NOT NULL OR (doc_id, i) <> u.first) AS gone
            FROM l LEFT JOIN u USING (line) LEFT JOIN near USING (line))
        SELECT doc_id, any_value(n_lines) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS text_sha256
        FROM k GROUP BY doc_id
    """,
    "op12_rotation": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
                   FROM documents),
        h AS (SELECT *, list_transform(range(0, 4), lambda k: CAST('0x' || substr(x, 8 * k + 1, 8) AS UBIGINT)) AS h FROM d),
        c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                       WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        s AS (SELECT *, substr(t, 1, CAST(a AS BIGINT)) AS p, substr(t, CAST(a AS BIGINT) + 1, CAST(b - a AS BIGINT)) AS m, substr(t, CAST(b AS BIGINT) + 1) AS s FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM s
    """,
    "op13_level_strings": r"""
        WITH RECURSIVE f AS (
            SELECT doc_id, source, concat(
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head, text,
                list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) % 2 = 1 AS even
            FROM documents),
        l AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(strlen(CASE WHEN even THEN replace(text, chr(10), '') ELSE text END) || ':' ||
                    CASE WHEN even THEN replace(text, chr(10), '') ELSE text END, '-')) AS seen FROM f),
        i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
        tree(source, j, nodes) AS (
            SELECT source, 0, list(leaf ORDER BY idx) FROM i GROUP BY source
            UNION ALL
            SELECT source, j + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda k: sha256(array_to_string(list_slice(nodes, 3 * k + 1, 3 * k + 3), '')))
            FROM tree WHERE len(nodes) > 1),
        subs AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM tree WHERE len(nodes) = 1),
        top(j, nodes) AS (
            SELECT 0, list(subroot ORDER BY place) FROM subs
            UNION ALL
            SELECT j + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda k: sha256(array_to_string(list_slice(nodes, 3 * k + 1, 3 * k + 3), '')))
            FROM top WHERE len(nodes) > 1),
        spots AS (
            SELECT i.doc_id, i.source, i.idx, tree.j, nodes, idx // CAST(pow(3, tree.j) AS BIGINT) AS q
            FROM i JOIN tree ON tree.source IS NOT DISTINCT FROM i.source WHERE len(nodes) > 1
            UNION ALL
            SELECT i.doc_id, i.source, i.idx, 1000 + top.j, nodes, place // CAST(pow(3, top.j) AS BIGINT)
            FROM i JOIN subs ON subs.source IS NOT DISTINCT FROM i.source CROSS JOIN top WHERE len(nodes) > 1),
        sides AS (
            SELECT doc_id, source, idx, j, array_to_string(list_slice(nodes, q // 3 * 3 + 1, q), '') AS a,
                   array_to_string(list_slice(nodes, q + 2, least(q // 3 * 3 + 3, len(nodes))), '') AS b FROM spots),
        path AS (SELECT source, idx, list(a ORDER BY j) AS a, list(b ORDER BY j) AS b, string_agg(a || b, '' ORDER BY j) AS every FROM sides GROUP BY ALL),
        fold(source, idx, k, node) AS (
            SELECT source, idx, 1, seen FROM i
            UNION ALL
            SELECT fold.source, fold.idx, k + 1, sha256(a[k] || node || b[k]) FROM fold JOIN path
                ON path.idx = fold.idx AND path.source IS NOT DISTINCT FROM fold.source WHERE k <= len(a)),
        done AS (SELECT source, idx, arg_max(node, k) AS folded_root FROM fold GROUP BY ALL)
        SELECT i.doc_id, i.leaf, subroot, root, sha256(coalesce(every, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM i JOIN subs ON subs.source IS NOT DISTINCT FROM i.source
        JOIN done ON done.idx = i.idx AND done.source IS NOT DISTINCT FROM i.source
        LEFT JOIN path ON path.idx = i.idx AND path.source IS NOT DISTINCT FROM i.source
        CROSS JOIN (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)
    """,
    "op2_chunk_table": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
        b AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keep,
                array_to_string(list_transform(range(1, 41), lambda k: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111',
                    '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', substr(hex, k, 1))]), '') AS bits
              FROM p)
        SELECT page_id, strlen(body) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                   16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER)
                   + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER)
                   + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keep THEN keep END AS refers_to
        FROM b
    """,
    "op1_grouped_prefix": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT b, root FROM reach JOIN sides ON a = node)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) LEFT JOIN sizes USING (doc_id)
    """,
}

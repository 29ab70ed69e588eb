"""Queries over verdict texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import SCORE_LABELS, WHITE_SPACE
from shelfmark.operators import verdicts as V
from shelfmark.operators.answers import answered, ask
from shelfmark.plans import bindings as B
from shelfmark.plans.sequences import CONTEXT, FLAGGED, SUMMARIES, context
from shelfmark.sources.config import load_config
from shelfmark.storage import new_folder

CONFIG = load_config()


def parsed(spark, sf_dir) -> DataFrame:
    return V.parse_lines(B.verdict_texts(spark, sf_dir).select("collection_id", "item_id", "response", "error"))


def verdict_parse(spark, sf_dir):
    return parsed(spark, sf_dir).select("item_id", "ai_score", "ai_reason", "parse_ok")


def verdict_factors(spark, sf_dir):
    return parsed(spark, sf_dir).select("item_id", F.explode("ai_factors").alias("factor", "value"))


def verdict_tags(spark, sf_dir):
    tags = V.parse_tags(F.col("tag_text"))
    return B.verdict_texts(spark, sf_dir).select("item_id", F.array_join(tags, "|").alias("tags"))


def fenced_json(spark, sf_dir):
    parsed_json = V.parse_json_verdict(F.col("markdown"))
    return B.verdict_texts(spark, sf_dir).select("item_id", parsed_json.alias("v")).select(
        "item_id",
        F.col("v.score").alias("score"),
        F.array_join("v.tags", "|").alias("tags"),
        F.col("v.reasoning").alias("reasoning"),
        F.col("v.is_relevant").alias("is_relevant"),
    )


def verdict_merge(spark, sf_dir):
    scores = parsed(spark, sf_dir).select("item_id", "ai_score", "ai_reason")
    given = F.when(F.col("item_id") % 4 != 1, F.col("tag_text"))
    tags = B.verdict_texts(spark, sf_dir).select("item_id", V.parse_tags(given).alias("ai_tags"))
    return V.merge_verdict(scores, tags, "item_id").withColumn("ai_tags", F.array_join("ai_tags", "|"))


def scored(spark, sf_dir) -> DataFrame:
    """Parsed verdicts with rubric value and score, using each item's place in its sequence."""
    marked = context(spark, sf_dir).select("item_id", "is_key", "is_filler")
    value, score = V.rubric_score(F.col("ai_factors"), F.col("is_key"), F.col("is_filler"), CONFIG)
    return parsed(spark, sf_dir).join(marked, "item_id").withColumns({"rubric_value": value, "rubric_score": score})


def rubric_score(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "item_id", "is_key", F.round("rubric_value", 6).alias("rubric_value"), "rubric_score"
    )


def rubric_sub_score(spark, sf_dir):
    values = F.expr("""map('focus', (item_id * 3 % 100) / 100.0D, 'noise', (item_id * 7 % 100) / 100.0D,
        'exposure', (item_id * 11 % 100) / 100.0D, 'balance', (item_id * 13 % 100) / 100.0D, 'framing', (item_id * 17 % 100) / 100.0D)""")
    scores = V.sub_scores(B.items(spark, sf_dir), "item_id", values, CONFIG)
    return scores.withColumn("value", F.round("value", 6))


def agreement_gate(spark, sf_dir):
    """Line verdict against JSON verdict of the same item."""
    lines = parsed(spark, sf_dir).select("item_id", (F.col("parse_ok") & (F.col("ai_score") >= 5)).alias("ok"))
    score = V.parse_json_verdict(F.col("markdown"))["score"]
    fenced = B.verdict_texts(spark, sf_dir).select(
        "item_id", F.when(F.col("item_id") % 9 != 0, F.coalesce(score >= 5, F.lit(False))).alias("ok")
    )
    return V.agreement(lines, fenced, "item_id")


def score_label(spark, sf_dir):
    return parsed(spark, sf_dir).select("item_id", "ai_score", V.score_label(F.col("ai_score")).alias("label"))


def prompt_build(spark, sf_dir):
    return context(spark, sf_dir).select(
        "item_id", V.score_prompt(F.col("is_key"), F.col("is_filler"), CONFIG).alias("prompt")
    )


def score_stage(spark, sf_dir):
    """Every item's text through the scoring stage and the parser."""
    prompts = B.items(spark, sf_dir).select("item_id", F.col("text").alias("prompt"))
    answers = V.parse_lines(V.score_stage(prompts, "item_id", "prompt"))
    return answers.select("item_id", "ai_score", "ai_reason", F.try_element_at("ai_factors", F.lit("clarity")).alias("clarity"))


def score_answers(spark, sf_dir):
    """The same through the answer table: the items of two languages first, then all, of which only new texts are asked."""
    root = new_folder(spark, "answers")
    prompts = B.items(spark, sf_dir).select("item_id", "lang", F.col("text").alias("prompt"))
    ask(prompts.filter(F.col("lang").isin("en", "de")), root, round_prompts=100_000)
    ask(prompts, root, round_prompts=100_000)
    answers = V.parse_lines(answered(prompts, root, "item_id"))
    return answers.select("item_id", "ai_score", "ai_reason", F.try_element_at("ai_factors", F.lit("clarity")).alias("clarity"))


def tag_vocab(spark, sf_dir):
    """Part types as categories, their brands as tags."""
    tags = B.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category_pos"), F.col("p_brand").alias("tag_pos"), F.col("p_type").alias("category"), F.col("p_brand").alias("tag")
    ).distinct()
    return V.vocabulary(tags)


QUERIES = {
    "verdict_parse": verdict_parse,
    "verdict_factors": verdict_factors,
    "verdict_tags": verdict_tags,
    "fenced_json": fenced_json,
    "verdict_merge": verdict_merge,
    "rubric_score": rubric_score,
    "rubric_sub_score": rubric_sub_score,
    "agreement_gate": agreement_gate,
    "score_label": score_label,
    "prompt_build": prompt_build,
    "score_stage": score_stage,
    "score_answers": score_answers,
    "tag_vocab": tag_vocab,
}

PARSED = f"""split_lines AS (
  SELECT collection_id, item_id, error, list_transform(string_split(coalesce(response, ''), chr(10)), lambda x: trim(x, '{WHITE_SPACE}')) AS ls FROM verdict_texts),
read_lines AS (
  SELECT *, list_filter(list_transform(list_filter(ls, lambda x: starts_with(x, 'ai_score:')), lambda x: trim(split_part(x, ':', 2))),
                        lambda x: regexp_full_match(x, '[+-]?[0-9]+')) AS scores,
         list_filter(ls, lambda x: starts_with(x, 'ai_reason:') OR starts_with(x, 'reason:')) AS reasons,
         list_filter(flatten(list_transform(list_filter(ls, lambda x: starts_with(x, 'ai_factors:')),
                     lambda x: string_split(trim(replace(x, 'ai_factors:', '')), ' '))), lambda p: contains(p, '=')) AS factors
  FROM split_lines),
parsed AS (
  SELECT collection_id, item_id, CASE WHEN error IS NOT NULL OR len(scores) = 0 THEN 5 ELSE greatest(1, least(9, CAST(scores[-1] AS INTEGER))) END AS ai_score,
         CASE WHEN error IS NOT NULL THEN error WHEN len(reasons) = 0 THEN '' ELSE trim(regexp_replace(reasons[-1], '^[^:]*:', '')) END AS ai_reason,
         CASE WHEN error IS NOT NULL THEN [] ELSE list_filter(factors, lambda p: regexp_full_match(split_part(p, '=', 2), '[0-9.]+')) END AS good,
         error IS NULL AND len(list_filter(factors, lambda p: NOT regexp_full_match(split_part(p, '=', 2), '[0-9.]+'))) = 0 AS parse_ok
  FROM read_lines)"""
_BLOCK = """blocks AS (
  SELECT item_id, list_filter(regexp_extract_all(markdown, '(?is)```json\\s*(.*?)```', 1), lambda b: json_valid(b))[-1] AS j FROM verdict_texts),
fenced AS (
  SELECT item_id, CAST(json_extract(j, '$.score') AS INTEGER) AS score,
         array_to_string(CAST(json_extract(j, '$.tags') AS VARCHAR[]), '|') AS tags, json_extract_string(j, '$.reasoning') AS reasoning,
         CAST(json_extract(j, '$.is_relevant') AS BOOLEAN) AS is_relevant FROM blocks)"""
_TAGS = f"""tagged AS (
  SELECT item_id, array_to_string(list_filter(list_transform(string_split(tag_text, ','), lambda x: trim(x, '{WHITE_SPACE}')), lambda x: x <> ''), '|') AS tags FROM verdict_texts)"""


def _factor(name: str) -> str:
    picked = f"list_filter(good, lambda p: starts_with(p, '{name}='))[-1]"
    return f"CAST(split_part({picked}, '=', 2) AS DOUBLE)"


_WEIGHTED = " + ".join(f"{_factor(name)} * {f['weight']}::DOUBLE" for name, f in CONFIG["factors"].items())
_WEIGHTS = " + ".join(f"{f['weight']}::DOUBLE" for f in CONFIG["factors"].values())
_BONUS, _PENALTY = CONFIG["modifier"]["key_frame_bonus"], CONFIG["modifier"]["filler_penalty"]
RUBRIC = f"""rubric AS (
  SELECT p.*, is_key, is_filler, CASE WHEN len(good) > 0 THEN
    ({_WEIGHTED}) / ({_WEIGHTS}) + CASE WHEN is_key THEN {_BONUS}::DOUBLE WHEN is_filler THEN {_PENALTY}::DOUBLE ELSE 0 END END AS rubric_value
  FROM parsed p JOIN context USING (item_id)),
scored AS (
  SELECT *, CAST(greatest(1, least(9, round(1 + 8 * rubric_value))) AS INTEGER) AS raw_score FROM rubric)"""
_SUB_VALUES = {"focus": 3, "noise": 7, "exposure": 11, "balance": 13, "framing": 17}


def _sub(subs: dict) -> str:
    known = {s: w for s, w in subs.items() if s in _SUB_VALUES}
    total = " + ".join(f"(item_id * {_SUB_VALUES[s]} % 100) / 100.0 * {w}" for s, w in known.items())
    return f"({total}) / ({' + '.join(str(w) for w in known.values())})"


_SUBS = " UNION ALL ".join(
    f"SELECT item_id, '{name}' AS factor, round({_sub(f['sub_factors'])}, 6) AS value FROM items"
    for name, f in CONFIG["factors"].items()
    if f["sub_factors"]
)
_LABELS = " ".join(f"WHEN {score} THEN '{label}'" for score, label in SCORE_LABELS.items())
_RUBRIC_LINES = " || chr(10) || ".join(f"'- {name}: weight={f['weight']}'" for name, f in CONFIG["factors"].items())
_REPLY = " ".join(f"{name}=<0-1>" for name in CONFIG["factors"])
_PARSED = B.cte(B.ITEMS, B.VERDICT_TEXTS, PARSED)

ORACLE = {
    "verdict_parse": _PARSED + "SELECT item_id, ai_score, ai_reason, parse_ok FROM parsed",
    "verdict_factors": _PARSED
    + """SELECT item_id, split_part(p, '=', 1) AS factor, CAST(split_part(p, '=', 2) AS DOUBLE) AS value
         FROM (SELECT item_id, unnest(good) AS p FROM parsed)""",
    "verdict_tags": B.cte(B.ITEMS, B.VERDICT_TEXTS, _TAGS) + "SELECT item_id, tags FROM tagged",
    "fenced_json": B.cte(B.ITEMS, B.VERDICT_TEXTS, _BLOCK) + "SELECT * FROM fenced",
    "verdict_merge": B.cte(B.ITEMS, B.VERDICT_TEXTS, PARSED, _TAGS)
    + "SELECT item_id, ai_score, ai_reason, CASE WHEN item_id % 4 <> 1 THEN tags ELSE '' END AS ai_tags FROM parsed JOIN tagged USING (item_id)",
    "rubric_score": B.cte(B.ITEMS, B.VERDICT_TEXTS, PARSED, FLAGGED, SUMMARIES, CONTEXT, RUBRIC)
    + "SELECT item_id, is_key, round(rubric_value, 6) AS rubric_value, CASE WHEN rubric_value IS NOT NULL THEN raw_score END AS rubric_score FROM scored",
    "rubric_sub_score": B.cte(B.ITEMS) + _SUBS,
    "agreement_gate": B.cte(B.ITEMS, B.VERDICT_TEXTS, PARSED, _BLOCK)
    + """SELECT item_id, CASE WHEN parse_ok AND ai_score >= 5 AND item_id % 9 <> 0 AND coalesce(score >= 5, false) THEN 'approved' ELSE 'needs_review' END AS decision
         FROM parsed JOIN fenced USING (item_id)""",
    "score_label": _PARSED + f"SELECT item_id, ai_score, CASE ai_score {_LABELS} END AS label FROM parsed",
    "prompt_build": B.cte(B.ITEMS, FLAGGED, SUMMARIES, CONTEXT)
    + f"""SELECT item_id, concat_ws(chr(10), 'Factors and their weights:', {_RUBRIC_LINES},
          CASE WHEN is_key THEN 'Place: first of a change (add {_BONUS}).' WHEN is_filler THEN 'Place: like the item before (add {_PENALTY}).'
               ELSE 'Place: unknown.' END,
          'Give a whole number from 1 to 9 and each factor between 0 and 1, in this form:', 'ai_score: <1-9>', 'ai_factors: {_REPLY}') AS prompt FROM context""",
    "score_stage": B.cte(B.ITEMS)
    + "SELECT item_id, CAST(1 + length(text) % 9 AS INTEGER) AS ai_score, 'offline' AS ai_reason, (length(text) % 100) / 100.0 AS clarity FROM items",
    "tag_vocab": """SELECT row_number() OVER (ORDER BY p_type, p_brand) - 1 AS place, p_type AS category, p_brand AS tag
        FROM (SELECT DISTINCT p_type, p_brand FROM part)""",
}
# Answers are those of asking every item by itself.
ORACLE["score_answers"] = ORACLE["score_stage"]

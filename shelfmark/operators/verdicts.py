"""Model verdicts: prompts, scoring stage, parsing, rubric scores and agreement."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import FALLBACK_SCORE, SCORE_LABELS, SPACE_CLASS
from shelfmark.functions.text import strip
from shelfmark.scale import ordered_index
from shelfmark.schemas import JSON_VERDICT

# The prefixes of the lines a model answers with.
# White space inside a line; lines end at a line feed only (the (?d) flag).
_S = "[" + SPACE_CLASS.replace(r"\n", "") + "]"
_NOT_S = f"[^{SPACE_CLASS}]"
_SCORE = rf"(?dm)^{_S}*ai_score:{_S}*([+-]?[0-9]+(?:_[0-9]+)*){_S}*(?::.*)?$"
_REASON = rf"(?dm)^{_S}*(?:ai_)?reason:(.*)$"
_FACTORS = rf"(?dm)^{_S}*ai_factors:(.*)$"
_FACTOR = rf"{_NOT_S}*={_NOT_S}*"
_NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_GOOD_FACTOR = rf"(?<!{_NOT_S})((?:(?!=){_NOT_S})*)=({_NUMBER})(?!{_NOT_S})"


def _all(text: Column, pattern: str, part: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(part))


def _last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def clamp_score(digits: Column) -> Column:
    """A written integer clamped to 1..9; null stays null."""
    digits = F.replace(digits, F.lit("_"), F.lit(""))
    far = F.when(F.startswith(digits, F.lit("-")), F.lit(1)).otherwise(F.lit(9))
    near = F.greatest(F.lit(1), F.least(F.lit(9), digits.try_cast("bigint"))).cast("int")
    return F.when(digits.isNotNull(), F.when(F.length(digits) > 18, far).otherwise(near))


def parse_lines(df: DataFrame, text: str = "response", error: str = "error") -> DataFrame:
    """Typed columns of a line-form verdict; an error becomes the fallback score with its message.

    The last line with a proper integer gives the score, the last reason line the reason. Factors
    add up over their lines; a malformed one is dropped and clears ``parse_ok``, a later one wins.
    Each pattern runs once per row, in a column of its own.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    found = df.withColumns(
        {
            "_score": _last(_all(t, _SCORE, 1)),
            "_reason": _last(_all(t, _REASON, 1)),
            "_listed": F.replace(F.array_join(_all(t, _FACTORS, 1), " "), F.lit("ai_factors:"), F.lit("")),
        }
    )
    split = found.withColumns(
        {
            "_n": _all(F.col("_listed"), _GOOD_FACTOR, 1),
            "_v": _all(F.col("_listed"), _GOOD_FACTOR, 2).cast("array<double>"),
            "_parts": F.size(_all(F.col("_listed"), _FACTOR, 0)),
        }
    ).withColumn("_unique", F.array_distinct("_n"))
    latest = F.transform("_unique", lambda n: F.get(F.col("_v"), F.size("_n") - F.array_position(F.reverse("_n"), n)))
    factors = F.when(F.size("_unique") == F.size("_n"), F.map_from_arrays("_n", "_v")).otherwise(
        F.map_from_arrays(F.col("_unique"), latest)
    )
    failed = F.col(error).isNotNull()
    none = F.create_map().cast("map<string,double>")
    return split.withColumns(
        {
            "ai_score": F.when(failed, FALLBACK_SCORE).otherwise(F.coalesce(clamp_score(F.col("_score")), F.lit(FALLBACK_SCORE))),
            "ai_reason": F.when(failed, F.col(error)).otherwise(F.coalesce(strip("_reason"), F.lit(""))),
            "ai_factors": F.when(failed, none).otherwise(factors),
            "parse_ok": ~failed & (F.size("_n") == F.col("_parts")),
        }
    ).drop("_score", "_reason", "_listed", "_n", "_v", "_parts", "_unique")


def parse_tags(text: Column, most: int | None = None) -> Column:
    """Comma list → its tags that are not blank; ``most`` may limit their number."""
    tags = F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")
    return tags if most is None else F.slice(tags, 1, most)


def last_json_block(markdown: Column) -> Column:
    """Last fenced block that is valid JSON, null without one."""
    blocks = F.regexp_extract_all(markdown, F.lit(r"(?is)```json\s*(.*?)```"), 1)
    return _last(F.filter(blocks, lambda b: F.try_parse_json(b).isNotNull()))


def parse_json_verdict(markdown: Column) -> Column:
    """Struct of a fenced JSON verdict; fields of the wrong type are null."""
    return F.from_json(last_json_block(markdown), JSON_VERDICT, {"mode": "PERMISSIVE"})


def score_label(score: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in SCORE_LABELS.items() for x in pair])
    return F.try_element_at(labels, score)


def rubric_value(factors: Column, config: dict) -> Column:
    """Weighted mean of the factors present, null when none is.

    A rubric has a handful of hand-written factors, so it is folded into the expression: no join
    and no shuffle.
    """
    total, weights = F.lit(0.0), F.lit(0.0)
    for name, factor in config["factors"].items():
        weight = float(factor["weight"])
        value = F.try_element_at(factors, F.lit(name))
        total = total + F.coalesce(value * weight, F.lit(0.0))
        weights = weights + F.when(value.isNotNull(), F.lit(weight)).otherwise(F.lit(0.0))
    return F.when(weights > 0, total / weights)


def rubric_score(factors: Column, is_key: Column, is_filler: Column, config: dict) -> tuple[Column, Column]:
    """(value with the key or filler modifier, score from 1 to 9)."""
    modifier = config["modifier"]
    change = (
        F.when(is_key, F.lit(float(modifier["key_frame_bonus"])))
        .when(is_filler, F.lit(float(modifier["filler_penalty"])))
        .otherwise(F.lit(0.0))
    )
    value = rubric_value(factors, config) + change
    score = F.greatest(F.lit(1), F.least(F.lit(9), F.round(F.lit(1.0) + F.lit(8.0) * value).cast("int")))
    return value, F.when(value.isNotNull(), score)


def sub_scores(df: DataFrame, key: str, sub_values: Column, config: dict) -> DataFrame:
    """One row per item and factor that has weighted sub-factors: the weighted mean of those present."""
    scored = []
    for name, factor in config["factors"].items():
        subs = factor.get("sub_factors") or {}
        if subs:
            total, weights = F.lit(0.0), F.lit(0.0)
            for sub, weight in subs.items():
                value = F.try_element_at(sub_values, F.lit(sub))
                total = total + F.coalesce(value * float(weight), F.lit(0.0))
                weights = weights + F.when(value.isNotNull(), F.lit(float(weight))).otherwise(F.lit(0.0))
            scored.append(F.struct(F.lit(name).alias("factor"), F.when(weights > 0, total / weights).alias("value")))
    return df.select(key, F.explode(F.array(*scored)).alias("s")).select(key, "s.factor", "s.value")


def vocabulary(tags: DataFrame, size: int | None = None) -> DataFrame:
    """Tags over all categories in order with their place; ``size`` may keep the first ones only."""
    placed = ordered_index(tags, [], [F.col("category_pos"), F.col("tag_pos")], "place").select("place", "category", "tag")
    return placed if size is None else placed.filter(F.col("place") < size)


def score_prompt(is_key: Column, is_filler: Column, config: dict) -> Column:
    """Prompt for one item: the rubric, the item's place in its sequence and the reply format."""
    factors = config["factors"]
    rubric = "\n".join(f"- {name}: weight={factor['weight']}" for name, factor in factors.items())
    reply = " ".join(f"{name}=<0-1>" for name in factors)
    bonus, penalty = config["modifier"]["key_frame_bonus"], config["modifier"]["filler_penalty"]
    context = (
        F.when(is_key, f"Place: first of a change (add {bonus}).")
        .when(is_filler, f"Place: like the item before (add {penalty}).")
        .otherwise("Place: unknown.")
    )
    return F.concat_ws(
        "\n",
        F.lit("Factors and their weights:"),
        F.lit(rubric),
        context,
        F.lit("Give a whole number from 1 to 9 and each factor between 0 and 1, in this form:"),
        F.lit("ai_score: <1-9>"),
        F.lit(f"ai_factors: {reply}"),
    )


def tag_prompt(config: dict, most: int | None = None) -> str:
    """Prompt that asks for tags of the vocabulary."""
    tags = [t for values in config["tag_categories"].values() for t in values]
    number = "All fitting tags" if most is None else f"The {most} best tags"
    return f"{number} of these, as one line with commas:\n{', '.join(tags)}"


def offline_scorer() -> Callable[[pd.Series], pd.Series]:
    """Deterministic stand-in for a model: the score follows the prompt's length."""

    def score(prompts: pd.Series) -> pd.Series:
        return prompts.map(
            lambda p: f"ai_score: {1 + len(p) % 9}\nai_factors: clarity={len(p) % 100 / 100.0}\nai_reason: offline"
        )

    return score


def _answers(scorer: Callable[[pd.Series], pd.Series], prompts: pd.Series) -> tuple[list, list]:
    """Answers and errors of a batch; one that fails is halved until its bad rows stand alone."""
    try:
        return list(scorer(prompts)), [None] * len(prompts)
    except Exception as e:  # the message is the row's result
        if len(prompts) == 1:
            return [None], [str(e)]
        half = len(prompts) // 2
        parts = [_answers(scorer, prompts.iloc[:half]), _answers(scorer, prompts.iloc[half:])]
        return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def score_stage(
    df: DataFrame, key: str, prompt: str, make_scorer: Callable[[], Callable[[pd.Series], pd.Series]] = offline_scorer
) -> DataFrame:
    """Prompts scored by batches; ``make_scorer`` runs once per task. A failure becomes its row's data."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            answers, errors = _answers(scorer, batch[prompt]) if len(batch) else ([], [])
            yield pd.DataFrame({key: batch[key], "response": answers, "error": errors})

    return df.select(key, prompt).mapInPandas(run, f"`{key}` {key_type}, response string, error string")


def merge_verdict(scores: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """Score and tags of each item side by side; items without tags get an empty list."""
    return scores.join(tags, key, "left").withColumn(
        "ai_tags", F.coalesce("ai_tags", F.array().cast("array<string>"))
    )


def agreement(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Approve items both verdicts accept (column ``ok``); all others need a review."""
    both = first.select(key, F.col("ok").alias("first_ok")).join(
        second.select(key, F.col("ok").alias("second_ok")), key, "full"
    )
    ok = F.coalesce("first_ok", F.lit(False)) & F.coalesce("second_ok", F.lit(False))
    return both.select(key, F.when(ok, "approved").otherwise("needs_review").alias("decision"))

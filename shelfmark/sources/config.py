"""Rubric and vocabulary configuration as small DataFrames.

Their size is that of a hand-written file, so they are the one kind of table broadcast by hint.
"""

from __future__ import annotations

import copy
import os

from pyspark.sql import DataFrame, SparkSession

from shelfmark.constants import DEFAULT_RUBRIC, SCORE_LABELS


def load_config(path: str | None = None) -> dict:
    """Configuration file, or the built-in one when the file is missing."""
    if path and os.path.exists(path):
        import yaml

        with open(path, encoding="utf-8") as f:
            loaded = yaml.safe_load(f) or {}
        scoring = loaded.get("scoring", {})
        return {
            "factors": scoring.get("factors", {}),
            "modifier": scoring.get("story_modifier", {}),
            "tag_categories": loaded.get("tag_categories", {}),
        }
    return copy.deepcopy(DEFAULT_RUBRIC)


def rubric_frame(spark: SparkSession, config: dict) -> DataFrame:
    rows = [
        (pos, name, float(factor.get("weight", 0)))
        for pos, (name, factor) in enumerate(config.get("factors", {}).items())
    ]
    return spark.createDataFrame(rows, "pos int, factor string, weight double")


def sub_rubric_frame(spark: SparkSession, config: dict) -> DataFrame:
    rows = [
        (name, sub, float(weight))
        for name, factor in config.get("factors", {}).items()
        for sub, weight in (factor.get("sub_factors") or {}).items()
    ]
    return spark.createDataFrame(rows, "factor string, sub_factor string, sub_weight double")


def vocabulary_frame(spark: SparkSession, config: dict) -> DataFrame:
    rows = [
        (category, cat_pos, tag_pos, tag)
        for cat_pos, (category, tags) in enumerate(config.get("tag_categories", {}).items())
        for tag_pos, tag in enumerate(tags)
    ]
    return spark.createDataFrame(rows, "category string, category_pos int, tag_pos int, tag string")


def score_label_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(SCORE_LABELS.items()), "score int, score_label string")

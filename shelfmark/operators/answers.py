"""Scoring that can be resumed: answers stored by the hash of their prompt.

Each distinct prompt is scored once, whatever the number of items that ask it, and an answer that is stored is never
asked for again. Prompts are scored in rounds, each its own job and folder: a run that ends early keeps the rounds
it finished, and the next run asks only what is left. Failed answers are stored with their error and asked again by the
next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.verdicts import offline_scorer, score_stage
from shelfmark.scale import HOT_ROWS, attach
from shelfmark.storage import stage

#: Distinct prompts of a round.
ROUND_PROMPTS = 1_000_000
ANSWER = "prompt_key string, response string, error string, round string"


def prompt_key(prompt: Column, model: str = "") -> Column:
    """Hash of a prompt and the model that is asked; null for a null prompt."""
    return F.sha2(F.concat(F.lit(f"{model}\n"), prompt), 256)


def read_answers(spark: SparkSession, root: str) -> DataFrame:
    """(prompt_key, response, error): one answer of each prompt, a good one where there is any."""
    rounds = spark.read.schema(ANSWER).option("pathGlobFilter", "*.parquet").parquet(root)
    # Of several rounds that answered a prompt, which only two runs at a time can do, the least name counts.
    best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "round", "response", "error"))
    return rounds.groupBy("prompt_key").agg(best.alias("a")).select("prompt_key", "a.response", "a.error")


def ask(
    prompts: DataFrame, root: str, prompt: str = "prompt", model: str = "",
    make_scorer: Callable[[], Callable[[pd.Series], pd.Series]] = offline_scorer, round_prompts: int = ROUND_PROMPTS,
) -> int:
    """Score the distinct prompts that have no good answer below ``root``; returns how many were asked."""
    spark = prompts.sparkSession
    _create(spark, root)
    asked = prompts.select(prompt_key(F.col(prompt), model).alias("prompt_key"), F.col(prompt).alias("prompt")).filter("prompt_key is not null")
    good = read_answers(spark, root).filter("error is null").select("prompt_key")
    # Written, as later rounds must not see the answers of earlier ones.
    unseen = stage(asked.join(good, "prompt_key", "left_anti").groupBy("prompt_key").agg(F.min("prompt").alias("prompt")), "unseen-prompts")
    many = unseen.count()
    rounds = -(-many // round_prompts)
    for i in range(rounds):
        own = unseen.filter(F.pmod(F.xxhash64("prompt_key"), F.lit(rounds)) == i)
        name = f"{uuid.uuid4().hex}"
        answers = score_stage(own, "prompt_key", "prompt", make_scorer)
        answers.withColumn("round", F.lit(name)).write.mode("append").parquet(root)
    return many


def _create(spark: SparkSession, root: str) -> None:
    """An empty table, so that one without answers can be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        spark.createDataFrame([], ANSWER).write.mode("append").parquet(root)


def answered(
    items: DataFrame, root: str, key: str, prompt: str = "prompt", model: str = "", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(key, response, error) of every item; both are null where its prompt has no answer yet."""
    keyed = items.select(key, prompt_key(F.col(prompt), model).alias("prompt_key"))
    answers = read_answers(items.sparkSession, root)
    return attach(keyed, answers, ["prompt_key"], [key], "left", hot_rows).drop("prompt_key")

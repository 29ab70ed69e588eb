"""From raw documents to a training mix, in five stages that each run one corpus operator.

Every stage takes (spark, docs, sf_dir), gets all its predecessor kept and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each stage's result to the shared folder and reads
it again, so that no stage is computed twice and a lost executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontaminate, exact_dedup, jaccard, language, mixing
from shelfmark.llm.common import read, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without any letter go."""
    return language.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, by five words and 80 percent: the one with the smallest id."""
    return jaccard.keep_one(docs, width=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; a few shared words alone do not make one so."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words it takes of each and its first slot."""
    return mixing.keep_taken(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("source_mix", source_mix),
]

#: Learned languages and linked components are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

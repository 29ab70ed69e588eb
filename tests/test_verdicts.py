"""Verdict parsing and scoring on hand-made texts."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators import answers as A
from shelfmark.operators import verdicts as V
from shelfmark.sources.config import load_config


def parse(spark, texts):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "i int, response string, error string")
    return V.parse_lines(df).orderBy("i").collect()


CASES = [
    ("ai_score: 7", 7, "", {}, True),
    ("  ai_score:  12 ", 9, "", {}, True),
    ("ai_score: -3", 1, "", {}, True),
    ("ai_score: 7.5", 5, "", {}, True),
    ("ai_score:", 5, "", {}, True),
    ("ai_score: 4\nai_score: x", 4, "", {}, True),
    ("ai_score: 4: 9", 4, "", {}, True),
    ("ai_score: 1_0", 9, "", {}, True),
    ("ai_score: " + "9" * 40, 9, "", {}, True),
    ("ai_score: -" + "9" * 40, 1, "", {}, True),
    ("ai_factors: a=0.5 b=x c", 5, "", {"a": 0.5}, False),
    ("ai_factors: a=0.5\nai_factors: a=0.7 d=1e1 e=f=2 =3", 5, "", {"a": 0.7, "d": 10.0, "": 3.0}, False),
    ("reason: one\nai_reason: two: three ", 5, "two: three", {}, True),
    ("　ai_score:　8　\r\n\tai_reason:　x", 8, "x", {}, True),
    ("Xai_score: 3", 5, "", {}, True),
    ("", 5, "", {}, True),
]


def test_lines(spark):
    for (text, *wanted), row in zip(CASES, parse(spark, [c[0] for c in CASES])):
        assert [row.ai_score, row.ai_reason, row.ai_factors, row.parse_ok] == wanted, text


NAME = st.sampled_from(["a", "b", "clarity", "é"])
FACTORS = st.lists(st.tuples(NAME, st.integers(0, 999)), max_size=4)
REPLY = st.tuples(st.none() | st.integers(-20, 40), st.none() | st.text(alphabet="ab:=. ", max_size=8), FACTORS, st.integers(0, 2))


def written(score, reason, factors, noise):
    """A reply with these contents, and lines that say nothing."""
    lines = ["other: 3"] * noise
    lines += [f"ai_factors: {name}={value / 100}" for name, value in factors]
    lines += [] if score is None else [f" ai_score: {score}"]
    lines += [] if reason is None else [f"reason:{reason}"]
    return "\n".join(lines)


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(REPLY, min_size=20, max_size=20))
def test_written_contents_are_read(spark, replies):
    for (score, reason, factors, noise), row in zip(replies, parse(spark, [written(*r) for r in replies])):
        assert row.ai_score == (5 if score is None else min(max(score, 1), 9))
        assert row.ai_reason == (reason or "").strip()
        assert row.ai_factors == {name: value / 100 for name, value in factors} and row.parse_ok


def test_error_is_data(spark):
    df = spark.createDataFrame([("ai_score: 9", "timeout")], "response string, error string")
    row = V.parse_lines(df).first()
    assert (row.ai_score, row.ai_reason, row.ai_factors, row.parse_ok) == (5, "timeout", {}, False)


def test_tags(spark):
    texts = ["a, ,b,b,c,d,e,f", "a，b, c", "", " , "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(V.parse_tags(F.col("t"))).collect()] == [["a", "b", "b", "c", "d", "e", "f"], ["a，b", "c"], [], []]
    assert [r[0] for r in df.select(V.parse_tags(F.col("t"), 2)).collect()] == [["a", "b"], ["a，b", "c"], [], []]


@pytest.mark.parametrize(
    "text,expected",
    [
        ('```json {"score": 1}``` ```json {"score": }```', 1),
        ('```JSON\n{"score": 1}\n```\n```json\n{"score": 2}\n```', 2),
        ("none", None),
        ('```{"score": 1}```', None),
        ('```json {"score": "bad"}```', None),
    ],
)
def test_fenced_json(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    value = df.select(V.parse_json_verdict(F.col("t")).alias("v")).select("v.score").first()[0]
    assert value == expected


def test_rubric(spark):
    config = load_config()
    df = spark.createDataFrame(
        [({"clarity": 1.0, "unknown": 9.0}, True, False), ({"clarity": 0.5, "lighting": 0.5}, False, True), ({}, True, False)],
        "f map<string,double>, k boolean, l boolean",
    )
    value, score = V.rubric_score(F.col("f"), F.col("k"), F.col("l"), config)
    assert [tuple(r) for r in df.select(F.round(value, 6), score).collect()] == [(1.2, 9), (0.4, 4), (None, None)]


def test_score_stage_turns_failures_into_data(spark):
    def make():
        def score(prompts):
            if (prompts == "bad").any():
                raise RuntimeError("no answer")
            return prompts.map(lambda p: json.dumps({"n": len(p)}))

        return score

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "fine!")], "id int, prompt string")
    got = {r.id: (r.response, r.error) for r in V.score_stage(df, "id", "prompt", make).collect()}
    assert got == {1: ('{"n": 4}', None), 2: (None, "no answer"), 3: ('{"n": 5}', None)}


def counting(path, bad=()):
    """A scorer that writes down every prompt it is asked."""

    def make():
        def score(prompts):
            if prompts.isin(bad).any():
                raise RuntimeError("no answer")
            with open(path, "a") as f:
                f.write("".join(p + "\n" for p in prompts))
            return prompts.map(lambda p: f"<{p}>")

        return score

    return make


def test_each_prompt_is_asked_once(spark, tmp_path):
    root, log = str(tmp_path / "answers"), tmp_path / "log"
    asked = lambda: sorted(log.read_text().split())
    items = spark.createDataFrame([(i, f"p{i % 7}") for i in range(700)] + [(700, None)], "id int, prompt string").repartition(5)
    assert A.answered(items, _made(spark, root), "id").filter("response is not null").count() == 0
    assert A.ask(items.filter("id < 3"), root, make_scorer=counting(log)) == 3
    assert asked() == ["p0", "p1", "p2"]
    assert A.ask(items, root, make_scorer=counting(log, ["p5"]), round_prompts=2) == 4
    assert asked() == ["p0", "p1", "p2", "p3", "p4", "p6"]
    got = {r.id: (r.response, r.error) for r in A.answered(items, root, "id", hot_rows=10).collect()}
    assert got == {i: (None, "no answer") if i % 7 == 5 else (f"<p{i % 7}>", None) for i in range(700)} | {700: (None, None)}
    assert A.ask(items, root, make_scorer=counting(log)) == 1
    assert asked() == [f"p{i}" for i in range(7)]
    assert A.ask(items, root, make_scorer=counting(log)) == 0
    assert A.answered(items, root, "id").filter("error is not null").count() == 0
    assert A.ask(items, root, model="another", make_scorer=counting(log)) == 7


def _made(spark, root):
    A._create(spark, root)
    return root


def test_a_run_that_ends_early_keeps_its_rounds(spark, tmp_path, monkeypatch):
    root, log = str(tmp_path / "answers"), tmp_path / "log"
    items = spark.createDataFrame([(i, f"p{i}") for i in range(30)], "id int, prompt string")
    real, calls = A.score_stage, []

    def fails(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("the run ends")
        return real(*args)

    monkeypatch.setattr(A, "score_stage", fails)
    with pytest.raises(RuntimeError, match="the run ends"):
        A.ask(items, root, make_scorer=counting(log), round_prompts=10)
    first = log.read_text().split()
    assert 0 < len(first) < 30
    A.ask(items, root, make_scorer=counting(log), round_prompts=10)
    assert sorted(log.read_text().split()) == sorted(f"p{i}" for i in range(30))


def test_prompts(spark):
    config = load_config()
    row = spark.range(1).select(
        V.score_prompt(F.lit(True), F.lit(False), config), V.score_prompt(F.lit(False), F.lit(True), config)
    ).first()
    assert "(add 0.2)" in row[0] and "(add -0.1)" in row[1] and "- clarity: weight=0.3" in row[0]
    assert V.tag_prompt(config).count(",") >= 11


def test_agreement(spark):
    a = spark.createDataFrame([(1, True), (2, True), (3, False)], "k int, ok boolean")
    b = spark.createDataFrame([(1, True), (2, False), (4, True)], "k int, ok boolean")
    got = dict(map(tuple, V.agreement(a, b, "k").collect()))
    assert got == {1: "approved", 2: "needs_review", 3: "needs_review", 4: "needs_review"}

"""Mixing and decontamination, against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import corpora
import pytest

from shelfmark.llm import decontaminate, mixing


def targets_expected(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        each = (total - sum(full.values())) / max(sum(weight[s] for s in free), 1)
        over = [s for s in free if each * weight[s] > 2 * sizes[s]]
        if not over:
            return full | {s: each * weight[s] for s in free}
        full |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("block_words", [1, 7, 1024])
def test_mix(spark, block_words):
    frame = corpora.frame(spark)
    rows = mixing.mix_documents(frame, block_words=block_words).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, words(t)) for i, t in corpora.pairs())
    sizes = defaultdict(int)
    for r in corpora.rows():
        sizes[r[3]] += words(r[1])
    wanted = targets_expected(sizes)
    by_target = defaultdict(int)
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        by_target[(r["source_size"], round(r["target"], 6))] += r["taken"]
    goals = Counter((sizes[s], round(t, 6)) for s, t in wanted.items())  # two sources may be alike
    assert by_target.keys() == goals.keys()
    assert all(abs(taken - goals[key] * key[1]) <= 0.5 * goals[key] + 1e-6 for key, taken in by_target.items())
    again = mixing.mix_documents(frame.orderBy("n_chars", "doc_id"), block_words=block_words)
    assert Counter(map(tuple, again.drop("d", "h", "skey").collect())) == Counter((*tuple(r)[3:],) for r in rows)


def test_schedule_spreads_every_source(spark):
    plan = spark.createDataFrame([("sa", 600), ("sb", 300), ("sc", 100), ("sd", 0), ("se", 1)], "skey string, blocks long")
    slots = mixing.schedule(plan, 1).collect()
    ranks = defaultdict(list)
    for r in sorted(slots, key=lambda r: r["slot"]):
        ranks[r["skey"]].append(r["r"])
    assert {k: v == list(range(len(v))) for k, v in ranks.items()} == dict.fromkeys(["sa", "sb", "sc", "se"], True)
    assert {k: len(v) for k, v in ranks.items()} == {"sa": 600, "sb": 300, "sc": 100, "se": 1}
    first = Counter(r["skey"] for r in slots if r["slot"] < 100)
    assert abs(first["sa"] - 60) <= 3 and abs(first["sb"] - 30) <= 3


def test_nothing_to_mix(spark):
    assert mixing.mix_documents(corpora.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix_documents(blank).collect()] == [0, 0]
    kept = mixing.keep_taken(corpora.frame(spark))
    assert set(kept.columns) > {"doc_id", "text", "source", "taken", "size"} and kept.filter("taken <= 0").count() == 0


def test_rows_are_kept_by_document_and_source(spark):
    """One text in two sources, and rows that repeat all three, beside the same rows mixed by brute force."""
    schema = "doc_id long, text string, source string, taken string, note string"
    data = [(1, "a b c d", "s0", "x", "1"), (1, "a b c d", "s1", "x", "2"), (2, "e f g", "s0", "x", "3"), (3, "h i j k l m", "s1", "x", "4")]
    data += [(4, "n o p", "s1", "x", str(5 + i)) for i in range(5)] + [(None, "q r", None, "x", "z"), (5, "", "s0", "x", "y"), (6, None, "s1", "x", "w")]
    frame = spark.createDataFrame(data, schema)
    kept = [r.asDict() for r in mixing.keep_taken(frame, block_words=2).collect()]
    assert set(kept[0]) == {"doc_id", "text", "source", "note", "size", "source_size", "target", "taken", "first_slot"}
    by_row = Counter(r["note"] for r in kept)
    assert set(by_row.values()) == {1} and "y" not in by_row and "w" not in by_row
    rows = {d[4]: d for d in data}
    sizes = Counter()
    for d in data:
        sizes[d[2]] += len((d[1] or "").split())
    for r in kept:
        wanted = rows[r["note"]]
        assert (r["doc_id"], r["text"], r["source"]) == wanted[:3]
        assert r["size"] == len(wanted[1].split()) and r["source_size"] == sizes[wanted[2]] and 0 < r["taken"] <= 2 * r["size"]
    goals = targets_expected(sizes)
    for source in sizes:
        assert abs(sum(r["taken"] for r in kept if r["source"] == source) - goals[source]) <= 0.5
    mixed = mixing.mix_documents(frame, block_words=2).collect()
    for key in {(d[0], d[2]) for d in data}:
        of_mix = sum(r["taken"] for r in mixed if (r["doc_id"], None if r["skey"] == "t" else r["skey"][1:]) == key)
        own = [r["taken"] for r in kept if (r["doc_id"], r["source"]) == key]
        assert sum(own) == of_mix and (not own or max(own) - min(own) <= 1)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination_expected(docs, items):
    out = []
    for i, text in docs:
        w, hit, found = lower(text), set(), set()
        for item, other in items:
            v = lower(other)
            size = min(13, len(v))
            for a in range(len(v) - size + 1) if v else ():
                for b in range(len(w) - size + 1):
                    if w[b : b + size] == v[a : a + size]:
                        hit.update(range(b, b + size))
                        found.add("null" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def case(spark):
    long = [f"a{i}" for i in range(40)]
    items = [(1, " ".join(long[:20])), (2, "Short one"), (10, " ".join(long[5:30])), (3, None), (4, "!!"), (None, "é x y"), (2, "Short one")]
    docs = [
        (1, "x " * 30 + " ".join(long)), (2, "SHORT   one, two"), (3, " ".join(long[:12])), (4, "b " * 400 + " ".join(long[:13])),
        (5, None), (6, ""), (7, " ".join(long[2:15] + long[:20])), (8, "short"), (None, "É x y é X Y"), (1, "x " * 30 + " ".join(long)),
        (9, "short one " * 50),
    ]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("broadcast_keys", [0, 10**6])
def test_contamination(spark, broadcast_keys):
    docs, items, d, b = case(spark)
    got = decontaminate.decontaminate(d, b, broadcast_keys=broadcast_keys)
    assert Counter(map(tuple, got.collect())) == contamination_expected(docs, items)


def test_contamination_of_awkward_tables(spark):
    _, _, d, b = case(spark)
    frame = corpora.frame(spark)
    assert Counter(map(tuple, decontaminate.decontaminate(frame, b).collect())) == contamination_expected(corpora.pairs(), case(spark)[1])
    assert decontaminate.decontaminate(corpora.empty(spark), b).count() == 0
    assert decontaminate.decontaminate(d, b.limit(0)).filter("n_hit > 0").count() == 0
    clean = decontaminate.keep_clean(d, b)
    assert clean.columns == d.columns and {4, 5, 6, 3} <= {r["doc_id"] for r in clean.collect()}

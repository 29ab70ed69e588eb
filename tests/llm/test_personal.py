"""Personal data: base spans against the patterns as they are stated, and what the weak labels add."""

from __future__ import annotations

import hashlib
import random
import re

import corpora

from shelfmark.llm import personal

# The patterns as stated.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = [int(c) for c in hit if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def base(text):
    out = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(STATED.items()) for m in re.finditer(p, text) if passes(kind, m.group())]
    return [(list(STATED)[k], s, e) for s, k, e in sorted(out)]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def found(spark, texts):
    data = [(i, t, None, None, None, None, None, None, None) for i, t in enumerate(texts)]
    rows = personal.find_personal(corpora.frame(spark, data)).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: r for r in rows}


def test_base_spans_are_those_of_the_stated_patterns(spark):
    rng = random.Random(4)
    odd = ["a@b.c%d@e.f", "a@@b.co", "x.y@z", "a@b..c d@e-f.g.h.", "1.2.3.4.5.6.7.8", "300.1.1.1 0001.2.3.255", "1.2.3.999999999999",
           "4111 1111 1111 1111", "4111--1111-1111-1111-1111", "+1 (696) 555-2293.", "+1--", "+12345678901234567890", "++49 30 123456-78 ",
           "é🙂 4242424242424242 🙂a@b.de", "+1 555 123 4567+1 555 123 4567", "12345678901234567890123", "x4111111111111111y", "", None,
           "1" * 50_000, "a" * 50_000, "a@" * 20_000, "a." * 20_000 + "@b" + ".c" * 20_000, "1." * 30_000, "+" * 1000, "1 " * 30_000, "1.2.3.4 " * 3000]
    alphabet = ["a", "@", ".", "-", " ", "1", "23", "+", "(", ")", "é", "🙂", "%", "\n", "4111111111111111", "10.0.0.1", "a@b.co", "+49 30 1234567"]
    texts = odd + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(600)]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        spans = base(text or "")
        row = got[i]
        assert row["base_sha256"] == hashlib.sha256(written(spans).encode()).hexdigest(), (text or "")[:80]
        assert [row[f"n_{k}"] for k in STATED] == [sum(s[0] == k for s in spans) for k in STATED]
        assert {written([s]) for s in spans} <= set(row["spans"].split(",")), (text or "")[:80]


def corpus(rng):
    """Texts in which context words mostly come with personal data, and others with numbers of other kinds."""
    texts = []
    prose = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet sed non".split()) for _ in range(n))
    phone = lambda: f"+49 30 {rng.randrange(10**6, 10**7)}"
    plain = lambda: f"0{rng.randrange(100, 999)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
    for _ in range(150):
        texts += [f"{prose(5)} call {phone()} now {prose(3)}", f"{prose(4)} call {plain()} now {prose(3)}",
                  f"{prose(4)} isbn {plain()} of {prose(3)}", f"{prose(4)} mail {rng.choice('abc')}.x@mail{rng.randrange(9)}.com {prose(2)}",
                  f"{prose(3)} mail bob{rng.randrange(99)} (at) site (dot) com {prose(2)}", f"{prose(20)}", f"version 1.{rng.randrange(9)}.2 {prose(9)}"]
    return texts


def test_what_context_and_gazetteers_add(spark):
    texts = corpus(random.Random(7))
    got = found(spark, texts)
    added = {i: [s for s in got[i]["spans"].split(",") if s and s not in written(base(t)).split(",")] for i, t in enumerate(texts)}
    kinds = {k: [len(added[i]) for i, t in enumerate(texts) if k(t)] for k in (
        lambda t: "call 0" in t, lambda t: "isbn" in t, lambda t: "(at)" in t, lambda t: not re.search("[0-9]", t))}
    called, books, spelled, clean = kinds.values()
    assert min(called) == 1 and min(spelled) == 1 and max(books) == 0 and max(clean) == 0
    at = next(i for i, t in enumerate(texts) if "call 0" in t)
    kind, start, end = added[at][0].split(":")
    assert kind == "phone" and re.fullmatch("0[0-9-]+", texts[at][int(start) : int(end)])
    assert not any(added[i] for i, t in enumerate(texts) if base(t))


def test_reliabilities_follow_the_agreement_of_labelers(spark):
    _, spans = personal.candidates(corpora.frame(spark, [(i, t, *[None] * 7) for i, t in enumerate(corpus(random.Random(1)))]), "doc_id", "text")
    voted = spans.select("*", *[v.alias(n) for n, v in personal.labelers().items()])
    known = personal.estimate(voted)
    other, own = known.votes["cue"]
    assert own[1] > other[1]
    other, own = known.votes["other"]
    assert other[0] > own[0]


def test_edge_cases(spark):
    rows = personal.find_personal(corpora.frame(spark)).collect()
    assert len(rows) == len(corpora.rows()) and all(r["spans"] == "" for r in rows)
    assert personal.find_personal(corpora.empty(spark)).count() == 0
    long = "word " * 300_000 + "a@b.co" + " é" * 1000
    row = found(spark, [long])[0]
    assert row["spans"] == "email:1500000:1500006"

"""Exact copies, near duplicates and lines, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import corpora
import pytest

from shelfmark.llm import exact_dedup, jaccard, line_dedup
from shelfmark.llm.components import components


def exact_expected(pairs):
    docs = [(i, t or "") for i, t in pairs]
    groups = defaultdict(list)
    for i, t in docs:
        groups[t].append(i)
    low = lambda i: -(2**63) if i is None else i
    out = Counter()
    for i, t in docs:
        keep = max(groups[t], key=low)
        out[(i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("block_bytes", [3, 4096])
def test_exact_copies(spark, block_bytes):
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(corpora.frame(spark), block_bytes=block_bytes).collect())
    assert got == exact_expected(corpora.pairs())


def test_repeated_rows_count_one_by_one(spark):
    data = [(1, "a"), (1, "a"), (2, "a"), (3, "lone one"), (3, "lone one"), (4, "x" * 20), (4, "x" * 20), (4, "x" * 20), (5, "y"), (None, "z"), (None, "z")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(frame, block_bytes=4).collect())
    assert got == exact_expected(data)
    kept = Counter(tuple(r) for r in exact_dedup.keep_one(frame).collect())
    assert kept == Counter([(2, "a"), (3, "lone one"), (4, "x" * 20), (5, "y"), (None, "z")])


def test_exact_copies_differ_in_one_block_or_in_length(spark):
    texts = ["abcabcabc", "abcabcabc", "abcabcabd", "abcabc", "abcabc", "abcabcab", "", "abc", "abcabcabcabc"]
    data = list(enumerate(texts))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert Counter(tuple(r) for r in exact_dedup.exact_dedup(frame, block_bytes=3).collect()) == exact_expected(data)


def test_exact_copies_of_nothing(spark):
    assert exact_dedup.exact_dedup(corpora.empty(spark)).count() == 0
    kept = exact_dedup.keep_one(corpora.frame(spark))
    assert kept.columns == corpora.frame(spark).columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert Counter(texts) == Counter({t or "" for _, t in corpora.pairs()})


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))) if w else frozenset()


def jaccard_expected(pairs):
    docs = sorted({(-(2**63) if i is None else i, t or "") for i, t in pairs})
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    least = {}
    for k, (i, _) in enumerate(docs):
        least.setdefault(root(k), i)
    return {(i, t): (len(sets[k]), least[root(k)]) for k, (i, t) in enumerate(docs)}


def check_jaccard(spark, pairs, frame):
    wanted = jaccard_expected(pairs)
    got = Counter(tuple(r) for r in jaccard.jaccard_join(frame).collect())
    plain = lambda i: None if i == -(2**63) else i
    assert got == Counter(
        (i, *(n if k == 0 else plain(n) for k, n in enumerate(wanted[(-(2**63) if i is None else i, t or "")]))) for i, t in pairs
    )


def test_near_duplicates(spark):
    check_jaccard(spark, corpora.pairs(), corpora.frame(spark))
    assert jaccard.jaccard_join(corpora.empty(spark)).count() == 0


def test_near_duplicates_in_a_crowd(spark):
    """Copies of one text with ever more changes: pivots, groups and strays."""
    rng = random.Random(5)
    data = []
    for base in range(3):
        text = corpora.words(rng, 150, 10**6).split()
        for i in range(40):
            own = list(text)
            for _ in range(i % 7):
                own[rng.randrange(len(own))] = f"z{base}{rng.randrange(10**6)}"
            data.append((len(data), " ".join(own)))
    rng.shuffle(data)
    check_jaccard(spark, data, spark.createDataFrame(data, "doc_id long, text string"))


def test_one_document_of_a_component_stays(spark):
    data = [(i, t) for i, t in corpora.pairs() if i is not None and i < 100][:-2]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    wanted = jaccard_expected(data)
    kept = {r["doc_id"] for r in jaccard.keep_one(frame).collect()}
    assert kept == {i for (i, _), (n, component) in wanted.items() if i == component or n == 0}


def test_unlinked_texts_of_one_id_all_stay(spark):
    """Null ids, and one id on several texts: only links make a component, and empty texts are none."""
    rng = random.Random(8)
    text = lambda: corpora.words(rng, 60, 10**6)
    group, other = text(), text()
    data = [(None, group), (None, text()), (None, text()), (None, "no id"), (None, ""), (None, None)]
    data += [(7, text()), (7, text()), (7, ""), (7, other), (9, other + " more"), (8, group), (11, group + " more"), (12, group)]
    data += [(7, " "), (None, data[1][1])]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    kept = Counter((r[0], r[1]) for r in jaccard.keep_one(frame).collect())
    sets = [set(zip(*[(t or "").lower().split()[k:] for k in range(4)])) or {tuple((t or "").split())} - {()} for _, t in data]
    linked = lambda a, b: bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)
    component = list(range(len(data)))
    for _ in data:
        component = [min(component[j] for j in range(len(data)) if j == i or linked(sets[i], sets[j])) for i in range(len(data))]
    wanted = Counter()
    for i, row in enumerate(data):
        least = min(data[j][0] if data[j][0] is not None else -(2**63) for j in range(len(data)) if component[j] == component[i])
        if not sets[i] or (row[0] if row[0] is not None else -(2**63)) == least:
            wanted[row] += 1
    assert kept == wanted


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (102, 100)}


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lines_expected(pairs):
    """Every row's number of lines, of dropped ones, and its text; a line goes for any earlier one."""
    docs = sorted({(-(2**63) if i is None else i, t or "") for i, t in pairs}, key=lambda x: x[0])
    seen, out = [], {}
    for i, t in docs:
        lines, kept = t.split("\n"), []
        for line in lines:
            if not line or not any(within_one_edit(line, s) for s in seen):
                kept.append(line)
            if line:
                seen.append(line)
        out[(i, t)] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def check_lines(spark, data, **options):
    frame = spark.createDataFrame(data, "doc_id long, text string")
    wanted = lines_expected(data)
    got = Counter(map(tuple, line_dedup.dedup_lines(frame, **options).collect()))
    assert got == Counter((i, *wanted[(-(2**63) if i is None else i, t or "")]) for i, t in data)


def changed(rng, line):
    at = rng.randrange(len(line))
    return rng.choice([line[:at] + line[at + 1 :], line[:at] + "q" + line[at + 1 :], line[:at] + "ü" + line[at:], line + "z"])


@pytest.mark.parametrize("part", [1, 3, 32])
def test_lines(spark, part):
    """Lines of 1 to 200 characters, several to a document, changed once or twice, in runs and at their ends."""
    rng = random.Random(part)
    lines = ["".join(rng.choice("abcdé🙂") for _ in range(rng.choice([1, 2, 3, 7, 20, 40, 65, 200]))) for _ in range(40)]
    lines += ["aaaaaaaa", "aaaaaaa", "aabaaaaa", "abababab", "babababa", "ababababa"]
    for line in list(lines):
        once = changed(rng, line)
        lines += [once, changed(rng, once) if once else "x", line]
    rng.shuffle(lines)
    data = [(i, "\n".join(lines[i * 3 : i * 3 + 3])) for i in range(-(-len(lines) // 3))]
    data += [(500, None), (501, ""), (502, "\n\n"), (503, "a\n\nb\n"), (None, lines[0]), data[1], data[1]]
    check_lines(spark, data, part=part)


def test_short_lines_are_looked_at(spark):
    check_lines(spark, [(1, "short one"), (2, "short one"), (3, "short on\nx"), (4, "xy\nother\nz"), (5, "xyz")])


def test_a_line_of_a_million_characters(spark):
    rng = random.Random(1)
    line = "".join(rng.choices("abcdefgh é", k=1_000_000))
    at = 654_321
    texts = [line, line[:at] + "#" + line[at + 1 :], line[:at] + line[at + 1 :] + "\nown line", line[: at - 9] + "##" + line[at:], line[:-1], "#" + line, line[::-1]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(frame).collect()}
    assert got == {0: (0, line), 1: (1, ""), 2: (1, "own line"), 3: (0, texts[3]), 4: (1, ""), 5: (1, ""), 6: (0, texts[6])}


def test_lines_of_awkward_tables(spark):
    frame = corpora.frame(spark)
    result = line_dedup.dedup_lines(frame)
    assert result.count() == frame.count()
    assert line_dedup.dedup_lines(corpora.empty(spark)).count() == 0

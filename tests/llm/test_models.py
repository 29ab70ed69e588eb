"""Learned operators: base columns against brute force, models on held-out rows, awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import corpora
import numpy as np
import pytest

from shelfmark.llm import common, language, scoring, secrets, tables, toxicity


def crc(i, by):
    return None if i is None else zlib.crc32(str(i).encode()) % by


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_language_of_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in language.language_table(docs).collect()}
    true = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == true.keys()
    held = [i for i in got if got[i]["held_out"]]
    assert held == [i for i in got if crc(i, 5) == 0]
    assert np.mean([got[i]["lang_pred"] == true[i] for i in held]) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_a_mixture_has_both_languages():
    rng = random.Random(1)
    make = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    tables = []
    for letters in ("abcde", "vwxyz", "mnopq"):
        counts = np.zeros(language.BUCKETS)
        found, n = language.trigrams(make(letters, 2000))
        counts[found] += n
        tables.append((counts + language.SMOOTH) / (counts + language.SMOOTH).sum())
    p = np.stack(tables, axis=1)
    for text, wanted in ((make("abcde", 50), {0}), (make("abcde", 60) + " " + make("mnopq", 30), {0, 2})):
        found, n = language.trigrams(text)
        every, chosen = language.choose(p[found], n)
        assert set(chosen) == wanted
        assert abs(sum(chosen.values()) - 1) < 1e-9 and max(chosen, key=chosen.get) == 0


def test_trigrams_of_long_texts_are_those_of_their_parts(monkeypatch):
    text = " ".join(f"w{i % 97}é" for i in range(3000))
    whole = language.trigrams(text)
    monkeypatch.setattr(language, "PIECE", 1000)
    parts = language.trigrams(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_language_of_awkward_tables(spark):
    rows = language.language_table(corpora.frame(spark)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in corpora.pairs())
    letterless = {i for i, t in corpora.pairs() if not any(map(str.isalpha, t or ""))}
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == letterless
    assert language.language_table(corpora.empty(spark)).count() == 0
    unlearned = corpora.frame(spark).withColumn("lang", language.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_table(unlearned).collect()} == {"und"}
    kept = language.keep_known(corpora.frame(spark))
    assert kept.columns == corpora.frame(spark).columns
    assert kept.count() == sum(any(map(str.isalpha, t or "")) for _, t in corpora.pairs())


def test_toxicity_of_held_out_documents(spark, docs, labels):
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.93
    toxic, clean = ([got[i]["score"] for i in held if truth[i] == y] for y in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) >= 0.9


def test_misspelt_words_share_their_subwords():
    rng = random.Random(2)
    plain = [corpora.words(rng, 40, 400) for _ in range(300)]
    y = np.array([i % 3 == 0 for i in range(300)]).astype(int)
    texts = [t + (" horrible" if k else "") for t, k in zip(plain, y)]
    weights, bias = toxicity.train(texts, y)
    score = lambda t: toxicity.toxic_score(t, weights, bias, 0.0)
    clean = corpora.words(rng, 2000, 400)
    assert score(clean + " horrible") > 0.5 > score(clean) and score("horribble") > 0.5
    assert score(None) == score("!") == 0.0


def test_toxic_scores_do_not_depend_on_pieces(monkeypatch):
    weights = np.random.default_rng(0).normal(size=toxicity.BUCKETS).astype(np.float32)
    text = " ".join(f"wörd{i}" for i in range(500))
    whole = toxicity.toxic_score(text, weights, -3.0, 0.0)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert toxicity.toxic_score(text, weights, -3.0, 0.0) == pytest.approx(whole)


def test_toxicity_of_awkward_tables(spark):
    frame = corpora.frame(spark)
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    for own in (marks, marks.limit(0), marks.filter("toxic = 0")):
        rows = toxicity.score_toxicity(frame, own).collect()
        assert len(rows) == frame.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(corpora.empty(spark), marks).count() == 0


PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def base_expected(text):
    spans = sorted(
        (m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m.group(g)) >= n
    )
    return ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in spans), Counter(k for _, k, _ in spans)


def test_secrets(spark, docs):
    awkward = [
        (1, "éé API_Key: 'abcdefghijkl' token : secret: abcdefghijklmnop"), (2, "AKIA" + "A" * 14 + " AKIAAKIA" + "0" * 10), (3, None), (4, ""),
        (5, "password=short " * 3 + "ab" * 8 + "\n" * 3 + "ABCDEF0123456789"), (None, "token='" + "x" * 50_000 + "'"), (1, "f" * 16),
    ]
    frame = spark.createDataFrame(awkward, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    texts = Counter()
    for i, t in [(r[0], r[1]) for r in frame.collect()]:
        base, kinds = base_expected(t)
        texts[(i, kinds[0], kinds[1], kinds[2], hashlib.sha256(base.encode()).hexdigest())] += 1
    rows = secrets.find_secrets(frame).collect()
    assert Counter(tuple(r)[:5] for r in rows) == texts
    for r in rows:
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("crf:"))
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]


def test_the_field_finds_what_the_patterns_miss():
    rng = random.Random(4)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = []
    for i in range(120):
        words = corpora.words(rng, 60, 500).split()
        if i % 2:
            words[30:30] = ["token", "=", f'"{key(40)}"']
        texts.append(" ".join(words))
    weights, moves = secrets.train(texts)
    # The sign is missing, and the hex digits are capitals: no pattern fits.
    hidden = corpora.words(rng, 20, 500) + " token = <" + key(40).upper() + "> " + corpora.words(rng, 20, 500)
    (base, added), (none, nothing), (empty, no) = secrets.scan([hidden, corpora.words(rng, 300, 500), ""], weights, moves)
    assert base == none == empty == [] == nothing == no
    assert len(added) == 1 and added[0][1] - added[0][0] == 40


def test_a_secret_of_three_tokens_is_one_span():
    rng = random.Random(6)
    key = lambda: "".join(rng.choices("0123456789abcdefABCDEFxyz", k=30))
    texts = [f"{corpora.words(rng, 30, 500)} password = \"{key()}\" {corpora.words(rng, 20, 500)}" for _ in range(60)]
    tokens, tags = secrets._labelled(texts[0])[0]
    assert [int(t) for t in tags if t] == [secrets.BEGIN, secrets.INSIDE, secrets.INSIDE]
    weights, moves = secrets.train(texts)
    value = key()[:9] + "!" + key()[:20]  # the sign ends the pattern's value before it is long enough
    odd = f"{corpora.words(rng, 12, 500)}\npassword = \"{value}\" {corpora.words(rng, 12, 500)}"
    (base, added), (old, none) = secrets.scan([odd, texts[1]], weights, moves)
    assert base == [] and [odd[a:b] for a, b in added] == [f'password = "{value}']
    assert len(old) >= 1 and none == []


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    data = np.frombuffer(b"a bb c\nd e\n\nf", np.uint8)
    tokens = secrets.Tokens(data, len(data))
    weights, moves = rng.normal(size=(secrets.FEATURES, 3)).astype(np.float32), rng.normal(size=(4, 3)).astype(np.float32)
    tags = secrets.viterbi(tokens, weights, moves)
    emit = weights[tokens.features].sum(axis=1)
    for first, last in zip(tokens.lines, np.r_[tokens.lines[1:], len(tokens.start)]):
        best = max(
            np.ndindex(*[3] * (last - first)),
            key=lambda p: moves[3][p[0]] + sum(emit[first + k][t] for k, t in enumerate(p)) + sum(moves[a][b] for a, b in zip(p, p[1:])),
        )
        assert tuple(tags[first:last]) == best


def test_secrets_of_nothing(spark):
    assert secrets.find_secrets(corpora.empty(spark)).count() == 0


def base_scores(pairs):
    counts = Counter()
    for i, t in pairs:
        if i is not None and crc(i, 7) != 2:
            counts.update((t or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for i, t in pairs:
        w = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        out[(i, crc(i, 7) == 2, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6))] += 1
    return out


@pytest.mark.parametrize("head", [3, 1 << 18])
def test_scores(spark, monkeypatch, head):
    monkeypatch.setattr(scoring, "HEAD_WORDS", head)
    rows = scoring.score_texts(corpora.frame(spark)).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in rows) == base_scores(corpora.pairs())
    assert all(r["score"] < 0 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault((r["doc_id"], r["n_tokens"]), set()).add(round(r["score"], 6))
    assert max(map(len, by_text.values())) <= 2
    assert scoring.score_texts(corpora.empty(spark)).count() == 0


def test_the_model_is_a_probability_and_learns():
    coder = scoring.subwords(scoring.TOKENIZER)
    rng = random.Random(6)
    text = lambda: " ".join(rng.choice(["the cat sat", "a dog ran", "it was red"]) for _ in range(60))
    model = scoring.trained([text() for _ in range(60)], coder)
    tables = model.tables()
    first = np.full((1, scoring.STEP), coder.begin)
    mass = 0.0
    for at in range(0, coder.size + 1, 5000):
        ids = np.arange(at, min(at + 5000, coder.size + 1))
        targets = np.full((len(ids), scoring.STEP), -1)
        targets[:, 0] = ids
        mass += np.exp(scoring.score_blocks(tables, np.repeat(first, len(ids), 0), targets, np.ones(len(ids), bool))).sum()
    assert mass == pytest.approx(1, abs=1e-3)
    # Scores far from zero neither overflow nor vanish.
    for shift in (300.0, -300.0):
        far = tables | {"s": tables["s"] + np.float32(shift)}
        targets = np.full((1, scoring.STEP), -1)
        targets[0, 0] = 5
        one = lambda t: scoring.score_blocks(t, first, targets, np.ones(1, bool))[0]  # noqa: E731, B023
        assert one(far) == pytest.approx(one(tables), abs=1e-3)

    def value(t, tables=tables):
        piece = scoring.Piece([t.encode()])
        inputs, targets, opens, _ = scoring.blocked(*scoring.id_streams(piece, coder), coder.begin)
        return scoring.score_blocks(tables, inputs, targets, opens).sum()

    words = text().split()
    mixed = list(words)
    rng.shuffle(mixed)
    assert value(" ".join(words)) > value(" ".join(mixed)) + 20
    # Blocks that are scored apart give what they give together.
    scoring.BLOCKS, old = 2, scoring.BLOCKS
    try:
        assert value(" ".join(words)) == pytest.approx(value(" ".join(words)), rel=1e-4)
    finally:
        scoring.BLOCKS = old


def test_the_model_has_its_whole_size_and_looks_back_that_far():
    """A subword is scored by up to 2 * 16 - 1 before it, over 64 classes and 4096 inputs."""
    assert (scoring.STEP, scoring.WIDTH, scoring.CLASSES, scoring.INPUTS) == (16, 16, 64, 4096)
    coder = scoring.subwords(scoring.TOKENIZER)
    rng = random.Random(8)
    model = scoring.trained([" ".join(rng.choice("the cat sat on a mat".split()) for _ in range(90)) for _ in range(20)], coder)
    tables = model.tables()
    assert tables["s"].shape == (4096, 64) and tables["q"].shape == (4096, 16) and tables["d"].shape[0] == 4096
    assert np.exp(tables["s"]).sum(axis=1) == pytest.approx(1, abs=1e-3)
    words = ("the cat sat on a mat " * 8).split()
    other = [*words[:1], "sat", *words[2:]]
    far = lambda ws: scoring.score_blocks(tables, *scoring.blocked(*scoring.id_streams(scoring.Piece([" ".join(ws).encode()]), coder), coder.begin)[:3])
    first, changed = far(words), far(other)
    assert first[1] != changed[1] and first[2:].tolist() == changed[2:].tolist()


def test_the_model_is_learned_from_all_training_rows(spark):
    """Three parts, each of its own words: counts and weights come from all of them, whatever the number of rows."""
    coder = scoring.subwords(scoring.TOKENIZER)
    data = [(i, "apple river stone " * 3) for i in range(900)] + [(i, "quartz lemon violet " * 3) for i in range(900, 1800)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(3, "doc_id")
    words, counts, blocks, pieces = scoring.counted(frame.select("text"), scoring.TOKENIZER)
    piece = scoring.Piece([t.encode() for _, t in data])
    stream, sizes = scoring.id_streams(piece, coder)
    assert counts.tolist() == np.bincount(stream, minlength=coder.size + 2).tolist()
    assert blocks == int((-(-sizes // scoring.STEP)).sum())
    often = dict(zip(piece.hashes.tolist(), np.bincount(piece.codes).tolist())) | {scoring.END_WORD: 1800}
    assert dict(map(tuple, words.collect())) == often
    context = spark.sparkContext
    moves = scoring.count_moves(pieces, context.broadcast(counts), scoring.TOKENIZER)
    fresh = scoring.Model(counts, coder.opens, moves)
    inputs, targets, _, _ = scoring.blocked(stream, sizes, coder.begin)
    assert moves.ravel().tolist() == fresh.count(inputs, targets).tolist()
    shared = context.broadcast((counts, moves, fresh.p))
    seen = scoring.averaged(pieces, shared, scoring.TOKENIZER, 1, 64, 0.01)
    row = fresh.row[coder([b"quartz"])[0][0]]
    part = scoring.counted(frame.filter("doc_id < 900").select("text"), scoring.TOKENIZER)[3]
    half = scoring.averaged(part, shared, scoring.TOKENIZER, 1, 64, 0.01)
    assert np.abs(seen["e"][row] - half["e"][row]).max() > 0.01
    assert half["e"][row] == pytest.approx(shared.value[2]["e"][row], abs=1e-5)


def test_words_and_their_subwords_by_bytes():
    rng = random.Random(9)
    texts = ["".join(rng.choice(["a", "B", "é", "🙂", " ", "\n", "\t", "\x1f", "\x85", "word", "x" * 5000]) for _ in range(n)) for n in (0, 1, 40, 300, 0, 7)]
    coder = scoring.Subwords(scoring.TOKENIZER)
    for _ in range(2):  # the second time from memory
        piece = scoring.Piece([t.encode() for t in texts])
        split = [t.encode().lower().split() for t in texts]
        assert piece.sizes.tolist() == [len(w) for w in split]
        assert [piece.word(c) for c in piece.codes] == [w for ws in split for w in ws]
        stream, sizes = scoring.id_streams(piece, coder)
        wanted = [[*np.concatenate([coder([w])[0] for w in ws] or [[]]).astype(int), coder.end] for ws in split]
        assert stream.tolist() == [i for ids in wanted for i in ids] and sizes.tolist() == [len(ids) for ids in wanted]
    swapped = scoring.Piece([b"ab ba aab aba baa a", b"x" * 4097 + b" " + b"x" * 4096 + b"y " + b"y" + b"x" * 4096])
    assert len(swapped.hashes) == 9


def test_every_class_that_counts_has_subwords():
    """A frequent end is a class of its own and leaves no other empty."""
    coder = scoring.subwords(scoring.TOKENIZER)
    counts = np.zeros(coder.size + 2)
    counts[coder.end] = 1000
    counts[[5, 6, 7]] = 3, 2, 1
    model = scoring.Model(counts, coder.opens)
    used = np.bincount(model.kind[:-1], minlength=scoring.CLASSES) > 0
    for row in model.s[:3]:
        assert np.exp(row[used]).sum() == pytest.approx(1, abs=1e-5) and (row[~used] < -1e8).all()


def test_more_texts_than_a_sample_are_learned(spark):
    """A word of 1 row in 2 has its probability even where a sample of 512 rows would hold none of it."""
    data = [(i, "apple river stone") for i in range(3000)]
    by_hash = spark.createDataFrame(data, "doc_id long, text string").selectExpr("doc_id", "xxhash64(3, cast(doc_id as string)) h")
    late = {r["doc_id"] for r in by_hash.orderBy("h").tail(1500)}
    data = [(i, "quartz lemon violet" if i in late else t) for i, t in data]
    rows = scoring.score_texts(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert min(r["score"] for r in rows if r["doc_id"] in late) > -3


def first_in_order(spark, seed, kind):
    ids = spark.range(1, 400).selectExpr("id", f"xxhash64({seed}, cast(id as {kind})) h").orderBy("h", "id").collect()
    return [r["id"] for r in ids]


def test_a_long_text_does_not_end_the_sample(spark, monkeypatch):
    """The text first in hash order is longer than the whole sample may be; ids and rows repeat."""
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 20_000)
    monkeypatch.setattr(secrets, "SAMPLE_BYTES", 20_000)
    learned = [i for i in first_in_order(spark, 9, "bigint") if crc(i, 5) != 0]
    data = [(i, f"good words here {'vilest' if i % 2 else 'kindly'} end") for i in range(1, 400)]
    data = [(i, "plain long text " * 3000) if i == learned[0] else (i, t) for i, t in data]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400)], "doc_id long, toxic int")
    frame = spark.createDataFrame([*data, data[0], data[0]], "doc_id long, text string")
    rows = toxicity.score_toxicity(frame, labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["predicted"] == r["doc_id"] % 2 for r in held)

    first = first_in_order(spark, 7, "string")[0]
    data = [(i, "plain long text " * 3000 if i == first else f"some words\npassword = q7Rt9ZxL2mVb4Kp{i}\nmore") for i in range(1, 400)]
    seen = []
    monkeypatch.setattr(common, "fill", lambda lengths, size, old=common.fill: seen.append(len(lengths)) or old(lengths, size))
    found = secrets.find_secrets(spark.createDataFrame([*data, data[0]], "doc_id long, text string")).collect()
    assert seen == [399]
    assert all(r["n_assign"] == int(r["doc_id"] != first) for r in found)


def test_windows_of_a_bounded_sample(spark):
    assert common.fill([5, 5, 100, 1000], 110) == 50 and common.fill([1, 2], 10) == 2 and common.fill([], 10) == 1
    text = "".join(chr(97 + i % 26) for i in range(10_000))
    data = [(1, 1, text), (1, 1, text), (2, 2, "short"), (2, 3, "other"), (3, 4, text[::-1])]
    texts = spark.createDataFrame(data, "d long, h long, text string")
    keys = texts.selectExpr("0L as at", "d", "h", "length(text) as n")
    got = {(r["d"], r["h"]): r["text"] for r in common.bounded_sample(keys, texts, 3, 1000).collect()}
    assert got.keys() == {(1, 1), (2, 2), (2, 3)} and got[2, 2] == "short"
    parts = got[1, 1].split("\n")
    assert len(parts) == 8 and all(p in text for p in parts) and sum(map(len, parts)) > 950


def test_counts_by_class_are_enough_to_learn():
    coder = scoring.subwords(scoring.TOKENIZER)
    model = scoring.trained(["the cat sat on a mat " * 20, "a dog ran " * 30], coder)
    counts = np.zeros(coder.size + 2)
    counts[: coder.size] = np.arange(coder.size) % 7
    rng = np.random.default_rng(4)
    moves = rng.integers(0, 3, (scoring.INPUTS, scoring.OUTPUTS + scoring.CLASSES)).astype(np.float64)
    whole = scoring.Model(counts, coder.opens, moves)
    assert scoring.Model(counts, coder.opens, whole.often(moves)).s == pytest.approx(whole.s, abs=1e-6)
    assert model.s.shape == whole.s.shape


def test_rows_written_for_learning_stay_small(spark):
    """A piece of a MB is many rows of whole texts, so that no task holds it as one object; its rows share its turn."""
    coder = scoring.subwords(scoring.TOKENIZER)
    data = [(i, "apple river stone quartz " * 100) for i in range(500)] + [(500, "violet " * 100_000)]
    frame = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    pieces = scoring.counted(frame.select("text"), scoring.TOKENIZER)[3].collect()
    many = sorted(len(r["ids"]) // np.dtype(coder.kind).itemsize for r in pieces)
    assert len(many) > 6 and many[-2] <= scoring.IDS_A_ROW + 600 and 100_000 <= many[-1] <= 100_001 + scoring.IDS_A_ROW
    assert len({r["turn"] for r in pieces}) < len(pieces)
    stream, sizes = scoring.id_streams(scoring.Piece([t.encode() for _, t in data]), coder)
    assert b"".join(r["ids"] for r in pieces) == stream.astype(coder.kind).tobytes()
    assert b"".join(r["sizes"] for r in pieces) == sizes.tobytes()
    for r in pieces:
        assert np.frombuffer(r["sizes"], np.int64).sum() == len(np.frombuffer(r["ids"], coder.kind))


def test_sparse_tables_add_up():
    rng = np.random.default_rng(5)
    dense = [rng.integers(0, 2, 60) * rng.integers(0, 9, 60) for _ in range(5)] + [np.zeros(60, np.int64)]
    place, many = tables.sparse_added(tables.sparse(t) for t in dense).reshape(2, -1)
    assert (np.diff(place) > 0).all() and np.bincount(place, many, minlength=60).tolist() == tables.added(dense).tolist()
    assert len(tables.sparse_added([tables.sparse(dense[-1])])) == 0


def test_exponentials_with_and_without_the_largest_subtracted(monkeypatch):
    """Gradients and scores are those of the plain softmax, whether logits are small or beyond every float's exponential."""
    coder = scoring.subwords(scoring.TOKENIZER)
    model = scoring.trained(["the cat sat on a mat " * 30, "a dog ran " * 40], coder)
    piece = scoring.Piece([("the dog sat on a cat " * 200).encode(), b"a mat"])
    inputs, targets, opens, _ = scoring.blocked(*scoring.id_streams(piece, coder), coder.begin)
    rows = np.concatenate([model.row[inputs][:1], model.row[inputs]])
    for times in (1, 300):
        model.p["c"] = model.p["c"] * np.float32(times)
        model.p["q"] = model.p["q"] * np.float32(times)
        found = []
        for safe, part in ((30.0, 128), (-1.0, 128), (30.0, 7)):
            monkeypatch.setattr(scoring, "SAFE", safe)
            monkeypatch.setattr(scoring, "PART", part)
            g, seen, g_e, loss = model.step(rows, targets, opens)
            found.append([*(g[k] for k in sorted(g)), seen, g_e, np.array(loss), scoring.score_blocks(model.tables(), inputs, targets, opens)])
        for other in found[1:]:
            for a, b in zip(found[0], other):
                assert np.isfinite(a).all() and b == pytest.approx(a, rel=1e-3, abs=float(1e-4 * (np.abs(a).max() + 1e-9)))


def test_written_ids_give_the_texts_back():
    """Training rows are scored from their ids: the words, their hashes and the texts are those the ids were made of."""
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "B", "é", "🙂", " ", "\n", "\t", "\x1f", "\x85", "\u3000", "word", "x" * 70]) for _ in range(n)) for n in (0, 40, 300, 0, 7, 0)]
    coder = scoring.Subwords(scoring.TOKENIZER)
    piece = scoring.Piece([t.encode() for t in texts])
    stream, sizes = scoring.id_streams(piece, coder)
    again = scoring.Piece(coder.texts(stream))
    assert again.hashes[again.codes].tolist() == piece.hashes[piece.codes].tolist()
    assert again.doc.tolist() == piece.doc.tolist() and again.sizes.tolist() == piece.sizes.tolist() and len(sizes) == len(texts)
    assert [again.word(c) for c in again.codes] == [piece.word(c) for c in piece.codes]


def test_training_rows_are_split_into_subwords_once(spark):
    """Only the first pass has their texts; scoring takes the written ids, and their keys come along."""
    data = [(i, f"apple river stone w{i} " * (i % 5)) for i in range(600)] + [(7, "another text"), (None, "no id")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    texts = spark.sparkContext.accumulator(0)
    coded = scoring.id_streams

    def counting(piece, coder):
        texts.add(len(piece.sizes))
        return coded(piece, coder)

    scoring.id_streams = counting
    try:
        rows = scoring.score_texts(frame).collect()
    finally:
        scoring.id_streams = coded
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(i for i, _ in data if i is not None)
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in rows) == base_scores(data)
    assert texts.value == len(data)


def test_texts_without_words_alone(spark):
    """Pieces in which no text has a word, in the fold and outside."""
    rows = scoring.score_texts(spark.createDataFrame([(i, None if i % 2 else " ") for i in range(30)], "doc_id long, text string")).collect()
    assert len(rows) == 30 and {(r["n_tokens"], r["n_known"], round(r["score"], 6)) for r in rows} == {(1, 1, 0)}


@pytest.mark.parametrize("most", [1, 4, 12, 1000])
def test_as_many_words_as_may_be_are_broadcast(spark, monkeypatch, most):
    """All words down to the least count that leaves them within the limit, not only those that must be few by arithmetic."""
    monkeypatch.setattr(scoring, "HEAD_WORDS", most)
    many = [90, 80, 70, 60, *[5] * 6, *[1] * 20]
    frame = spark.createDataFrame([*enumerate(many)], "w long, c long")
    n, v, least = scoring.head_of(frame)
    assert (n, v) == (sum(many), len(many))
    assert sum(c >= least for c in many) == {1: 1, 4: 4, 12: 10, 1000: 30}[most]
    assert scoring.head_of(frame.limit(0)) == (0, 0, 1 << 62)


def test_hashes_of_words_take_in_every_byte():
    rng = random.Random(13)
    words = {"".join(rng.choice("ab") for _ in range(n)).encode() for n in (*range(1, 30), 63, 64, 65, 66, 128, 5000) for _ in range(40)}
    words |= {b"a" * n for n in range(1, 140)} | {b"a" * n + b"\x00" for n in range(140)}
    piece = scoring.Piece([b" ".join(sorted(words))])
    assert len(piece.hashes) == len(words)
    again = scoring.Piece([b"b", b" ".join(sorted(words, reverse=True))])
    assert set(again.hashes.tolist()) == set(piece.hashes.tolist())


def test_gradients_are_those_of_the_loss():
    """By differences, over blocks of which some open a text, some have missing targets, and a batch in parts."""
    coder = scoring.subwords(scoring.TOKENIZER)
    model = scoring.trained(["the cat sat on a mat " * 30, "a dog ran " * 40], coder)
    piece = scoring.Piece([b"the cat sat on a mat " * 30, b"a dog ran"])
    inputs, targets, opens, _ = scoring.blocked(*scoring.id_streams(piece, coder), coder.begin)
    rows = np.concatenate([model.row[inputs][:1], model.row[inputs]])
    g, seen, g_e, _ = model.step(rows, targets, opens)
    g["e"] = np.zeros_like(model.p["e"])
    g["e"][seen] = g_e
    rng = np.random.default_rng(3)
    for key, x in g.items():
        way = rng.normal(size=x.shape).astype(np.float32) * np.abs(x).max() / max(float(np.abs(x).max()) * np.sqrt(x.size), 1e-9)
        old, far = model.p[key], np.float32(0.004)
        if key == "e":
            way[np.setdiff1d(np.arange(len(way)), seen)] = 0
            far = np.float32(0.04)
        losses = []
        for side in (1, -1):
            model.p[key] = old + side * far * way
            losses.append(model.step(rows, targets, opens)[3])
        model.p[key] = old
        assert (losses[0] - losses[1]) / (2 * far) == pytest.approx(float((x * way).sum()), abs=5e-4 + 0.05 * abs(float((x * way).sum()))), key

"""Small tables with everything that real ones hold: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, h string, keep string, size string"


def words(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def rows(seed: int = 0) -> list[tuple]:
    rng = random.Random(seed)
    base = words(rng, 80, 5000)
    texts = [base, base, base.replace("w1", "v1", 1), base + " more", base.upper(), words(rng, 30, 5000)]
    texts += [None, None, "", "", " \t\n", "one", "one", "One two", "é É", "%%% 123", words(rng, 9000, 9000)]
    near = base.split()
    for i in range(12):
        changed = list(near)
        changed[(i * 7) % len(changed)] = f"x{i}"
        texts.append(" ".join(changed))
    out = [(i, t, "en" if i % 3 else "de", None if i % 5 == 0 else f"s{i % 4}", 0) for i, t in enumerate(texts)]
    out.append((None, base, None, "s1", 0))
    out.append((None, "no id", "en", None, None))
    out.append(out[0])  # a repeated row
    out.append((3, "the id of another text", "en", "s1", 0))
    return [(*r, "a", None, "b", "c") for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(data=None) -> list[tuple]:
    return [(r[0], r[1]) for r in (rows() if data is None else data)]

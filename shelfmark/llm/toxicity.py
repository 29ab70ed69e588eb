"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the bag of its byte n-grams (3 to 6 bytes, with its ends marked), hashed into ``BUCKETS``
embeddings that are averaged and go through a linear layer. A document is a softmax over "clean" and
each of its words being the toxic one, so one toxic word among thousands is not averaged away.
Embeddings, layer and bias are learned together in numpy. Misspellings share most of their n-grams.

Learning takes ``SAMPLE_ROWS`` labelled documents in the order of a seeded hash, in one task; where they
have more than ``SAMPLE_BYTES`` characters together, the longest ones give seeded windows over their text. For scoring, layer times embedding is one number per bucket, so that a text
is a few passes over its bytes in pieces of bounded size. Nothing else crosses the network.

Defined results: null and empty texts get the score of a document without words, the share of toxic
documents in the sample among those; labels repeated for an id count as toxic if one of them is;
null labels are left out; a null id is neither learned from nor held out; without labels of both
kinds every score is the share of toxic rows (0 without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_sample, text_hash
from shelfmark.llm.language import remainder

BUCKETS = 1 << 18
SIZES = (3, 4, 5, 6)
DIMENSIONS, RATE, BATCH = 4, 0.8, 64
#: Passes over the sample: EPOCHS, or more of a small one until there were STEPS steps.
EPOCHS, STEPS = 5, 150
SAMPLE_ROWS, SAMPLE_BYTES = 4096, 12_000_000
#: Bytes of a text that are scored at once; a longer word is cut there.
PIECE = 1 << 19
#: ASCII letters in lower case, other ASCII as blanks, other bytes as they are.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: str) -> Iterator[bytes]:
    data = text.lower().encode("utf-8", "surrogatepass").translate(FOLD)
    start = 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        if end < len(data) and (blank := data.rfind(b" ", start, end)) > start:
            end = blank
        yield b" " + data[start:end] + b" "
        start = end


def subwords(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram in order of its word, and where each word starts in that list."""
    x = np.frombuffer(data, np.uint8)
    blank = x == 32
    word = np.cumsum(blank[:-1] & ~blank[1:], dtype=np.int32)
    x = x.astype(np.uint32)
    h = x[:-1] * np.uint32(16777619) ^ x[1:]
    inside, ids, words = None, [], []
    for n in range(3, max(SIZES) + 1):
        places = len(x) - n + 1
        if places <= 0:
            break
        h = h[:places] * np.uint32(16777619) ^ x[n - 1 :]
        # Blanks may only stand at the ends of an n-gram.
        inner = ~blank[n - 2 : n - 2 + places]
        inside = inner if inside is None else inside[:places] & inner
        if n in SIZES:
            k = h[inside]
            k = (k ^ (k >> np.uint32(15))) * np.uint32(2246822507) + np.uint32(n * 977)
            ids.append(((k ^ (k >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32))
            words.append(word[1 : places + 1][inside])  # the word of the byte after the first
    if not ids:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    words = np.concatenate(words)
    order = np.argsort(words, kind="stable")
    words = words[order]
    return np.concatenate(ids)[order], np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.empty(0, np.int64)


def train(texts: list[str], labels: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weight per bucket, and bias, of the toxic class against the clean one."""
    rng = np.random.default_rng(seed)
    docs, kept = [], []
    for i, text in enumerate(texts):
        parts = [subwords(p) for p in pieces(text or "")]
        parts = [p for p in parts if len(p[0])]
        if parts:
            shift = np.cumsum([0, *(len(p[0]) for p in parts)])
            docs.append((np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + s for p, s in zip(parts, shift)])))
            kept.append(i)
    y = labels[kept].astype(np.float64)
    e = rng.normal(0, 0.1, (DIMENSIONS, BUCKETS)).astype(np.float32)
    w = rng.normal(0, 1, DIMENSIONS)
    bias, e_sum, w_sum, b_sum = -4.0, np.full(BUCKETS, 1e-6), 1e-6, 1e-6
    for _ in range(max(EPOCHS, STEPS * BATCH // max(len(docs), 1))):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            ids = np.concatenate([docs[i][0] for i in batch])
            shift = np.cumsum([0, *(len(docs[i][0]) for i in batch)])
            starts = np.concatenate([docs[i][1] + s for i, s in zip(batch, shift)])
            doc = np.repeat(np.arange(len(batch)), [len(docs[i][1]) for i in batch])
            size = np.diff(np.r_[starts, len(ids)])
            hidden = np.stack([np.add.reduceat(e[k][ids], starts) for k in range(DIMENSIONS)], axis=1) / size[:, None]
            z = hidden @ w + bias
            top = np.zeros(len(batch))
            np.maximum.at(top, doc, z)
            share = np.exp(z - top[doc])
            total = np.bincount(doc, share, minlength=len(batch))
            toxic = total / (total + np.exp(-top))
            grad = ((toxic - y[batch]) / len(batch))[doc] * share / total[doc]
            flow = np.bincount(ids, np.repeat(grad / size, size), minlength=BUCKETS)
            grad_w, grad_b = hidden.T @ grad, grad.sum()
            e_sum += flow * flow * (w @ w / DIMENSIONS)
            w_sum += (grad_w @ grad_w) / DIMENSIONS
            b_sum += grad_b * grad_b
            e -= np.outer(w, RATE * flow / np.sqrt(e_sum)).astype(np.float32)
            w = w - 0.1 * RATE * grad_w / np.sqrt(w_sum)
            bias -= 0.3 * RATE * grad_b / np.sqrt(b_sum)
    return (w @ e).astype(np.float32), float(bias)


def toxic_score(text: str | None, weights: np.ndarray, bias: float, empty: float) -> float:
    value = None
    for part in pieces(text or ""):
        ids, starts = subwords(part)
        if len(ids):
            z = np.add.reduceat(weights[ids], starts, dtype=np.float64) / np.diff(np.r_[starts, len(ids)]) + bias
            z = np.logaddexp.reduce(z)
            value = z if value is None else np.logaddexp(value, z)
    return empty if value is None else float(1 / (1 + np.exp(-np.clip(value, -700, 700))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int) -> tuple[np.ndarray, float, float]:
    marks = labels.filter(labels[label_col].isNotNull() & (remainder(labels[id_col], folds) != 0))
    marks = marks.groupBy(labels[id_col].cast("bigint").alias("d")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    texts = docs.filter(remainder(docs[id_col], folds) != 0).select(
        docs[id_col].cast("bigint").alias("d"), text_hash(docs[text_col]).alias("h"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    keys = texts.select("d", "h", F.length("text").alias("n")).join(marks, "d")
    keys = keys.select(F.xxhash64(F.lit(9), "d").alias("at"), "d", "h", "n", "y")
    sample = bounded_sample(keys, texts, SAMPLE_ROWS, SAMPLE_BYTES).select("d", "text", "y")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(at=pd.util.hash_array(rows["d"].to_numpy())).sort_values(["at", "d", "text"])
        y = (rows["y"].to_numpy() > 0).astype(np.int64)
        rate = float(y.mean()) if len(y) else 0.0
        weights, bias = np.zeros(BUCKETS, np.float32), 0.0
        known = len(np.unique(y)) > 1
        if known:
            weights, bias = train(rows["text"].tolist(), y)
        none = [not t.strip() for t in rows["text"]]
        empty = float(y[none].mean()) if any(none) else rate if not known else 0.0
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias], "empty": [empty], "known": [known], "rate": [rate]})

    model = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fit, "weights binary, bias double, empty double, known boolean, rate double").collect()
    if not model or not model[0]["known"]:
        rate = model[0]["rate"] if model else 0.0
        return np.zeros(BUCKETS, np.float32), float("nan"), rate
    return np.frombuffer(model[0]["weights"], np.float32), model[0]["bias"], model[0]["empty"]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    weights, bias, empty = learn(docs, labels, id_col, text_col, label_col, folds)
    model = docs.sparkSession.sparkContext.broadcast(weights)  # one number a bucket

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value
        for texts in batches:
            if np.isnan(bias):
                yield pa.array([empty] * len(texts), pa.float64())
            else:
                yield pa.array([toxic_score(t.as_py(), table, bias, empty) for t in texts], pa.float64())

    scored = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(remainder(docs[id_col], folds) == 0, F.lit(False)).alias("held_out"),
        F.arrow_udf(score, "double")(docs[text_col].cast("string")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Language identification as multilingual mixture inference.

Learning counts byte trigrams of the normalised texts by language, over all rows that may be learned
from, in tables of ``BUCKETS`` counters (summed in a tree). A document is then a mixture: its trigrams
come from language l with probability pi_l. Expectation-maximisation fits the proportions pi over all
languages; the languages are then tried in falling order of their proportion, refitting each set, and
a language is added only while it raises the log-likelihood by more than ``PENALTY`` times the log
of the number of trigrams. The prediction is the largest proportion of the chosen set.

Both passes read a text once, keep nothing per corpus but the tables, and cross the network with one
table per task and language.

Defined results: null text, and text without a letter, is ``und`` with score 0; so is every text if
nothing could be learned. A null id is not learned from and not held out. Repeated rows are scored
alike; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import tree_sum

BUCKETS = 1 << 16
SMOOTH = 0.5
#: In units of log(trigrams) for each further language; trigrams overlap, so it is above the usual half.
PENALTY = 3.0
ROUNDS = 12
UNKNOWN = "und"
#: Characters of a text that are counted at once.
PIECE = 1 << 20
#: ASCII that is no letter becomes a blank.
LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur in the text, and how often. Pieces of long texts overlap by two bytes."""
    data = (" " + text + " ").lower().encode("utf-8", "surrogatepass").translate(LETTERS)
    total = None
    for start in range(0, max(len(data) - 2, 1), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + 2, len(data) - start), start).astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        code = code[code != 0x202020]
        ids = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
        if len(data) <= 4096:
            return np.unique(ids, return_counts=True)
        counted = np.bincount(ids, minlength=BUCKETS)
        total = counted if total is None else total + counted
    found = np.flatnonzero(total)
    return found, total[found]


def fit(p: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of the mixture; ``p`` is trigram by language."""
    share = np.full(p.shape[1], 1.0 / p.shape[1])
    n = counts.sum()
    if p.shape[1] > 1:
        for _ in range(rounds):
            share = share * ((counts / (p @ share)) @ p) / n
    return share, float(counts @ np.log(p @ share))


def choose(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[int, float]]:
    """Proportions over all languages, and those of the chosen set."""
    every, _ = fit(p, counts)
    order = np.argsort(-every, kind="stable")
    # With one language the likelihood is direct; the best one may not lead the mixture.
    alone = counts @ np.log(p)
    best = int(np.argmax(alone))
    chosen, value = {best: 1.0}, float(alone[best])
    price = PENALTY * np.log(max(counts.sum(), 2))
    own = [best]
    for other in order:
        if other == best:
            continue
        if every[other] <= 1e-3:
            break
        share, likelihood = fit(p[:, [*own, other]], counts)
        if likelihood - value <= price:
            break
        own.append(int(other))
        chosen, value = dict(zip(own, share.tolist())), likelihood
    return every, chosen


def remainder(id_column: Column, by: int) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % by


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int) -> tuple[list[str], np.ndarray]:
    """Languages in order, and p(trigram | language) as trigram by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                found, counts = trigrams(text.as_py())
                if lang not in totals:
                    totals[lang] = np.zeros(BUCKETS, np.int64)
                totals[lang][found] += counts
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.string()), pa.array([part] * len(totals), pa.int32()),
                pa.array([t.tobytes() for t in totals.values()], pa.binary()),
            ],
            names=["lang", "part", "counts"],
        )

    rows = docs.filter(
        (remainder(docs[id_col], folds) != 0) & docs[lang_col].isNotNull() & docs[text_col].isNotNull()
    ).select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    tables = tree_sum(rows.mapInArrow(count, "lang string, part int, counts binary"), ["lang"], "trigrams")
    learned = sorted((r["lang"], np.frombuffer(r["counts"], np.int64)) for r in tables.collect())  # one table a language
    if not learned:
        return [], np.zeros((BUCKETS, 0), np.float32)
    counts = np.stack([c for _, c in learned], axis=1).astype(np.float64) + SMOOTH
    return [name for name, _ in learned], (counts / counts.sum(axis=0)).astype(np.float32)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5
) -> DataFrame:
    """Rows of ``docs`` with ``lang_pred``, ``score`` (its share of the full mixture) and ``languages``."""
    names, table = learn(docs, id_col, text_col, lang_col, folds)
    model = docs.sparkSession.sparkContext.broadcast(table)

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        p_of = model.value
        for batch in texts:
            out = []
            for value in batch:
                text = value.as_py()
                if not text or not names or not any(map(str.isalpha, text)):
                    out.append({"lang_pred": UNKNOWN, "score": 0.0, "languages": ""})
                    continue
                found, counts = trigrams(text)
                every, chosen = choose(p_of[found].astype(np.float64), counts)
                best = max(chosen, key=lambda k: (chosen[k], -k))
                listed = ",".join(f"{names[k]}:{v:.3f}" for k, v in sorted(chosen.items(), key=lambda kv: (-kv[1], kv[0])))
                out.append({"lang_pred": names[best], "score": float(min(max(every[best], 0.0), 1.0)), "languages": listed})
            yield pa.array(out, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.string())]))

    predicted = F.arrow_udf(predict, "lang_pred string, score double, languages string")
    return docs.withColumn("_language", predicted(docs[text_col].cast("string")))


def language_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, languages."""
    narrow = docs.select(id_col, text_col, lang_col)
    return identify(narrow, id_col, text_col, lang_col, folds).select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(remainder(F.col(id_col), folds) == 0, F.lit(False)).alias("held_out"),
        "_language.*",
    )


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of ``docs`` in a language: those without any letter go."""
    found = identify(docs, id_col, text_col, lang_col)
    return found.filter(F.col("_language.lang_pred") != UNKNOWN).select(*docs.columns)

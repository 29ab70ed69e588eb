"""Scoring texts with a causal self-attention model on subword ids, beside a word unigram base.

One pass over the training rows counts words and subwords, and writes the subword ids; learning and scoring read these, so that only
the other rows are split into subwords when they are scored. Base: partial word counts by task meet in a shuffle by
64-bit word hash. The most frequent words, at most ``HEAD_WORDS`` by a histogram of the counts, are broadcast; all other words
of a text meet their counts in a shuffle join, one row per text and word, in which no key is hot because each of these words is rare.

Model: one attention layer with learned relative positions over blocks of ``STEP`` subwords. A block
attends to itself, causally, and to the block before it, so windows of two blocks overlap by one and
every subword is scored once, in batches of masked attention. The output is factored: a softmax over
``CLASSES`` classes of subwords, then a fixed distribution inside the class; with the tokenizer's whole
vocabulary covered it is a probability over texts. What attention adds to the class scores goes on top of the smoothed
share of each class after each input. Queries, keys and values depend on the subword alone, so scoring looks them up.

Everything in the model comes from all training rows. Classes, inner distribution and input vocabulary are
their subword counts, shares are counted in a second pass; both are one fixed table per task. The weights are trained
in numpy in ``ROUNDS`` rounds: each task goes on from the same weights over its own rows, in batches of consecutive
blocks, and the weights are averaged by blocks; only rows of the embedding that occur are updated. Each round takes its
own share of the rows, or all of them where they are so few that ``STEPS`` steps need several passes. As tasks follow the
files, weights depend on how rows lie in them, in the last digits of a score; counts and base do not.

What a task holds besides is bounded: written rows have some ``IDS_A_ROW`` ids, counts of moves travel as the places that
occur, and files of large rows have small pages. Softmaxes are taken without the largest of a row where bounds on the
lengths of vectors show that no exponential can overflow or vanish.

Texts are read whole, in pieces of whole texts of about ``CHUNK`` bytes; a longer text is one piece, and
its blocks are scored in batches.

Defined results: null and empty texts have the end token only; a null id is scored, but neither held
out nor learned from; without training rows the base and the model are uniform over what they know
(N = V = 0, hence the base is 0). Repeated rows are scored alike. Other columns are not read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import NO_ID, doc_key, id_of, stage
from shelfmark.llm.language import remainder
from shelfmark.llm.tables import sparse, sparse_added, tree_sum
from shelfmark.storage import LARGE_ROWS

#: Session setting with the path of the vocabulary file, and its default.
TOKENIZER_KEY = "spark.shelfmark.tokenizer"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the tokenizer's texts are parted.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
HEAD_WORDS = 1 << 18
#: Inputs and outputs that have counts of their own; rarer ones share those of a rest.
STEP, WIDTH, CLASSES, INPUTS, OUTPUTS = 16, 16, 64, 4096, 1024
RATE, BATCH, WIDE = 0.01, 64, 512
#: Blocks of a batch whose gradients are taken at once, so that they fit a cache.
PART = 256
#: Steps over all rounds at least, with passes repeated where the rows are few; blocks held at once.
ROUNDS, STEPS, HELD = 3, 1200, 1200 * 64
#: Counts of the prior in the share of a class after an input, and of a subword in its class.
PRIOR = 16.0
#: Tables of counts that are added at once.
FAN_IN = 8
#: Inputs whose counts are one row of a table.
SLICE = 256
#: Weights are summed as whole numbers of this part, so that the order of the sum does not matter.
UNIT = 1 << 20
CHUNK = 1 << 20
#: Subword ids in a written row, the text that passes it included: rows of a MB are large objects to the JVM.
IDS_A_ROW = 1 << 15
BLOCKS = 256
#: Logits of which exponentials are taken as they are; where any may be larger, the largest of a row is subtracted.
SAFE = 30.0
#: Words whose subwords a process remembers.
REMEMBERED = 250_000
#: Hash of the end of a text, that of a word without letters; no word is empty.
END_WORD = 0

_SUBWORDS: dict = {}
#: Longest words in bytes whose hash is taken in steps; the number of steps is that of the longest word.
LONG = 64
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # the first bytes of eight
_ODDS = np.random.default_rng(77).integers(0, 1 << 63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


class Piece:
    """Some whole texts, lower-cased: their distinct words by hash, the word at each place, and the text of each place."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts).lower()
        array = np.frombuffer(self.data, np.uint8)
        space = np.concatenate([[True], (array == 32) | (array - np.uint8(9) < 5), [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.doc = np.searchsorted(begins, self.start, side="right") - 1
        self.sizes = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.codes, self.hashes = pd.factorize(self._hash())
        self.place = np.zeros(len(self.hashes), np.int64)  # where a distinct word occurs
        self.place[self.codes] = np.arange(len(self.codes))

    def _hash(self) -> np.ndarray:
        """Words are taken in by eight bytes and mixed each time, so that words of as many bytes differ if their first bytes alone do."""
        at, left, which = self.start, self.end - self.start, slice(None)
        out = left.astype(np.uint64) * _MIX[0]
        array = np.frombuffer(self.data + bytes(8), np.uint8)
        eight = np.ndarray(len(self.data) + 1, "<u8", array, 0, (1,))  # those from each place on
        long = np.flatnonzero(left > LONG)
        for _ in range(0, LONG, 8):
            x = eight[at] & _LOW[np.minimum(left, 8)]
            x ^= out[which]
            x *= _MIX[1]
            x ^= x >> np.uint64(29)
            x *= _MIX[0]
            x ^= x >> np.uint64(32)
            out[which] = x
            more = np.flatnonzero(left > 8)
            if not len(more):
                break
            at, left, which = at[more] + 8, left[more] - 8, np.arange(len(out))[which][more]
        if len(long):
            out[long] = self._sums(self.start[long], self.end[long] - self.start[long])
        return out.view(np.int64)

    def _sums(self, start: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """For words of any length: sums of bytes times odd random numbers of their place in the word, modulo 2^64."""
        first = np.cumsum(wide) - wide
        within = np.arange(wide.sum()) - np.repeat(first, wide)
        terms = np.frombuffer(self.data, np.uint8)[np.repeat(start, wide) + within].astype(np.uint64)
        terms += np.uint64(1)
        terms *= _ODDS[within & 4095]
        within >>= 12
        if within.any():
            terms *= (within * 2 + 1).view(np.uint64)
        return np.add.reduceat(terms, first)

    def word(self, i: int) -> bytes:
        return self.words(np.array([i]))[0]

    def words(self, which: np.ndarray) -> list[bytes]:
        at = self.place[which]
        return [self.data[a:b] for a, b in zip(self.start[at].tolist(), self.end[at].tolist())]


class Subwords:
    """Subword ids of words, each with the blank before it. Kept once per process, with the words it has seen."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("words", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.opens = np.zeros(self.size + 2, bool)
        self.opens[[i for piece, i in ranks.items() if piece.startswith(b" ")]] = True
        self.end, self.begin = self.size, self.size + 1
        self.kind = np.uint16 if self.begin < 1 << 16 else np.int32
        pieces = [b""] * (self.size + 2)
        for piece, i in ranks.items():
            pieces[i] = piece
        pieces[self.end] = b"\n"
        self.bytes, self.wide = np.frombuffer(b"".join(pieces), np.uint8), np.array([*map(len, pieces)], np.int64)
        self.at = np.cumsum(self.wide) - self.wide
        self.forget()

    def forget(self) -> None:
        # Hashes, ascending, and where the ids of each begin and how many they are.
        self.known, self.first, self.count = (np.empty(0, np.int64) for _ in range(3))
        self.ids, self.used = np.empty(1 << 16, np.int32), 0

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word starts; only their blanks open a word."""
        if not words:
            return np.empty(0, np.int64), np.zeros(1, np.int64)
        text = b"".join(b" " + w for w in words).decode("utf-8", "replace")
        ids = np.array(self.coder.encode_ordinary(text), np.int64)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(words):  # a blank inside a piece: take these words one by one
            parts = [np.array(self.coder.encode_ordinary(" " + w.decode("utf-8", "replace")), np.int64) for w in words]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, np.r_[starts, len(ids)]

    def texts(self, ids: np.ndarray) -> list[bytes]:
        """The words of texts, each after a blank, from their ids; an end closes a text, and no word holds a line break."""
        wide = self.wide.take(ids)
        ends = np.cumsum(wide)
        at = np.repeat(self.at.take(ids) - ends + wide, wide)
        at += np.arange(len(at))
        return self.bytes.take(at).tobytes().split(b"\n")[:-1]

    def of(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct word of a piece start in ``ids``, and how many they are."""
        if len(self.known) > REMEMBERED:
            self.forget()
        if not len(piece.hashes):
            return self.first[:0], self.count[:0]
        at = np.searchsorted(self.known, piece.hashes)
        old = np.zeros(len(at), bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == piece.hashes[inside]
        first, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        first[old], count[old] = self.first[at[old]], self.count[at[old]]
        new = np.flatnonzero(~old)
        if len(new):
            ids, starts = self(piece.words(new))
            first[new], count[new] = starts[:-1] + self.used, np.diff(starts)
            self.ids = _grown(self.ids, self.used + len(ids))
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            known = np.concatenate([self.known, piece.hashes[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.first = np.concatenate([self.first, first[new]])[order]
            self.count = np.concatenate([self.count, count[new]])[order]
        return first, count


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.empty(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


def subwords(path: str) -> Subwords:
    if path not in _SUBWORDS:
        if not os.path.exists(path):
            raise FileNotFoundError(f"no tokenizer vocabulary at {path}: pass its path, or set {TOKENIZER_KEY}")
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


def cut(batch: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in pieces, each with the place of its first; taken one by one, so that they are never all copied."""
    start, size, part = 0, 0, []
    for i, text in enumerate(batch):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if part and size + len(data) > CHUNK:
            yield start, part
            start, size, part = i, 0, []
        part.append(data)
        size += len(data)
    if part:
        yield start, part


def id_streams(piece: Piece, coder: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all texts, each closed by the end id, and the number of ids of each text."""
    first, many = coder.of(piece)
    per_word = many[piece.codes]
    counts = np.bincount(piece.doc, per_word, minlength=len(piece.sizes)).astype(np.int64)
    total = int(per_word.sum())
    out = np.full(total + len(counts), coder.end, np.int64)
    if total:
        at = np.repeat(first[piece.codes] - np.cumsum(np.r_[0, per_word[:-1]]), per_word) + np.arange(total)
        # The texts before a place have each put one end there.
        out[np.arange(total) + np.repeat(np.arange(len(counts)), counts)] = coder.ids[at]
    return out, counts + 1


def blocked(stream: np.ndarray, counts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets in blocks of STEP, whether a block is its text's first, and the text of a block.

    Inputs are the ids one place earlier, after a begin id; targets past a text's end are -1.
    """
    blocks = -(-counts // STEP)
    first = np.cumsum(np.r_[0, blocks[:-1]])
    place = np.arange(len(stream)) - np.repeat(np.cumsum(np.r_[0, counts[:-1]]), counts) + np.repeat(first * STEP, counts)
    targets = np.full(int(blocks.sum()) * STEP, -1, np.int64)
    targets[place] = stream
    inputs = np.r_[begin, np.where(targets[:-1] >= 0, targets[:-1], begin)]
    inputs[first * STEP] = begin
    opens = np.zeros(int(blocks.sum()), bool)
    opens[first] = True
    return inputs.reshape(-1, STEP), targets.reshape(-1, STEP), opens, np.repeat(np.arange(len(counts)), blocks)


_AHEAD = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)[None, :]  # distance from query to key
_CAUSAL = np.where(_AHEAD >= 0, 0.0, -1e9).astype(np.float32)


def _flat(t: np.ndarray) -> np.ndarray:
    return t.reshape(-1, t.shape[-1])


def _length(t: np.ndarray) -> float:
    """The largest length of a row."""
    rows = _flat(t)
    return float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0)))


def _sums(t: np.ndarray) -> np.ndarray:
    """Sums of all rows, as a product."""
    rows = _flat(t)
    return rows @ np.ones(rows.shape[1], t.dtype)


def _attention(q: np.ndarray, k: np.ndarray, bias: np.ndarray, opens: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """What each place takes of those of its window, and the sums by place that it is to be divided by; no logit is beyond ``most``."""
    a = q @ _columns(k)
    a += bias
    a[opens, :, :STEP] = -1e9
    if most > SAFE:
        a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    return a, _sums(a)


def _odds(z: np.ndarray, rows: np.ndarray, s: np.ndarray, odds: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Odds of the classes from what attention adds to them, in place, and the logs of what each row was divided by.

    ``s`` and ``odds`` have the scores after each input, less the largest of each, and their exponentials; no ``z`` is beyond ``most``.
    """
    less = np.zeros(len(z), z.dtype)
    if most > SAFE:
        z += s.take(rows, axis=0)
        less = z.max(axis=1)
        z -= less[:, None]
        return np.exp(z, out=z), less
    np.exp(z, out=z)
    z *= odds.take(rows, axis=0)
    return z, less


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The product of ``x`` transposed and ``y``, some of their many rows at a time, which takes half the time of all at once."""
    n = len(x) - len(x) % 256
    parts = x[:n].reshape(-1, 256, x.shape[1]).transpose(0, 2, 1) @ y[:n].reshape(-1, 256, y.shape[1])
    return parts.sum(axis=0) + x[n:].T @ y[n:]


def _windows(t: np.ndarray) -> np.ndarray:
    """Each block's rows after those of the block before it, as a view."""
    return np.ndarray((len(t) - 1, 2 * STEP, t.shape[2]), t.dtype, t, 0, t.strides)


def _columns(t: np.ndarray) -> np.ndarray:
    """The same transposed, as a view of one transpose: products with the columns of many small ones take twice the time."""
    by_column = np.ascontiguousarray(_flat(t).T)
    row, one = by_column.strides
    return np.ndarray((len(t) - 1, t.shape[2], 2 * STEP), t.dtype, by_column, 0, (STEP * one, row, one))


def _logs(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    return np.where(some > 0, np.log(np.maximum(x, 1e-30)), -1e9).astype(np.float32)


class Model:
    """Parameters: e embeddings, q k v maps, r bias by distance, c from attention to classes; s is the score of a class after an input."""

    def __init__(self, counts: np.ndarray, opens: np.ndarray, moves: np.ndarray | None = None, seed: int = 0):
        n = len(counts)
        order = np.argsort(-counts[:-2], kind="stable")  # the end is a class of its own, the begin id is never a target
        bins = CLASSES // 4
        singles = CLASSES - 2 * bins - 1
        self.kind = np.zeros(n, np.int64)
        self.kind[order[:singles]] = np.arange(singles)
        self.kind[n - 2] = CLASSES - 1
        rest = order[singles:]
        for side, base in ((True, singles), (False, singles + bins)):
            ids = rest[opens[rest] == side]
            mass = np.cumsum(counts[ids] + 0.1)
            self.kind[ids] = base + np.minimum((mass / mass[-1] * bins).astype(np.int64), bins - 1) if len(ids) else 0
        # Frequent subwords are symbols of their own, the others of a class are one together.
        top = order[:OUTPUTS]
        self.symbol = OUTPUTS + self.kind
        self.symbol[top] = np.arange(len(top))
        self.kind_of = np.r_[self.kind[top], np.zeros(OUTPUTS - len(top), np.int64), np.arange(CLASSES)]
        mass = counts + 0.1
        mass[n - 1] = 0.0
        self.share = np.bincount(self.symbol, mass, minlength=OUTPUTS + CLASSES)
        part = mass / np.maximum(self.share[self.symbol], 1e-30)
        self.inner = np.where(mass > 0, np.log(np.maximum(part, 1e-30)), -1e9).astype(np.float32)
        self.row = np.full(n, INPUTS - 1, np.int64)
        known = np.r_[n - 1, n - 2, order[: INPUTS - 3]]
        self.row[known] = np.arange(len(known))
        self.moves = moves
        self.mass = np.bincount(self.kind_of, self.share, minlength=CLASSES)
        self.s = self.by_class()
        self.least = self.s - self.s.max(axis=1, keepdims=True)
        self.odds = np.exp(self.least)
        rng = np.random.default_rng(seed)
        make = lambda *s: rng.normal(0, WIDTH**-0.5, s).astype(np.float32)
        self.p = {"e": make(INPUTS, WIDTH), "q": make(WIDTH, WIDTH), "k": make(WIDTH, WIDTH), "v": make(WIDTH, WIDTH),
                  "r": np.zeros(2 * STEP, np.float32), "c": make(WIDTH, CLASSES) * 0.1}

    def by_class(self) -> np.ndarray:
        """Logs of the smoothed shares of each class after each input; a class without subwords has none."""
        prior = self.mass / self.mass.sum()
        often = np.zeros((INPUTS, CLASSES)) if self.moves is None else self.often(self.moves)
        return _logs((often + PRIOR * prior) / (often.sum(axis=1, keepdims=True) + PRIOR), prior)

    def by_symbol(self) -> np.ndarray:
        """Logs of the smoothed shares of each symbol in its class after each input, some inputs at a time."""
        inside = self.share / np.maximum(self.mass, 1e-30)[self.kind_of]
        out = np.empty((INPUTS, OUTPUTS + CLASSES), np.float32)
        for at in range(0, INPUTS, SLICE):
            moves = np.zeros((SLICE, OUTPUTS + CLASSES)) if self.moves is None else self.moves[at : at + SLICE]
            out[at : at + SLICE] = _logs((moves + PRIOR * inside) / (self.often(moves)[:, self.kind_of] + PRIOR), inside)
        return out

    def often(self, moves: np.ndarray) -> np.ndarray:
        """Counts by class; they are taken as they are if they come by class."""
        if moves.shape[1] == CLASSES:
            return moves
        of_class = np.zeros((OUTPUTS + CLASSES, CLASSES))
        of_class[np.arange(OUTPUTS + CLASSES), self.kind_of] = 1.0
        return moves @ of_class

    def places(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """The place of each input and the symbol after it, in a flat table."""
        real = targets >= 0
        return self.row[inputs[real]] * (OUTPUTS + CLASSES) + self.symbol[targets[real]]

    def count(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """How often each symbol follows each input, flat."""
        return np.bincount(self.places(inputs, targets), minlength=INPUTS * (OUTPUTS + CLASSES))

    def tables(self) -> dict[str, np.ndarray]:
        """Everything that depends on the input alone, looked up when scoring."""
        p = self.p
        return {
            "row": self.row, "kind": self.kind, "symbol": self.symbol, "inner": self.inner, "s": self.s, "d": self.by_symbol(), "c": p["c"],
            "q": p["e"] @ p["q"] * np.float32(WIDTH**-0.5), "k": p["e"] @ p["k"], "v": p["e"] @ p["v"],
            "bias": (p["r"][np.maximum(_AHEAD, 0)] + _CAUSAL).astype(np.float32),
        }

    def step(self, rows: np.ndarray, targets: np.ndarray, opens: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray, float]:
        """Gradients of the mean loss over the targets of consecutive blocks; ``rows`` has the block before them, too.

        The gradient of the embedding comes by the rows that occur, ascending.
        """
        p, n, g, loss = self.p, max(int((targets >= 0).sum()), 1), {}, 0.0
        flat = rows.ravel()
        order = np.argsort(flat.astype(np.int16), kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        seen = flat[order[first]]
        where = np.empty(INPUTS, np.int64)
        where[seen] = np.arange(len(seen))
        # Queries, keys and values depend on the input alone: once for each that occurs, and so do their gradients.
        e, scale = p["e"].take(seen, axis=0), np.float32(WIDTH**-0.5)
        q, k, v = e @ (p["q"] * scale), e @ p["k"], e @ p["v"]
        bias = p["r"][np.maximum(_AHEAD, 0)] + _CAUSAL
        # A place takes a mean of values, so what it takes is no longer than the longest.
        most = _length(q) * _length(k) + float(np.abs(p["r"]).max()), _length(v) * _length(p["c"].T)
        d = [np.zeros((*rows.shape, WIDTH), np.float32) for _ in "qkv"]
        for at in range(0, len(targets), PART):
            own = slice(at, at + PART + 1)
            taken = where[rows[own]]
            g_part, d_part, loss_part = self.part(
                q.take(taken[1:], axis=0), k.take(taken, axis=0), v.take(taken, axis=0), bias, most,
                rows[own][1:].ravel(), targets[at : at + PART], opens[at : at + PART], n,
            )
            g = {k: g[k] + x for k, x in g_part.items()} if g else g_part
            d[0][own][1:] = d_part[0]
            for whole, windows in zip(d[1:], d_part[1:]):
                whole[own][:-1] += windows[:, :STEP]
                whole[own][1:] += windows[:, STEP:]
            loss += loss_part
        dq, dk, dv = (np.add.reduceat(_flat(x).take(order, axis=0), first, axis=0) for x in d)
        dq *= scale
        g["q"], g["k"], g["v"] = e.T @ dq, e.T @ dk, e.T @ dv
        return g, seen, dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T, loss

    def part(
        self, q: np.ndarray, k: np.ndarray, v: np.ndarray, bias: np.ndarray, most: tuple[float, float],
        after: np.ndarray, targets: np.ndarray, opens: np.ndarray, n: int,
    ) -> tuple[dict, tuple, float]:
        """Gradients by some blocks of a batch of ``n`` targets, those of queries by place and of keys and values by window, and the loss."""
        c = self.p["c"]
        a, sums = _attention(q, k, bias, opens, most[0])
        m = a @ _windows(v)
        m *= (1 / sums).reshape(*m.shape[:2], 1)
        z, _ = _odds(_flat(m @ c), after, self.least, self.odds, most[1])
        whole = _sums(z)
        real = (targets >= 0).ravel()
        goal = np.arange(len(z)) * CLASSES + self.kind[np.maximum(targets, 0)].ravel()
        loss = -float(np.log((z.ravel().take(goal) / whole)[real] + 1e-30).sum()) / n
        # The gradient of a row of logits is this times ``by``; narrower factors are multiplied in its place.
        z.ravel()[goal] -= whole
        by = real / (whole * np.float32(n))
        g = {"c": _product(_flat(m) * by[:, None], z)}
        dm = z.reshape(*m.shape[:2], CLASSES) @ np.ascontiguousarray(c.T)
        dm *= (by / sums).reshape(*m.shape[:2], 1)  # as the weights are not divided
        dv = a.transpose(0, 2, 1) @ dm
        da = dm @ _columns(v)
        da -= np.einsum("ijk,ijk->ij", dm, m)[:, :, None]
        da *= a
        g["r"] = np.bincount(np.maximum(_AHEAD, 0).ravel(), da.sum(axis=0).ravel(), minlength=2 * STEP).astype(np.float32)
        return g, (da @ _windows(k), da.transpose(0, 2, 1) @ q, dv), loss

    def fit(self, inputs: np.ndarray, targets: np.ndarray, opens: np.ndarray, passes: int, batch: int, rate: float, state: dict | None = None) -> dict:
        """Adam over batches of consecutive blocks; ``state`` has the moments and steps so far.

        An embedding's moments go on only when it occurs.
        """
        rows = self.row[inputs]
        state = state or {"n": 0, "m": {k: np.zeros(x.shape, np.float32) for k, x in self.p.items()},
                          "v": {k: np.zeros(x.shape, np.float32) for k, x in self.p.items()}}
        rng = np.random.default_rng(state["n"])
        for _ in range(passes):
            for at in rng.permutation(np.arange(0, len(rows), batch)):
                # A first block opens its text and does not look at the block before it.
                own = rows[at - 1 : at + batch] if at else np.concatenate([rows[:1], rows[:batch]])
                g, seen, g_e, _ = self.step(own, targets[at : at + batch], opens[at : at + batch])
                state["n"] += 1
                up, down = rate / (1 - 0.9 ** state["n"]), 1 / (1 - 0.99 ** state["n"])
                for key, grad, part in [*((key, grad, ...) for key, grad in g.items()), ("e", g_e, seen)]:
                    m = 0.9 * state["m"][key][part] + 0.1 * grad
                    v = 0.99 * state["v"][key][part] + 0.01 * grad * grad
                    state["m"][key][part], state["v"][key][part] = m, v
                    self.p[key][part] -= (up * m / (np.sqrt(v * down) + 1e-8)).astype(np.float32)
        return state


def plan(blocks: int) -> tuple[int, int, bool]:
    """Passes and batch size of a round, and whether a round takes all rows."""
    passes = -(-STEPS * BATCH // max(blocks, 1))
    whole = passes >= ROUNDS
    return -(-passes // ROUNDS) if whole else passes, max(BATCH, min(WIDE, blocks // STEPS)), whole


def rate_of(turn: int) -> float:
    return RATE * (1 - 0.9 * turn / max(ROUNDS - 1, 1))


def score_blocks(t: dict, inputs: np.ndarray, targets: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Sum of the natural log probabilities of each block's targets."""
    rows, out = t["row"][inputs], np.empty(len(inputs))
    least = t["s"] - t["s"].max(axis=1, keepdims=True)
    odds = np.exp(least)
    near = _length(t["q"]) * _length(t["k"]) + float(np.abs(t["bias"][_AHEAD >= 0]).max())
    far = _length(t["v"]) * _length(t["c"].T)
    for at in range(0, len(rows), BLOCKS):
        own = rows[at - 1 : at + BLOCKS] if at else np.concatenate([rows[:1], rows[:BLOCKS]])
        after = own[1:].ravel()
        a, sums = _attention(t["q"].take(own[1:], axis=0), t["k"].take(own, axis=0), t["bias"], opens[at : at + BLOCKS], near)
        m = a @ _windows(t["v"].take(own, axis=0))
        m *= (1 / sums).reshape(*m.shape[:2], 1)
        z = _flat(m @ t["c"])
        goal = targets[at : at + BLOCKS].ravel()
        real = np.maximum(goal, 0)
        kind = t["kind"].take(real)
        picked = z.ravel().take(np.arange(len(z)) * CLASSES + kind) + least.ravel().take(after * CLASSES + kind)
        z, less = _odds(z, after, least, odds, far)
        value = picked - less - np.log(_sums(z)) + t["d"].ravel().take(after * (OUTPUTS + CLASSES) + t["symbol"].take(real)) + t["inner"].take(real)
        out[at : at + BLOCKS] = np.where(goal >= 0, value, 0.0).reshape(-1, STEP).sum(axis=1, dtype=np.float64)
    return out


def counted(rows: DataFrame, tokenizer: str) -> tuple[DataFrame, np.ndarray, int, DataFrame]:
    """One pass over the column ``text``: (w, c) of all tokens by word hash, written; the counts of all subwords, ends
    included; the number of blocks; and the subword ids, (turn, rid, ids, sizes, d) by piece, written for the passes of learning
    and scoring. ``rid`` numbers the first text of a piece, those after it follow; ``d`` has their keys, if ``rows`` do."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, total, turn = subwords(tokenizer), None, TaskContext.get().partitionId()
        words, counts, held, rid = [], [], 0, turn << 33

        def merged() -> tuple[np.ndarray, np.ndarray]:
            w, where = np.unique(np.concatenate(words), return_inverse=True)
            return w, np.bincount(where, np.concatenate(counts)).astype(np.int64)

        for batch in batches:
            for start, texts in cut(batch.column("text")):
                total = np.zeros(coder.size + 3, np.int64) if total is None else total
                piece = Piece(texts)
                ids, sizes = id_streams(piece, coder)
                total[:-1] += np.bincount(ids, minlength=coder.size + 2)
                total[-1] += int((-(-sizes // STEP)).sum())
                words += [piece.hashes, np.array([END_WORD], np.int64)]
                counts += [np.bincount(piece.codes, minlength=len(piece.hashes)), np.array([len(texts)])]
                held += len(piece.hashes)
                if held > 400_000:
                    w, c = merged()
                    words, counts, held = [w], [c], 0
                turn += 1
                d = batch.column("d").slice(start, len(texts)).to_numpy()
                firsts, *some = zip(*in_rows(ids.astype(coder.kind), sizes, d))
                yield filled(_COUNTED, turn=[turn % ROUNDS] * len(firsts), rid=[rid + i for i in firsts], **dict(zip(("ids", "sizes", "d"), some)))
                rid += len(texts)
        if total is not None:
            yield table(total, schema=_COUNTED)
            w, c = merged()
            for at in range(0, len(w), 100_000):
                yield filled(_COUNTED, w=w[at : at + 100_000], c=c[at : at + 100_000])

    rows = rows if "d" in rows.columns else rows.withColumn("d", F.lit(NO_ID))
    schema = "one int, part int, counts binary, w long, c long, turn int, rid long, ids binary, sizes binary, d binary"
    found = stage(rows.mapInArrow(count, schema), "counted", LARGE_ROWS)
    summed = tree_sum(found.filter("counts is not null").select("one", "part", "counts"), ["one"], "subword-counts").collect()  # one table
    total = np.frombuffer(summed[0]["counts"], np.int64) if summed else np.zeros(subwords(tokenizer).size + 3, np.int64)
    by_word = stage(found.filter("w is not null").groupBy("w").agg(F.sum("c").alias("c")), "word-counts")
    pieces = found.filter("ids is not null").select("turn", "rid", "ids", "sizes", "d")
    return by_word, total[:-1].astype(np.float64), int(total[-1]), pieces


_TABLE = pa.schema([("one", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
_COUNTED = pa.schema([*_TABLE, ("w", pa.int64()), ("c", pa.int64()), ("turn", pa.int32()), ("rid", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("d", pa.binary())])


def filled(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of some columns; the others are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def table(values: np.ndarray, one: int = 0, schema: pa.Schema = _TABLE) -> pa.RecordBatch:
    """One row with the table of a task, or the part ``one`` of it."""
    from pyspark import TaskContext

    return filled(schema, one=[one], part=[TaskContext.get().partitionId()], counts=[values.tobytes()])


def in_rows(ids: np.ndarray, sizes: np.ndarray, d: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """The place of the first text, ids, sizes and keys of whole texts, some ``IDS_A_ROW`` ids a row."""
    ends = np.cumsum(sizes)
    last = np.flatnonzero(np.diff((ends - sizes) // IDS_A_ROW, append=-1)) + 1  # where the text after it begins in another part
    for a, b in zip([0, *last.tolist()], last.tolist()):
        yield a, ids[ends[a] - sizes[a] : ends[b - 1]].tobytes(), sizes[a:b].tobytes(), d[a:b].tobytes()


def blocks_of(batches: Iterator[pa.RecordBatch], coder: Subwords) -> Iterator[tuple]:
    """Inputs, targets and openings of the blocks of the columns ``ids`` and ``sizes``, piece by piece."""
    for batch in batches:
        for ids, sizes in zip(batch.column("ids"), batch.column("sizes")):
            stream = np.frombuffer(ids.as_buffer(), coder.kind).astype(np.int64)
            yield blocked(stream, np.frombuffer(sizes.as_buffer(), np.int64), coder.begin)[:3]


def texts_of(batches: Iterator[pa.RecordBatch], coder: Subwords) -> Iterator[tuple]:
    """Numbers, keys, ids and sizes of the texts of the columns (rid, ids, sizes, d), about ``CHUNK`` bytes of ids at once."""
    some, held = [], 0

    def joined() -> tuple:
        rids, ids, sizes, d = zip(*some)
        some.clear()
        number = [rid + np.arange(len(x)) for rid, x in zip(rids, d)]
        return np.concatenate(number), np.concatenate(d), np.concatenate(ids).astype(np.int64), np.concatenate(sizes)

    for batch in batches:
        for rid, *parts in zip(*(batch.column(c) for c in ("rid", "ids", "sizes", "d"))):
            ids, sizes, d = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(parts, (coder.kind, np.int64, np.int64)))
            some.append((rid.as_py(), ids, sizes, d))
            held += ids.nbytes
            if held >= CHUNK:
                yield joined()
                held = 0
    if some:
        yield joined()


def count_moves(pieces: DataFrame, shared, tokenizer: str) -> np.ndarray:
    """How often each symbol follows each input, over all ``pieces`` (ids, sizes); ``shared`` has the subword counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, model, total = subwords(tokenizer), None, None
        coder.forget()  # the ids are known from here on
        for inputs, targets, _ in blocks_of(batches, coder):
            if model is None:
                model, total = Model(shared.value, coder.opens), np.zeros(INPUTS * (OUTPUTS + CLASSES), np.int64)
            place, many = np.unique(model.places(inputs, targets), return_counts=True)
            total[place] += many
        if total is not None:
            for one in range(INPUTS // SLICE):
                yield table(sparse(total[one * wide : (one + 1) * wide]), one)

    wide = SLICE * (OUTPUTS + CLASSES)
    found = pieces.select("ids", "sizes").mapInArrow(count, "one int, part int, counts binary")
    summed = tree_sum(found, ["one"], "moves", FAN_IN, sparse_added).collect()  # one table
    moves = np.zeros((INPUTS, OUTPUTS + CLASSES))
    for row in summed:
        place, many = np.frombuffer(row["counts"], np.int64).reshape(2, -1)
        moves.ravel()[row["one"] * wide + place] = many
    return moves


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def averaged(pieces: DataFrame, shared, tokenizer: str, passes: int, batch_size: int, rate: float) -> dict | None:
    """Weights after one round over ``pieces`` (ids, sizes): each task's own, averaged by its blocks."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, model, state, waiting, held, done = subwords(tokenizer), None, None, [], 0, 0
        coder.forget()

        def fit() -> None:
            nonlocal state, held, done
            state = model.fit(*(np.concatenate(x) for x in zip(*waiting)), passes, batch_size, rate, state)
            done += held
            held = 0
            waiting.clear()

        for blocks in blocks_of(batches, coder):
            if model is None:
                counts, moves, p = shared.value
                model = Model(counts, coder.opens, moves)
                model.p = {k: x.copy() for k, x in p.items()}
            waiting.append(blocks)
            held += len(blocks[0])
            if held >= HELD:
                fit()
        if held:
            fit()
        if done:
            yield table(np.r_[np.rint(flat(model.p) * done * UNIT), done].astype(np.int64))

    summed = tree_sum(pieces.select("ids", "sizes").mapInArrow(go, "one int, part int, counts binary"), ["one"], "weights").collect()  # one table
    if not summed:
        return None
    total = np.frombuffer(summed[0]["counts"], np.int64)
    return shaped(total[:-1] / (float(total[-1]) * UNIT), shared.value[2])


def learn(pieces: DataFrame, counts: np.ndarray, blocks: int, tokenizer: str) -> dict[str, np.ndarray]:
    """The model's tables; trained on all ``pieces`` (turn, ids, sizes)."""
    context = pieces.sparkSession.sparkContext
    moves = count_moves(pieces, context.broadcast(counts), tokenizer)
    model = Model(counts, subwords(tokenizer).opens, moves)
    passes, batch, whole = plan(blocks)
    often = model.often(moves)  # learning needs the classes alone
    for i in range(ROUNDS if blocks else 0):
        shared = context.broadcast((counts, often, model.p))  # fixed size
        taken = pieces if whole else pieces.filter(F.col("turn") == i)
        model.p = averaged(taken, shared, tokenizer, passes, batch, rate_of(i)) or model.p
        shared.destroy()
    return model.tables()


def trained(texts: list[str], coder: Subwords) -> Model:
    """The same in one process."""
    piece = Piece([t.encode("utf-8", "surrogatepass") for t in texts])
    stream, sizes = id_streams(piece, coder)
    counts = np.bincount(stream, minlength=coder.size + 2).astype(np.float64)
    model = Model(counts, coder.opens)
    if len(stream):
        inputs, targets, opens, _ = blocked(stream, sizes, coder.begin)
        model = Model(counts, coder.opens, model.count(inputs, targets).reshape(INPUTS, -1).astype(np.float64))
        passes, batch, whole = plan(len(inputs))
        for i in range(ROUNDS):
            model.fit(inputs, targets, opens, passes if whole else -(-passes // ROUNDS), batch, rate_of(i))
    return model


def head_of(counts: DataFrame) -> tuple[int, int, int]:
    """All tokens and distinct tokens of ``counts`` (w, c), and a count that at most ``HEAD_WORDS`` of them reach, in steps of an eighth of a power of two."""
    steps = counts.groupBy(F.floor(F.log2("c") * 8).alias("step")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.min("c").alias("least"))
    steps = sorted(steps.collect(), key=lambda r: -r["least"])  # some hundred rows at most
    inside = np.cumsum([r["v"] for r in steps]) <= HEAD_WORDS
    return sum(r["n"] for r in steps), sum(r["v"] for r in steps), min((r["least"] for r, fits in zip(steps, inside) if fits), default=1 << 62)


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, tokenizer: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``tokenizer`` is the path of a vocabulary file that every executor has; by default that of the session's setting.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or spark.conf.get(TOKENIZER_KEY, TOKENIZER)
    learns = F.coalesce(remainder(docs[id_col], folds) != held, F.lit(False))
    narrow = lambda which: docs.filter(which).select(doc_key(docs[id_col]).alias("d"), docs[text_col].cast("string").alias("text"))
    counts, subword_counts, blocks, pieces = counted(narrow(learns), tokenizer)
    learned = learn(pieces, subword_counts, blocks, tokenizer)
    n, v, least = head_of(counts)
    end = END_WORD
    frequent = (F.col("c") >= least) | (F.col("w") == end)
    head = counts.filter(frequent).orderBy("w").toArrow()
    shared = spark.sparkContext.broadcast((head["w"].to_numpy(), head["c"].to_numpy(), learned))

    def scored(piece: Piece, stream: np.ndarray, sizes: np.ndarray, rid: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        w, c, tables = shared.value
        ln = np.log10((c + 1) / (n + v + 1)) if len(c) else np.empty(0)
        many = len(sizes)
        inputs, targets, opens, owner = blocked(stream, sizes, subwords(tokenizer).begin)
        model = np.bincount(owner, score_blocks(tables, inputs, targets, opens), minlength=many) / np.log(10)
        codes = piece.hashes
        at = np.minimum(np.searchsorted(w, codes), max(len(w) - 1, 0))
        known = w[at] == codes if len(w) else np.zeros(len(codes), bool)
        value = np.where(known, ln[at], 0.0) if len(w) else np.zeros(len(codes))
        base = np.bincount(piece.doc, value[piece.codes], minlength=many).astype(np.float64)  # whole numbers where there is no word
        head_n = np.bincount(piece.doc, known[piece.codes], minlength=many).astype(np.int64)
        is_end = np.flatnonzero(w == end)
        base += ln[is_end[0]] if len(is_end) else np.log10(1 / (n + v + 1))
        head_n += len(is_end)
        yield pa.RecordBatch.from_arrays(
            # The key of a text's own row spreads it; it counts no word.
            [pa.array(rid), pa.array(d), pa.array(rid), pa.array(np.zeros(many, np.int64)), pa.array(piece.sizes + 1), pa.array(head_n), pa.array(base), pa.array(model)],
            names=["rid", "d", "w", "k", "n_tokens", "known", "base", "score"],
        )
        tail = ~known[piece.codes]
        pair, k = np.unique(piece.doc[tail] * max(len(codes), 1) + piece.codes[tail], return_counts=True)
        zero, none = np.zeros(len(pair), np.int64), np.zeros(len(pair))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rid[pair // max(len(codes), 1)]), pa.nulls(len(pair), pa.int64()), pa.array(codes[pair % max(len(codes), 1)]), pa.array(k.astype(np.int64)), pa.array(zero), pa.array(zero), pa.array(none), pa.array(none)],
            names=["rid", "d", "w", "k", "n_tokens", "known", "base", "score"],
        )

    def by_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = subwords(tokenizer)
        coder.forget()  # the ids are known
        for rid, d, stream, sizes in texts_of(batches, coder):
            yield from scored(Piece(coder.texts(stream)), stream, sizes, rid, d)

    def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, d = (batch.column(i).to_numpy() for i in range(2))
            for start, texts in cut(batch.column(2)):
                piece, own = Piece(texts), slice(start, start + len(texts))
                yield from scored(piece, *id_streams(piece, subwords(tokenizer)), rid[own], d[own])

    # The number addresses a row within this one job, below zero if its ids are not written; the row's id travels with it.
    others = narrow(~learns).select((-1 - F.monotonically_increasing_id()).alias("rid"), "d", "text")
    schema = "rid long, d long, w long, k long, n_tokens long, known long, base double, score double"
    parts = pieces.select("rid", "ids", "sizes", "d").mapInArrow(by_ids, schema).unionAll(others.mapInArrow(by_text, schema))
    rare = counts.filter(~frequent)
    seen = F.coalesce("c", F.lit(0))
    each = parts.join(rare, "w", "left").select(
        "rid", "d", "n_tokens", "score",
        (F.col("known") + F.when(seen > 0, F.col("k")).otherwise(0)).alias("known"),
        (F.col("base") + F.col("k") * F.log10((seen + 1) / F.lit(float(n + v + 1)))).alias("base"),
    )
    total = each.groupBy("rid").agg(F.max("d").alias("d"), *[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score")])
    doc_id = id_of(F.col("d"))
    return total.select(
        doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, folds) == held, F.lit(False)).alias("held_out"), "n_tokens",
        F.col("known").alias("n_known"), F.lit(int(n)).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )

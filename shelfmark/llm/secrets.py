"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns give the base spans. The field tags the tokens (words without white space) of each line as
outside, begin or inside a secret, from the token's shape and hashed text, those of its neighbours, and
features of the whole text, and is decoded by Viterbi, all lines of a piece in step. It is trained in
numpy on ``SAMPLE_ROWS`` texts in the order of a seeded hash; where they have more than ``SAMPLE_BYTES``
characters together, the longest ones give seeded windows over their text. Its labels are the base spans: the first
token of one begins a secret, the others (the sign and the value of an assignment) are inside it. When tagging, a token
that begins a secret and those inside after it are one span of kind ``crf``, unless it touches a base span; spans
are trimmed to the characters that secrets are made of.

Texts are read whole, by pieces of whole lines of bounded size (a line of more than ``LINE`` tokens is
several sequences); nothing crosses the network but the sample.

Defined results: null text is empty and has no spans; positions are code points, ends exclusive; an
assignment's span is its whole match; repeated rows are scanned alike; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_sample, doc_key, text_hash

# The base patterns, with the group to measure and its least length.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
#: What a secret is made of; a tagged token is trimmed to it.
BODY = re.compile(r"[A-Za-z0-9+/_.=-]+")
LEAST = 8

SAMPLE_ROWS, SAMPLE_BYTES = 2048, 8_000_000
FEATURES = 1 << 14
EPOCHS, RATE, BATCH, LINE = 6, 0.3, 32, 256
PIECE = 1 << 20
OUTSIDE, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str, may_hex: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    found = []
    low = text.lower()
    for kind, (_, pattern, group, least) in enumerate(PATTERNS):
        if kind == 0 and not any(k in low for k in KEYWORDS) or kind == 1 and "AKIA" not in text or kind == 2 and not may_hex:
            continue
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


# Classes of bytes: lower hex letter, other lower, upper, digit, joint, other; other bytes count as letters.
_CLASS = np.full(256, 1, np.uint8)
_CLASS[:128] = 5
_CLASS[[*range(97, 123)]] = 1
_CLASS[[*range(97, 103)]] = 0
_CLASS[[*range(65, 91)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[[ord(c) for c in "+/_.=-"]] = 4
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _bins(values: np.ndarray, edges: tuple[int, ...]) -> np.ndarray:
    return np.searchsorted(np.array(edges), values, side="right").astype(np.int64)


class Tokens:
    """Tokens of some bytes: their ends, line and features."""

    def __init__(self, data: np.ndarray, whole: int):
        space = _SPACE[data]
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        n = len(self.start)
        breaks = np.flatnonzero((data == 10) | (data == 13))
        line = np.searchsorted(breaks, self.start)
        new = np.r_[True, line[1:] != line[:-1]] if n else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.empty(0, np.int64)
        place = np.arange(n) - first
        new |= place % LINE == 0
        self.lines = np.flatnonzero(new)
        if not n:
            self.features = np.empty((0, 8), np.int32)
            self.hexes = np.empty(0, np.int64)
            return
        kinds = _CLASS[data]
        counts = [np.r_[0, np.cumsum(kinds == k, dtype=np.int32)] for k in range(6)]
        low_hex, low, up, digit, joint, odd = (c[self.end] - c[self.start] for c in counts)
        self.hexes = low_hex + digit
        size = self.end - self.start
        change = np.r_[0, np.cumsum(kinds[1:] != kinds[:-1], dtype=np.int32), 0]
        change = change[self.end - 1] - change[self.start]
        many = _bins(size, (2, 4, 8, 12, 16, 20, 24, 32, 40, 64))
        shape = many
        for part, edges in ((digit * 8 // size, (1, 2, 4, 6)), (up * 4 // size, (1, 2, 4)), (odd, (1, 3)), (joint, (1, 2))):
            shape = shape * (len(edges) + 1) + _bins(part, edges)
        coarse = (shape % 2311).astype(np.int64)
        pure = (self.hexes == size).astype(np.int64) * 2 + (low == 0)
        # Hash of the token's text, without regard to case.
        spread = (data.astype(np.uint64) | np.uint64(32)) * np.uint64(0x9E3779B1)
        powers = np.cumprod(np.r_[np.uint64(1), np.full(31, 0x01000193, np.uint64)])
        within = np.arange(len(data)) - np.repeat(np.r_[0, self.start], np.diff(np.r_[0, self.start, len(data)]))
        with np.errstate(over="ignore"):
            word = np.add.reduceat(np.where(space, np.uint64(0), spread * powers[within & 31]), self.start)
        word = ((word ^ (word >> np.uint64(29))) % np.uint64(2039)).astype(np.int64)
        shift = lambda x, by: np.r_[np.full(by, -1), x[:-by]] if by > 0 else np.r_[x[-by:], np.full(-by, -1)]
        columns = [
            coarse, pure * 16 + _bins(change, (1, 2, 4, 8, 12)), word, shift(word, 1)[:n], shift(word, 2)[:n],
            shift(word, -1)[-n:], shift(coarse, 1)[:n], np.full(n, int(np.log2(whole + 1)) * 8 + int(_bins(np.array([odd.sum() * 64 // len(data)]), (1, 2, 4, 8, 16))[0])),
        ]
        salted = [((c + 2) * 8 + i) * 2654435761 % (1 << 32) >> 7 for i, c in enumerate(columns)]
        self.features = np.stack([s % FEATURES for s in salted], axis=1).astype(np.int32)

    @classmethod
    def together(cls, parts: list[Tokens]) -> Tokens:
        """The tokens of several texts, to be tagged in step."""
        out = cls.__new__(cls)
        shift = np.cumsum([0, *(len(p.start) for p in parts)])
        out.lines = np.concatenate([p.lines + s for p, s in zip(parts, shift)])
        out.start, out.features = np.concatenate([p.start for p in parts]), np.concatenate([p.features for p in parts])
        return out

    def steps(self, order: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Lines from long to short; for each place, the tokens there of the lines that reach it."""
        begin = self.lines[order]
        for t in range(int(size[order[0]]) if len(order) else 0):
            alive = np.searchsorted(-size[order], -t, side="left")
            yield alive, begin[:alive] + t


def _lengths(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(np.r_[tokens.lines, len(tokens.start)])
    return size, np.argsort(-size, kind="stable")


def viterbi(tokens: Tokens, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag of each token."""
    n = len(tokens.start)
    tags = np.zeros(n, np.int8)
    if not n:
        return tags
    emit = weights[tokens.features].sum(axis=1)
    size, order = _lengths(tokens)
    score, back = np.zeros((len(order), 3), np.float32), np.zeros((n, 3), np.int8)
    for t, (alive, at) in enumerate(tokens.steps(order, size)):
        if t == 0:
            score[:] = emit[at] + moves[3]
            continue
        best = score[:alive, :, None] + moves[None, :3]
        back[at] = best.argmax(axis=1)
        score[:alive] = best.max(axis=1) + emit[at]
    last = tokens.lines[order] + size[order] - 1
    tags[last] = score.argmax(axis=1)
    longest = int(size.max())
    for t in range(longest - 1, 0, -1):
        alive = np.searchsorted(-size[order], -t, side="left")
        at = tokens.lines[order[:alive]] + t
        tags[at - 1] = back[at, tags[at]]
    return tags


def _gradient(tokens: Tokens, tags: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected minus seen tags by token, and the same for the moves, by forward and backward sums."""
    n = len(tokens.start)
    emit = weights[tokens.features].sum(axis=1).astype(np.float64)
    size, order = _lengths(tokens)
    ahead, behind = np.zeros((n, 3)), np.zeros((n, 3))
    steps = list(tokens.steps(order, size))
    lse = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for t, (_, at) in enumerate(steps):
        ahead[at] = emit[at] + (moves[3] if t == 0 else lse(ahead[at - 1][:, :, None] + moves[None, :3], 1))
    for t in range(len(steps) - 2, -1, -1):
        at = steps[t + 1][1]
        behind[at - 1] = lse(moves[None, :3] + (emit[at] + behind[at])[:, None, :], 2)
    last = tokens.lines + size - 1
    total = np.repeat(lse(ahead[last], 1), size)
    expected = np.exp(ahead + behind - total[:, None])
    move = np.zeros((4, 3))
    move[3] = expected[tokens.lines].sum(axis=0)
    inner = np.ones(n, bool)
    inner[tokens.lines] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] + moves[None, :3] + (emit[at] + behind[at])[:, None, :] - total[at][:, None, None]
    move[:3] = np.exp(joint).sum(axis=0)
    expected[np.arange(n), tags] -= 1
    np.subtract.at(move, (np.full(len(tokens.lines), 3), tags[tokens.lines]), 1)
    np.subtract.at(move, (tags[at - 1], tags[at]), 1)
    return expected, move


def _cut(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of whole lines, of about PIECE bytes; a longer line is cut at a blank, or anywhere."""
    start = 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        if end < len(data):
            for mark in (b"\n", b" "):
                if (at := data.rfind(mark, start, end)) > start:
                    end = at + 1
                    break
        yield start, data[start:end]
        start = end


def _points(data: bytes) -> np.ndarray:
    """Code points before each byte."""
    return np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]


def _labelled(text: str) -> list[tuple[Tokens, np.ndarray]]:
    data = text.encode("utf-8", "surrogatepass")
    points, spans, out = _points(data), base_spans(text), []
    for start, piece in _cut(data):
        tokens = Tokens(np.frombuffer(piece, np.uint8), len(data))
        tags = np.zeros(len(tokens.start), np.int64)
        first, last = points[tokens.start + start], points[tokens.end + start]
        for s, _, e in spans:
            hit = np.flatnonzero((first < e) & (last > s))
            # Spans may touch in one token, which then begins one.
            tags[hit[1:]] = np.where(tags[hit[1:]] == BEGIN, BEGIN, INSIDE)
            tags[hit[:1]] = BEGIN
        tags[tokens.lines] = np.where(tags[tokens.lines] == INSIDE, BEGIN, tags[tokens.lines])  # a long line is several sequences
        out.append((tokens, tags))
    return [x for x in out if len(x[1])]


def train(texts: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weights by feature and tag, and moves from tag to tag (row 3: start of a line)."""
    weights, moves = np.zeros((FEATURES, 3)), np.zeros((4, 3))
    moves[[OUTSIDE, 3], INSIDE] = -8.0
    w_sum, m_sum = np.full((FEATURES, 3), 1e-3), np.full((4, 3), 1e-3)
    rng = np.random.default_rng(seed)
    docs = [part for text in texts for part in _labelled(text)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            batch = [docs[i] for i in order[at : at + BATCH]]
            tokens, tags = Tokens.together([t for t, _ in batch]), np.concatenate([g for _, g in batch])
            expected, move = _gradient(tokens, tags, weights, moves)
            ids, wide = tokens.features.ravel(), tokens.features.shape[1]
            grad = np.stack([np.bincount(ids, np.repeat(expected[:, k], wide), minlength=FEATURES) for k in range(3)], axis=1)
            w_sum += grad * grad
            m_sum += move * move
            weights -= RATE * grad / np.sqrt(w_sum)
            moves -= RATE * move / np.sqrt(m_sum)
    return weights.astype(np.float32), moves.astype(np.float32)


def scan(texts: list[str], weights: np.ndarray, moves: np.ndarray) -> list[tuple[list, list]]:
    """For each text its base spans, and the spans that the field adds. Texts are tagged in step."""
    tagged: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    may_hex, waiting, held = [False] * len(texts), [], 0

    def tag() -> None:
        tags = viterbi(Tokens.together([t for _, _, t in waiting]), weights, moves)
        at = 0
        for i, start, tokens in waiting:
            own = tags[at : at + len(tokens.start)]
            # A run goes on with the tokens inside, up to the end of its sequence.
            inside = own == INSIDE
            inside[tokens.lines] = False
            heads = np.flatnonzero((own != OUTSIDE) & ~(inside & np.r_[False, own[:-1] != OUTSIDE]))
            stops = np.flatnonzero(~(inside & np.r_[False, own[:-1] != OUTSIDE]))
            for k in heads:
                after = np.searchsorted(stops, k, side="right")
                last = (int(stops[after]) if after < len(stops) else len(own)) - 1
                tagged[i].append((start + int(tokens.start[k]), start + int(tokens.end[k]), start + int(tokens.end[last])))
            at += len(tokens.start)
        waiting.clear()

    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        may_hex[i] = len(data) > PIECE  # a run of hex digits may be cut with its line
        for start, piece in _cut(data):
            tokens = Tokens(np.frombuffer(piece, np.uint8), len(data))
            if len(tokens.start):
                may_hex[i] |= bool(tokens.hexes.max() >= 16)
                waiting.append((i, start, tokens))
                held += len(piece)
            if held >= PIECE:
                tag()
                held = 0
    if waiting:
        tag()
    return [(base := base_spans(text, h), _added(text, t, base)) for text, h, t in zip(texts, may_hex, tagged)]


def _added(text: str, tagged: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the tagged runs (start, end of the first token, end of the last) in code points."""
    if not tagged:
        return []
    points, added = _points(text.encode("utf-8", "surrogatepass")), []
    for s, first, last in tagged:
        parts = [m.span() for m in BODY.finditer(text, int(points[s]), int(points[last]))]
        if last > first and parts:  # one secret, whatever parts its tokens
            parts = [(parts[0][0], parts[-1][1])]
        for a, b in parts:
            if b - a >= LEAST and all(b <= c or a >= d for c, _, d in base):
                added.append((a, b))
    return added


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    at = F.xxhash64(F.lit(7), docs[id_col].cast("string"))
    texts = docs.select(
        doc_key(docs[id_col]).alias("d"), text_hash(docs[text_col]).alias("h"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), at.alias("at"),
    )
    keys = texts.select("at", "d", "h", F.length("text").alias("n"))
    sample = bounded_sample(keys, texts.drop("at"), SAMPLE_ROWS, SAMPLE_BYTES).select("at", "text", F.lit(0).alias("one"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "text"])
        weights, moves = train(rows["text"].tolist())
        return pd.DataFrame({"weights": [weights.tobytes()], "moves": [moves.tobytes()]})

    model = sample.groupBy("one").applyInPandas(fit, "weights binary, moves binary").collect()  # one model
    weights = np.frombuffer(model[0]["weights"], np.float32).reshape(FEATURES, 3) if model else np.zeros((FEATURES, 3), np.float32)
    moves = np.frombuffer(model[0]["moves"], np.float32).reshape(4, 3) if model else np.zeros((4, 3), np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((weights, moves))
    names = [name for name, *_ in PATTERNS]

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, m = shared.value
        for texts in batches:
            out = []
            for base, added in scan([value or "" for value in texts.to_pylist()], w, m):
                every = sorted([*base, *((s, len(names), e) for s, e in added)])
                written = lambda spans: ",".join(f"{[*names, 'crf'][k]}:{s}:{e}" for s, k, e in spans)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append(
                    dict(zip(("n_assign", "n_access", "n_hex"), counts))
                    | {"base_sha256": hashlib.sha256(written(base).encode()).hexdigest(), "spans": written(every)}
                )
            yield pa.array(out, pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]))

    searched = F.arrow_udf(search, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return docs.select(docs[id_col].alias("doc_id"), searched(docs[text_col].cast("string")).alias("_found")).select("doc_id", "_found.*")

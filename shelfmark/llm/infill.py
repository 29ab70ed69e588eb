"""Fill-in-middle transformation of texts by in-place block rotation.

A text's bytes are put into one bytearray with the sentinels at the cuts, in the order prefix, middle,
suffix. Adjacent segments are then exchanged where they lie by three reversals (each segment, then both
together); undoing the same rotation and taking the sentinels out gives the text back, byte by byte.
Reversed bytes are never read as characters, so segments of any script survive.

Cuts are code points. They are scanned in the UTF-8 bytes (bytes that do not continue a character), so no
list of characters is built. The random numbers come from the SHA-256 of the id, hence every run agrees.

Data movement: none; each row is read, rewritten and returned by the task that holds it. Rows are taken one at a time
out of their batch, so a task holds one text and its copy besides the batch.

Defined results: null text is empty, and an empty text is plain; a text that holds a sentinel is plain; a null id
draws its numbers from ``<seed>:`` alone; repeated rows are cut alike; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of texts that are cut at all, and of those that put the suffix first.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
#: Rows are written out once their texts have this many bytes.
OUT_BYTES = 1 << 23


def draw(doc_id: int | None, seed: str = "1") -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that belong to the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def reverse(buffer: bytearray, start: int, end: int) -> None:
    buffer[start:end] = buffer[start:end][::-1]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the segments [start, cut) and [cut, end) where they lie."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, end)
    reverse(buffer, start, end)


def character_starts(data: bytes) -> np.ndarray:
    """Byte offset of every code point, and the length."""
    at = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(at, len(data))


def cut_text(data: bytes, numbers: tuple[int, int, int, int], cut_percent: int = CUT_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT) -> tuple[str, int, int | None, int | None, bytes]:
    """(form, n, prefix_chars, middle_chars, output) of a text in UTF-8."""
    starts = character_starts(data)
    n = len(starts) - 1
    h1, h2, h3, h4 = numbers
    if not n or h3 % 100 >= cut_percent or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", n, None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m = int(starts[first]), int(starts[second])
    buffer = bytearray(data)
    for at, sentinel in ((m, SUFFIX), (p, MIDDLE), (0, PREFIX)):  # from the end, so that offsets hold
        buffer[at:at] = sentinel
    p, m = p + len(PREFIX), m + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < suffix_first else "psm"
    # <P>prefix <M>middle <S>suffix: the suffix moves before the middle, or before both.
    rotate(buffer, 0 if form == "spm" else p, m, len(buffer))
    return form, n, first, second - first, bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The exact text of an output; sentinels occur once each, as no text that is cut holds one."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    suffix, last = buffer.find(SUFFIX), buffer.find(PREFIX if form == "spm" else MIDDLE)
    # The suffix lies before the other segment; rotating them again puts it last.
    rotate(buffer, suffix, last, len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.find(sentinel)
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


CUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes; ``weight`` is the place of the large column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[weight]) + 64
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
    cut_percent: int = CUT_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
                for doc_id, text in zip(ids, texts):
                    form, n, prefix, middle, out = cut_text(text.as_py() or b"", draw(doc_id, seed), cut_percent, suffix_first)
                    yield doc_id, n, form, prefix, middle, out

        return _batches(rows(), schema, 5)

    narrow = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(cut, CUT_SCHEMA)


def restore(cut_docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), form_col: str = "form", output_col: str = "output") -> DataFrame:
    """The columns ``keep`` and ``text``, rebuilt from form and output alone."""
    rebuilt = F.arrow_udf(_rebuild, "string")
    return cut_docs.select(*keep, rebuilt(cut_docs[form_col], cut_docs[output_col]).alias("text"))


def _rebuild(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for forms, outputs in columns:
        outputs = outputs.cast(pa.binary())
        yield pa.array([restore_text(o.as_py(), f) for f, o in zip(forms.to_pylist(), outputs)], pa.binary()).cast(pa.string())


def fill_in_middle_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    cut_docs = fill_in_middle(docs, id_col, text_col)
    back = restore(cut_docs, (*[c for c in cut_docs.columns if c != "output"], "output"))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )

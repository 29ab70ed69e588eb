"""The fill-in-middle transformation against slices of the text, and its inversion."""

from __future__ import annotations

import hashlib
import random

import corpora
import pytest

from shelfmark.llm import infill


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", n, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", n, a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", n, a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_every_row_by_slices(spark):
    texts = [r[:2] for r in corpora.rows()] + [(1000 + i, t) for i, t in enumerate(["a<P>b", "<S", "<<<S", "x<M", "🙂é\n" * 50, "\x00", ">S<" * 9])]
    texts += [(2000 + i, "".join(random.Random(i).choice("<PSM>é🙂 a") for _ in range(i % 40))) for i in range(300)]
    data = [(i, t, None, None, None, None, None, None, None) for i, t in texts]
    cut = infill.fill_in_middle(corpora.frame(spark, data))
    got = sorted(map(str, map(tuple, cut.collect())))
    assert got == sorted(str((i, *((e := expected(i, t))[1], e[0], *e[2:]))) for i, t in texts)
    assert {r["form"] for r in cut.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    back = infill.restore(cut, ("doc_id", "form"))
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in back.collect()])) == sorted(str((i, t or "")) for i, t in texts)


def test_rotation_of_any_cut():
    for n in range(6):
        for a in range(n + 1):
            for b in range(a, n + 1):
                buffer = bytearray(range(n))
                infill.rotate(buffer, a, b, n)
                assert list(buffer) == [*range(a), *range(b, n), *range(a, b)]
                infill.rotate(buffer, a, a + n - b, n)
                assert list(buffer) == list(range(n))


def test_a_long_text_and_batches(spark, monkeypatch):
    long = "é🙂 word\n" * 400_000
    got = infill.fill_in_middle_digests(spark.createDataFrame([(7, long)], "doc_id long, text string")).first()
    form, n, p, m, out = expected(7, long)
    assert (got["form"], got["n"], got["prefix_chars"], got["middle_chars"]) == (form, n, p, m)
    assert got["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
    assert got["restored_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    monkeypatch.setattr(infill, "OUT_BYTES", 100)
    schema = infill.pa.schema([("a", infill.pa.int64()), ("t", infill.pa.string())])
    parts = list(infill._batches(((i, b"x" * 60) for i in range(5)), schema, 1))
    assert [p.num_rows for p in parts] == [1, 1, 1, 1, 1] and parts[4].column(1)[0].as_py() == "x" * 60


def test_empty_table(spark):
    out = infill.fill_in_middle_digests(corpora.empty(spark))
    assert out.count() == 0 and "restored_sha256" in out.columns


@pytest.mark.parametrize("cut,first,form", [(0, 0, "plain"), (100, 100, "spm"), (100, 0, "psm")])
def test_shares_are_parameters(cut, first, form):
    assert infill.cut_text(b"some text", infill.draw(3), cut, first)[0] == form

"""The Merkle manifest against a tree built by hand."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import corpora

from shelfmark.llm import merkle


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def climb(nodes):
    """Root, and the siblings of every node as (left, right) by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, q in enumerate(at):
            run = q // 3 * 3
            paths[i].append(("".join(nodes[run:q]), "".join(nodes[q + 1 : run + 3])))
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [q // 3 for q in at]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        seen = own
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            seen = leaf(doc_id, source, lang, n_chars, text.replace("\n", ""))
        groups[source].append((doc_id is not None, doc_id or 0, own, doc_id, seen))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        subroot, paths = trees[s]
        for (_, _, own, doc_id, seen), path in zip(sorted(groups[s], key=lambda x: x[:3]), paths):
            node, every = seen, path + top
            for a, b in every:
                node = h(a + node + b)
            out.append((doc_id, own, subroot, root, h("".join(a + b for a, b in every)), node, node == root))
    return sorted(map(str, out))


def found(spark, data, **options):
    rows = merkle.verify_manifest(corpora.frame(spark, data), **options).collect()
    return sorted(str(tuple(r)) for r in rows)


def many(sizes, seed=0):
    rng = random.Random(seed)
    ids = rng.sample(range(-500, 5000), sum(sizes))
    out = []
    for k, n in enumerate(sizes):
        source = [None, "", "b", "é", "a", "zz", "Z"][k % 7] if k < 7 else f"s{k}"
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "no end", "\n", "é🙂\n" * 3])
            out.append((ids.pop(), text, rng.choice([None, "de"]), source, rng.choice([None, 3]), "x", None, "k", "z"))
    rng.shuffle(out)
    return out


def test_nulls_repeated_rows_and_clashing_columns(spark):
    data = corpora.rows()
    assert found(spark, data) == expected(data)


def test_several_rounds_of_small_blocks(spark):
    """Blocks of nine nodes: sources of one to several hundred rows, more sources than a block."""
    data = many([1, 2, 3, 4, 9, 10, 300, 27, 28, 81, 82, 1, 12])
    got = found(spark, data, levels=2)
    assert got == expected(data)
    assert any("True" in r for r in got) and any("False" in r for r in got)


def test_blocks_of_full_size(spark):
    data = many([729, 730, 1, 2200])
    assert found(spark, data) == expected(data)


def test_hot_sources_are_salted(spark, monkeypatch):
    import shelfmark.scale as scale

    data = many([200, 5, 1])
    monkeypatch.setattr(scale.attach, "__defaults__", ("left", 2, None, None))
    assert found(spark, data, levels=1) == expected(data)


def test_lone_row_and_empty_table(spark):
    data = [(5, "a", "de", "s", 1, None, None, None, None)]
    got = merkle.verify_manifest(corpora.frame(spark, data)).first()
    assert got["root"] == got["leaf"] == got["subroot"] and got["proof_sha256"] == h("")
    assert merkle.verify_manifest(corpora.empty(spark)).count() == 0

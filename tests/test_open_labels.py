"""Label documents with unknown fields: scan, edit, write and scan again."""

from __future__ import annotations

import json
import os

from shelfmark.sources import open_labels as O


def read(spark, root):
    rows = O.open_fields(O.scan_open_labels(spark, root)).collect()
    out = {(r["collection_id"], r["stem"], r["field"]): json.loads(r["value"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_an_unknown_field_survives_scan_edit_and_write(spark, tmp_path):
    documents = {
        "7_a_labels.json": {"albumScore": 7, "mood board": {"x": [1, {"y": None}], "é": "ü"}, "images": {"001": {"score": 3, "crop\"s": [1.5, 2]}, "002": {"stars": 4}}},
        "8_labels.json": {"albumNotes": "", "locked": True, "images": {}},
        "10_labels.json": {"images": {"a b": {"n": 12345678901234}, "bad": 3}},
    }
    for name, document in documents.items():
        (tmp_path / name).write_text(json.dumps(document, indent=2, ensure_ascii=False))
    for name, text in {"9_labels.json": "{broken", "11_labels.json": "[1]", "x_labels.json": "{}", "12_other.json": '{"a": 1}'}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "7_b_labels.json").write_text('{"albumScore": 1, "older": "kept"}')
    os.utime(tmp_path / "7_b_labels.json", (1000, 1000))
    fields = O.open_fields(O.scan_open_labels(spark, str(tmp_path)))
    wanted = {
        (7, None, "albumScore"): 7, (7, None, "mood board"): documents["7_a_labels.json"]["mood board"], (7, None, "older"): "kept",
        (7, "001", "score"): 3, (7, "001", 'crop"s'): [1.5, 2], (7, "002", "stars"): 4,
        (8, None, "albumNotes"): "", (8, None, "locked"): True, (10, "a b", "n"): 12345678901234,
    }
    assert read(spark, str(tmp_path)) == wanted
    edits = spark.createDataFrame(
        [(7, "001", '{"score": 5, "notes": "n"}', 1), (7, "001", '{"score": 4}', 3), (7, "001", '{"score": 9, "tags": ["t"]}', 2),
         (8, None, '{"locked": null}', 1), (20, "new", '{"any": {"thing": 1}}', 1), (7, "002", "{oops", 5), (7, "002", "[]", 6)],
        "collection_id long, stem string, document string, seq long",
    )
    edited = O.edit_fields(fields, edits)
    out = str(tmp_path.parent / f"{tmp_path.name}-out")
    O.write_open_labels(edited, out)
    wanted |= {(7, "001", "score"): 4, (7, "001", "notes"): "n", (7, "001", "tags"): ["t"], (8, None, "locked"): None, (20, "new", "any"): {"thing": 1}}
    assert read(spark, out) == wanted
    O.write_open_labels(O.open_fields(O.scan_open_labels(spark, out)), out + "2")
    assert read(spark, out + "2") == wanted


def test_no_documents(spark, tmp_path):
    (tmp_path / "1_labels.json").write_text("")
    assert O.open_fields(O.scan_open_labels(spark, str(tmp_path))).count() == 0

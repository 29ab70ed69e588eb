"""Scans and sinks over small trees of files."""

from __future__ import annotations

import hashlib
import json
import os
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from shelfmark.constants import BROWSE_EXTENSIONS
from shelfmark.functions import media
from shelfmark.operators import packing
from shelfmark.sources import config, creators, files, listing, lookup, packed, publish


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"\0" * 8)) + chunk(b"IEND", b"")


def jpeg(width, height):
    app = b"\xff\xe0\x00\x04ab"
    frame = b"\xff\xc2\x00\x0b\x08" + struct.pack(">HH", height, width) + b"\x01\x01\x11\x00"
    return b"\xff\xd8" + app + frame + b"\xff\xd9"


def webp(width, height):
    body = b"WEBPVP8X" + struct.pack("<I", 10) + b"\0" * 4 + struct.pack("<I", width - 1)[:3] + struct.pack("<I", height - 1)[:3]
    return b"RIFF" + struct.pack("<I", len(body)) + body


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "downloads"
    for folder, name, body in [
        ("7_a", "001.PNG", png(3, 5)),
        ("7_a", "002.jpg", jpeg(640, 480)),
        ("7_a", "003.webp", webp(70000, 9)),
        ("7_a", "004.gif", b"GIF89a" + struct.pack("<HH", 11, 12) + b"\x3b"),
        ("7_a", "note.txt", b"x"),
        ("8_b", "001.png", png(3, 5)[:-4]),
        ("8_b", "002.bmp", b"BM" + struct.pack("<I", 54) + b"\0" * 12 + struct.pack("<ii", 21, 22) + b"\0" * 28),
        ("9_c", "x.md", b""),
    ]:
        (root / folder).mkdir(parents=True, exist_ok=True)
        (root / folder / name).write_bytes(body)
    return root


def test_scan_items(spark, tree):
    found = files.scan_items(spark, str(tree))
    assert sorted((r.folder, r.stem, r.extension) for r in found.collect()) == [
        ("7_a", "001", ".png"),
        ("7_a", "002", ".jpg"),
        ("7_a", "003", ".webp"),
        ("8_b", "001", ".png"),
    ]
    assert "content" not in found.columns
    assert files.scan_items(spark, str(tree), BROWSE_EXTENSIONS).count() == 6


def test_headers_and_broken(spark, tree):
    found = files.scan_items(spark, str(tree), BROWSE_EXTENSIONS, content=True)
    sized = found.select("folder", "stem", media.header_size("content").alias("s"), media.is_broken("content").alias("b"))
    got = {(r.folder, r.stem): (r.s.width, r.s.height, r.b) for r in sized.collect()}
    assert got == {
        ("7_a", "001"): (3, 5, False),
        ("7_a", "002"): (640, 480, False),
        ("7_a", "003"): (70000, 9, False),
        ("7_a", "004"): (11, 12, False),
        ("8_b", "001"): (3, 5, True),
        ("8_b", "002"): (21, 22, False),
    }
    other = spark.createDataFrame([(bytearray(b"nothing"),), (bytearray(b""),), (None,)], "c binary")
    assert [tuple(r.s) + (r.b,) for r in other.select(media.header_size("c").alias("s"), media.is_broken("c").alias("b")).collect()] == [(0, 0, True)] * 3


def test_listing_by_tasks_finds_what_the_scan_finds(spark, tree, monkeypatch):
    (tree / "7_a" / "deep" / "er").mkdir(parents=True)
    (tree / "7_a" / "deep" / "er" / "é 1.PNG").write_bytes(b"12345")
    (tree / "_temporary").mkdir()
    (tree / "_temporary" / "5.png").write_bytes(b"1")
    monkeypatch.setattr(listing, "ENTRIES", 2)
    for root in (str(tree), f"file://{tree}/"):
        listed = listing.list_items(spark, root, BROWSE_EXTENSIONS, tasks=3)
        scanned = files.scan_items(spark, root, BROWSE_EXTENSIONS)
        assert listed.columns == scanned.columns
        assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, scanned.collect())) and listed.count() == 7
    assert listing.list_items(spark, str(tree / "none")).count() == 0


def test_jpeg_sizes_in_the_jvm_and_beyond(spark):
    frame = lambda w, h: b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", h, w) + b"\x01\x01\x11\x00"
    segment = b"\xff\xe1\x00\x05abc"
    table = b"\xff\xc4\x00\x04ab"
    images = [
        b"\xff\xd8" + segment * n + filler + table + frame(300 + n, 200) + b"\xff\xd9" for n in (0, 1, 5, 61, 62, 63, 64, 200) for filler in (b"", b"\xff\xff\xff")
    ] + [b"\xff\xd8\xff", b"\xff\xd8" + segment, b"\xff\xd8" + segment + b"junk" * 9, b"\xff\xd8\xff\xe1\xff\xffshort", b"\xff\xd8" + frame(1, 2)[:8]]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(images)], "i int, c binary")
    got = {r[0]: (r[1]["width"], r[1]["height"]) for r in df.select("i", media.header_size("c")).collect()}
    assert got == {i: media.jpeg_size(b) for i, b in enumerate(images)}
    assert sum(w > 0 for w, _ in got.values()) == 16
    sent = df.select(F.sum((media.is_jpeg(F.col("c")) & media.jpeg_walk(F.col("c"))["open"]).cast("int"))).first()[0]
    assert 0 < sent < 9


def test_scan_metadata(spark, tmp_path):
    docs = {
        "7_a": '{"album_id": 7, "title": "t", "model_name": "n", "tags": ["x"], "girl_id": 3, "image_count": 2}',
        "8_b": '{"album_id": "8",\n "title": "u"}',
        "9_c": '{"title": "v"}',
        "10_d": "{broken",
    }
    for folder, text in docs.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "metadata.json").write_text(text)
    (tmp_path / "11_e").mkdir()
    got = {r.folder: r for r in files.scan_metadata(spark, str(tmp_path)).collect()}
    assert {f: r.collection_id for f, r in got.items()} == {"7_a": 7, "8_b": 8, "9_c": 9}
    assert (got["8_b"].creator_name, got["8_b"].tags, got["8_b"].creator_id) == ("", [], None)


def test_scan_labels(spark, tmp_path):
    def put(name, text, at):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (at, at))

    nested = {"albumScore": 7, "images": {"001": {"ai_score": 5, "ai_factors": {"a": 0.5}, "ai_tags": ["t"]}, "002": {"score": 2}}}
    put("7_a_labels.json", json.dumps(nested), 1000)
    put("7_b_labels.json", '{"albumScore": 3}', 900)
    put("8_labels.json", "{oops", 1000)
    put("9_x.json", '{"albumScore": 1}', 1000)
    docs = files.scan_labels(spark, str(tmp_path))
    assert [(r.collection_id, r.albumScore) for r in docs.collect()] == [(7, 7)]
    items = {r.stem: r for r in files.explode_item_labels(docs).collect()}
    assert items["001"].ai_factors == {"a": 0.5} and items["002"].score == 2 and items["002"].ai_score is None


def test_packed_round_trip(spark, tree, tmp_path):
    scanned = files.scan_items(spark, str(tree), BROWSE_EXTENSIONS)
    items = scanned.select(
        F.col("path").alias("image"), "file_name", F.concat("folder", "stem").alias("item_id"), "bytes"
    )
    assigned = packing.name_shards(packing.assign_shards(items.select("item_id", "bytes"), 0.006))
    rows = items.drop("bytes").join(assigned.select("item_id", "position", "file"), "item_id").withColumn("album_id", F.lit(7).cast("bigint"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second write replaces the first
        packed.write_shards(rows, out, payload="image")
    names = sorted(d for d in os.listdir(out) if d.startswith("file"))
    assert names == [f"file=train-{i:05d}-of-{len(names):05d}.parquet" for i in range(len(names))] and len(names) > 1
    read = packed.read_packed(spark, out).collect()
    assert sorted(r.file_name for r in read) == sorted(r.file_name for r in scanned.collect())
    for r in read:
        with open(r.image.path.removeprefix("file:"), "rb") as f:
            assert bytes(r.image.bytes) == f.read()
    assert packed.read_packed(spark, out, rows=2).count() == 2
    packed.write_sidecar(rows, str(tmp_path / "meta"))
    assert set(spark.read.json(str(tmp_path / "meta")).columns) == {"file_name", "position", "file", "item_id", "album_id"}


def test_shards_are_cut_by_bytes(spark):
    rng = random.Random(5)
    sizes = [rng.choice([0, 10, 500, 3000, 100_000, None]) for _ in range(400)] + [2_000_000]
    items = spark.createDataFrame(list(enumerate(sizes)), "item_id long, bytes long").repartition(7)
    target = 50_000
    rows = sorted(packing.balance_shards(items, target / 1024 / 1024).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(401))
    before, cuts, weight = 0, [], lambda r: (r["bytes"] or 0) + 2000
    for r in rows:
        cuts.append(before // target)
        before += weight(r)
    ranks = {c: i for i, c in enumerate(sorted(set(cuts)))}
    assert [r["shard"] for r in rows] == [ranks[c] for c in cuts]
    for shard in set(ranks.values()):
        own = [weight(r) for r in rows if r["shard"] == shard]
        assert sum(own) < target + own[-1]
    assert packing.balance_shards(items.limit(0), 1.0).count() == 0


def test_files_are_written_and_read_as_payload(spark, tmp_path):
    data = [("a/1.txt", bytearray(b"one")), ("a/2.txt", bytearray(b"")), ("b/é 3.txt", bytearray(b"\x00\xff" * 1000)), ("b/4.txt", None)]
    done = packed.write_files(spark.createDataFrame(data, "path string, payload binary"), str(tmp_path))
    assert {(r["path"].removeprefix(f"{tmp_path}/"), r["bytes"]) for r in done.collect()} == {(p, len(b)) for p, b in data if b is not None}
    for path, payload in data[:3]:
        assert (tmp_path / path).read_bytes() == bytes(payload)
    assert sorted(f.name for f in (tmp_path / "b").iterdir() if not f.name.endswith(".crc")) == ["é 3.txt"]


def _set(spark, texts):
    rows = [(f"{i}.txt", i, f"train-{i % 2:05d}-of-00002.parquet", t.encode()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "file_name string, position long, file string, b binary")
    manifest = df.groupBy(F.col("file").alias("name")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("b")).alias("bytes"))
    return df.withColumn("image", F.struct(F.col("b").alias("bytes"), F.lit("p").alias("path"))).drop("b"), manifest


def test_a_failed_write_leaves_the_published_set(spark, tmp_path):
    root = str(tmp_path / "set")
    seen = lambda: sorted(bytes(r["image"]["bytes"]).decode() for r in publish.read_published(spark, root).collect())
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    old, old_manifest = _set(spark, ["a", "bb", "ccc"])
    first = publish.publish_shards(old, root, old_manifest)
    new, new_manifest = _set(spark, ["x", "yy", "zzz", "w"])
    for wrong in (old_manifest, new_manifest.filter("rows < 0"), new_manifest.withColumn("bytes", F.col("bytes") + 1)):
        with pytest.raises(publish.NotPublished):
            publish.publish_shards(new, root, wrong)
        assert seen() == ["a", "bb", "ccc"]
    with pytest.raises(Exception, match="broken"):
        publish.publish_shards(new.withColumn("title", F.raise_error(F.lit("broken"))), root, new_manifest)
    assert seen() == ["a", "bb", "ccc"] and publish.published(spark, root) == first
    second = publish.publish_shards(new, root, new_manifest)
    assert seen() == ["w", "x", "yy", "zzz"] and second != first
    assert publish.retire(spark, root) >= 1 and seen() == ["w", "x", "yy", "zzz"]
    assert [d for d in os.listdir(root) if d.startswith("version-")] == [second.rpartition("/")[2]]


def test_first_rows_of_a_set_are_those_of_its_first_shard(spark, tmp_path):
    df, manifest = _set(spark, [f"t{i}" for i in range(20)])
    publish.publish_shards(df, str(tmp_path), manifest)
    assert [r["file_name"] for r in publish.read_published(spark, str(tmp_path), rows=4).collect()] == ["0.txt", "2.txt", "4.txt", "6.txt"]


def test_folders_are_not_written_by_every_task(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 5).alias("c"), F.col("id").alias("v")).repartition(16)
    packed.write_documents(df, str(tmp_path / "d"), "c")
    parts = [f for c in range(5) for f in os.listdir(tmp_path / "d" / f"c={c}") if f.startswith("part-")]
    assert len(parts) == 5 and spark.read.json(str(tmp_path / "d")).count() == 2000


def rows_read(df):
    """Rows that the file scans of ``df`` hand on when it runs, before any filter: what row groups and pages leave over."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    final = executed.executedPlan() if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else executed
    leaves = final.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "names")
    names = spark.range(0, 200_000, 1, 8).select(F.format_string("name-%06d", F.col("id") * 2).alias("name"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    lookup.write_lookup(names, path, files=4, group_bytes=1 << 18)
    found = spark.read.parquet(path).filter("name = 'name-123456'")
    assert found.count() == 1 and 0 < rows_read(found) < 30_000
    # Within every range, but in no filter.
    assert rows_read(spark.read.parquet(path).filter("name = 'name-123457'")) == 0
    assert [r["found"] for r in lookup.look_up(spark, path, "name-000004").collect()] == [True]
    assert [(r["name"], r["found"]) for r in lookup.look_up(spark, path, "nobody").collect()] == [("nobody", False)]


def test_missing_payload_is_null(spark):
    df = spark.createDataFrame([("file:/no/such/file.png", 1), (None, 2)], "image string, k int")
    assert [(r.image.bytes, r.k) for r in packed.load_images(df).collect()] == [(None, 1), (None, 2)]


def test_quarantine_sink(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "broken"), (1, 2, "duplicate")], "collection_id int, item int, category string")
    packed.write_quarantine(rows, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).filter("category = 'broken'").count() == 1


def test_creator_cache(spark, tmp_path):
    path = str(tmp_path / "creators")
    creators.append_creators(spark.createDataFrame([(1, "a"), (2, "b")], "creator_id int, name string"), path, 0)
    creators.append_creators(spark.createDataFrame([(2, "z"), (3, "c")], "creator_id int, name string"), path, 1)
    creators.append_creators(spark.createDataFrame([(2, "z"), (3, "c")], "creator_id int, name string"), path, 1)
    assert sorted(map(tuple, creators.load_creators(spark, path).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_config(spark, tmp_path):
    built_in = config.load_config(str(tmp_path / "none.yaml"))
    assert config.rubric_frame(spark, built_in).agg(F.round(F.sum("weight"), 6)).first()[0] == 1.0
    assert config.sub_rubric_frame(spark, built_in).count() == 6
    assert config.vocabulary_frame(spark, built_in).count() == 12
    assert config.score_label_frame(spark).count() == 9
    (tmp_path / "c.yaml").write_text(
        "scoring:\n  factors:\n    a: {weight: 0.5}\n  story_modifier: {key_frame_bonus: 0.3, filler_penalty: -0.2}\ntag_categories:\n  k: [x, y]\n"
    )
    own = config.load_config(str(tmp_path / "c.yaml"))
    assert own["factors"]["a"]["weight"] == 0.5 and own["modifier"]["key_frame_bonus"] == 0.3
    assert [r.tag for r in config.vocabulary_frame(spark, own).orderBy("tag_pos").collect()] == ["x", "y"]


def test_packed_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """A scan plans every file on the driver and gives a task few of them; the listing finds the same files."""
    from shelfmark.plans import relational as plans

    def scanned(*_, **__):
        raise AssertionError("a scan of all files")

    monkeypatch.setattr(plans.files, "scan_items", scanned)
    texts = [(i, None if i == 7 else f"text {i} é" * (i % 5), None if i == 3 else f"src{i % 4}", "de", 1) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    found = plans.pack_files(spark, str(tmp_path)).collect()
    data = {i: t.encode() for i, t, *_ in texts if t is not None}
    wanted = [(None if i == 3 else i % 4, f"{i:03d}.txt", hashlib.md5(b).hexdigest(), len(b)) for i, b in data.items()]
    assert sorted(map(tuple, found), key=lambda r: r[1]) == sorted(wanted, key=lambda r: r[1])

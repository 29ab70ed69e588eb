"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

from oracle import plan_of

from shelfmark.plans import catalog




def scanned(plan: str) -> set[str]:
    return set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))


def test_columns_are_pruned(spark, sf_dir):
    assert scanned(plan_of(catalog.QUERIES["todo_items"](spark, sf_dir))) == {
        "doc_id:bigint,source:string",
        "doc_id:bigint,quality:int",
    }
    assert scanned(plan_of(catalog.QUERIES["sample_per_group"](spark, sf_dir))) == {"doc_id:bigint,source:string"}


def test_filters_are_pushed(spark, sf_dir):
    assert "EqualTo(toxic,1)" in plan_of(catalog.QUERIES["labeled"](spark, sf_dir))


def test_samples_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["sample_per_group"](spark, sf_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_bytes_are_not_read_by_the_item_scan(spark, sf_dir):
    assert "content" not in plan_of(catalog.QUERIES["scan_items"](spark, sf_dir)).split("ReadSchema")[1]


def test_page_expressions_do_not_shuffle(spark, sf_dir):
    for name in ("page_title", "page_tags", "page_media_urls", "verdict_parse", "rubric_sub_score", "fenced_json"):
        assert "Exchange" not in plan_of(catalog.QUERIES[name](spark, sf_dir)), name


def test_packing_from_buckets_moves_nothing(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["pack_buckets"](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert len(set(re.findall(r"SelectedBucketsCount: (\d+ out of \d+)", plan))) == 1

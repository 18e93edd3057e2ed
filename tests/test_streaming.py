"""Incremental landing: each run lands only the files that arrived since the last run."""

from __future__ import annotations

import json

from conftest import SAMPLE_HOLIDAYS

from sheetmill.sources import files
from sheetmill.streaming.landing import bank_holidays_from_payload, land_new_files


def test_land_new_files_is_incremental(spark, tmp_path, root):
    landing = tmp_path / "landing"
    landing.mkdir()
    ckpt = str(tmp_path / "ckpt")
    (landing / "a.json").write_text(json.dumps(SAMPLE_HOLIDAYS))
    land_new_files(spark, str(landing), root, "example", glob="*.json", checkpoint_location=ckpt)
    (landing / "b.json").write_text(json.dumps({"scotland": SAMPLE_HOLIDAYS["scotland"]}))
    land_new_files(spark, str(landing), root, "example", glob="*.json", checkpoint_location=ckpt)
    hist = files.read_historical(spark, root, "bronze", "example", "file")
    assert sorted(r["filename"] for r in hist.collect()) == ["a.json", "b.json"]
    assert hist.select("batch").distinct().count() == 2
    assert [r["filename"] for r in files.read_latest(spark, root, "bronze", "example", "file").collect()] == ["b.json"]


def test_stream_to_silver(spark, tmp_path, root):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(SAMPLE_HOLIDAYS))
    land_new_files(spark, str(landing), root, "example", glob="*.json", checkpoint_location=str(tmp_path / "c2"), transform=bank_holidays_from_payload, layer="silver", table="bank_holidays")
    assert files.read_latest(spark, root, "silver", "example", "bank_holidays").count() == 3


def test_backlog_is_split_into_bounded_batches(spark, tmp_path, root):
    """Three waiting files with at most one per trigger: three batches, every file landed once."""
    landing = tmp_path / "landing"
    landing.mkdir()
    for name in ("a", "b", "c"):
        (landing / f"{name}.json").write_text(json.dumps(SAMPLE_HOLIDAYS))
    land_new_files(spark, str(landing), root, "backlog", glob="*.json", checkpoint_location=str(tmp_path / "c3"), max_files_per_trigger=1)
    hist = files.read_historical(spark, root, "bronze", "backlog", "file")
    assert sorted(r["filename"] for r in hist.collect()) == ["a.json", "b.json", "c.json"]
    assert hist.select("batch").distinct().count() == 3
    latest = files.read_latest(spark, root, "bronze", "backlog", "file")
    assert sorted(r["filename"] for r in latest.collect()) == ["a.json", "b.json", "c.json"]


def test_lost_checkpoint_cannot_overwrite_older_versions(spark, tmp_path, root):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(SAMPLE_HOLIDAYS))
    for n in range(2):
        land_new_files(spark, str(landing), root, "lost", glob="*.json", checkpoint_location=str(tmp_path / f"lost{n}"))
    assert files.read_historical(spark, root, "bronze", "lost", "file").select("batch").distinct().count() == 2


def test_publish_removes_its_staged_copy(spark, tmp_path, root):
    from sheetmill.sources import medallion

    medallion.publish(spark.range(3), root, "silver", "d", "t", "v", "1")
    staging = [p for p in (tmp_path / "lake").rglob("*.parquet") if "_staging" in str(p)]
    assert not staging

"""Publishing by commit records: readers and dying writers always see one whole version."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.operators.contracts import Contract, ContractError, Field, isin
from sheetmill.sources import commits, files, medallion
from sheetmill.streaming import landing


class Killed(BaseException):
    """Not an Exception: nothing in the library may catch it, like a killed process."""


def table(spark, tag, n=40):
    return spark.range(n).select("id", F.lit(tag).alias("tag")).repartition(4)


def seen(spark, root):
    rows = files.read_latest(spark, root, "silver", "d", "t").collect()
    return {r["tag"] for r in rows}, len(rows)


def kill_at(monkeypatch, owner, name, nth):
    """Let the n-th call of a function die before (even) or after (odd steps) it ran."""
    real, calls = getattr(owner, name), [0]

    def dying(*args, **kwargs):
        calls[0] += 1
        if calls[0] == nth // 2 + 1 and nth % 2 == 0:
            raise Killed
        out = real(*args, **kwargs)
        if calls[0] == nth // 2 + 1:
            raise Killed
        return out

    monkeypatch.setattr(owner, name, dying)


STEPS = [(medallion, "write_table", 0), (medallion, "write_table", 1), (commits, "commit", 0), (commits, "numbers", 1), (commits, "_create_once", 0)]


@pytest.mark.parametrize("owner, name, nth", STEPS)
@pytest.mark.parametrize("version", ["v2", "v1"])  # a new version, and the same one again
def test_a_killed_writer_changes_nothing(spark, root, monkeypatch, owner, name, nth, version):
    medallion.publish(table(spark, "old"), root, "silver", "d", "t", "v", "v1")
    with monkeypatch.context() as m:
        kill_at(m, owner, name, nth)
        with pytest.raises(Killed):
            medallion.publish(table(spark, "new", 7), root, "silver", "d", "t", "v", version)
    assert seen(spark, root) == ({"old"}, 40)
    assert files.read_historical(spark, root, "silver", "d", "t").count() == 40
    medallion.publish(table(spark, "newer", 9), root, "silver", "d", "t", "v", version)
    assert seen(spark, root) == ({"newer"}, 9)
    assert files.read_historical(spark, root, "silver", "d", "t").count() == (9 if version == "v1" else 49)


def test_a_writer_killed_after_the_record_has_published(spark, root, monkeypatch):
    medallion.publish(table(spark, "old"), root, "silver", "d", "t", "v", "v1")
    with monkeypatch.context() as m:
        kill_at(m, commits, "_create_once", 1)
        with pytest.raises(Killed):
            medallion.publish(table(spark, "new", 7), root, "silver", "d", "t", "v", "v2")
    assert seen(spark, root) == ({"new"}, 7)


def test_a_reader_keeps_its_version(spark, root):
    medallion.publish(table(spark, "old"), root, "silver", "d", "t", "v", "v1")
    reader = files.read_latest(spark, root, "silver", "d", "t")
    medallion.publish(table(spark, "new", 7), root, "silver", "d", "t", "v", "v1")
    assert {r["tag"] for r in reader.collect()} == {"old"} and reader.count() == 40
    assert seen(spark, root) == ({"new"}, 7)
    assert commits.vacuum(spark, root, "silver", "d", "t") == []  # too young to go
    gone = commits.vacuum(spark, root, "silver", "d", "t", older_than_hours=-1)
    assert len(gone) == 1 and gone[0].startswith("v=v1/run-")
    assert seen(spark, root) == ({"new"}, 7)


def test_racing_writers_both_publish(spark, root, monkeypatch):
    """Another writer takes the number between looking and creating: the next one is used."""
    records = commits.commits_path(root, "silver", "d", "t")
    medallion.publish(table(spark, "a", 3), root, "silver", "d", "t", "v", "v1")
    real, raced = commits._create_once, []

    def raced_once(s, path, text):
        if not raced:
            raced.append(path)
            assert real(s, path, json.dumps({"key": "v", "version": None, "folder": None, "latest": None}))
        return real(s, path, text)

    monkeypatch.setattr(commits, "_create_once", raced_once)
    medallion.publish(table(spark, "b", 4), root, "silver", "d", "t", "v", "v2")
    assert commits.numbers(spark, records) == [0, 1, 2]
    assert seen(spark, root) == ({"b"}, 4)
    assert not commits._create_once(spark, raced[0], "{}")  # a name is given once
    assert commits.read_record(spark, records, 1).latest is None


def test_a_failed_contract_removes_its_data(spark, root, tmp_path):
    strict = Contract("t", (Field("id", T.LongType()), Field("tag", T.StringType(), checks=(isin("tag", ["good"]),))))
    medallion.publish(table(spark, "good"), root, "silver", "d", "t", "v", "v1", contract=strict)
    with pytest.raises(ContractError):
        medallion.publish(table(spark, "bad"), root, "silver", "d", "t", "v", "v2", contract=strict)
    assert seen(spark, root) == ({"good"}, 40)
    left = [p for p in (tmp_path / "lake").rglob("run-*") if list(p.glob("*.parquet"))]
    assert len(left) == 1


def test_versions_keep_odd_characters_and_prune(spark, root):
    for v in ("2031-01-01T00:00:00Z", "a b/c=d%"):
        medallion.publish(table(spark, v, 3), root, "silver", "d", "t", "v", v)
    hist = files.read_historical(spark, root, "silver", "d", "t")
    assert {(r["v"], r["tag"]) for r in hist.collect()} == {(v, v) for v in ("2031-01-01T00:00:00Z", "a b/c=d%")}
    assert medallion.read_version(spark, root, "silver", "d", "t", "v", "a b/c=d%").count() == 3
    assert "v" not in files.read_latest(spark, root, "silver", "d", "t").columns


def test_unpublished_tables_are_not_found(spark, root):
    with pytest.raises(files.SourceNotFound):
        files.read_latest(spark, root, "silver", "d", "none")
    medallion.publish(table(spark, "x"), root, "silver", "d", "t", "v", "v1", set_latest=False)
    with pytest.raises(files.SourceNotFound):
        files.read_latest(spark, root, "silver", "d", "t")
    assert files.read_historical(spark, root, "silver", "d", "t").count() == 40


@pytest.mark.parametrize("dies", ["before latest", "in the second batch"])
def test_landing_recovers_from_a_crash(spark, tmp_path, root, monkeypatch, dies):
    folder, ckpt = tmp_path / "in", str(tmp_path / "ckpt")
    folder.mkdir()
    for name in "abc":
        (folder / f"{name}.json").write_text("{}")
    run = lambda: landing.land_new_files(spark, str(folder), root, "s", glob="*.json", checkpoint_location=ckpt, max_files_per_trigger=1)
    with monkeypatch.context() as m:
        if dies == "before latest":
            m.setattr(medallion, "set_latest_versions", lambda *a, **k: (_ for _ in ()).throw(Killed()))
            with pytest.raises(Killed):
                run()
        else:
            real, n = medallion.land_raw, []

            def failing(*a, **k):
                n.append(1)
                if len(n) == 2:
                    raise RuntimeError("killed")
                return real(*a, **k)

            m.setattr(medallion, "land_raw", failing)
            with pytest.raises(Exception, match="killed"):
                run()
    with pytest.raises(files.SourceNotFound):
        files.read_latest(spark, root, "bronze", "s", "file")
    run()  # no new files
    names = lambda df: sorted(r["filename"] for r in df.collect())
    assert names(files.read_latest(spark, root, "bronze", "s", "file")) == ["a.json", "b.json", "c.json"]
    assert names(files.read_historical(spark, root, "bronze", "s", "file")) == ["a.json", "b.json", "c.json"]
    (folder / "d.json").write_text("{}")
    run()
    assert names(files.read_latest(spark, root, "bronze", "s", "file")) == ["d.json"]
    run()  # nothing new: latest stays
    assert names(files.read_latest(spark, root, "bronze", "s", "file")) == ["d.json"]

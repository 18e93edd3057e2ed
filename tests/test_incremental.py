"""Series over a stream, versions of different schemas, landing by content."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.operators.timeseries import period_over_period
from sheetmill.sources import content, evolution, files, medallion
from sheetmill.streaming import series
from sheetmill.streaming.series import publish_changes

SERIES = "k string, p int, value double"


def _batches(seed: int) -> list[list[tuple]]:
    rng = random.Random(seed)
    return [
        [(k, p, rng.choice([None, 0.0, 1.0, 2.5, 7.0])) for k in ("a", "b", "c") for p in range(5 * n, 5 * n + 5) if rng.random() < 0.7]
        for n in range(4)
    ]


def _run(spark, tmp_path, root, rows, name="s", **how):
    spark.createDataFrame(rows, SERIES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SERIES).parquet(str(tmp_path / "in"))
    publish_changes(stream, root, "d", name, ["k"], ["p"], "value", checkpoint_location=str(tmp_path / "ckpt"), **how)


def _rows(df):
    return sorted((tuple(r[c] for c in ("k", "p", "value", "filled", "change", "pct_change")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", [None, "p div 3"])
def test_batches_equal_the_whole_history(spark, tmp_path, root, split):
    how = {"split_by": F.expr(split)} if split else {}
    batches = _batches(7)
    for rows in batches:
        random.Random(1).shuffle(rows)
        _run(spark, tmp_path, root, rows, **how)
    got = files.read_latest(spark, root, "gold", "d", "s")
    assert got.where("late").count() == 0
    whole = spark.createDataFrame([r for b in batches for r in b], SERIES)
    want = period_over_period(whole, ["k"], ["p"], "value", "change", "pct_change", filled_col="filled")
    assert _rows(got) == _rows(want)


def test_late_rows_and_null_keys(spark, tmp_path, root):
    _run(spark, tmp_path, root, [("a", 1, 1.0), ("a", 3, 4.0), (None, 1, 9.0)])
    _run(spark, tmp_path, root, [("a", 2, 50.0), ("a", 3, 60.0), ("a", 4, 6.0), ("n", 0, 1.0), (None, 0, 8.0)])
    out = files.read_latest(spark, root, "gold", "d", "s")
    got = {(r.k, r.p, r.value): (r.late, r.change, r.pct_change, r.filled) for r in out.collect()}
    assert got[("a", 2, 50.0)] == got[("a", 3, 60.0)] == (True, None, None, None)
    assert got[("a", 4, 6.0)] == (False, 2.0, 50.0, 6.0)  # against period 3 of the first batch
    assert got[("n", 0, 1.0)] == (False, None, None, 1.0)
    assert got[(None, 0, 8.0)] == (False, None, None, 8.0)


def test_run_that_dies_is_made_good(spark, tmp_path, root, monkeypatch):
    """A failure after the version was published and before the tail was written, and one after the tail."""
    batches = [[("a", 1, 1.0)], [("a", 2, None), ("b", 2, 3.0)], [("a", 3, 4.0), ("b", 3, 6.0)]]
    _run(spark, tmp_path, root, batches[0])
    real = series.tail_of
    monkeypatch.setattr(series, "tail_of", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception):
        _run(spark, tmp_path, root, batches[1])
    monkeypatch.setattr(series, "tail_of", real)
    removed = series.remove_path
    monkeypatch.setattr(series, "remove_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception):  # the waiting batch runs again, the next one dies after its tail
        _run(spark, tmp_path, root, batches[2])
    monkeypatch.setattr(series, "remove_path", removed)
    _run(spark, tmp_path, root, [])
    whole = spark.createDataFrame([r for b in batches for r in b], SERIES)
    want = period_over_period(whole, ["k"], ["p"], "value", "change", "pct_change", filled_col="filled")
    assert _rows(files.read_latest(spark, root, "gold", "d", "s")) == _rows(want)


def test_stream_of_nothing(spark, tmp_path, root):
    _run(spark, tmp_path, root, [])
    with pytest.raises(files.SourceNotFound):
        files.read_latest(spark, root, "gold", "d", "s")
    _run(spark, tmp_path, root, [("a", 1, 1.0)])
    assert files.read_latest(spark, root, "gold", "d", "s").count() == 1


# ------------------------------------------------------------------ versions of different schemas


def _publish(spark, root, version, rows, schema):
    medallion.publish(spark.createDataFrame(rows, schema), root, "silver", "d", "t", "published", version)


def test_added_dropped_and_widened_columns(spark, root):
    _publish(spark, root, "v1", [(1, 1.5, dt.date(2020, 1, 1), "x")], "id int, f float, d date, old string")
    _publish(spark, root, "v2", [(1 << 40, 0.1, dt.datetime(2021, 1, 1, 5), True)], "ID bigint, f double, d timestamp_ntz, fresh boolean")
    out = evolution.read_evolved(spark, root, "silver", "d", "t")
    assert dict(out.dtypes) == {"id": "bigint", "f": "double", "d": "timestamp_ntz", "old": "string", "fresh": "boolean", "published": "string"}
    got = {r.published: r for r in out.collect()}
    assert got["v1"][:5] == (1, 1.5, dt.datetime(2020, 1, 1), "x", None)
    assert got["v2"][:5] == (1 << 40, 0.1, dt.datetime(2021, 1, 1, 5), None, True)
    assert [r.ID for r in evolution.read_evolved(spark, root, "silver", "d", "t", ["v2"]).collect()] == [1 << 40]


def test_nested_columns_evolve(spark, root):
    _publish(spark, root, "v1", [([(1,)], {"a": 1}), (None, None)], "s array<struct<a:int>>, m map<string,int>")
    _publish(spark, root, "v2", [([(2, "b"), None], {"a": 1 << 33})], "s array<struct<a:bigint,b:string>>, m map<string,bigint>")
    got = evolution.read_evolved(spark, root, "silver", "d", "t").collect()
    assert sorted(([r.s, r.m] for r in got), key=repr) == sorted(
        [[[Row(a=1, b=None)], {"a": 1}], [None, None], [[Row(a=2, b="b"), None], {"a": 1 << 33}]], key=repr
    )


def test_conflict_names_column_and_versions(spark, root):
    _publish(spark, root, "v1", [((1,),)], "s struct<a:int>")
    _publish(spark, root, "v2", [((2,),)], "s struct<a:bigint>")
    _publish(spark, root, "v3", [(("x",),)], "s struct<a:string>")
    with pytest.raises(evolution.SchemaConflict, match=r"column s\.a: string in v3 .* int in v1; bigint in v2"):
        evolution.read_evolved(spark, root, "silver", "d", "t")
    assert evolution.read_evolved(spark, root, "silver", "d", "t", ["v1", "v2"]).count() == 2


TYPES = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.DateType(), T.TimestampNTZType(), T.StringType(), T.BooleanType(), T.NullType()]


def _join(a, b):
    try:
        return evolution.join_types(a, b)
    except evolution._NoCommonType:
        return None


def test_join_of_types_is_a_lattice():
    for a in TYPES:
        assert _join(a, a) == a
        for b in TYPES:
            ab = _join(a, b)
            assert ab == _join(b, a)
            if ab is not None:
                assert _join(ab, a) == ab and _join(ab, b) == ab
    assert _join(T.LongType(), T.DoubleType()) is None and _join(T.IntegerType(), T.StringType()) is None
    assert _join(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(21, 2)


# ------------------------------------------------------------------ landing by content

FILES = "path string, content binary, metadata map<string,string>"


def _land(spark, root, version, rows):
    return content.land_by_content(spark.createDataFrame(rows, FILES), root, "d", "landed", version)


def _payload_rows(spark, root):
    return content.known_payloads(spark, root, "bronze", "d").count()


def test_second_landing_writes_no_payload(spark, root):
    rows = [("/in/a", b"one", {"s": "x"}), ("/in/b", b"two", None), ("/other/a", b"one", None), ("/in/e", b"", None)]
    assert _land(spark, root, "1", rows) == {"files": 4, "payloads": 3}
    assert _land(spark, root, "2", rows) == {"files": 4, "payloads": 0}
    assert _payload_rows(spark, root) == 3
    manifest = files.read_historical(spark, root, "bronze", "d", "file")
    got = content.with_payload(manifest, root, "d").collect()
    assert len(got) == 8
    want = {p: bytes(c) for p, c, _ in rows}
    assert all(bytes(r.content) == want[r.path] for r in got)
    assert {r.metadata["s"] for r in got if r.metadata} == {"x"}


def test_only_changed_files_are_stored_and_history_stays(spark, root):
    _land(spark, root, "1", [("/in/a", b"one", None), ("/in/b", b"two", None)])
    assert _land(spark, root, "2", [("/in/a", b"new", None), ("/in/b", b"two", None)])["payloads"] == 1
    assert _land(spark, root, "2", [("/in/c", b"three", None)])["payloads"] == 1  # version 2 landed again
    got = content.with_payload(files.read_historical(spark, root, "bronze", "d", "file"), root, "d")
    assert sorted((str(r.landed), r.filename, bytes(r.content)) for r in got.collect()) == [("1", "a", b"one"), ("1", "b", b"two"), ("2", "c", b"three")]
    assert [r.filename for r in files.read_latest(spark, root, "bronze", "d", "file").collect()] == ["c"]


def test_landing_that_dies_references_its_payloads_later(spark, root, monkeypatch):
    real = medallion.publish

    def dies(df, root, layer, dataset, table, *a, **k):
        if table == content.MANIFEST:
            raise RuntimeError("lost")
        return real(df, root, layer, dataset, table, *a, **k)

    monkeypatch.setattr(content.medallion, "publish", dies)
    with pytest.raises(RuntimeError):
        _land(spark, root, "1", [("/in/a", b"one", None)])
    monkeypatch.setattr(content.medallion, "publish", real)
    assert _land(spark, root, "1", [("/in/a", b"one", None)]) == {"files": 1, "payloads": 0}
    assert _land(spark, root, "2", []) == {"files": 0, "payloads": 0}
    assert files.read_latest(spark, root, "bronze", "d", "file").count() == 0


def test_null_content(spark, root):
    assert _land(spark, root, "1", [("/in/a", None, None), (None, b"x", None)])["files"] == 2
    got = content.with_payload(files.read_latest(spark, root, "bronze", "d", "file"), root, "d").collect()
    assert {r.path: r.content and bytes(r.content) for r in got} == {"/in/a": None, None: b"x"}


def test_repeated_rows_share_one_payload(spark, root):
    rows = [("/in/a", b"one", None)] * 50 + [("/in/b", b"two", None)]
    assert _land(spark, root, "1", rows) == {"files": 51, "payloads": 2}
    assert _payload_rows(spark, root) == 2

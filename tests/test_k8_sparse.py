"""K8 on a sparse line-item table: blank sheet cells are filled from the left, and the
registered query still equals its SQL oracle (run here with DuckDB on the same parquet)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

import __spark_entry__ as entry


def test_k8_sparse_matches_oracle(spark, tmp_path):
    rows = []
    for i, (flag, status, part, disc, year) in enumerate(
        [("A", "F", 0, 0.01, 1995), ("A", "F", 0, 0.01, 1997), ("A", "O", 3, 0.09, 1996), ("N", "F", 2, 0.02, 1995), ("R", "O", 1, 0.07, 1997), ("R", "F", 3, 0.0, 1996)]
    ):
        rows.append((i, part, 1, 1, 1.0, 1000.0 * (i + 1), disc, 0.0, flag, status, dt.datetime(year, 6, 1)))
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    sf = tmp_path / "sf"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(sf / "lineitem.parquet"))
    got = entry.queries()["K8_tidy_tariff_tables"](spark, str(sf))
    cols = sorted(got.columns)
    spark_rows = sorted(tuple(r[c] for c in cols) for r in got.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf}/lineitem.parquet/*.parquet')")
    res = con.execute(entry.oracle_sql()["K8_tidy_tariff_tables"])
    names = [d[0] for d in res.description]
    oracle_rows = sorted(tuple(r[names.index(c)] for c in cols) for r in res.fetchall())
    assert len(spark_rows) == len(oracle_rows) == 78 * 3
    for a, b in zip(spark_rows, oracle_rows, strict=True):
        for x, y in zip(a, b, strict=True):
            assert (x is None and y is None) or x == y or (isinstance(x, float) and math.isclose(x, y))
    # a level with line items only in 1995 carries its value into 1996 and 1997
    carried = [r for r in got.collect() if r["payment_method"] == "Standard Credit" and r["fuel"] == "Gas" and r["tariff_component"] == "DF" and r["consumption"] == "Nil consumption"]
    assert sorted((r["period"], r["value"]) for r in carried) == [("Jan 1995 - Dec 1995", 4.0), ("Jan 1996 - Dec 1996", 4.0), ("Jan 1997 - Dec 1997", 4.0)]

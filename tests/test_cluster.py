"""Embedded databases where executors are processes apart."""

import datetime as dt
import decimal
import json
import os
import subprocess
import sys


def on_cluster(shared, query):
    """A query's rows, twice, from executors that are processes apart."""
    run = subprocess.run([sys.executable, os.path.join(os.path.dirname(__file__), "cluster.py"), str(shared), "/root/testdata/sf0.001", query], capture_output=True, text=True, timeout=240)
    found = [json.loads(x.removeprefix("RESULT ")) for x in run.stdout.splitlines() if x.startswith("RESULT ")]
    assert found, run.stderr[-2000:]
    return found[0][1:]


NATIONS = [[["n_regionkey", i], ["n", 5], ["top", 20 + i]] for i in range(5)]


def test_embedded_jdbc_databases_on_a_cluster(tmp_path):
    assert on_cluster(tmp_path, "jdbc_aggregate") == [NATIONS, NATIONS]


def test_odd_rows_through_derby(spark, tmp_path):
    from tablebridge.sources import jdbc

    c = jdbc.connection("derby", {"path": str(tmp_path / "derby"), "create": "true"})
    day, at = dt.date(1999, 1, 2), dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [(1, 'a "quoted", text\nof two lines ', b"\x00\xff", decimal.Decimal("1e-18"), day, at, at, True, 1.5e300), (2, "", b"", None, None, None, None, False, -1.0), (3, *[None] * 8), (4, "null", *[None] * 7)]
    df = spark.createDataFrame(rows, "id int, s string, b binary, d decimal(30,18), day date, at timestamp, wall timestamp_ntz, yes boolean, v double")
    jdbc.write(df, c, "odd", "overwrite", read_write=True)
    assert sorted(map(tuple, jdbc.read(spark, c, "odd").collect())) == sorted(map(tuple, df.collect()))
    jdbc.write(df.where("id = 3").select("s", "id"), c, "odd", read_write=True)
    assert jdbc.read(spark, c, "odd").where("id = 3 and s is null").count() == 2
    jdbc.write(df.where("id > 9"), c, "odd", "overwrite", read_write=True)
    assert jdbc.read(spark, c, "odd").count() == 0


def test_embedded_jdbc_catalogs_on_a_cluster(tmp_path):
    assert on_cluster(tmp_path, "jdbc_agg_pushdown") == [NATIONS, NATIONS]

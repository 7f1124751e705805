"""Inserts into SQLite that tasks prepare, reads in ranges of stored rows, databases made table by table."""

import datetime as dt
import decimal
import os
import sqlite3

import pytest

from tablebridge import catalog
from tablebridge.catalog import open_database
from tablebridge.errors import BridgeError, InvalidOption
from tablebridge.plans import queries, workspace

SF_DIR = "/root/testdata/sf0.001"
ODD = "k long, s string, v double, n int, at timestamp, wall timestamp_ntz, day date, yes boolean, b binary, d decimal(20,2)"


def stored(path, table="t"):
    c = sqlite3.connect(path)
    try:
        return c.execute(f"SELECT *, {', '.join(f'typeof({n})' for n in 'k s v n at wall day yes b d'.split())} FROM {table} ORDER BY k").fetchall()
    finally:
        c.close()


def test_shards_store_what_rows_do(spark, tmp_path, monkeypatch):
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    rows = [(i, *((None,) * 9 if i % 7 == 3 else ("" if i % 2 else "ä\x00", float("nan") if i == 5 else i * 0.5, i, at, at.replace(microsecond=i) if i % 3 else at, dt.date(1, 1, 1 + i % 9), i % 2 == 0, bytes([i]), i))) for i in range(40)]
    df = spark.createDataFrame([(*r[:-1], None if r[-1] is None else decimal.Decimal(r[-1])) for r in rows], ODD).repartition(13)
    seen, found = [], []
    monkeypatch.setattr(catalog.lite, "load_shards", lambda *a, f=catalog.lite.load_shards: seen.append(len(a[2])) or f(*a))
    for name, at_least in (("rows", 1 << 40), ("shards", 0)):
        monkeypatch.setattr(catalog, "SHARDED_BYTES", at_least)
        db = open_database(spark, "sqlite", path=str(tmp_path / f"{name}.sqlite"), read_write=True)
        db.create_external_table("t", df.schema, primary_key=("k",))
        assert db.insert("t", df) == 40
        assert db.insert("t", df.withColumn("n", df.n + 1).where("k < 30"), on_conflict="upsert:(k)") == 30
        with pytest.raises(BridgeError):
            db.insert("t", df.selectExpr("k + 5 as k", "s"))
        assert db.insert("t", df.where("k <> 7"), mode="overwrite") == 39
        with pytest.raises(BridgeError):
            db.insert("t", df, mode="overwrite", on_commit=lambda c: (_ for _ in ()).throw(RuntimeError()))
        assert not [f for f in os.listdir(tmp_path) if "staged" in f]
        found.append(stored(db.options["path"]))
    assert len(found[0]) == 39 and found[0] == found[1] and 1 < max(seen) <= 10 and seen


def test_reads_in_ranges(spark, tmp_path):
    db = open_database(spark, "sqlite", path=str(tmp_path / "r.sqlite"), read_write=True)
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k", "if(id % 3 = 0, null, id) as v")
    db.create_external_table("t", df.schema, primary_key=("k",))
    assert db.table("t", partition_rows=10).count() == 0
    db.insert("t", df)
    db.execute("DELETE FROM t WHERE rowid BETWEEN 300 AND 420")
    whole, cut = db.table("t"), db.table("t", partition_rows=100)
    assert whole.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() == 10
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect())) and cut.count() == 879
    # Frames of their own: Spark keeps filters that it has pushed to a Python source with the frame they were pushed from.
    assert db.table("t", partition_rows=100).where("k > 500 and v is null").count() == db.table("t").where("k > 500 and v is null").count() > 0
    assert [r.k for r in db.table("t", columns=["k"], order_by=[("k", True, True)], limit=3, partition_rows=100).collect()] == [r.k for r in whole.orderBy("k").limit(3).collect()]
    db.create_external_table("u", spark.range(1).withColumnRenamed("id", "rowid").schema)
    with pytest.raises(Exception, match="rowid"):
        db.table("u", partition_rows=10).count()
    with pytest.raises(InvalidOption):
        catalog.duck.DuckDBSource({}).pieces("t", 1)


@pytest.mark.parametrize("name, made", [("agg_pivot", {"orders"}), ("intersect", {"customer", "supplier"})])
def test_only_tables_of_the_query_are_made(spark, tmp_path, monkeypatch, name, made):
    inserted = []
    monkeypatch.setattr(workspace, "_MADE", {})
    monkeypatch.setattr(catalog.Database, "insert", lambda self, table, *a, f=catalog.Database.insert, **b: inserted.append(table) or f(self, table, *a, **b))
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0 and set(inserted) == made
    assert queries.database(spark, SF_DIR, "sales").tables() == ["customer", "orders"]


def test_large_tables_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    df = queries._sales(spark, SF_DIR, "orders", columns=["o_orderkey"])
    assert df.rdd.getNumPartitions() == 15 and df.distinct().count() == 1500

"""Transactions, callbacks, drift, pruned remote reads, aggregates in the database, late data."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge import streaming
from tablebridge.catalog import open_database
from tablebridge.errors import InvalidOption, SchemaMismatch
from tablebridge.federation import federate
from tablebridge.operators.generations import swap_file
from tablebridge.plans import queries
from tablebridge.sources.sqlite import _column

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = T.StructType().add("id", "long").add("name", "string").add("v", "double")


@pytest.fixture(params=["sqlite", "duckdb"])
def db(request, spark, tmp_path):
    d = open_database(spark, request.param, path=str(tmp_path / "w.db"), read_write=True)
    d.create_external_table("t", SCHEMA, primary_key=("id",), indexes="name")
    return d


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_callbacks_are_part_of_the_transaction(db, spark, mode):
    rows = spark.range(10).selectExpr("id", "concat('n', id) as name", "id * 0.5D as v")
    seen = []
    assert db.insert("t", rows, mode=mode, on_commit=lambda c: seen.append(c.execute("SELECT 1").fetchone()[0])) == 10 and seen == [1]

    def fails(c):
        raise RuntimeError("not now")

    with pytest.raises(Exception, match="not now"):
        db.insert("t", rows.withColumn("id", F.col("id") + 100), mode=mode, on_commit=fails)
    assert db.table("t").count() == 10 and db.table("t").agg(F.max("id")).first()[0] == 9
    assert not [n for n in os.listdir(os.path.dirname(db.options["path"])) if "staged" in n]


def test_inserts_run_their_input_once(db, spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    db.declared["t"] = ((), ())
    given = spark.range(50).selectExpr("id", "'x' as name", "1.0D as v").mapInArrow(count, "id long, name string, v double")
    assert db.insert("t", given) == 50 and runs.value == 50
    assert db.insert("t", given.where("false")) == 0


def test_drift_of_columns_keys_and_indexes(db):
    other = T.StructType([*SCHEMA, T.StructField("w", T.IntegerType())])
    key, indexes = db.stored_key("t")
    assert key == ("id",) and [i.columns for i in indexes] == [("name",)]
    db.declared["t"] = (("name",), ())
    found = db.drift("t", SCHEMA)
    assert any("primary key" in x for x in found) and any("index on (name) is not declared" in x for x in found)
    if db.system == "duckdb":
        with pytest.raises(SchemaMismatch):
            db.create_external_table("t", other, primary_key=("id",), indexes="name")
    else:
        assert db.create_external_table("t", other, primary_key=("id",), indexes="name") == ["column w is missing"]
    assert db.create_external_table("t", SCHEMA, primary_key=("id",), indexes="name") == []


def test_a_file_is_there_all_the_time(tmp_path, monkeypatch):
    path, steps, replace = str(tmp_path / "f"), [], os.replace
    swap_file(path, lambda p: open(p, "w").write("one") and None)
    monkeypatch.setattr(os, "replace", lambda a, b: (steps.append(os.path.exists(path)), replace(a, b), steps.append(os.path.exists(path))))
    swap_file(path, lambda p: open(p, "w").write("two") and None)
    assert steps == [True, True] and open(path).read() == "two"


def test_stored_values_that_arrow_refuses():
    for values, t, want in [((1, 2.0, None), T.LongType(), [1, 2, None]), (("a", 1, b"b"), T.StringType(), ["a", "1", "b"]), (("2024-01-02 03:04:05", None), T.DateType(), [dt.date(2024, 1, 2), None]), ((1, 0, None), T.BooleanType(), [True, False, None]), ((1, 2.5), T.DoubleType(), [1.0, 2.5])]:
        from pyspark.sql.pandas.types import to_arrow_type

        assert _column(values, t, to_arrow_type(t)).to_pylist() == want
    with pytest.raises(SchemaMismatch):
        _column((1, 2.5), T.LongType(), to_arrow_type(T.LongType()))


def test_federated_reads_name_their_columns(spark):
    sales, ref = queries.database(spark, SF_DIR, "sales"), queries.database(spark, SF_DIR, "reference")
    spark.range(3).createOrReplaceTempView("orders")
    sql = "SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey"
    df, reads = federate(spark, sql, {"orders": sales, "customer": sales, "nation": ref})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert reads == 3 and df.count() > 0 and "o_totalprice" not in plan and "c_mktsegment" not in plan and "o_custkey" in plan
    assert spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")
    assert federate(spark, "SELECT count(*) AS n FROM orders", {"orders": sales})[1] == 1


def test_joins_are_split_by_context(spark, monkeypatch):
    from tablebridge.catalog import Database
    from tablebridge.federation import RemoteFrame, federated_join

    sent, ask = [], Database.query
    monkeypatch.setattr(Database, "query", lambda self, select: sent.append(select if isinstance(select, str) else select.sql(self.dialect)) or ask(self, select))
    assert queries.federated_split(spark, SF_DIR).count() > 0 and len(sent) == 2
    assert 'INNER JOIN "customer"' in sent[0] and 'INNER JOIN "region"' in sent[1] and "c_name" not in "".join(sent)
    sales = queries.database(spark, SF_DIR, "sales")
    with pytest.raises(InvalidOption):
        federated_join({"a": RemoteFrame.table(sales, "orders"), "b": RemoteFrame.table(queries.database(spark, SF_DIR, "reference"), "nation")}, [], [("a", "o_orderkey")])


def test_aggregates_run_in_the_database(spark):
    df = queries.jdbc_agg_pushdown(spark, SF_DIR)
    assert "PushedAggregates: [COUNT(*)" in df._jdf.queryExecution().executedPlan().toString() or "PushedAggregates" in df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in queries.agg_group(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_late_events_change_nothing(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, start + dt.timedelta(hours=6 * i)) for i in range(40)], "event_id long, ts timestamp_ntz")
    got = {r.start: r.n for r in streaming.append_days(spark, events, str(tmp_path / "s")).collect()}
    assert got == {start + dt.timedelta(days=k): 4 for k in range(9)}


def test_upserts_of_a_stream(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    streaming.upsert_stream(stream, lambda batch, k: seen.append((k, batch.count())), str(tmp_path / "ck")).awaitTermination()
    assert seen == [(0, 5)]

"""Sources, sinks and table operators against small databases."""

import datetime as dt
import decimal
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.catalog import TableFactory, open_database, register
from tablebridge.errors import BridgeError, ConstraintViolation, InvalidOption, ReadOnlyTable, SchemaMismatch, UndefinedTable
from tablebridge.federation import RemoteFrame, federate, join
from tablebridge.operators import merge
from tablebridge.operators.asof import asof_join, range_join
from tablebridge.operators.constraints import drift, validate
from tablebridge.operators.generations import DuckDBGenerations, FolderGenerations, recover, swap_file
from tablebridge.options import Index, parse_on_conflict
from tablebridge.sources import documents as docs
from tablebridge.types import enforce_schema

SCHEMA = "id long, name string, v double"
ROWS = [(1, "a", 1.5), (2, None, -2.0), (3, "c'd", None), (4, "%x_", 0.0)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=["sqlite", "duckdb"])
def db(request, spark, tmp_path):
    d = open_database(spark, request.param, path=str(tmp_path / "x.db"), read_write=True)
    d.create_external_table("t", T._parse_datatype_string(SCHEMA), primary_key=("id",), indexes="name")
    d.insert("t", spark.createDataFrame(ROWS, SCHEMA))
    return d


def test_catalog_and_reads(db, spark):
    assert db.tables() == ["t"] and "main" in db.schemas()
    assert rows(db.table("t")) == sorted(ROWS, key=repr)
    assert db.table("t", columns=["v", "id"]).columns == ["v", "id"]
    assert db.table("t").count() == 4
    assert [r.id for r in db.table("t", order_by=[("v", True, True), ("id", True, True)], limit=2).collect()] == [3, 2]
    # A filter above a limit doesn't move below it.
    assert db.table("t", order_by=[("id", True, True)], limit=2).where("id > 1").count() == 1
    assert rows(db.table("t", partition_column="id", num_partitions=3)) == sorted(ROWS, key=repr)
    assert db.table("t", partition_column="id", num_partitions=4).rdd.getNumPartitions() == 4
    f = TableFactory(spark, db.system, path=db.options["path"])
    assert f.tables() == ["t"] and f.get_table("t").count() == 4


def test_filters_reach_the_database(db):
    df = db.table("t").where("id >= 2 and name is not null")
    assert sorted(r.id for r in df.collect()) == [3, 4]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter isnotnull" not in plan


def test_patterns_reach_the_database(db):
    df = db.table("t").where("name like '\\%x%' or startswith(name, 'A') or endswith(name, \"d\")")
    assert sorted(r.id for r in df.collect()) == [3, 4]
    starts = db.table("t").where("startswith(name, 'c')")
    assert [r.id for r in starts.collect()] == [3] and "StartsWith" not in starts._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]


def test_writes(db, spark):
    more = spark.createDataFrame([(5, "e", 5.0)], SCHEMA)
    assert db.insert("t", more) == 1 and db.table("t").count() == 5
    with pytest.raises(ConstraintViolation):
        db.insert("t", more.union(more))
    with pytest.raises(BridgeError):
        db.insert("t", more)  # the key exists: nothing changes
    assert db.table("t").count() == 5
    db.insert("t", spark.createDataFrame([(5, "new", 6.0), (6, "f", 7.0)], SCHEMA), on_conflict="upsert:(id)")
    assert {(r.id, r.name) for r in db.table("t").where("id >= 5").collect()} == {(5, "new"), (6, "f")}
    db.insert("t", spark.createDataFrame([(5, "old", 6.0)], SCHEMA), on_conflict="do_nothing_all")
    assert db.table("t").where("name = 'old'").count() == 0
    assert db.delete("t", [q.Binary("=", q.Column("id"), q.Literal(6))]).first()["count"] == 1
    assert db.update("t", {"name": q.Literal("z")}, [q.IsNull(q.Column("name"))]).first()["count"] == 1
    assert db.update("t", {}).first()["count"] == 0
    db.insert("t", spark.createDataFrame([(9, "only", 1.0)], SCHEMA), mode="overwrite")
    assert rows(db.table("t")) == [(9, "only", 1.0)]
    db.insert("t", spark.createDataFrame([(10, "more", 1.0)], SCHEMA))
    assert db.table("t").count() == 2 and db.tables() == ["t"]
    assert db.delete("t").first()["count"] == 2
    for mode in ("replace", "x"):
        with pytest.raises(InvalidOption):
            db.insert("t", more, mode=mode)
    with pytest.raises(SchemaMismatch):
        db.insert("t", more.withColumn("extra", F.lit(1)))
    with pytest.raises(UndefinedTable):
        db.insert("nowhere", more)


def test_read_only(db, spark):
    closed = open_database(spark, db.system, path=db.options["path"])
    with pytest.raises(ReadOnlyTable):
        closed.insert("t", spark.createDataFrame(ROWS, SCHEMA))
    with pytest.raises(ReadOnlyTable):
        closed.execute("DELETE FROM t")
    with pytest.raises(InvalidOption):
        open_database(spark, db.system, path=":memory:")
    with pytest.raises(InvalidOption):
        db.create_external_table("a.b", T._parse_datatype_string(SCHEMA))


def test_types_round_trip(spark, tmp_path):
    schema = "i int, s short, l long, f float, d double, t string, b boolean, n decimal(12,3), day date, at timestamp, wall timestamp_ntz, raw binary, nums array<int>, rec struct<x:int,y:string>"
    row = (1, 2, 3, 0.5, 0.25, "é'\"", True, decimal.Decimal("1.500"), dt.date(1969, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6, tzinfo=dt.UTC), dt.datetime(1960, 1, 1, 1, 1, 1), b"\x00\xff", [1, None], {"x": 1, "y": None})
    df = spark.createDataFrame([row, (None,) * 14], schema)
    for system in ("sqlite", "duckdb"):
        d = open_database(spark, system, path=str(tmp_path / f"{system}.db"), read_write=True)
        d.create_external_table("t", df.schema)
        d.insert("t", df)
        back = d.table("t")
        if system == "sqlite":
            back = docs.decode_json(docs.decode_json(back, "nums", df.schema["nums"].dataType), "rec", df.schema["rec"].dataType)
        back = enforce_schema(back, df.schema)
        assert rows(back) == rows(df), system


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(["id > {n}", "id <> {n}", "name like '%{n}'", "v < {n} or id = 1", "not (id = {n})", "name in ('a', '{n}')", "v is null", "name <=> null", "id between {n} and 3"]), st.integers(-1, 5))
def test_pushed_filters_equal_local_ones(spark, pushed, text, n):
    where = text.format(n=n)
    assert rows(pushed.table("t").where(where)) == rows(spark.createDataFrame(ROWS, SCHEMA).where(where))


@pytest.fixture(scope="module")
def pushed(spark, tmp_path_factory):
    d = open_database(spark, "sqlite", path=str(tmp_path_factory.mktemp("p") / "x.db"), read_write=True)
    d.create_external_table("t", T._parse_datatype_string(SCHEMA))
    d.insert("t", spark.createDataFrame(ROWS, SCHEMA))
    return d


def test_federation(db, spark, tmp_path):
    other = open_database(spark, "sqlite", path=str(tmp_path / "o.db"), read_write=True)
    other.create_external_table("u", T._parse_datatype_string("k long, w string"))
    other.insert("u", spark.createDataFrame([(1, "x"), (3, "y")], "k long, w string"))
    a = RemoteFrame.table(db, "t").where(q.Binary(">", q.Column("id"), q.Literal(1)))
    same = RemoteFrame.table(db, "t").join(a, q.Binary("=", q.Column("id", "a"), q.Column("id", "b")))
    assert same is not None and same.to_df().count() == 3
    assert a.join(RemoteFrame.table(other, "u"), q.Binary("=", q.Column("id", "a"), q.Column("k", "b"))) is None
    assert join(a, RemoteFrame.table(other, "u"), [("id", "k")]).count() == 1
    assert federate(spark, "SELECT count(*) AS n FROM t", {"t": db})[1] == 1
    df, reads = federate(spark, "SELECT count(*) AS n FROM t JOIN u ON id = k", {"t": db, "u": other})
    assert reads == 2 and df.first().n == 2


def test_endpoints(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    register(spark)
    for i in range(3):
        pq.write_table(pa.table({"col1": pa.array([0.5] * 4, pa.float32()), "col2": pa.array([10 * i + k for k in range(4)], pa.int8())}), tmp_path / f"{i}.parquet")
    ends = [{"ticket": f"{i}.parquet", "locations": [str(tmp_path / "down"), str(tmp_path)]} for i in range(3)]
    df = spark.read.format("tablebridge_endpoints").options(endpoints=json.dumps(ends)).load()
    assert df.rdd.getNumPartitions() == 3 and df.count() == 12 and df.agg(F.sum("col2")).first()[0] == 138
    wider = spark.read.format("tablebridge_endpoints").schema("col2 long, more string").options(endpoints=json.dumps(ends)).load()
    assert wider.where("more is null").count() == 12
    down = [{"ticket": "0.parquet", "locations": [str(tmp_path / "down")]}]
    with pytest.raises(Exception, match="no location"):
        spark.read.format("tablebridge_endpoints").schema("col2 long").options(endpoints=json.dumps(down)).load().count()


def test_documents_in_spark(spark, tmp_path):
    lines = ['{"id": 1, "z": {"b": 1, "a": [2, {"y": 1, "x": 2}]}, "n": null, "q\\"k": "v"}', '{"id": 2}', "[1, 2]"]
    p = docs.Projection(T._parse_datatype_string("id long"), "rest")
    got = docs.project(spark.createDataFrame([(x,) for x in lines], "value string"), p).collect()
    for line, r in zip(lines[:2], got, strict=False):
        assert r.rest == docs.project_document(json.loads(line), p)["rest"]
    assert got[2].id is None and json.loads(got[2].rest) == [1, 2]
    path = tmp_path / "c.json"
    path.write_text('{"u": {"name": "a", "age": 3}, "big": 3000000000, "tags": ["x", 1], "bad": "no"}\n{"u": {"name": "b"}, "big": 1, "bad": 5}\n')
    df = docs.read_collection(spark, str(path), depth=1, declared=T._parse_datatype_string("bad int"))
    assert {(f.name, f.dataType.simpleString()) for f in df.schema} == {("bad", "int"), ("big", "bigint"), ("tags", "array<string>"), ("u.age", "int"), ("u.name", "string")}
    assert [(r["u.name"], r["u.age"], r.bad, r.tags) for r in df.collect()] == [("a", 3, None, ["x", "1"]), ("b", None, 5, None)]
    with pytest.raises(SchemaMismatch):
        (tmp_path / "e.json").write_text("")
        docs.read_collection(spark, str(tmp_path / "e.json"))
    flat = docs.unnest(spark.createDataFrame([((1, (2,)),)], "a struct<b:int,c:struct<d:int>>"), 1)
    assert flat.columns == ["a.b", "a.c"]
    with pytest.raises(Exception, match="MALFORMED|malformed|PARSE|BadRecord"):
        docs.decode_json(spark.createDataFrame([("{",)], "j string"), "j", T._parse_datatype_string("array<int>")).collect()


def test_enforce_schema(spark):
    df = spark.createDataFrame([(1, "2", 3)], "a int, b string, extra int")
    want = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert rows(enforce_schema(df, want)) == [(2, 1, None)]
    with pytest.raises(SchemaMismatch):
        enforce_schema(df, T.StructType([T.StructField("c", T.StringType(), False)]))


def test_merges(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (None, "N"), (3, "C")], "k int, v string")
    assert rows(merge.insert(t, new, parse_on_conflict("upsert:(k)"))) == sorted([(1, "a"), (2, "B"), (None, "N"), (3, "C")], key=repr)
    assert rows(merge.insert(t, new, parse_on_conflict("do_nothing:(k)"))) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "C")], key=repr)
    with pytest.raises(ConstraintViolation):
        merge.insert(t, new.union(new), parse_on_conflict("upsert:(k)"))
    stay, n = merge.delete(t, F.col("k") > 1)
    assert rows(stay) == sorted([(1, "a"), (None, "n")], key=repr) and n.first()["count"] == 1
    changed, n = merge.update(t, {"v": F.lit("x"), "k": F.col("k") + 1}, F.col("k") == 1)
    assert (2, "x") in rows(changed) and n.first()["count"] == 1
    assert merge.update(t, {})[1].first()["count"] == 0
    with pytest.raises(ConstraintViolation):
        validate(t.union(t.where("k is null")), [("k",)])


def test_drift():
    a, b = T._parse_datatype_string("x long, y string"), T._parse_datatype_string("x int, z string")
    assert len(drift(a, b, indexes=[Index(("x",))], strict=False)) == 4
    with pytest.raises(SchemaMismatch):
        drift(a, b)
    assert drift(a, a) == []


def test_asof_and_range_joins(spark):
    left = spark.createDataFrame([(1, 10), (1, 5), (2, 1), (1, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 4, "a"), (1, 10, "b"), (2, 7, "c"), (1, 4, "A")], "k int, t int, v string")
    assert rows(asof_join(left, right, "t", ["k"], ["v"])) == sorted([(1, 10, "b"), (1, 5, "a"), (2, 1, None), (1, 1, None)], key=repr)
    p, r = spark.range(0, 50).toDF("x"), spark.createDataFrame([(3, 14), (10, 11), (40, 90)], "lo long, hi long")
    want = sorted((x, lo, hi) for x in range(50) for lo, hi in ((3, 14), (10, 11), (40, 90)) if lo <= x < hi)
    assert sorted(map(tuple, range_join(p, r, "x", "lo", "hi", 8).select("x", "lo", "hi").collect())) == want


def test_generations(spark, tmp_path):
    import duckdb

    path, schema = str(tmp_path / "g.db"), T._parse_datatype_string("id int")
    g = DuckDBGenerations(lambda: duckdb.connect(path), "t", schema, (), (Index(("id",)),))
    assert g.overwrite(lambda c, t: c.execute(f'INSERT INTO "{t}" VALUES (1)').fetchone()[0]) == 1

    def fails(c):
        raise RuntimeError("no")

    with pytest.raises(BridgeError):
        g.overwrite(lambda c, t: c.execute(f'INSERT INTO "{t}" VALUES (2)').fetchone()[0], on_commit=fails)
    with duckdb.connect(path) as c:
        assert c.execute("SELECT id FROM t").fetchall() == [(1,)] and len(g.internal_tables(c)) == 1
    f = FolderGenerations(str(tmp_path / "f"))
    os.makedirs(f.root)
    f.overwrite(spark.range(3))
    os.makedirs(os.path.join(f.root, "g_crashed"))
    assert f.recover() == ["g_crashed"] and f.read(spark).count() == 3


def test_file_swap(tmp_path):
    path = str(tmp_path / "d.db")
    swap_file(path, lambda p: open(p, "w").write("one") and None)
    with pytest.raises(RuntimeError):
        swap_file(path, lambda p: (_ for _ in ()).throw(RuntimeError()))
    assert open(path).read() == "one"
    os.replace(path, path + ".previous")  # a crash between the two renames
    open(path + ".staged.x", "w").close()
    assert recover(path) == "restored the previous file" and open(path).read() == "one" and not os.path.exists(path + ".staged.x")
    assert recover(path) == "nothing"


def test_jdbc(spark, tmp_path):
    from tablebridge.sources import jdbc

    c = jdbc.connection("derby", {"path": str(tmp_path / "derby"), "create": "true"})
    df = spark.createDataFrame([(i, i * 1.5) for i in range(20)], "id int, v double")
    with pytest.raises(ReadOnlyTable):
        jdbc.write(df, c, "nums")
    jdbc.write(df, c, "nums", "overwrite", read_write=True)
    jdbc.write(df.limit(1), c, "nums", "append", read_write=True)
    assert jdbc.read(spark, c, "nums").where("id > 17").count() == 2
    assert jdbc.read(spark, c, "nums", partition=("id", 0, 20, 4)).rdd.getNumPartitions() == 4
    with pytest.raises(InvalidOption):
        jdbc.write(df, c, "nums", "replace", read_write=True)

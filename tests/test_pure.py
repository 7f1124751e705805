"""Options, types, SQL text and predicates, without Spark jobs."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS, parse_reference
from tablebridge.errors import InvalidOption, RemoteFailure, SchemaMismatch, UnsupportedExpression, UnsupportedType, classify
from tablebridge.federation import bind_parameters, no_context, odbc_context, probe_parameters, replace_arguments
from tablebridge.operators.generations import create_index_sql, create_table_sql, create_type_sql
from tablebridge.options import Index, OnConflict, Secret, parse_columns, parse_indexes, parse_on_conflict, strip_prefixes
from tablebridge.predicates import like_to_regex, matches, to_document
from tablebridge.sources.documents import Projection, infer_schema, project_document, unnest_document
from tablebridge.sources.jdbc import catalog_conf, connection
from tablebridge.types import build_schema, merge_schemas, parse_hive_type, remote_type


def test_options():
    assert strip_prefixes({"pg_host": "a", "host": "b", "port": "1"}, "pg") == {"host": "a", "port": "1"}
    assert parse_columns("(b, a)") == ("a", "b") and parse_columns("a") == ("a",)
    for bad in ("(a", "a)", "(a,)", "(a,a)", ""):
        with pytest.raises(InvalidOption):
            parse_columns(bad)
    assert parse_indexes("(b,a):unique;c:enabled") == [Index(("a", "b"), True), Index(("c",))]
    assert Index(("a", "b")).name("t") == "i_t_a_b"
    with pytest.raises(InvalidOption):
        parse_indexes("a:primary")
    quote = DIALECTS["sqlite"].quote
    assert parse_on_conflict("do_nothing_all").sql(quote, ["a"]) == "ON CONFLICT DO NOTHING"
    assert parse_on_conflict("upsert:(a)").sql(quote, ["a", "b"]) == 'ON CONFLICT ("a") DO UPDATE SET "b" = EXCLUDED."b"'
    assert OnConflict("upsert", ("a",)).sql(quote, ["a"]).endswith("DO NOTHING")
    with pytest.raises(InvalidOption, match="colon"):
        parse_on_conflict("upsert;a")
    assert "x1" not in repr(Secret("x1")) and Secret(lambda: "x1").reveal() == "x1"
    assert classify(Exception("database is locked")).retriable and isinstance(classify(Exception("database is locked")), RemoteFailure)


def test_remote_types():
    assert remote_type("postgres", "numeric") == T.DecimalType(38, 20)
    assert remote_type("postgres", "numeric(10,2)[]") == T.ArrayType(T.DecimalType(10, 2))
    assert remote_type("postgres", "_text") == T.ArrayType(T.StringType())
    assert remote_type("postgres", "timestamp with time zone") == T.TimestampType()
    assert remote_type("mysql", "decimal(50,10)") == T.StringType()
    assert remote_type("mysql", "bigint unsigned") == T.DecimalType(20, 0) and remote_type("mysql", "tinyint(1)") == T.BooleanType()
    assert remote_type("mysql", "enum('a','b')") == T.StringType()
    assert remote_type("clickhouse", "Nullable(DateTime64(3))") == T.TimestampType()
    assert remote_type("clickhouse", "Array(Array(String))") == T.ArrayType(T.ArrayType(T.StringType()))
    assert remote_type("clickhouse", "Tuple(Float32, Float32)").names == ["_1", "_2"]
    assert remote_type("duckdb", "STRUCT(a INTEGER, b VARCHAR[])") == T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.StringType()))])
    assert remote_type("sqlite", "DOUBLE") == T.DoubleType() and remote_type("sqlite", "VARCHAR(10)") == T.StringType() and remote_type("sqlite", "") == T.StringType()
    nested = parse_hive_type("array<struct<a:int NOT NULL COMMENT 'x, y',b:map<string,decimal(9,2)>>>")
    assert nested.elementType["a"].nullable is False and nested.elementType["b"].dataType.valueType == T.DecimalType(9, 2)
    for bad in ("array<int", "map<int>", "struct<a>", "array<" * 120 + "int" + ">" * 120):
        with pytest.raises((InvalidOption, UnsupportedType)):
            parse_hive_type(bad)


def test_unsupported_policy():
    columns, said = [("a", "int", True), ("b", "tsvector", True)], []
    with pytest.raises(UnsupportedType):
        build_schema(columns, "postgres")
    assert build_schema(columns, "postgres", "warn", said.append).names == ["a"] and said
    assert build_schema(columns, "postgres", "ignore").names == ["a"]
    assert build_schema(columns, "postgres", "string")["b"].dataType == T.StringType()


def test_merge_schemas():
    a = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("y", T.DateType()), T.StructField("z", T.StringType())])
    assert [(f.name, f.dataType.simpleString()) for f in merge_schemas(a, b)] == [("x", "bigint"), ("y", "date"), ("z", "string")]


def test_select_text():
    s = q.Select("users", ("name",)).filtered(q.Binary("=", q.Column("id"), q.Literal("it's"))).limited(3)
    assert s.sql("duckdb") == 'SELECT "name" FROM "users" WHERE ("id" = \'it\'\'s\') LIMIT 3'
    assert s.sql("mysql") == "SELECT `name` FROM `users` WHERE (`id` = 'it''s') LIMIT 3"
    assert q.Select("t", ()).sql("sqlite") == 'SELECT 1 AS "1" FROM "t"'
    assert s.limited(10).fetch == 3 and s.limited(1).fetch == 1
    assert s.filtered(q.IsNull(q.Column("name"))).sql("duckdb").startswith("SELECT * FROM (SELECT")
    order = q.Select("t").sorted(q.Order(q.Column("a")), q.Order(q.Column("b"), False, True))
    assert order.sql("duckdb").endswith('ORDER BY "a" ASC NULLS FIRST, "b" DESC NULLS FIRST')
    assert order.sql("mysql").endswith("ORDER BY (`a` IS NULL) DESC, `a` ASC, (`b` IS NULL) DESC, `b` DESC")
    assert q.Select("v", arguments=(("name", "x"),)).sql("clickhouse") == "SELECT * FROM `v`(name = 'x')"
    assert parse_reference('a."b.c".d') == ("a", "b.c", "d")


def test_expressions():
    d, c = DIALECTS["duckdb"], q.Column("a")
    assert q.write(q.Not(q.Binary("=", c, q.Literal(1)) | q.IsNull(c)), d) == '(NOT (("a" = 1) OR ("a" IS NULL)))'
    assert q.write(q.InList(c, ()), d) == '("a" <> "a")'
    assert q.write(q.Like(c, "x%", ignore_case=True), DIALECTS["mysql"]) == "(LOWER(`a`) LIKE LOWER('x%'))"
    assert not q.pushable(q.Binary("=", c, q.Subquery(q.Select("t"))), d)
    assert not q.pushable(q.Binary("=", c, q.Literal(float("nan"))), DIALECTS["sqlite"])
    assert d.literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and DIALECTS["sqlite"].literal(True) == "1"
    with pytest.raises(UnsupportedExpression):
        q.write(q.Binary("~", c, c), d)


def test_sqlite_intervals():
    d = DIALECTS["sqlite"]
    assert d.add_interval("x", days=1) == "CAST(date(x, '+1 days') AS TEXT)"
    assert d.add_interval("x", micros=-3_600_000_000) == "CAST(datetime(x, '-3600 seconds') AS TEXT)"
    assert d.add_interval("x", months=-14) == "CAST(date(x, '-1 years', '-2 months') AS TEXT)"
    assert "%f" in d.add_interval("x", micros=1_500_000)


def test_mysql_windows():
    over = q.Over(q.Call("rank", ()), (q.Column("a"),), (q.Order(q.Column("b")),), "ROWS UNBOUNDED PRECEDING")
    assert q.write(over, DIALECTS["mysql"]) == "RANK() OVER (PARTITION BY `a` ORDER BY `b` ASC)"
    assert q.write(over, DIALECTS["duckdb"]).endswith('ORDER BY "b" ASC NULLS FIRST ROWS UNBOUNDED PRECEDING)')
    total = q.Over(q.Call("sum", (q.Column("v"),)), (), (q.Order(q.Column("b")),), "ROWS UNBOUNDED PRECEDING")
    assert q.write(total, DIALECTS["mysql"]) == "SUM(`v`) OVER (ORDER BY `b` ASC ROWS UNBOUNDED PRECEDING)"


def test_definitions():
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("p", T.StructType([T.StructField("x", T.DoubleType())]))])
    assert create_table_sql("t", schema, "sqlite", ("id",)) == 'CREATE TABLE IF NOT EXISTS "t" ("id" BIGINT NOT NULL, "tags" JSON, "p" JSON, PRIMARY KEY ("id"))'
    assert '"tags" TEXT[]' in create_table_sql("t", schema, "postgres") and "struct_t_p" in create_table_sql("t", schema, "postgres")
    assert create_type_sql("t", schema["p"]).startswith('DO $$ BEGIN CREATE TYPE "struct_t_p" AS ("x" DOUBLE PRECISION)')
    assert create_index_sql("t", Index(("a", "b"), True), "duckdb") == 'CREATE UNIQUE INDEX IF NOT EXISTS "i_t_a_b" ON "t" ("a", "b")'
    with pytest.raises(UnsupportedType):
        create_table_sql("t", T.StructType([T.StructField("m", T.MapType(T.StringType(), T.StringType()))]), "postgres")


def test_connections():
    c = connection("postgres", {"pg_host": "h", "pg_db": "d", "pg_user": "u", "pg_pass": "p"})
    assert c.url == "jdbc:postgresql://h:5432/d?sslmode=verify-full" and c.options()["password"] == "p" and "'p'" not in repr(c)
    assert c.context == "postgres://h:5432/d?user=u"
    assert connection("adbc", {"url": "jdbc:x"}).context is None and connection("odbc", {"url": "jdbc:x"}).options()["fetchsize"] == "4000"
    with pytest.raises(InvalidOption):
        connection("mysql", {"host": "h", "sslmode": "maybe"})
    assert catalog_conf("c", c)["spark.sql.catalog.c.pushDownAggregate"] == "true"
    assert no_context() != no_context() and odbc_context("a") == odbc_context("a")


def test_parameters():
    lit = DIALECTS["clickhouse"].literal
    assert replace_arguments("SELECT * FROM v WHERE x = ' from v '", {"v": {"a": 1}}, lit) == "SELECT * FROM v(a = 1) AS v WHERE x = ' from v '"
    assert replace_arguments("SELECT * FROM v AS t JOIN w ON true", {"v": {"a": "b"}}, lit) == "SELECT * FROM v(a = 'b') AS t JOIN w ON true"
    assert probe_parameters("SELECT {a:UInt8}, {b:String}, {c:Nullable(Date)}") == "SELECT 0, '', '1970-01-01'"
    assert bind_parameters("SELECT {a:String}", {"a": "x'y"}, lit) == "SELECT 'x''y'"


def test_like_regex():
    import re

    assert re.match(like_to_regex("a%b_"), "a\n.bz") and not re.match(like_to_regex("a.c"), "abc")
    assert re.match(like_to_regex(r"10\%", "\\"), "10%") and not re.match(like_to_regex(r"10\%", "\\"), "10x")


A, B = q.Column("a"), q.Column("b")
_atoms = st.one_of(
    st.builds(lambda c, op, v: q.Binary(op, c, q.Literal(v)), st.sampled_from([A, B]), st.sampled_from(["=", "<>", "<", "<=", ">", ">="]), st.integers(-2, 2)),
    st.builds(q.IsNull, st.sampled_from([A, B]), st.booleans()),
    st.builds(lambda c, vs, n: q.InList(c, tuple(map(q.Literal, vs)), n), st.sampled_from([A, B]), st.lists(st.one_of(st.none(), st.integers(-2, 2)), max_size=3), st.booleans()),
    st.builds(lambda c, lo, hi, n: q.Between(c, q.Literal(lo), q.Literal(hi), n), st.sampled_from([A, B]), st.integers(-2, 2), st.integers(-2, 2), st.booleans()),
)
_predicates = st.recursive(_atoms, lambda p: st.one_of(st.builds(q.Not, p), st.builds(lambda x, y: x & y, p, p), st.builds(lambda x, y: x | y, p, p)), max_leaves=6)


@given(_predicates, st.lists(st.fixed_dictionaries({}, optional={"a": st.one_of(st.none(), st.integers(-2, 2)), "b": st.one_of(st.none(), st.integers(-2, 2))}), max_size=6))
def test_filter_documents_follow_sql(predicate, rows):
    import sqlite3

    c = sqlite3.connect(":memory:")
    c.execute("CREATE TABLE t (i, a, b)")
    c.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, r.get("a"), r.get("b")) for i, r in enumerate(rows)])
    wanted = {x[0] for x in c.execute(f"SELECT i FROM t WHERE {q.write(predicate, DIALECTS['sqlite'])}")}
    document = to_document(predicate)
    assert {i for i, r in enumerate(rows) if matches(r, document)} == wanted


def test_documents():
    found = infer_schema([{"a": 1, "b": {"c": 1}, "d": "2024-01-01"}, {"a": 2.5, "d": "2024-01-01T05:00:00"}, {"a": None}])
    assert [(f.name, f.dataType.simpleString()) for f in found] == [("a", "double"), ("b", "string"), ("d", "timestamp")]
    assert unnest_document({"a": {"b": {"c": 1}}, "d": 2}, 1) == {"a.b": {"c": 1}, "d": 2}
    with pytest.raises(SchemaMismatch):
        unnest_document({"a": {"b": 1}, "a.b": 2}, 1)
    p = Projection(T.StructType([T.StructField("id", T.LongType())]), "rest")
    assert project_document({"z": 1, "id": 2, "a": {"y": 1, "x": [1]}}, p) == {"id": 2, "rest": '{"a":{"x":[1],"y":1},"z":1}'}
    assert project_document({"id": 2}, p)["rest"] is None and project_document([1, 2], p) == {"id": None, "rest": "[1,2]"}
    with pytest.raises(InvalidOption):
        Projection(T.StructType(), "rest", frozenset({"id"}))

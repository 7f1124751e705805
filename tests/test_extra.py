"""Streams and predicates in Spark."""

import json

from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge import streaming
from tablebridge.catalog import register
from tablebridge.predicates import to_column
from tablebridge.sources.documents import Collection

A = q.Column("a")


def test_predicates_in_spark(spark):
    df = spark.createDataFrame([(1, "x%"), (2, "Y"), (None, None)], "a int, s string")
    cases = [
        (q.Binary("=", A, q.Literal(1)), 1), (~q.Binary("=", A, q.Literal(1)), 1), (q.IsNull(A), 1), (q.InList(A, (q.Literal(1), q.Literal(2)), True), 0),
        (q.InList(A, ()), 0), (q.Between(A, q.Literal(2), q.Literal(5)), 1), (q.Like(q.Column("s"), "y", ignore_case=True), 1), (q.Like(q.Column("s"), "_\\%", escape="\\"), 1),
        (q.Binary("<=>", A, q.Literal(None)), 1), (q.Binary("=", A, q.Literal(1)) | q.IsNull(A), 2), (q.Binary(">", q.Negative(A), q.Literal(-2)), 1),
    ]
    for predicate, n in cases:
        assert df.where(to_column(predicate)).count() == n, predicate


def test_collections(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"_id": "1", "a": 1}\n{"_id": "2"}\n{"_id": "3", "a": 3}\n')
    c = Collection(spark, str(path), T._parse_datatype_string("a int"))
    assert [r._id for r in c.find(~q.Binary("=", A, q.Literal(1)), ["_id"]).collect()] == ["3"]
    assert [r.a for r in c.find(order=[("a", True)], limit=2).collect()] == [None, 1]
    assert c.projection_document([]) == {"_id": 1} and c.projection_document(["a"]) == {"a": 1, "_id": 0}
    assert c.sort_document([("a", False)]) == {"a": -1}
    assert c.filter_document(q.Binary(">", q.Literal(3), A)) == {"a": {"$lt": 3}}


def test_unbounded_endpoints(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    register(spark)
    for i in range(2):
        pq.write_table(pa.table({"x": [i]}), tmp_path / f"{i}.parquet")
    ends = json.dumps([{"ticket": f"{i}.parquet", "locations": [str(tmp_path)]} for i in range(2)])
    stream = spark.readStream.format("tablebridge_endpoints").options(endpoints=ends, unbounded="true").load()
    assert sorted(r.x for r in streaming.run_to_end(stream, str(tmp_path / "out"), "append").collect()) == [0, 1]


def test_events_stream_reads_folders_and_files(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' AS ts")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("part-*.parquet")
    part.rename(tmp_path / "events.parquet")
    for path in (tmp_path / "many" / "events.parquet", tmp_path / "events.parquet"):
        got = streaming.run_to_end(streaming.events_stream(spark, str(path)), str(tmp_path / "out"), "append")
        assert sorted(r.id for r in got.collect()) == list(range(100))

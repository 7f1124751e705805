"""The query catalogue: relational work in Spark over the package's sources, each query with its DuckDB SQL."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge import streaming
from tablebridge.federation import RemoteFrame, bind_parameters, federate, federated_join, join
from tablebridge.functions import dot, money, norm
from tablebridge.operators import merge
from tablebridge.operators.asof import asof_join, range_join
from tablebridge.operators.constraints import violations
from tablebridge.operators.generations import FolderGenerations
from tablebridge.options import parse_on_conflict
from tablebridge.plans.workspace import database, folder, parquet, scratch
from tablebridge.sources import documents as docs
from tablebridge.sources.jdbc import attach_catalog, connection
from tablebridge.sources.jdbc import read as jdbc_read
from tablebridge.sources.jdbc import write as jdbc_write
from tablebridge.types import enforce_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Stored rows that one task reads.
TASK_ROWS = 500_000


def _sales(spark: SparkSession, d: str, table: str, **options) -> DataFrame:
    return database(spark, d, "sales", (table,)).table(table, **{"partition_rows": TASK_ROWS, **options})


def _ref(spark: SparkSession, d: str, table: str, **options) -> DataFrame:
    return database(spark, d, "reference", (table,)).table(table, **{"partition_rows": TASK_ROWS, **options})


# ---- scans


@query("SELECT c_custkey, c_name FROM customer")
def scan_projection(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_name"])


@query("SELECT count(*) AS n FROM orders")
def scan_count_star(s, d):
    return database(s, d, "sales").query(RemoteFrame.table(database(s, d, "sales"), "orders").project().select).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'")
def scan_filter_cmp(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_acctbal", "c_mktsegment"]).where("c_acctbal > 5000 and c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') OR o_orderkey BETWEEN 100 AND 200")
def scan_filter_or_in_between(s, d):
    return _sales(s, d, "orders", columns=["o_orderkey", "o_orderstatus"]).where("o_orderstatus in ('F', 'P') or o_orderkey between 100 and 200").select("o_orderkey", "o_orderstatus")


@query("SELECT p_partkey, p_name FROM part WHERE p_type LIKE 'S%' OR p_brand ILIKE 'brand#1_'")
def scan_like_ilike(s, d):
    return _ref(s, d, "part").where("p_type like 'S%' or p_brand ilike 'brand#1_'").select("p_partkey", "p_name")


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS NULL OR NOT (nullif(c_mktsegment, 'BUILDING') <> 'MACHINERY')")
def scan_null_predicates(s, d):
    rows = _sales(s, d, "customer", columns=["c_custkey", "c_mktsegment"]).select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return rows.where("seg is null or not (seg <> 'MACHINERY')")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def scan_limit_ordered(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_acctbal"], order_by=[("c_acctbal", False, False), ("c_custkey", True, True)], limit=10)


@query("SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer ORDER BY k ASC NULLS FIRST, c_custkey LIMIT 25")
def topk_nulls_first(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_nationkey"]).select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("k")).orderBy(F.col("k").asc_nulls_first(), "c_custkey").limit(25)


@query("SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer ORDER BY k DESC NULLS LAST, c_custkey LIMIT 25")
def topk_nulls_last(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_nationkey"]).select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("k")).orderBy(F.col("k").desc_nulls_last(), "c_custkey").limit(25)


@query("SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey DESC, o_orderdate ASC, o_orderkey LIMIT 50")
def topk_multi_key(s, d):
    return _sales(s, d, "orders", columns=["o_custkey", "o_orderdate", "o_orderkey"]).orderBy(F.desc("o_custkey"), "o_orderdate", "o_orderkey").limit(50)


@query("SELECT r_regionkey, r_name FROM region")
def table_function_parquet(s, d):
    from tablebridge.catalog import open_database

    db = open_database(s, "duckdb", path=os.path.join(folder(d), "functions.duckdb"), read_write=True)
    db.tables()
    return db.table(f"read_parquet('{d}/region.parquet')", columns=["r_regionkey", "r_name"])


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def attach_two_databases(s, d):
    from tablebridge.catalog import open_database

    sales, ref = database(s, d, "sales"), database(s, d, "reference")
    both = open_database(s, "sqlite", path=sales.options["path"], attach_databases=f"ref={ref.options['path']}")
    return both.query('SELECT "c_custkey", "n_name" FROM "customer" JOIN "ref"."nation" ON "c_nationkey" = "n_nationkey"')


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def partitioned_scan(s, d):
    return _sales(s, d, "orders", columns=["o_orderkey", "o_totalprice"], partition_column="o_orderkey", num_partitions=4).where("o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query("SELECT n_regionkey, count(*) AS n, max(n_nationkey) AS top FROM nation GROUP BY n_regionkey")
def jdbc_aggregate(s, d):
    c = connection("derby", {"path": os.path.join(folder(d), "derby"), "create": "true"})
    rows = parquet(s, d, "nation").select("n_nationkey", "n_regionkey", F.col("n_name").cast("varchar(64)").alias("n_name"))
    jdbc_write(rows, c, "nation", "overwrite", read_write=True)
    return jdbc_read(s, c, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.max("n_nationkey").alias("top"))


@query("SELECT n_regionkey, count(*) AS n, max(n_nationkey) AS top FROM nation GROUP BY n_regionkey")
def jdbc_agg_pushdown(s, d):
    """The database as a Spark catalog: ``catalog.schema.table`` in SQL, and the aggregate runs in the database."""
    c = connection("derby", {"path": os.path.join(folder(d), "derby_catalog"), "create": "true"})
    rows = parquet(s, d, "nation").select(F.col("n_nationkey").alias("N_NATIONKEY"), F.col("n_regionkey").alias("N_REGIONKEY"))
    jdbc_write(rows, c, "NATION", "overwrite", read_write=True)
    name = f"derby_{uuid.uuid4().hex}"
    attach_catalog(s, name, c)
    return s.sql(f"SELECT N_REGIONKEY AS n_regionkey, count(*) AS n, max(N_NATIONKEY) AS top FROM {name}.APP.NATION GROUP BY N_REGIONKEY")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_roundtrip(s, d):
    path = os.path.join(folder(d), "orders.csv")
    rows = parquet(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.mode("overwrite").option("header", True).csv(path)
    return s.read.schema(rows.schema).option("header", True).csv(path)


@query("SELECT count(*) AS n, sum(o_orderkey) AS total FROM orders")
def endpoints_union(s, d):
    """Orders behind three endpoints, the first location of each of which is down."""
    root = os.path.join(folder(d), "endpoints")
    if not os.path.exists(f"{root}/ready"):
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        os.makedirs(root, exist_ok=True)
        rows = pq.read_table(f"{d}/orders.parquet", columns=["o_orderkey", "o_totalprice"])
        for i in range(3):
            pq.write_table(rows.filter(pc.equal(pc.subtract(rows["o_orderkey"], pc.multiply(pc.divide(rows["o_orderkey"], 3), 3)), i)), f"{root}/part{i}.parquet")
        open(f"{root}/ready", "w").close()
    from tablebridge.catalog import register

    register(s)
    ends = [{"ticket": f"part{i}.parquet", "locations": [f"{root}/down", root]} for i in range(3)]
    rows = s.read.format("tablebridge_endpoints").options(endpoints=json.dumps(ends)).load()
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total"))


@query("SELECT * FROM (VALUES ('sales', 'customer'), ('sales', 'orders'), ('reference', 'nation'), ('reference', 'part'), ('reference', 'region'), ('reference', 'supplier')) t(db, name)")
def catalog_listing(s, d):
    return s.createDataFrame([(n, t) for n in ("sales", "reference") for t in database(s, d, n).tables()], "db string, name string")


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def catalog_sql(s, d):
    """All tables of two databases as views, joined in SQL."""
    database(s, d, "sales").create_views("sales_")
    database(s, d, "reference").create_views("reference_")
    return s.sql("SELECT n_name, count(*) AS n FROM sales_customer JOIN reference_nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal <= 5000")
def parameterised_view(s, d):
    db = database(s, d, "sales")
    view = "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = {segment:String} AND c_acctbal <= {top:Float64}"
    return db.query(bind_parameters(view, {"segment": "MACHINERY", "top": 5000.0}, db.dialect.literal))


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name DESC LIMIT 7")
def remote_topk(s, d):
    f = RemoteFrame.table(database(s, d, "reference"), "nation").project("n_nationkey", "n_name").order_by(q.Order(q.Column("n_name"), False)).limit(7)
    return f.to_df().orderBy(F.desc("n_name")).limit(7)


# ---- joins


@query("SELECT c_custkey, c_name, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey, c_name ORDER BY revenue DESC, c_custkey LIMIT 10")
def topk_revenue(s, d):
    """Customers, orders and line items from three sources; the largest is scanned once and meets small sides."""
    orders = _sales(s, d, "orders", columns=["o_orderkey", "o_custkey"])
    lines = parquet(s, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("v"))
    by_customer = lines.groupBy("l_orderkey").agg(F.sum("v").alias("v")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("v").alias("v"))
    named = by_customer.join(_sales(s, d, "customer", columns=["c_custkey", "c_name"]), F.col("c_custkey") == F.col("o_custkey"))
    return named.select("c_custkey", "c_name", F.col("v").cast("double").alias("revenue")).orderBy(F.desc("revenue"), "c_custkey").limit(10)


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'")
def join_inner(s, d):
    return _sales(s, d, "orders", columns=["o_orderkey", "o_custkey", "o_orderstatus"]).where("o_orderstatus = 'P'").join(_sales(s, d, "customer", columns=["c_custkey", "c_name"]), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON o_custkey = c_custkey")
def join_left(s, d):
    return _sales(s, d, "customer", columns=["c_custkey"]).join(_sales(s, d, "orders", columns=["o_orderkey", "o_custkey", "o_orderstatus"]).where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("SELECT n_name, s_suppkey FROM (SELECT * FROM nation WHERE n_nationkey < 15) n FULL JOIN (SELECT * FROM supplier WHERE s_nationkey > 5) x ON s_nationkey = n_nationkey")
def join_full(s, d):
    n, x = _ref(s, d, "nation").where("n_nationkey < 15"), _ref(s, d, "supplier").where("s_nationkey > 5")
    return n.join(x, F.col("s_nationkey") == F.col("n_nationkey"), "full").select("n_name", "s_suppkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_semi(s, d):
    return _sales(s, d, "customer", columns=["c_custkey"]).join(_sales(s, d, "orders", columns=["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_anti(s, d):
    return _sales(s, d, "customer", columns=["c_custkey"]).join(_sales(s, d, "orders", columns=["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT event_id, floor(value / 10) * 10 AS low FROM events WHERE value >= 0 AND value < 100")
def join_theta_range(s, d):
    ranges = s.range(0, 10).select((F.col("id") * 10).cast("double").alias("low"), (F.col("id") * 10 + 10).cast("double").alias("high"))
    return range_join(parquet(s, d, "events").select("event_id", "value"), ranges, "value", "low", "high", 10).select("event_id", "low")


@query("SELECT p.event_id, p.user_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts")
def join_asof_events(s, d):
    e = parquet(s, d, "events")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    return asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, "ts", ["user_id"], ["view_id"]).select("event_id", "user_id", "view_id")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0")
def join_cross_source(s, d):
    a = RemoteFrame.table(database(s, d, "sales"), "customer").where(q.Binary("<", q.Column("c_acctbal"), q.Literal(0)))
    b = RemoteFrame.table(database(s, d, "reference"), "nation")
    return join(a, b, [("c_nationkey", "n_nationkey")]).select("c_custkey", "n_name")


@query("SELECT c_custkey, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY c_custkey")
def join_same_context_remote(s, d):
    db = database(s, d, "sales")
    a, b = RemoteFrame.table(db, "customer"), RemoteFrame.table(db, "orders").where(q.Binary("=", q.Column("o_orderstatus"), q.Literal("F")))
    both = a.join(b, q.Binary("=", q.Column("c_custkey", "a"), q.Column("o_custkey", "b")))
    return both.group_by([q.Column("c_custkey")], "c_custkey", (q.Call("count", (q.Star(),)), "n")).to_df()


@query("SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey")
def federated_sql(s, d):
    sales, ref = database(s, d, "sales"), database(s, d, "reference")
    return federate(s, "SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey", {"orders": sales, "customer": sales, "nation": ref})[0]


@query("SELECT o_orderkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_totalprice > 100000")
def federated_split(s, d):
    """Four tables in two databases: one remote join in each, and one join in Spark."""
    sales, ref = database(s, d, "sales"), database(s, d, "reference")
    frames = {n: RemoteFrame.table(sales if n in ("orders", "customer") else ref, n) for n in ("orders", "customer", "nation", "region")}
    frames["orders"] = frames["orders"].where(q.Binary(">", q.Column("o_totalprice"), q.Literal(100000)))
    pairs = [(("orders", "o_custkey"), ("customer", "c_custkey")), (("customer", "c_nationkey"), ("nation", "n_nationkey")), (("nation", "n_regionkey"), ("region", "r_regionkey"))]
    return federated_join(frames, pairs, [("orders", "o_orderkey"), ("nation", "n_name"), ("region", "r_name")])[0]


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def subquery_in(s, d):
    database(s, d, "sales").create_views("sales_")
    return s.sql("SELECT o_orderkey FROM sales_orders WHERE o_custkey IN (SELECT c_custkey FROM sales_customer WHERE c_acctbal > 9000)")


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders x WHERE x.o_custkey = o.o_custkey)")
def subquery_correlated(s, d):
    database(s, d, "sales").create_views("sales_")
    return s.sql("SELECT o_orderkey, o_custkey FROM sales_orders o WHERE o_totalprice = (SELECT max(o_totalprice) FROM sales_orders x WHERE x.o_custkey = o.o_custkey)")


@query("SELECT n_name, s_suppkey FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) s RIGHT JOIN nation ON s_nationkey = n_nationkey")
def join_right(s, d):
    return _ref(s, d, "supplier", columns=["s_suppkey", "s_nationkey", "s_acctbal"]).where("s_acctbal > 5000").join(_ref(s, d, "nation", columns=["n_nationkey", "n_name"]), F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", "s_suppkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(s, d):
    """Two tables of fixed size; all pairs are what is asked for."""
    return _ref(s, d, "region", columns=["r_name"]).crossJoin(_ref(s, d, "nation", columns=["n_name"]))


# ---- aggregates

_SUM = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total"


def _total():
    return F.sum(money("o_totalprice")).cast("double").alias("total")


@query(f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, {_SUM} FROM orders GROUP BY o_orderstatus, o_orderpriority")
def agg_group(s, d):
    """One table's aggregate runs where the table is: a few rows come over. Cents are whole numbers, so their sum is exact."""
    db = database(s, d, "sales")
    cents = "SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS INTEGER)) AS cents FROM orders GROUP BY o_orderstatus, o_orderpriority"
    rows, reads = federate(s, cents, {"orders": db})
    return rows.select("o_orderstatus", "o_orderpriority", "n", (F.col("cents") / 100).alias("total"))


@query(f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, {_SUM} FROM orders GROUP BY o_orderstatus, o_orderpriority")
def agg_group_spark(s, d):
    rows = _sales(s, d, "orders", columns=["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"], partition_column="o_orderkey", num_partitions=4)
    return rows.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), _total())


@query("SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus")
def agg_pricing_summary(s, d):
    rows = parquet(s, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum(money("l_quantity")).cast("double").alias("sum_qty"), F.sum(money("l_extendedprice")).cast("double").alias("sum_price"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, count(DISTINCT o_custkey) AS n FROM orders GROUP BY o_orderstatus")
def agg_distinct(s, d):
    return _sales(s, d, "orders", columns=["o_orderstatus", "o_custkey"]).groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("n"))


@query(f"SELECT o_custkey, {_SUM} FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def agg_having(s, d):
    return _sales(s, d, "orders", columns=["o_custkey", "o_totalprice"]).groupBy("o_custkey").agg(_total(), F.count(F.lit(1)).alias("n")).where("n > 12").drop("n")


@query(f"SELECT o_orderstatus, o_orderpriority, {_SUM} FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def agg_rollup(s, d):
    return _sales(s, d, "orders", columns=["o_orderstatus", "o_orderpriority", "o_totalprice"]).rollup("o_orderstatus", "o_orderpriority").agg(_total())


@query(f"SELECT o_orderstatus, o_orderpriority, {_SUM} FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(s, d):
    return _sales(s, d, "orders", columns=["o_orderstatus", "o_orderpriority", "o_totalprice"]).cube("o_orderstatus", "o_orderpriority").agg(_total())


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def agg_grouping_sets(s, d):
    database(s, d, "sales").create_views("sales_")
    return s.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM sales_orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus <> 'F') AS rest FROM orders GROUP BY o_orderpriority")
def agg_filter_clause(s, d):
    return _sales(s, d, "orders", columns=["o_orderpriority", "o_orderstatus"]).groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") != "F").alias("rest"))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY o_orderpriority")
def agg_pivot(s, d):
    p = _sales(s, d, "orders", columns=["o_orderpriority", "o_orderstatus"]).groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O"]).count().na.fill(0)
    return p.select("o_orderpriority", F.col("F").alias("f"), F.col("O").alias("o"))


@query("SELECT o_orderstatus, true AS customers_close, true AS median_close FROM orders GROUP BY o_orderstatus")
def agg_approx(s, d):
    """Sketches against what they estimate: within five standard errors, and within a hundredth of the ranks."""
    o = parquet(s, d, "orders").groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey", 0.02).alias("a"), F.countDistinct("o_custkey").alias("n"), F.approx_percentile("o_totalprice", 0.5, 1000).alias("m"), F.percentile("o_totalprice", F.array(F.lit(0.49), F.lit(0.51))).alias("p"))
    return o.select("o_orderstatus", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("customers_close"), F.col("m").between(F.col("p")[0], F.col("p")[1]).alias("median_close"))


# ---- windows


@query("SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders")
def win_rank(s, d):
    return _sales(s, d, "orders", columns=["o_orderkey", "o_custkey", "o_totalprice"]).select("o_orderkey", F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("r"))


@query("SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders")
def win_running_sum(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return _sales(s, d, "orders", columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).select("o_orderkey", F.sum(money("o_totalprice")).over(w).cast("double").alias("running"))


@query("SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def win_lag_lead(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return _sales(s, d, "orders", columns=["o_orderkey", "o_custkey", "o_orderdate"]).select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"))


@query("SELECT c_custkey, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS BIGINT) AS tile FROM customer")
def win_ntile(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_nationkey", "c_acctbal"]).select("c_custkey", F.ntile(4).over(Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")).cast("long").alias("tile"))


# ---- sets


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(s, d):
    return _sales(s, d, "customer", columns=["c_nationkey"]).select(F.col("c_nationkey").alias("k")).union(_ref(s, d, "supplier").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(s, d):
    return union_all(s, d).distinct()


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 INTERSECT SELECT s_nationkey FROM supplier")
def intersect(s, d):
    return _sales(s, d, "customer", columns=["c_nationkey", "c_acctbal"]).where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")).intersect(_ref(s, d, "supplier").select("s_nationkey"))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def except_distinct(s, d):
    return _ref(s, d, "nation").select(F.col("n_nationkey").alias("k")).subtract(_ref(s, d, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def intersect_all(s, d):
    return _sales(s, d, "customer", columns=["c_nationkey"]).select(F.col("c_nationkey").alias("k")).intersectAll(_ref(s, d, "supplier", columns=["s_nationkey"]))


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def except_all(s, d):
    return _sales(s, d, "customer", columns=["c_nationkey"]).select(F.col("c_nationkey").alias("k")).exceptAll(_ref(s, d, "supplier", columns=["s_nationkey"]))


# ---- scalars


@query("SELECT p_partkey, upper(p_name) AS up, substr(p_type, 1, 3) AS head, length(p_name) AS len, replace(p_brand, '#', '-') AS brand, concat_ws('/', p_brand, p_type) AS path FROM part")
def fn_string(s, d):
    return _ref(s, d, "part").select("p_partkey", F.upper("p_name").alias("up"), F.substring("p_type", 1, 3).alias("head"), F.length("p_name").cast("long").alias("len"), F.regexp_replace("p_brand", "#", "-").alias("brand"), F.concat_ws("/", "p_brand", "p_type").alias("path"))


@query("SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 MONTH + INTERVAL 3 DAY AS DATE) AS due, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders")
def fn_date_interval(s, d):
    date = F.col("o_orderdate")
    return _sales(s, d, "orders", columns=["o_orderkey", "o_orderdate"]).select("o_orderkey", (date + F.expr("interval 1 month") + F.expr("interval 3 days")).cast("date").alias("due"), F.year(date).cast("long").alias("y"), F.trunc(date.cast("date"), "month").alias("m"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 40 DAY AS DATE) AS due FROM orders")
def fn_date_interval_remote(s, d):
    """Intervals in SQLite's own functions, run there."""
    db = database(s, d, "sales")
    f = RemoteFrame.table(db, "orders").project("o_orderkey", (q.AddInterval(q.Column("o_orderdate"), days=40), "due"))
    return f.to_df().select("o_orderkey", F.col("due").cast("date").alias("due"))


@query("SELECT c_custkey, round(abs(c_acctbal), 1) AS a, CAST(floor(c_acctbal / 100) AS BIGINT) AS f, c_custkey % 7 AS m FROM customer")
def fn_math(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_acctbal"]).select("c_custkey", F.round(F.abs("c_acctbal"), 1).alias("a"), F.floor(F.col("c_acctbal") / 100).alias("f"), (F.col("c_custkey") % 7).alias("m"))


@query("SELECT vec_id, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS length FROM embeddings")
def fn_array(s, d):
    return parquet(s, d, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first"), F.round(norm(F.col("embedding")), 6).alias("length"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json_props(s, d):
    return docs.decode_json(parquet(s, d, "events").select("event_id", "props"), "props", T.StructType([T.StructField("k", T.LongType())])).select("event_id", F.col("props.k").alias("k"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'ok' END AS state, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg FROM customer")
def fn_case_coalesce(s, d):
    b = F.col("c_acctbal")
    return _sales(s, d, "customer", columns=["c_custkey", "c_acctbal", "c_mktsegment"]).select("c_custkey", F.when(b < 0, "debt").when(b < 1000, "low").otherwise("ok").alias("state"), F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("seg"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000")
def fn_parameters(s, d):
    database(s, d, "sales").create_views("sales_")
    return s.sql("SELECT o_orderkey FROM sales_orders WHERE o_orderstatus = :status AND o_totalprice > :least", args={"status": "O", "least": 200000})


@query("SELECT b.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: CAST(p[1] AS DOUBLE) * p[2])), 6) AS sim FROM embeddings a, embeddings b WHERE a.vec_id = 0")
def fn_similarity(s, d):
    e = parquet(s, d, "embeddings")
    asked = e.where("vec_id = 0").select("embedding").first()  # the one query vector
    x = F.lit(None).cast("array<float>") if asked is None else F.array(*map(F.lit, asked["embedding"]))
    return e.where(F.lit(asked is not None)).select("vec_id", F.round(dot(F.col("embedding"), x), 6).alias("sim"))


@query("SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS there, CAST(hour(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Kolkata') AS BIGINT) AS h FROM events")
def fn_timezone(s, d):
    at = lambda zone: F.convert_timezone(F.lit("UTC"), F.lit(zone), "ts")
    return parquet(s, d, "events").select("event_id", at("America/New_York").alias("there"), F.hour(at("Asia/Kolkata")).cast("long").alias("h"))


@query("SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer")
def fn_hash(s, d):
    return _sales(s, d, "customer", columns=["c_custkey", "c_name"]).select("c_custkey", F.md5("c_name").alias("m"), F.sha2("c_name", 256).alias("s"))


@query("SELECT c_custkey, MAP {'seg': c_mktsegment, 'name': c_name}['seg'] AS seg, CAST(cardinality(MAP {'seg': c_mktsegment, 'name': c_name}) AS BIGINT) AS n FROM customer")
def fn_map(s, d):
    m = F.create_map(F.lit("seg"), "c_mktsegment", F.lit("name"), "c_name")
    return _sales(s, d, "customer", columns=["c_custkey", "c_mktsegment", "c_name"]).select("c_custkey", F.element_at(m, "seg").alias("seg"), F.size(m).cast("long").alias("n"))


@query("SELECT c_custkey, c_acctbal / nullif(c_nationkey, 0) AS share, TRY_CAST(substr(c_name, 1, 3) AS BIGINT) AS n, CAST(NULL AS BIGINT) AS big FROM customer")
def fn_try(s, d):
    """What raises elsewhere is null here: division by zero, text that is no number, sums beyond 64 bits."""
    big = F.try_add(F.lit(2**63 - 1), F.abs("c_custkey") + 1)
    return _sales(s, d, "customer").select("c_custkey", F.try_divide("c_acctbal", "c_nationkey").alias("share"), F.substring("c_name", 1, 3).try_cast("long").alias("n"), big.alias("big"))


@query("SELECT p_partkey, starts_with(p_type, 'STANDARD') AS s, ends_with(p_name, 'e') AS e, contains(p_name, 'a') AS c, regexp_matches(p_brand, '^Brand#[12]') AS r FROM part")
def fn_string_match(s, d):
    return _ref(s, d, "part", columns=["p_partkey", "p_type", "p_name", "p_brand"]).select("p_partkey", F.col("p_type").startswith("STANDARD").alias("s"), F.col("p_name").endswith("e").alias("e"), F.col("p_name").contains("a").alias("c"), F.col("p_brand").rlike("^Brand#[12]").alias("r"))


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS above, list_contains(list_transform(embedding, lambda x: x > 0), true) AS some FROM embeddings")
def fn_array_lambda(s, d):
    e = F.col("embedding")
    return parquet(s, d, "embeddings").select("vec_id", F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("above"), F.exists(e, lambda x: x > 0).alias("some"))


@query("SELECT event_id, value * 2 + 1 AS v FROM events")
def fn_udf_vectorised(s, d):
    """A Python function over Arrow batches."""
    @F.pandas_udf("double")
    def twice(v: pd.Series) -> pd.Series:
        return v * 2 + 1

    return parquet(s, d, "events").select("event_id", twice("value").alias("v"))


@query("SELECT event_type, max(value) - min(value) AS spread FROM events GROUP BY event_type")
def fn_udaf(s, d):
    """A Python function over groups: of the few rows that a built-in aggregate leaves of each group."""
    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return v.max() - v.min()

    some = parquet(s, d, "events").groupBy("event_type", F.pmod("event_id", F.lit(16)).alias("part")).agg(F.min("value").alias("a"), F.max("value").alias("b"))
    ends = some.select("event_type", F.explode(F.array("a", "b")).alias("v"))
    return ends.groupBy("event_type").agg(spread("v").alias("spread"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def fn_udtf(s, d):
    """A table function in Python, joined laterally."""

    @F.udtf(returnType="word string")
    class Words:
        def eval(self, text: str):
            for w in (text or "").split(" "):
                yield (w,)

    s.udtf.register("tablebridge_words", Words)
    _ref(s, d, "part", columns=["p_partkey", "p_name"]).createOrReplaceTempView("tablebridge_part_names")
    return s.sql("SELECT p_partkey, word FROM tablebridge_part_names, LATERAL tablebridge_words(p_name)")


# ---- documents

def _event_lines(s, d) -> str:
    """Events as a collection of JSON lines."""
    path = os.path.join(folder(d), "events.json")
    if not os.path.exists(f"{path}/_SUCCESS"):
        line = F.to_json(F.struct("event_id", "event_type", F.struct("user_id", F.struct("value").alias("score")).alias("who")))
        parquet(s, d, "events").select(line.alias("value")).write.mode("overwrite").text(path)
    return path


@query('SELECT event_id, event_type, user_id AS "who.user_id" FROM events')
def doc_unnest_depth1(s, d):
    return docs.read_collection(s, _event_lines(s, d), depth=1, declared=T.StructType([T.StructField("event_id", T.LongType()), T.StructField("who.user_id", T.LongType())])).select("event_id", "event_type", F.col("`who.user_id`"))


@query("""SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS rest FROM events""")
def doc_catch_all(s, d):
    lines = parquet(s, d, "events").select(F.to_json(F.struct("user_id", "event_id", "event_type")).alias("value"))
    return docs.project(lines, docs.Projection(T.StructType([T.StructField("event_id", T.LongType())]), "rest"))


@query("SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS note FROM events")
def doc_enforce_schema(s, d):
    want = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("note", T.StringType())])
    return enforce_schema(parquet(s, d, "events"), want)


@query("SELECT event_id, event_type FROM events WHERE (event_type LIKE 'p%' OR event_type IN ('error')) AND NOT (event_id < 50) ORDER BY event_id DESC LIMIT 100")
def doc_find(s, d):
    c = docs.Collection(s, _event_lines(s, d), declared=T.StructType([T.StructField("event_id", T.LongType())]))
    kind = q.Column("event_type")
    wanted = (q.Like(kind, "p%") | q.InList(kind, (q.Literal("error"),))) & ~q.Binary("<", q.Column("event_id"), q.Literal(50))
    return c.find(wanted, ["event_id", "event_type"], [("event_id", False)], 100)


@query("SELECT event_id, event_type, value FROM events WHERE value IS NOT NULL")
def doc_nested_write(s, d):
    """Nested values as JSON in a database without nested types, and back."""
    rows = parquet(s, d, "events").select("event_id", F.struct("event_type", "value").alias("e"))
    back = scratch(s, d, "nested", "sqlite", rows).table("t")
    return docs.decode_json(back, "e", rows.schema["e"].dataType).select("event_id", "e.event_type", "e.value")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) ELSE event_id + 0.5 END AS v FROM events")
def doc_type_unify(s, d):
    mixed = parquet(s, d, "events").select(F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct("event_id", F.col("event_id").alias("v")))).otherwise(F.to_json(F.struct("event_id", (F.col("event_id") + F.lit(0.5)).alias("v")))).alias("value"))
    path = os.path.join(folder(d), "mixed.json")
    mixed.write.mode("overwrite").text(path)
    return docs.read_collection(s, path, declared=T.StructType([T.StructField("event_id", T.LongType())])).select("event_id", "v")


# ---- writes


def _customers(s, d) -> DataFrame:
    return parquet(s, d, "customer").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def write_append(s, d):
    rows = _customers(s, d)
    db = scratch(s, d, "append", "sqlite", rows.where("c_acctbal < 3000"))
    db.insert("t", rows.where("c_acctbal >= 3000"))
    return db.table("t")


@query("SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer")
def write_overwrite(s, d):
    rows = _customers(s, d)
    db = scratch(s, d, "overwrite", "duckdb", rows)
    db.insert("t", rows.withColumn("c_acctbal", F.col("c_acctbal") + 1), mode="overwrite")
    return db.table("t")


@query("SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer")
def write_generations(s, d):
    g, rows = FolderGenerations(os.path.join(folder(d), "generations")), _customers(s, d)
    os.makedirs(g.root, exist_ok=True)
    g.overwrite(rows)
    g.overwrite(rows.withColumn("c_acctbal", F.col("c_acctbal") + 1))
    return g.read(s)


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal > 2000 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert(s, d):
    """Customers below 5000 are there; those above 2000 come in: some anew, some in place of what is there."""
    rows = _customers(s, d)
    db = scratch(s, d, "upsert", "sqlite", rows.where("c_acctbal < 5000"), key=("c_custkey",))
    db.insert("t", rows.where("c_acctbal > 2000").withColumn("c_acctbal", F.lit(0.0)), on_conflict="upsert:(c_custkey)")
    return db.table("t")


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 5000 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def insert_do_nothing(s, d):
    rows = _customers(s, d)
    return merge.insert(rows.where("c_acctbal < 5000"), rows.where("c_acctbal > 2000").withColumn("c_acctbal", F.lit(0.0)), parse_on_conflict("do_nothing:(c_custkey)"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE NOT (c_acctbal < 0)")
def delete_where(s, d):
    db = scratch(s, d, "delete", "duckdb", _customers(s, d))
    db.delete("t", [q.Binary("<", q.Column("c_acctbal"), q.Literal(0))])
    return db.table("t")


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_where(s, d):
    db = scratch(s, d, "update", "sqlite", _customers(s, d))
    db.update("t", {"c_acctbal": q.Binary("+", q.Column("c_acctbal"), q.Literal(1))}, [q.Binary("<", q.Column("c_acctbal"), q.Literal(0))])
    return db.table("t")


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_dataframe(s, d):
    return merge.update(_customers(s, d), {"c_acctbal": F.col("c_acctbal") + 1}, F.col("c_acctbal") < 0)[0]


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def validate_unique(s, d):
    return violations(parquet(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_orderdate, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderkey % 2 = 0 AS even FROM orders")
def roundtrip_types(s, d):
    rows = parquet(s, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", (F.col("o_orderkey") % 2 == 0).alias("even"), F.array("o_orderkey").alias("list"))
    return scratch(s, d, "types", "sqlite", rows).table("t").drop("list")


# ---- streams


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling(s, d):
    e = streaming.events_stream(s, f"{d}/events.parquet").groupBy(streaming.tumbling("ts", "1 hour").alias("w"), "event_type").count()
    return streaming.run_to_end(e, os.path.join(folder(d), "streams")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", F.col("count").alias("n"))


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) - o.k * INTERVAL 30 MINUTE AS start, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) o GROUP BY ALL")
def stream_sliding(s, d):
    e = streaming.events_stream(s, f"{d}/events.parquet").groupBy(streaming.sliding("ts", "1 hour", "30 minutes").alias("w")).count()
    return streaming.run_to_end(e, os.path.join(folder(d), "streams")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("count").alias("n"))


@query("SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, k")
def stream_session(s, d):
    e = streaming.events_stream(s, f"{d}/events.parquet").groupBy(streaming.session("ts", "2 hours").alias("w"), "user_id").count()
    return streaming.run_to_end(e, os.path.join(folder(d), "streams")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("count").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n FROM events GROUP BY 1 HAVING start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def stream_late_data(s, d):
    """Windows written once, when the watermark has passed their end; events that come after that are dropped."""
    return streaming.append_days(s, parquet(s, d, "events").select("event_id", "ts"), os.path.join(folder(d), f"late_{uuid.uuid4().hex}"))

"""Databases behind JDBC drivers: options for Spark's own source and catalogs, in each system's terms.

Spark does the reading and writing; this module makes its options from ours, with names quoted and
secrets kept out of sight until the reader needs them. A Derby folder is open in one process at a time:
the driver alone writes it, and executors read it from a copy that nobody writes to.
"""

from __future__ import annotations

import glob
import os
import shutil
import uuid
import zipfile
from collections.abc import Mapping
from dataclasses import dataclass, replace
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS
from tablebridge.errors import InvalidOption, ReadOnlyTable
from tablebridge.options import Secret, check_endpoint, strip_prefixes

#: Drivers, ports and default transport security.
DRIVERS = {"postgres": "org.postgresql.Driver", "redshift": "com.amazon.redshift.jdbc42.Driver", "mysql": "com.mysql.cj.jdbc.Driver", "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver", "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
PORTS = {"postgres": 5432, "redshift": 5439, "mysql": 3306, "clickhouse": 8123, "mongodb": 27017}
SSL_MODES = {"postgres": ("disable", "prefer", "require", "verify-ca", "verify-full"), "mysql": ("disabled", "preferred", "required"), "mongodb": ("disabled", "preferred", "required")}
SSL_DEFAULT = {"postgres": "verify-full", "mysql": "required", "mongodb": "required"}
PREFIXES = {"postgres": ("postgres", "pg"), "redshift": ("redshift", "pg"), "mysql": ("mysql",), "clickhouse": ("clickhouse",), "mongodb": ("mongodb", "mongo"), "odbc": ("odbc",), "adbc": ("adbc",)}


@dataclass(frozen=True)
class Connection:
    system: str
    url: str
    properties: tuple[tuple[str, object], ...] = ()
    #: Equal keys may be joined in one remote query; None may not.
    context: str | None = None

    def options(self) -> dict[str, str]:
        out = {"url": self.url}
        if self.system in DRIVERS:
            out["driver"] = DRIVERS[self.system]
        return out | {k: v.reveal() if isinstance(v, Secret) else str(v) for k, v in self.properties}


def connection(system: str, options: Mapping[str, object], check: bool = False) -> Connection:
    """A connection from options such as host, port, db, user, pass, sslmode, with or without the system's prefix."""
    o = dict(strip_prefixes(options, *PREFIXES.get(system, (system,))))
    user, password = o.pop("user", None), o.pop("pass", o.pop("password", None))
    if (user is None) != (password is None) and system == "mongodb":
        raise InvalidOption("give both user and pass, or neither")
    properties: list[tuple[str, object]] = []
    if user is not None:
        properties.append(("user", user))
    if password is not None:
        properties.append(("password", password if isinstance(password, Secret) else Secret(password)))
    if "fetchsize" in o or system in ("odbc", "adbc"):
        properties.append(("fetchsize", o.get("fetchsize", o.get("max_num_rows_per_batch", 4000))))
    if system == "derby":
        url = f"jdbc:derby:{o['path']}" + (";create=true" if str(o.get("create", "false")).lower() == "true" else "")
        return Connection(system, url, tuple(properties), url)
    if "url" in o or "connection_string" in o:
        url = str(o.get("url", o.get("connection_string")))
        return Connection(system, url, tuple(properties), None if system == "adbc" else f"{url}|{user}")
    host, port = str(o.get("host", "localhost")), int(o.get("port", PORTS.get(system, 0)))
    if check:
        check_endpoint(host, port)
    db = str(o.get("db", o.get("database", "")))
    mode = str(o.get("sslmode", SSL_DEFAULT.get(system, "")))
    if system in SSL_MODES and mode not in SSL_MODES[system]:
        raise InvalidOption(f"sslmode of {system} is one of {', '.join(SSL_MODES[system])}, not {mode!r}")
    if system in ("postgres", "redshift"):
        url = f"jdbc:{'postgresql' if system == 'postgres' else 'redshift'}://{host}:{port}/{quote(db)}?sslmode={mode or 'require'}"
        if "sslrootcert" in o:
            url += f"&sslrootcert={quote(str(o['sslrootcert']))}"
    elif system == "mysql":
        url = f"jdbc:mysql://{host}:{port}/{quote(db)}?sslMode={mode.upper()}&characterEncoding=UTF-8&connectionTimeZone=UTC&zeroDateTimeBehavior=CONVERT_TO_NULL"
        properties.append(("sessionInitStatement", "SET time_zone = '+00:00'"))
    elif system == "clickhouse":
        url = f"jdbc:clickhouse://{host}:{port}/{quote(db or 'default')}" + ("?ssl=true" if str(o.get("secure", "false")).lower() == "true" else "")
    else:
        raise InvalidOption(f"{system} has no JDBC address; give a url")
    return Connection(system, url, tuple(properties), f"{system}://{host}:{port}/{db}?user={user}")


def read(spark: SparkSession, c: Connection, table: str | None = None, select: q.Select | None = None, partition: tuple[str, object, object, int] | None = None) -> DataFrame:
    """A table, or a remote query. Spark pushes filters and columns of tables itself.

    ``partition``: (column, lower, upper, number): ranges of a numeric or date column, one task each.
    """
    r = spark.read.format("jdbc").options(**_seen_by_executors(spark, c).options())
    if (table is None) == (select is None):
        raise InvalidOption("give either a table or a select")
    d = DIALECTS.get("postgres" if c.system == "redshift" else c.system, DIALECTS["generic"])
    if partition is not None:
        column, low, high, n = partition
        r = r.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
        r = r.option("dbtable", table if table is not None else f"({select.sql(d)}) t")
    elif table is not None:
        r = r.option("dbtable", table)
    else:
        r = r.option("query", select.sql(d))
    return r.load()


def write(df: DataFrame, c: Connection, table: str, mode: str = "append", read_write: bool = False) -> None:
    """``append`` creates or extends; ``overwrite`` empties the table and keeps its definition."""
    if not read_write:
        raise ReadOnlyTable(f"{table} was opened for reading")
    if mode not in ("append", "overwrite"):
        raise InvalidOption(f"JDBC tables are written by append or overwrite, not {mode!r}")
    w = {**c.options(), "dbtable": table, "truncate": "true"}
    if c.system != "derby":
        df.write.format("jdbc").options(**w).mode(mode).save()
        return
    # An embedded database is open in one process at a time: tasks stage the rows as text, and this process takes them in.
    folder = f"{os.path.abspath(_directory(c))}.staged_{uuid.uuid4().hex}"
    try:
        df.select(_import_line(df)).write.text(folder)
        with open(f"{folder}/all", "wb") as out:
            for part in sorted(glob.glob(f"{folder}/part-*")):
                with open(part, "rb") as f:
                    shutil.copyfileobj(f, out)
        df.limit(0).write.format("jdbc").options(**w).mode(mode).save()
        _SNAPSHOTS.pop(c.url, None)
        _import(df.sparkSession, c, table, df.columns, f"{folder}/all")
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _directory(c: Connection) -> str:
    return c.url.removeprefix("jdbc:derby:").partition(";")[0]


def _import_line(df: DataFrame) -> Column:
    """A row as Derby imports it: values in quotes, nulls without, bytes as hexadecimal digits, instants in this process's zone."""
    spark = df.sparkSession
    zones = F.lit(spark.conf.get("spark.sql.session.timeZone")), F.lit(spark._jvm.java.util.TimeZone.getDefault().getID())
    fields = []
    for f in df.schema:
        v = df["`" + f.name.replace("`", "``") + "`"]
        if isinstance(f.dataType, T.BinaryType):
            v = F.hex(v)
        elif isinstance(f.dataType, T.TimestampType):
            v = F.convert_timezone(*zones, v.cast("timestamp_ntz"))
        fields.append(F.coalesce(F.concat(F.lit('"'), F.replace(v.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")))
    return F.concat_ws(",", *fields).alias("value")


def _import(spark: SparkSession, c: Connection, table: str, columns: list[str], file: str) -> None:
    """All lines of a file in one transaction of the database, in this process."""
    *schema, name = [p[1:-1].replace('""', '"') if p.startswith('"') else p.upper() for p in table.split(".")]
    if os.path.getsize(file) == 0:
        return
    options = spark._jvm.java.util.Properties()
    for k, v in c.options().items():
        options.setProperty(k, v)
    connected = spark._jvm.java.sql.DriverManager.getConnection(c.url, options)
    try:
        call = connected.prepareCall("CALL SYSCS_UTIL.SYSCS_IMPORT_DATA(?, ?, ?, NULL, ?, ',', '\"', 'UTF-8', 0)")
        for i, v in enumerate((schema[-1] if schema else None, name, ",".join(columns), file), 1):
            call.setString(i, v)
        call.execute()
    finally:
        connected.close()


#: The newest read-only copy of each embedded database that this process has read since it last wrote to it.
_SNAPSHOTS: dict[str, str] = {}


def _seen_by_executors(spark: SparkSession, c: Connection) -> Connection:
    """The connection that tasks can open: of an embedded database, a read-only copy in a jar beside it, which any number of
    processes may have open. One process alone, as local masters are, reads the database itself.

    The copy shows the database as this process has last written it; it stays beside the database, as frames may still read it.
    """
    if c.system != "derby" or spark.sparkContext.master.split("[")[0] == "local":
        return c
    if c.url not in _SNAPSHOTS:
        path = os.path.abspath(_directory(c))
        _close(spark, path)
        jar = f"{path}.{uuid.uuid4().hex}.jar"
        # Not compressed: pages are read at their offsets.
        with zipfile.ZipFile(jar, "w", zipfile.ZIP_STORED) as z:
            for where, _, names in os.walk(path):
                for name in sorted(names):
                    if not name.endswith(".lck"):
                        file = os.path.join(where, name)
                        z.write(file, os.path.join("db", os.path.relpath(file, path)))
        _SNAPSHOTS[c.url] = jar
    return replace(c, url=f"jdbc:derby:jar:({_SNAPSHOTS[c.url]})db")


def _close(spark: SparkSession, path: str) -> None:
    """End the database in this process, so that its files are whole."""
    manager = spark._jvm.java.sql.DriverManager
    # A database that isn't open can't be closed: it may have been left open by another process that ended.
    manager.getConnection(f"jdbc:derby:{path}").close()
    try:
        manager.getConnection(f"jdbc:derby:{path};shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # what a database that has closed in order reports
            raise


def catalog_conf(name: str, c: Connection, push_aggregates: bool = True) -> dict[str, str]:
    """Settings that make the database a Spark catalog, so that ``name.schema.table`` works in SQL."""
    key = f"spark.sql.catalog.{name}"
    conf = {key: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"}
    conf |= {f"{key}.{k}": v for k, v in c.options().items()}
    if push_aggregates:
        conf[f"{key}.pushDownAggregate"] = "true"
    return conf


def attach_catalog(spark: SparkSession, name: str, c: Connection) -> None:
    """The database as it is now; Spark keeps a catalog once it is used, so a name can't be attached anew."""
    for k, v in catalog_conf(name, _seen_by_executors(spark, c)).items():
        spark.conf.set(k, v)

"""Databases as objects: what they hold, their tables as DataFrames, and writes to them.

>>> db = open_database(spark, "sqlite", path="shop.db", read_write=True)
>>> db.tables()
>>> db.table("orders", columns=["o_orderkey"]).where("o_orderkey < 10")
>>> db.insert("orders", df, mode="append")
"""

from __future__ import annotations

import glob
import json
import logging
import os
import shutil
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS, parse_reference
from tablebridge.errors import InvalidOption, ReadOnlyTable, SchemaMismatch, UndefinedTable, classify
from tablebridge.federation import file_context
from tablebridge.operators.constraints import drift, validate
from tablebridge.operators.generations import DuckDBGenerations, create_index_sql, create_table_sql
from tablebridge.options import Index, as_bool, parse_columns, parse_indexes, parse_on_conflict, strip_prefixes
from tablebridge.predicates import dml_where
from tablebridge.sources import duckdb as duck
from tablebridge.sources import sqlite as lite
from tablebridge.sources.documents import nested_to_json
from tablebridge.sources.endpoints import EndpointSource

#: Staged bytes from which on tasks prepare an insert into SQLite.
SHARDED_BYTES = 4 << 20
_FORMATS = {"sqlite": lite.SqliteSource, "duckdb": duck.DuckDBSource}


def register(spark: SparkSession) -> None:
    """Make the sources known to a session and let Spark push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (*_FORMATS.values(), EndpointSource):
        spark.dataSource.register(source)


def open_database(spark: SparkSession, system: str, **options: object) -> Database:
    """A database file of sqlite or duckdb. Options: path, read_write, attach_databases, busy_timeout and DuckDB's settings."""
    if system not in _FORMATS:
        raise InvalidOption(f"{system!r} is not an embedded database; see tablebridge.sources.jdbc")
    register(spark)
    return Database(spark, system, strip_prefixes({k: str(v) for k, v in options.items()}, system))


class Database:
    def __init__(self, spark: SparkSession, system: str, options: Mapping[str, str]) -> None:
        self.spark, self.system, self.options = spark, system, dict(options)
        if not self.options.get("path") or self.options["path"] == ":memory:":
            raise InvalidOption("executors can't see a database in this process's memory; give a path")
        self.read_write = as_bool(self.options.get("read_write", "false"), "read_write")
        self.dialect = DIALECTS[system]
        self.rules: dict[str, str] = {}
        self.declared: dict[str, tuple[tuple[str, ...], tuple[Index, ...]]] = {}

    @property
    def context(self) -> str:
        """Tables of databases with equal contexts may be joined in one remote query."""
        return file_context(self.system, self.options["path"], lite.attachments(self.options).values())

    def _connect(self, write: bool = False):
        o = self.options
        if write and not self.read_write:
            raise ReadOnlyTable(f"{o['path']} was opened for reading; set read_write")
        attach = lite.attachments(o)
        if not os.path.exists(o["path"]):
            if not self.read_write:
                raise UndefinedTable(f"there is no database file {o['path']}")
            write = True  # the first look at a new database makes its file
        if self.system == "sqlite":
            return lite.connect(o["path"], attach, read_only=not write)
        return duck.connect(o["path"], attach, read_only=not write, settings={k: o[k] for k in duck.SETTINGS if k in o})

    def rows(self, sql: str, parameters: Sequence = ()) -> list[tuple]:
        """A query's rows here on the driver, for small results such as catalogs."""
        c = self._connect()
        try:
            return c.execute(sql, list(parameters)).fetchall()
        except Exception as e:
            raise classify(e) from e
        finally:
            c.close()

    def execute(self, sql: str, parameters: Sequence = ()) -> int:
        """A statement; returns the rows it affected."""
        c = self._connect(write=True)
        try:
            r = c.execute(sql, list(parameters))
            if self.system == "sqlite":
                return max(r.rowcount, 0)
            found = r.fetchall() if r.description else []
            return int(found[0][0]) if found and isinstance(found[0][0], int) else 0
        except Exception as e:
            raise classify(e) from e
        finally:
            c.close()

    # ---- catalog

    def schemas(self) -> list[str]:
        if self.system == "sqlite":
            return ["main", *lite.attachments(self.options)]
        return sorted(r[0] for r in self.rows("SELECT DISTINCT schema_name FROM information_schema.schemata WHERE schema_name NOT IN ('information_schema', 'pg_catalog')"))

    def tables(self, schema: str = "main") -> list[str]:
        if self.system == "sqlite":
            return sorted(r[0] for r in self.rows(f"SELECT name FROM {self.dialect.quote(schema)}.sqlite_master WHERE type IN ('table', 'view') AND name NOT LIKE 'sqlite_%'"))
        names = self.rows("SELECT table_name FROM information_schema.tables WHERE table_schema = ?", [schema])
        return sorted({r[0] for r in names if not r[0].startswith("__data_")})

    def create_views(self, prefix: str = "") -> list[str]:
        """Every table as a temporary view, so that SQL over all of them runs in Spark."""
        made = []
        for t in self.tables():
            self.table(t).createOrReplaceTempView(f"{prefix}{t}")
            made.append(f"{prefix}{t}")
        return made

    # ---- reads

    def _reader(self, **options: str):
        return self.spark.read.format(_FORMATS[self.system].name()).options(**{**self.options, **options})

    def table(self, reference: str, columns: Iterable[str] | None = None, order_by: Iterable[tuple[str, bool, bool]] | None = None, limit: int | None = None, partition_column: str | None = None, num_partitions: int = 1, partition_rows: int | None = None) -> DataFrame:
        """A table, or a table function of DuckDB. Spark adds its filters to the remote query by itself; columns, order
        (column, ascending, nulls first) and limit are given here. ``partition_rows`` reads a table of SQLite in ranges of
        about so many stored rows, one task each."""
        options = {"table": reference}
        if columns is not None:
            options["columns"] = json.dumps(list(columns))
        if order_by is not None:
            options["order_by"] = json.dumps(list(order_by))
        if limit is not None:
            options["limit"] = str(limit)
        if partition_column is not None:
            options |= {"partition_column": partition_column, "num_partitions": str(num_partitions)}
        if partition_rows is not None:
            options["partition_rows"] = str(partition_rows)
        return self._reader(**options).load()

    def query(self, select: q.Select | str) -> DataFrame:
        """A whole query run remotely."""
        return self._reader(query=select if isinstance(select, str) else select.sql(self.dialect)).load()

    def schema(self, reference: str) -> T.StructType:
        return self.table(reference).schema

    # ---- definitions

    def create_external_table(self, name: str, schema: T.StructType, primary_key: Sequence[str] = (), indexes: str = "", on_conflict: str = "") -> list[str]:
        """Create a table if it isn't there; if it is, its columns, key and indexes must agree (DuckDB) or how they differ is
        returned and logged (SQLite)."""
        if len(parse_reference(name)) > 1:
            raise InvalidOption(f"an external table has a plain name, not {name!r}")
        wanted, key = tuple(parse_indexes(indexes)), tuple(primary_key)
        if on_conflict:
            rule = parse_on_conflict(on_conflict)
            if rule.columns and set(rule.columns) != set(key) and not any(i.unique and i.columns == rule.columns for i in wanted):
                raise InvalidOption(f"a conflict rule needs a unique key on ({', '.join(rule.columns)})")
            self.rules[name] = on_conflict
        self.declared[name] = (key, wanted)
        if name in self.tables():
            found = self.drift(name, schema, strict=self.system == "duckdb")
            for line in found:
                logging.getLogger(__name__).warning("%s: %s", name, line)
            return found
        self.execute(create_table_sql(name, schema, self.system, key))
        for i in wanted:
            self.execute(create_index_sql(name, i, self.system))
        return []

    def stored_key(self, name: str) -> tuple[tuple[str, ...], tuple[Index, ...]]:
        """A table's primary key and its other indexes, as the database has them."""
        if self.system == "sqlite":
            q_ = self.dialect.quote
            key = tuple(r[1] for r in sorted((r for r in self.rows(f"PRAGMA table_info({q_(name)})") if r[5]), key=lambda r: r[5]))
            rows = [r for r in self.rows(f"PRAGMA index_list({q_(name)})") if r[3] == "c"]
            return key, tuple(Index(tuple(x[2] for x in self.rows(f"PRAGMA index_info({q_(r[1])})")), bool(r[2])) for r in rows)
        target = self._target(name)
        keys = self.rows("SELECT constraint_column_names FROM duckdb_constraints() WHERE table_name = ? AND constraint_type = 'PRIMARY KEY'", [target])
        found = self.rows("SELECT expressions, is_unique FROM duckdb_indexes() WHERE table_name = ?", [target])
        columns = lambda text: tuple(c.strip().strip("'").strip('"') for c in text.strip("[]").split(","))
        return tuple(keys[0][0]) if keys else (), tuple(Index(columns(e), bool(u)) for e, u in found)

    def drift(self, name: str, schema: T.StructType, strict: bool = False) -> list[str]:
        stored = self.schema(name)
        expected = T.StructType([T.StructField(f.name, stored[f.name].dataType if f.name in stored.names and _same_storage(f.dataType, stored[f.name].dataType) else f.dataType) for f in schema])
        (key, indexes), (stored_key, stored_indexes) = self.declared.get(name, ((), ())), self.stored_key(name)
        return drift(expected, stored, key, stored_key, indexes, stored_indexes, strict=strict)

    # ---- writes

    def insert(self, name: str, df: DataFrame, mode: str = "append", on_conflict: str | None = None, unique: Iterable[Sequence[str]] = (), on_commit=None) -> int:
        """Write a DataFrame in one transaction; returns the rows given.

        ``append`` adds, ``overwrite`` replaces all rows. Uniqueness of ``unique`` keys is checked over the whole input first,
        which is one more pass over it. ``on_commit`` gets the connection before the transaction ends; if it raises, nothing
        is written.
        """
        if not self.read_write:
            raise ReadOnlyTable(f"{name} was opened for reading; set read_write")
        if mode not in ("append", "overwrite"):
            raise InvalidOption(f"rows are written by append or overwrite, not {mode!r}")
        if name not in self.tables():
            raise UndefinedTable(name)
        stored = self.schema(name)
        if extra := set(df.columns) - set(stored.names):
            raise SchemaMismatch(f"{name} has no columns {', '.join(sorted(extra))}")
        keys = [*unique, *([self.declared[name][0]] if name in self.declared and self.declared[name][0] else [])]
        rule = on_conflict or self.rules.get(name)
        if keys and not (rule and parse_on_conflict(rule).action == "do_nothing"):
            validate(df, keys)
        given = df.select(*df.columns)
        if self.system == "sqlite":
            given = nested_to_json(given)
        if self.system == "duckdb":
            return self._insert_duckdb(name, given, mode, rule, on_commit)
        return self._insert_sqlite(name, given, mode, rule, on_commit)

    @contextmanager
    def _staged(self, df: DataFrame) -> Iterator[list[str]]:
        """The rows as Parquet files beside the database: one pass over the input, by Spark's own writer."""
        folder = f"{os.path.abspath(self.options['path'])}.staged_{os.urandom(6).hex()}"
        try:
            df.write.parquet(folder)
            yield sorted(glob.glob(f"{folder}/*.parquet"))
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    def _insert_sqlite(self, name: str, df: DataFrame, mode: str, rule: str | None, on_commit) -> int:
        conflict = f" {parse_on_conflict(rule).sql(self.dialect.quote, df.columns)}" if rule else ""
        with self._staged(df) as paths:
            # One file may have ten others attached.
            slots = 10 - len(lite.attachments(self.options))
            if len(paths) > 1 and slots > 0 and sum(map(os.path.getsize, paths)) >= SHARDED_BYTES:
                return self._insert_shards(name, paths, slots, df.columns, conflict, mode == "overwrite", on_commit)
            c = self._connect(write=True)
            try:
                return lite.load_staged(c, name, paths, df.columns, conflict, mode == "overwrite", on_commit)
            except Exception as e:
                raise classify(e) from e
            finally:
                c.close()

    def _insert_shards(self, name: str, paths: list[str], slots: int, columns: list[str], conflict: str, overwrite: bool, on_commit) -> int:
        """Tasks make SQLite files of the staged rows, which the database takes in without a value passing through Python here."""
        n = min(slots, len(paths))
        groups = [paths[len(paths) * i // n : len(paths) * (i + 1) // n] for i in range(n)]

        def make(group: list[str]) -> tuple[str, int]:
            shard = f"{group[0]}.{os.urandom(6).hex()}.sqlite"  # another name for each attempt
            return shard, lite.make_shard(group, columns, shard)

        made = self.spark.sparkContext.parallelize(groups, n).map(make).collect()
        c = self._connect(write=True)
        try:
            lite.load_shards(c, name, [shard for shard, _ in made], columns, conflict, overwrite, on_commit)
            return sum(rows for _, rows in made)
        except Exception as e:
            raise classify(e) from e
        finally:
            c.close()

    def _insert_duckdb(self, name: str, df: DataFrame, mode: str, rule: str | None, on_commit) -> int:
        names = ", ".join(map(self.dialect.quote, df.columns))
        conflict = f" {parse_on_conflict(rule).sql(self.dialect.quote, df.columns)}" if rule else ""
        generations = DuckDBGenerations(lambda: self._connect(write=True), name, self.schema(name), *self.declared.get(name, ((), ())))
        with self._staged(df) as paths:
            files = ", ".join(map(self.dialect.literal, paths))
            source = f"SELECT {names} FROM read_parquet([{files}])" if paths else f"SELECT {names} FROM {self.dialect.quote(name)} WHERE false"
            if mode == "overwrite":
                return generations.overwrite(lambda c, t: c.execute(f"INSERT INTO {self.dialect.quote(t)} ({names}) {source}").fetchone()[0], on_commit)
            c = self._connect(write=True)
            try:
                c.execute("BEGIN")
                try:
                    n = c.execute(f"SELECT count(*) FROM ({source})").fetchone()[0]
                    c.execute(f"INSERT INTO {self.dialect.quote(generations.current(c))} ({names}) {source}{conflict}")
                    if on_commit is not None:
                        on_commit(c)
                    c.execute("COMMIT")
                    return n
                except Exception as e:
                    c.execute("ROLLBACK")
                    raise classify(e) from e
            finally:
                c.close()

    def _target(self, name: str) -> str:
        if self.system != "duckdb":
            return name
        c = self._connect()
        try:
            return DuckDBGenerations(self._connect, name, T.StructType()).current(c)
        finally:
            c.close()

    def delete(self, name: str, where: Sequence[q.Expr | str] = ()) -> DataFrame:
        """Delete rows; no filter deletes all. Returns one row: count."""
        text = dml_where(list(where), self.dialect)
        n = self.execute(f"DELETE FROM {self.dialect.quote(self._target(name))}{f' WHERE {text}' if text else ''}")
        return self.spark.range(1).selectExpr(f"cast({n} as bigint) as count")

    def update(self, name: str, assignments: Mapping[str, q.Expr | str], where: Sequence[q.Expr | str] = ()) -> DataFrame:
        """Set columns; no assignment changes nothing. Returns one row: count."""
        n = 0
        if assignments:
            text = dml_where(list(where), self.dialect)
            sets = ", ".join(f"{self.dialect.quote(k)} = {v if isinstance(v, str) else q.write(v, self.dialect)}" for k, v in assignments.items())
            n = self.execute(f"UPDATE {self.dialect.quote(self._target(name))} SET {sets}{f' WHERE {text}' if text else ''}")
        return self.spark.range(1).selectExpr(f"cast({n} as bigint) as count")

    def analyze(self, name: str | None = None) -> None:
        self.execute(f"ANALYZE {self.dialect.quote(name)}" if name else "ANALYZE")

    def checkpoint(self) -> None:
        self.execute("PRAGMA wal_checkpoint(TRUNCATE)" if self.system == "sqlite" else "CHECKPOINT")


def _same_storage(a: T.DataType, b: T.DataType) -> bool:
    """Whether two types are one in a database that knows fewer."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return (isinstance(a, whole) and isinstance(b, whole)) or (isinstance(a, (T.FloatType, T.DoubleType)) and isinstance(b, (T.FloatType, T.DoubleType))) or (isinstance(a, (T.ArrayType, T.StructType, T.MapType)) and isinstance(b, T.StringType)) or (isinstance(a, (T.TimestampType, T.TimestampNTZType)) and isinstance(b, (T.TimestampType, T.TimestampNTZType)))


class TableFactory:
    """``tables()`` and ``get_table(reference)`` of a database: reads only."""

    def __init__(self, spark: SparkSession, system: str, **options: object) -> None:
        self.database = open_database(spark, system, **{k: v for k, v in options.items() if k != "read_write"})

    def tables(self) -> list[str]:
        return self.database.tables()

    def get_table(self, reference: str, arguments: Mapping[str, object] | None = None) -> DataFrame:
        if arguments:
            return self.database.query(q.Select(reference, arguments=tuple(arguments.items())))
        return self.database.table(reference)


__all__ = ["Database", "TableFactory", "open_database", "parse_columns", "register"]

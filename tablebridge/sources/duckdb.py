"""DuckDB files, and its table functions, as Spark tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS
from tablebridge.errors import classify
from tablebridge.sources.remote import BATCH, RemoteSource, arrow_schema
from tablebridge.sources.sqlite import attachments
from tablebridge.types import remote_type


def connect(path: str, attach: dict[str, str] | None = None, read_only: bool = False, settings: dict[str, str] | None = None):
    import duckdb

    c = duckdb.connect(path, read_only=read_only and path != ":memory:")
    c.execute("SET TimeZone = 'UTC'")
    for key, value in (settings or {}).items():
        c.execute(f"SET {key} = {DIALECTS['duckdb'].literal(value)}")
    for name, file in (attach or {}).items():
        c.execute(f"ATTACH {DIALECTS['duckdb'].literal(file)} AS {DIALECTS['duckdb'].quote(name)} (READ_ONLY)")
    return c


#: Settings that options may carry into a connection.
SETTINGS = ("memory_limit", "temp_directory", "preserve_insertion_order", "threads")


class DuckDBSource(RemoteSource):
    """Options as for SQLite, and the settings memory_limit, temp_directory, preserve_insertion_order, threads."""

    dialect = "duckdb"

    @classmethod
    def name(cls) -> str:
        return "tablebridge_duckdb"

    def _open(self, read_only: bool = True):
        o = self.plain
        return connect(o.get("path", ":memory:"), attachments(o), read_only, {k: o[k] for k in SETTINGS if k in o})

    def describe(self, select: q.Select) -> T.StructType:
        import duckdb

        try:
            c = self._open()
            try:
                rows = c.execute(f"DESCRIBE {select.sql('duckdb')}").fetchall()
            finally:
                c.close()
        except duckdb.Error as e:
            raise classify(e) from None
        return T.StructType([T.StructField(r[0], remote_type("duckdb", r[1])) for r in rows])

    def bounds(self, select: q.Select, column: str) -> tuple[object, object]:
        d = DIALECTS["duckdb"]
        c = self._open()
        try:
            return c.execute(f"SELECT MIN({d.quote(column)}), MAX({d.quote(column)}) FROM ({select.sql(d)})").fetchone()
        finally:
            c.close()

    def run(self, sql: str, schema: T.StructType) -> Iterator[pa.RecordBatch]:
        import duckdb

        arrow = arrow_schema(schema)
        c = self._open()
        try:
            for batch in _stream(c.execute(sql)):
                yield pa.RecordBatch.from_arrays([_cast(batch.column(i), f.type) for i, f in enumerate(arrow)], schema=arrow)
        except duckdb.Error as e:
            raise classify(e) from None
        finally:
            c.close()

    def load(self, paths: list[str], schema: T.StructType, overwrite: bool) -> int:
        import duckdb

        d, table = DIALECTS["duckdb"], DIALECTS["duckdb"].table(self.plain["table"])
        names = ", ".join(map(d.quote, schema.names))
        conflict = f" {self.conflict.sql(d.quote, schema.names)}" if self.conflict else ""
        c = self._open(read_only=False)
        try:
            c.execute("BEGIN")
            if overwrite:
                c.execute(f"DELETE FROM {table}")
            loaded = 0
            for path in paths:
                loaded += c.execute(f"INSERT INTO {table} ({names}) SELECT {names} FROM read_parquet({d.literal(path)}){conflict}").fetchone()[0]
            c.execute("COMMIT")
            return loaded
        except duckdb.Error as e:
            c.execute("ROLLBACK")
            raise classify(e) from None
        finally:
            c.close()


def _stream(result) -> Iterator[pa.RecordBatch]:
    for name in ("to_arrow_reader", "fetch_record_batch"):
        if hasattr(result, name):
            yield from getattr(result, name)(BATCH)
            return
    yield from result.arrow().to_batches()


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    if column.type == kind:
        return column
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    return column.cast(kind, safe=False) if not pa.types.is_string(kind) or pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.array([None if v is None else str(v) for v in column.to_pylist()], kind)

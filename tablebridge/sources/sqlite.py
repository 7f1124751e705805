"""SQLite files as Spark tables, over the standard library's driver."""

from __future__ import annotations

import datetime as dt
import decimal
import json
import sqlite3
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS
from tablebridge.errors import InvalidOption, SchemaMismatch, UndefinedTable, classify
from tablebridge.sources.remote import BATCH, RemoteSource, arrow_schema, staged_batches
from tablebridge.types import sqlite_type

_NESTED = (T.ArrayType, T.StructType, T.MapType)


def connect(path: str, attach: dict[str, str] | None = None, read_only: bool = False, busy_timeout: float = 5.0) -> sqlite3.Connection:
    """A connection with other files attached under their names."""
    c = sqlite3.connect(f"file:{path}?mode=ro" if read_only else path, uri=read_only, timeout=busy_timeout, isolation_level=None)
    if not read_only:
        c.execute("PRAGMA journal_mode=WAL")
        c.execute("PRAGMA synchronous=NORMAL")
    c.execute("PRAGMA case_sensitive_like=ON")
    for name, file in (attach or {}).items():
        c.execute(f"ATTACH DATABASE ? AS {DIALECTS['sqlite'].quote(name)}", (file,))
    return c


def attachments(options: dict[str, str]) -> dict[str, str]:
    """``attach_databases``: files divided by ``;``, named attachment_0 and so on, or given as ``name=file``."""
    out = {}
    for i, part in enumerate(p for p in options.get("attach_databases", "").split(";") if p):
        name, eq, file = part.partition("=")
        out[name if eq else f"attachment_{i}"] = file if eq else part
    return out


def _to_python(value: object, t: T.DataType) -> object:
    """A stored value as the Python value of a Spark type."""
    if value is None:
        return None
    if isinstance(t, T.BooleanType):
        return bool(value)
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        if isinstance(value, float):
            if not value.is_integer():
                raise SchemaMismatch(f"{value!r} is stored where whole numbers are declared")
            return int(value)
        return int(value)
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return float(value)
    if isinstance(t, T.DecimalType):
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-t.scale), context=decimal.Context(prec=60))
    if isinstance(t, T.DateType):
        return dt.date.fromisoformat(str(value)[:10])
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        stamp = dt.datetime.fromisoformat(str(value))
        if isinstance(t, T.TimestampType):
            return stamp.astimezone(dt.UTC) if stamp.tzinfo else stamp.replace(tzinfo=dt.UTC)
        return stamp.replace(tzinfo=None)
    if isinstance(t, _NESTED):
        return _nested(json.loads(value), t)
    if isinstance(t, T.BinaryType):
        return value.encode() if isinstance(value, str) else bytes(value)
    return value if isinstance(value, str) else value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def _nested(value: object, t: T.DataType) -> object:
    if value is None:
        return None
    if isinstance(t, T.ArrayType):
        return [_nested(v, t.elementType) for v in value]
    if isinstance(t, T.StructType):
        return {f.name: _nested(value.get(f.name), f.dataType) for f in t}
    if isinstance(t, T.MapType):
        return [(k, _nested(v, t.valueType)) for k, v in value.items()]
    return _to_python(value, t)


def _column(values: tuple, t: T.DataType, arrow: pa.DataType) -> pa.Array:
    """A column of stored values. What SQLite stores as Arrow takes it goes over whole; only what Arrow refuses is converted value by value."""
    kinds = set(map(type, values)) - {type(None)}
    plain = {int} if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else {int, float} if isinstance(t, (T.DoubleType, T.FloatType)) else {str}
    try:
        if kinds <= plain and isinstance(t, (T.IntegralType, T.FractionalType, T.StringType)) and not isinstance(t, T.DecimalType):
            return pa.array(values, arrow)
        if isinstance(t, T.DateType):
            return pc.utf8_slice_codeunits(pa.array(values, pa.string()), 0, 10).cast(arrow)
        if isinstance(t, T.TimestampNTZType):
            return pa.array(values, pa.string()).cast(arrow)
    except (pa.ArrowException, TypeError, ValueError, OverflowError):
        pass
    return pa.array([_to_python(v, t) for v in values], arrow)


def _to_sqlite(value: object) -> object:
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    if isinstance(value, (dt.date, dt.time)):
        return value.isoformat()
    if isinstance(value, (list, dict)):
        return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)
    return value


def _values(column: pa.Array) -> list:
    """A column's values as the driver binds them; numbers and text need no conversion."""
    t = column.type
    if pa.types.is_timestamp(t) and t.tz is None and t.unit in ("us", "ms", "s"):
        column = pc.replace_substring_regex(column.cast(pa.timestamp("us")).cast(pa.string()), r"\.000000$", "")
        t = column.type
    elif pa.types.is_date32(t):
        column = column.cast(pa.string())
        t = column.type
    if pa.types.is_string(t) or (column.null_count == 0 and (pa.types.is_integer(t) or pa.types.is_floating(t))):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_integer(t) or pa.types.is_floating(t) or pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_binary(t):
        return column.to_pylist()
    return [_to_sqlite(v) for v in column.to_pylist()]


def make_shard(paths: list[str], names: list[str], shard: str) -> int:
    """Rows of Parquet files as table ``s`` of a new SQLite file, each value as it is bound; returns their number."""
    d, given = DIALECTS["sqlite"], 0
    c = sqlite3.connect(shard, isolation_level=None)
    try:
        c.execute("PRAGMA journal_mode=OFF")
        c.execute("PRAGMA synchronous=OFF")
        c.execute(f"CREATE TABLE s ({', '.join(map(d.quote, names))})")
        c.execute("BEGIN")
        for batch in staged_batches(paths):
            c.executemany(f"INSERT INTO s VALUES ({', '.join('?' * len(names))})", zip(*(_values(batch.column(n)) for n in names), strict=True))
            given += batch.num_rows
        c.execute("COMMIT")
    finally:
        c.close()
    return given


def load_shards(c: sqlite3.Connection, table: str, shards: list[str], names: list[str], conflict: str = "", overwrite: bool = False, on_commit: Callable[[sqlite3.Connection], None] | None = None) -> None:
    """All rows of files made by :func:`make_shard`, in their order and in one transaction, in which ``on_commit`` runs last."""
    d = DIALECTS["sqlite"]
    columns, held = ", ".join(map(d.quote, names)), [f"shard_{i}" for i in range(len(shards))]
    # Pages of the keys' indexes stay in memory, as keys may come in any order.
    c.execute("PRAGMA cache_size=-131072")
    try:
        for name, shard in zip(held, shards, strict=True):
            c.execute(f"ATTACH DATABASE ? AS {name}", (shard,))
        c.execute("BEGIN IMMEDIATE")
        if overwrite:
            c.execute(f"DELETE FROM {d.table(table)}")
        for name in held:
            c.execute(f"INSERT INTO {d.table(table)} ({columns}) SELECT {columns} FROM {name}.s WHERE true{conflict}")
        if on_commit is not None:
            on_commit(c)
        c.execute("COMMIT")
    except BaseException:
        if c.in_transaction:
            c.execute("ROLLBACK")
        raise


def load_staged(c: sqlite3.Connection, table: str, paths: list[str], names: list[str], conflict: str = "", overwrite: bool = False, on_commit: Callable[[sqlite3.Connection], None] | None = None) -> int:
    """All rows of Parquet files with one prepared statement, in one transaction, in which ``on_commit`` runs last.

    Returns the number of rows given.
    """
    d, given = DIALECTS["sqlite"], 0
    sql = f"INSERT INTO {d.table(table)} ({', '.join(map(d.quote, names))}) VALUES ({', '.join('?' * len(names))}){conflict}"
    try:
        c.execute("BEGIN IMMEDIATE")
        if overwrite:
            c.execute(f"DELETE FROM {d.table(table)}")
        for batch in staged_batches(paths):
            c.executemany(sql, zip(*(_values(batch.column(n)) for n in names), strict=True))
            given += batch.num_rows
        if on_commit is not None:
            on_commit(c)
        c.execute("COMMIT")
        return given
    except BaseException:
        if c.in_transaction:
            c.execute("ROLLBACK")
        raise


class SqliteSource(RemoteSource):
    """Options: path, table or query, columns, order_by, limit, partition_column, num_partitions, partition_rows, attach_databases, read_write, on_conflict, staging."""

    dialect = "sqlite"

    @classmethod
    def name(cls) -> str:
        return "tablebridge_sqlite"

    def _open(self, read_only: bool = True) -> sqlite3.Connection:
        return connect(self.plain["path"], attachments(self.plain), read_only, float(self.plain.get("busy_timeout", "5")))

    def describe(self, select: q.Select) -> T.StructType:
        """Declared types of a table's columns; of a query's columns, what their first value is."""
        try:
            c = self._open()
            with c:
                declared = {}
                if isinstance(select.source, str):
                    *where, name = [p for p in DIALECTS["sqlite"].table(select.source).split(".")]
                    rows = c.execute(f"PRAGMA {'.'.join(where) + '.' if where else ''}table_info({name})").fetchall()
                    if not rows:
                        raise UndefinedTable(select.source)
                    declared = {r[1]: T.StructField(r[1], sqlite_type(r[2]), not r[3]) for r in rows}
                cursor = c.execute(q.Select(q.Aliased(select, "d")).limited(64).sql("sqlite"))
                names = [x[0] for x in cursor.description]
                sample = cursor.fetchall()
                return T.StructType([declared.get(n) or T.StructField(n, self._guess([r[i] for r in sample])) for i, n in enumerate(names)])
        except sqlite3.Error as e:
            raise classify(e) from None

    @staticmethod
    def _guess(values: list) -> T.DataType:
        kinds = {type(v) for v in values if v is not None}
        if kinds == {int}:
            return T.LongType()
        if kinds and kinds <= {int, float}:
            return T.DoubleType()
        return T.BinaryType() if kinds == {bytes} else T.StringType()

    def bounds(self, select: q.Select, column: str) -> tuple[object, object]:
        d = DIALECTS["sqlite"]
        with self._open() as c:
            return c.execute(f"SELECT MIN({d.quote(column)}), MAX({d.quote(column)}) FROM ({select.sql(d)})").fetchone()

    def pieces(self, table: str, rows: int) -> list[q.Expr | None]:
        """Conditions that cut a table into ranges of about so many rows in the order in which they are stored."""
        d, key = DIALECTS["sqlite"], q.Column("rowid")
        if "rowid" in (n.lower() for n in self.describe(q.Select(table)).names):
            raise InvalidOption(f"{table} has a column rowid: give a partition_column")
        with self._open() as c:
            low, high = c.execute(f"SELECT (SELECT MIN(rowid) FROM {d.table(table)}), (SELECT MAX(rowid) FROM {d.table(table)})").fetchone()
        cuts = list(range(low + rows, high + 1, rows)) if low is not None else []
        ends = zip([None, *cuts], [*cuts, None], strict=True)
        return [q.all_of([q.Binary(op, key, q.Literal(v)) for op, v in ((">=", a), ("<", b)) if v is not None]) for a, b in ends]

    def run(self, sql: str, schema: T.StructType) -> Iterator[pa.RecordBatch]:
        arrow = arrow_schema(schema)
        c = self._open()
        try:
            cursor = c.execute(sql)
            while rows := cursor.fetchmany(BATCH):
                if not schema.fields:
                    yield pa.RecordBatch.from_struct_array(pa.array([{}] * len(rows), pa.struct([])))
                    continue
                columns = [_column(col, f.dataType, arrow.field(i).type) for i, (col, f) in enumerate(zip(zip(*rows, strict=True), schema, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        except sqlite3.Error as e:
            raise classify(e) from None
        finally:
            c.close()

    def load(self, paths: list[str], schema: T.StructType, overwrite: bool) -> int:
        """All staged rows with one prepared statement, in one transaction."""
        conflict = f" {self.conflict.sql(DIALECTS['sqlite'].quote, schema.names)}" if self.conflict else ""
        c = self._open(read_only=False)
        try:
            return load_staged(c, self.plain["table"], paths, schema.names, conflict, overwrite)
        except sqlite3.Error as e:
            raise classify(e) from None
        finally:
            c.close()

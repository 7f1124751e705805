"""What connectors of embedded databases share: the data source, its reader and its staged writer.

A read is a :class:`~tablebridge.sqlgen.Select`. Spark hands over filters; those with an exact form join
it and disappear from the plan, the others stay with Spark. Columns, order and limit come as options, as
Spark passes none of them to Python sources. A partition column cuts the read into ranges, one task each.

A write stages its tasks' rows as Parquet next to the database, in storage that the driver also sees, and
loads them in one transaction when all have arrived; an aborted write leaves the table as it was.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from tablebridge import sqlgen as q
from tablebridge.dialects import DIALECTS
from tablebridge.errors import InvalidOption, ReadOnlyTable
from tablebridge.options import OnConflict, as_bool, parse_on_conflict
from tablebridge.predicates import from_spark_filter

BATCH = 8192


def base_select(options: dict[str, str]) -> q.Select:
    """The read that the options describe: ``table`` or ``query``, ``columns``, ``order_by`` and ``limit``."""
    if ("table" in options) == ("query" in options):
        raise InvalidOption(f"give either table or query, not {sorted(options)}")
    if "query" in options:
        out = q.Select(q.Aliased(q.RawSql(options["query"]), "t"))
    elif is_function(options["table"]):
        out = q.Select(q.Aliased(q.TableFunction(options["table"]), "t"))
    else:
        out = q.Select(options["table"])
    if "columns" in options:
        out = q.Select(out.source, tuple(json.loads(options["columns"])))
    if "order_by" in options:
        out = out.sorted(*(q.Order(q.Column(c), asc, nulls) for c, asc, nulls in json.loads(options["order_by"])))
    return out.limited(int(options["limit"])) if "limit" in options else out


def is_function(reference: str) -> bool:
    """Whether a bare reference is a call, such as read_csv_auto('x.csv')."""
    name, paren, rest = reference.strip().partition("(")
    return bool(paren) and rest.endswith(")") and name.replace("_", "a").isalnum() and not name[0].isdigit()


@dataclass
class Range(InputPartition):
    where: q.Expr | None = None


@dataclass
class Staged(WriterCommitMessage):
    path: str | None
    rows: int


class RemoteSource(DataSource):
    """Subclasses name a dialect and say how to connect, describe, read and load."""

    dialect = "generic"

    def describe(self, select: q.Select) -> T.StructType:
        raise NotImplementedError

    def run(self, sql: str, schema: T.StructType) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def bounds(self, select: q.Select, column: str) -> tuple[object, object]:
        raise NotImplementedError

    def pieces(self, table: str, rows: int) -> list[q.Expr | None]:
        raise InvalidOption(f"{self.dialect} has no rows in an order of its own: give a partition_column")

    def load(self, paths: list[str], schema: T.StructType, overwrite: bool) -> int:
        raise NotImplementedError

    @property
    def plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def schema(self) -> T.StructType:
        return self.describe(base_select(self.plain))

    def reader(self, schema: T.StructType) -> RemoteReader:
        return RemoteReader(self, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> RemoteWriter:
        if not as_bool(self.plain.get("read_write", "false"), "read_write"):
            raise ReadOnlyTable(f"{self.plain.get('table')} was opened for reading; set read_write")
        return RemoteWriter(self, schema, overwrite)

    @property
    def conflict(self) -> OnConflict | None:
        text = self.plain.get("on_conflict")
        return parse_on_conflict(text) if text else None


class RemoteReader(DataSourceReader):
    def __init__(self, source: RemoteSource, schema: T.StructType) -> None:
        self.source, self.schema, self.predicates = source, schema, ()

    def pushFilters(self, filters: list) -> Iterator:
        dialect = DIALECTS[self.source.dialect]
        # Below a limit a filter would choose other rows: Spark keeps it above.
        limited = "limit" in self.source.plain
        for f in filters:
            e = None if limited else from_spark_filter(f)
            if e is not None and q.pushable(e, dialect):
                self.predicates += (e,)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        options = self.source.plain
        if "partition_rows" in options and not {"limit", "order_by", "partition_column"} & set(options):
            return [Range(where) for where in self.source.pieces(options["table"], int(options["partition_rows"]))]
        column, n = options.get("partition_column"), int(options.get("num_partitions", "1"))
        if not column or n <= 1 or "limit" in options:
            return [Range(None)]
        low, high = self.source.bounds(base_select(options), column)
        if low is None:
            return [Range(None)]
        step = max(1, -(-(int(high) - int(low) + 1) // n))
        cuts = list(range(int(low) + step, int(high) + 1, step))
        c = q.Column(column)
        out = []
        for a, b in zip([None, *cuts], [*cuts, None], strict=True):
            parts = [q.Binary(">=", c, q.Literal(a))] if a is not None else []
            parts += [q.Binary("<", c, q.Literal(b))] if b is not None else []
            where = q.all_of(parts)
            if a is None:  # nulls are in the first range
                where = q.IsNull(c) if where is None else q.IsNull(c) | where
            out.append(Range(where))
        return out

    def select(self, partition: Range) -> q.Select:
        out = base_select(self.source.plain)
        extra = self.predicates + ((partition.where,) if partition.where is not None else ())
        out = out.filtered(*extra) if extra else out
        if out.columns is None:
            # Names in order, so that a table changed meanwhile can't shift columns.
            out = q.Select(q.Aliased(out, "s") if out.where or out.order or out.fetch is not None else out.source, tuple(f.name for f in self.schema))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from self.source.run(self.select(partition).sql(self.source.dialect), self.schema)


class RemoteWriter(DataSourceArrowWriter):
    def __init__(self, source: RemoteSource, schema: T.StructType, overwrite: bool) -> None:
        self.source, self.schema, self.overwrite = source, schema, overwrite
        options = source.plain
        root = options.get("staging") or os.path.dirname(os.path.abspath(options["path"]))
        self.folder = os.path.join(root, f".staged-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        writer, rows, path = None, 0, os.path.join(self.folder, f"{uuid.uuid4().hex}.parquet")
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    os.makedirs(self.folder, exist_ok=True)
                    writer = pq.ParquetWriter(path, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(path if writer is not None else None, rows)

    def commit(self, messages: list) -> None:
        try:
            # Tasks that Spark ran twice left files too; only those of committed ones are loaded.
            self.source.load([m.path for m in messages if m is not None and m.path], self.schema, self.overwrite)
        finally:
            shutil.rmtree(self.folder, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def staged_batches(paths: list[str]) -> Iterator[pa.RecordBatch]:
    for path in paths:
        with pq.ParquetFile(path) as f:
            yield from f.iter_batches(BATCH)

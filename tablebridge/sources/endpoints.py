"""A table whose parts live behind several endpoints, each in one or more places.

Every endpoint is one partition; its locations are tried in order until one answers. How an endpoint is
read is up to a driver class: this package brings one for Arrow and Parquet files, others subclass
:class:`EndpointDriver`. Filters and limits stay with Spark; columns are selected at the endpoint.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

from tablebridge.errors import InvalidOption, RemoteFailure, SchemaMismatch
from tablebridge.options import as_bool
from tablebridge.sources.remote import arrow_schema


@dataclass
class Endpoint(InputPartition):
    ticket: str
    locations: list[str] = field(default_factory=list)


class EndpointDriver:
    """How a service is asked. Subclasses are named by the option ``driver`` as module:Class."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def endpoints(self) -> list[Endpoint]:
        """``endpoints``: a JSON list of {ticket, locations}."""
        return [Endpoint(e["ticket"], list(e["locations"])) for e in json.loads(self.options["endpoints"])]

    def schema(self) -> T.StructType:
        for e in self.endpoints():
            for location in e.locations:
                try:
                    first = next(iter(self.fetch(location, e.ticket, None)), None)
                except OSError:
                    continue
                if first is not None:
                    return from_arrow_schema(first.schema)
        raise SchemaMismatch("no endpoint tells a schema")

    def fetch(self, location: str, ticket: str, columns: list[str] | None) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


class FileDriver(EndpointDriver):
    """Locations are folders; a ticket is a file name in them, Parquet or Arrow IPC."""

    def fetch(self, location: str, ticket: str, columns: list[str] | None) -> Iterator[pa.RecordBatch]:
        path = f"{location.rstrip('/')}/{ticket}"
        if ticket.endswith(".parquet"):
            import pyarrow.parquet as pq

            with pq.ParquetFile(path) as f:
                yield from f.iter_batches(columns=columns)
        else:
            with pa.memory_map(path) as m:
                file = pa.ipc.open_file(m)
                for i in range(file.num_record_batches):
                    batch = file.get_batch(i)
                    yield batch.select(columns) if columns is not None else batch


def driver_of(options: dict[str, str]) -> EndpointDriver:
    name = options.get("driver")
    if not name:
        return FileDriver(options)
    module, _, cls = name.partition(":")
    made = getattr(importlib.import_module(module), cls)(options)
    if not isinstance(made, EndpointDriver):
        raise InvalidOption(f"{name} is not an EndpointDriver")
    return made


def conform(batch: pa.RecordBatch, schema: T.StructType) -> pa.RecordBatch:
    """A batch with exactly the schema's columns, in order: extra ones go, types are cast, missing nullable ones are null."""
    arrow = arrow_schema(schema)
    out = []
    for f, want in zip(schema, arrow, strict=True):
        at = batch.schema.get_field_index(f.name)
        if at >= 0:
            out.append(batch.column(at) if batch.column(at).type == want.type else batch.column(at).cast(want.type))
        elif f.nullable:
            out.append(pa.nulls(batch.num_rows, want.type))
        else:
            raise SchemaMismatch(f"column {f.name!r} is required but an endpoint lacks it")
    return pa.RecordBatch.from_arrays(out, schema=arrow)


class EndpointReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options, self.schema = options, schema

    def partitions(self) -> list[InputPartition]:
        return driver_of(self.options).endpoints()

    def read(self, partition: Endpoint) -> Iterator[pa.RecordBatch]:
        driver, failed = driver_of(self.options), []
        wanted = self.schema.names if "columns" in self.options else None
        for location in partition.locations:
            given = 0
            try:
                for batch in driver.fetch(location, partition.ticket, wanted):
                    yield conform(batch, self.schema)
                    given += 1
                return
            except (OSError, RemoteFailure) as e:
                if given:  # rows were passed on: another place would repeat them
                    raise
                failed.append(f"{location}: {e}")
        raise RemoteFailure(f"no location of {partition.ticket!r} answers: {'; '.join(failed)}")


class EndpointStream(EndpointReader, DataSourceStreamReader):
    """Unbounded endpoints: offsets count endpoints, each of which is read once."""

    def initialOffset(self) -> dict:
        return {"endpoints": 0}

    def latestOffset(self) -> dict:
        return {"endpoints": len(driver_of(self.options).endpoints())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:  # type: ignore[override]
        return driver_of(self.options).endpoints()[start["endpoints"] : end["endpoints"]]

    def commit(self, end: dict) -> None:
        return None


class EndpointSource(DataSource):
    """Options: endpoints or what the driver wants, driver, columns, unbounded."""

    @classmethod
    def name(cls) -> str:
        return "tablebridge_endpoints"

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def schema(self) -> T.StructType:
        full = driver_of(self._options()).schema()
        if "columns" in self._options():
            return T.StructType([full[c] for c in json.loads(self._options()["columns"])])
        return full

    def reader(self, schema: T.StructType) -> EndpointReader:
        return EndpointReader(self._options(), schema)

    def streamReader(self, schema: T.StructType) -> EndpointStream:
        if not as_bool(self._options().get("unbounded", "false"), "unbounded"):
            raise InvalidOption("endpoints are read as a stream only with unbounded=true")
        return EndpointStream(self._options(), schema)

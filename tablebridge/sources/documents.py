"""JSON documents as tables: inferred types, unnesting, and a catch-all column for what isn't declared.

A collection is a folder or file of JSON lines, read as text and shaped by Spark. Types are unified over a
sample of documents; the rest is SQL over the JSON text, so filters and projections stay in the engine.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.errors import InvalidOption, SchemaMismatch

SAMPLE = 400
_STAMP = re.compile(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:?\d\d)?$")
_DAY = re.compile(r"^\d{4}-\d\d-\d\d$")


# ---- inference


def value_type(value: object, dates: bool = True) -> T.DataType:
    """The type of one JSON value. Objects are JSON text and arrays are lists of text unless they are unnested."""
    if value is None:
        return T.NullType()
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.IntegerType() if -(1 << 31) <= value < 1 << 31 else T.LongType() if -(1 << 63) <= value < 1 << 63 else T.DecimalType(38, 0)
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, str):
        if dates and _DAY.match(value):
            return T.DateType()
        if dates and _STAMP.match(value):
            return T.TimestampType()
        return T.StringType()
    if isinstance(value, list):
        return T.ArrayType(T.StringType())
    return T.StringType()


def unify(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest of the known types that holds both; unlike kinds become text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    both = {type(a), type(b)}
    if both == {T.IntegerType, T.LongType}:
        return T.LongType()
    if both <= {T.IntegerType, T.LongType, T.DoubleType}:
        return T.DoubleType()
    if both == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def infer_schema(documents: list[Mapping], depth: int = 0, dates: bool = True) -> T.StructType:
    """Fields in order of their names; with a depth, objects become dotted fields as :func:`unnest_document` has them."""
    found: dict[str, T.DataType] = {}
    for d in documents:
        for name, value in (unnest_document(d, depth) if depth else d).items():
            found[name] = unify(found.get(name, T.NullType()), value_type(value, dates))
    return T.StructType([T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t) for n, t in sorted(found.items())])


def unnest_document(document: Mapping, depth: int, custom: Callable[[str, object], object] | None = None) -> dict:
    """Objects down to ``depth`` as dotted keys; what lies deeper stays. Two paths to one key are an error."""
    out: dict = {}

    def walk(prefix: str, value: object, left: int) -> None:
        if custom is not None and prefix:
            value = custom(prefix, value)
        if isinstance(value, Mapping) and (left > 0 or not prefix) and value:
            for k, v in value.items():
                walk(f"{prefix}.{k}" if prefix else k, v, left - 1 if prefix else left)
            return
        if prefix in out:
            raise SchemaMismatch(f"the key {prefix!r} occurs twice after unnesting")
        out[prefix] = value

    walk("", document, depth)
    return out


# ---- projection with a catch-all


@dataclass(frozen=True)
class Projection:
    """Declared columns, and optionally one that holds all other fields as JSON with sorted keys."""

    columns: T.StructType
    catch_all: str | None = None
    required: frozenset[str] = field(default_factory=frozenset)
    open_world: bool = False

    def __post_init__(self) -> None:
        names = self.columns.names + ([self.catch_all] if self.catch_all else [])
        if len(set(names)) < len(names):
            raise InvalidOption("a column is declared twice")
        if missing := self.required - set(self.columns.names):
            raise InvalidOption(f"required columns can't go to the catch-all: {', '.join(sorted(missing))}")

    def schema(self, inferred: T.StructType | None = None) -> T.StructType:
        """Closed world: what is declared, and the catch-all. Open world: what was inferred as well."""
        fields = list(self.columns)
        if self.open_world and inferred is not None:
            fields += [f for f in inferred if f.name not in self.columns.names and f.name != self.catch_all]
        return T.StructType(fields + ([T.StructField(self.catch_all, T.StringType())] if self.catch_all else []))


def canonical(value: object) -> str:
    """JSON with sorted keys and no spaces."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def project_document(document: object, p: Projection) -> dict:
    """One document as a row: the definition that :func:`project` follows."""
    if not isinstance(document, Mapping):
        return {f.name: None for f in p.columns} | ({p.catch_all: canonical(document)} if p.catch_all else {})
    row = {f.name: document.get(f.name) for f in p.columns}
    if p.catch_all:
        rest = {k: v for k, v in document.items() if k not in row}
        row[p.catch_all] = canonical(rest) if rest else None
    return row


def field_value(json_text: Column, name: str, kind: T.DataType) -> Column:
    """One field of JSON text as a type; explicit null and absence are null."""
    schema = T.StructType([T.StructField(name, kind)])
    return F.from_json(json_text, schema)[name]


def project(df: DataFrame, p: Projection, json_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text as declared columns and the catch-all, in SQL expressions alone.

    The remainder's values keep their types as variants; only the top level's keys need sorting, as variants hold
    nested keys in order.
    """
    text = F.col(json_col)
    declared = F.from_json(text, p.columns) if p.columns.fields else None
    out = [F.col(c) for c in keep or []]
    out += [declared[f.name].alias(f.name) for f in p.columns]
    if p.catch_all:
        fields = F.from_json(text, T.MapType(T.StringType(), T.VariantType()))
        rest = F.map_filter(fields, lambda k, v: ~k.isin(*p.columns.names)) if p.columns.fields else fields
        entries = F.array_sort(F.transform(F.map_keys(rest), lambda k: k))
        body = F.concat_ws(",", F.transform(entries, lambda k: F.concat(F.to_json(F.array(k)).substr(F.lit(2), F.length(F.to_json(F.array(k))) - 2), F.lit(":"), F.to_json(F.element_at(rest, k)))))
        # What isn't an object goes to the catch-all whole.
        is_object = text.rlike(r"^\s*\{")
        folded = F.when(~is_object, text).when(F.size(rest) > 0, F.concat(F.lit("{"), body, F.lit("}")))
        out.append(folded.alias(p.catch_all))
    return df.select(*out)


# ---- collections


def read_collection(spark: SparkSession, path: str, declared: T.StructType | None = None, depth: int = 0, sample: int = SAMPLE, projection: Projection | None = None) -> DataFrame:
    """A collection of JSON lines as a DataFrame.

    Types come from at most ``sample`` documents, declared ones override them. ``depth`` unnests objects into dotted
    columns. An empty collection needs a declared schema.
    """
    lines = spark.read.text(path)
    if projection is not None:
        return project(lines, projection)
    head = [json.loads(r["value"]) for r in lines.limit(sample).collect()]
    if not head and declared is None:
        raise SchemaMismatch(f"{path} holds no documents; declare a schema")
    inferred = infer_schema([d for d in head if isinstance(d, Mapping)], depth)
    over = {f.name: f for f in declared} if declared else {}
    fields = [over.get(f.name, f) for f in inferred] + [f for f in declared or [] if f.name not in inferred.names]
    return lines.select(*(coerced(F.col("value"), f.name, f.dataType, depth).alias(f.name) for f in fields))


def coerced(text: Column, name: str, kind: T.DataType, depth: int = 0) -> Column:
    """A field by its dotted name as a type. Values that don't fit are null: out of range, not a number, not a date."""
    path = "$." + ".".join(f"['{p}']" for p in name.split(".")).replace(".[", "[") if depth else f"$['{name}']"
    path = path.replace("$.[", "$[")
    raw = F.get_json_object(text, path)
    if isinstance(kind, T.ArrayType):
        items = F.from_json(raw, T.ArrayType(T.VariantType()))
        return F.transform(items, lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.from_json(raw, kind)
    if isinstance(kind, T.DecimalType):
        return F.round(raw.try_cast(T.DecimalType(38, min(18, kind.scale + 4))), kind.scale).try_cast(kind)
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return raw.try_cast(T.DecimalType(38, 6)).try_cast(kind)
    return raw if isinstance(kind, T.StringType) else raw.try_cast(kind)


def decode_json(df: DataFrame, column: str, kind: T.DataType) -> DataFrame:
    """JSON text as a list, struct or map; text that isn't JSON of that kind is an error."""
    wrapped = T.StructType([T.StructField("v", kind)])
    text = F.when(F.col(column).isNotNull(), F.concat(F.lit('{"v":'), F.col(column), F.lit("}")))
    return df.withColumn(column, F.from_json(text, wrapped, {"mode": "FAILFAST"})["v"])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text, for systems without nested types."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*(F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema))


def unnest(df: DataFrame, depth: int) -> DataFrame:
    """Struct columns down to ``depth`` as dotted columns."""

    def leaves(prefix: str, column: Column, t: T.DataType, left: int):
        if isinstance(t, T.StructType) and left > 0 and t.fields:
            for f in t:
                yield from leaves(f"{prefix}.{f.name}", column[f.name], f.dataType, left - 1)
        else:
            yield prefix, column

    pairs = [x for f in df.schema for x in leaves(f.name, F.col(f"`{f.name}`"), f.dataType, depth)]
    names = [n for n, _ in pairs]
    if len(set(names)) < len(names):
        raise SchemaMismatch("two columns have one name after unnesting")
    return df.select(*(c.alias(n) for n, c in pairs))


def midnight_dates(values: list[dt.datetime]) -> T.DataType:
    """Stamps that are all at midnight are dates; any other makes them timestamps."""
    return T.DateType() if values and all(v.time() == dt.time(0) for v in values) else T.TimestampType()


class Collection:
    """A collection as one would ask a document store: a filter, columns, an order and a limit.

    ``filter_document`` is what a store is sent. Here the same predicate runs in Spark over the collection's columns, so a
    scan reads the documents once, in parallel.
    """

    def __init__(self, spark: SparkSession, path: str, declared: T.StructType | None = None, depth: int = 0) -> None:
        self.df = read_collection(spark, path, declared, depth)

    @staticmethod
    def filter_document(predicate) -> dict:
        from tablebridge.predicates import to_document

        return to_document(predicate)

    @staticmethod
    def projection_document(columns: list[str] | None) -> dict | None:
        """None takes all fields; no columns at all still needs one to count rows by."""
        if columns is None:
            return None
        return {c: 1 for c in columns} | ({} if "_id" in columns or not columns else {"_id": 0}) if columns else {"_id": 1}

    @staticmethod
    def sort_document(order: list[tuple[str, bool]]) -> dict:
        """Stores can't place nulls, so Spark sorts again."""
        return {c: 1 if ascending else -1 for c, ascending in order}

    def find(self, predicate=None, columns: list[str] | None = None, order: list[tuple[str, bool]] | None = None, limit: int | None = None) -> DataFrame:
        from tablebridge.predicates import to_column

        if limit is not None and not 0 <= limit < 1 << 31:
            raise InvalidOption("a limit is a 32-bit number")
        out = self.df if predicate is None else self.df.where(to_column(predicate))
        if order:
            out = out.orderBy(*(F.col(f"`{c}`").asc_nulls_first() if ascending else F.col(f"`{c}`").desc_nulls_last() for c, ascending in order))
        out = out if limit is None else out.limit(limit)
        return out if columns is None else out.select(*(F.col(f"`{c}`") for c in columns))

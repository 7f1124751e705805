"""Type names of remote systems as Spark types, schemas merged and enforced, Spark types as column types."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.errors import InvalidOption, SchemaMismatch, UnsupportedType

#: Decimals without precision, as PostgreSQL's numeric.
DEFAULT_DECIMAL = T.DecimalType(38, 20)


def decimal_type(precision: int | None, scale: int | None) -> T.DataType:
    """A decimal; beyond 38 digits a string, which loses nothing."""
    if precision is None:
        return DEFAULT_DECIMAL
    scale = scale or 0
    if precision > 38:
        return T.StringType()
    return T.DecimalType(precision, min(scale, precision))


def _sized(name: str) -> tuple[str, list[int]]:
    m = re.match(r"^\s*([^(]+?)\s*(?:\(\s*([\d\s,]+)\)\s*([^()]*))?$", name)
    if not m:
        return name.strip().lower(), []
    base = f"{m[1]} {m[3] or ''}".strip().lower()
    return re.sub(r"\s+", " ", base), [int(x) for x in m[2].split(",")] if m[2] else []


_S, _I, _L, _D = T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TEXT, _BIN, _BOOL = T.StringType(), T.BinaryType(), T.BooleanType()
_NTZ, _TS, _DATE = T.TimestampNTZType(), T.TimestampType(), T.DateType()
_TIME = T.TimeType(6) if hasattr(T, "TimeType") else T.LongType()
_RANGE = T.StructType([T.StructField("lower", _I), T.StructField("upper", _I)])

#: Type names of each system.
POSTGRES = {
    "smallint": _S, "int2": _S, "integer": _I, "int": _I, "int4": _I, "serial": _I, "bigint": _L, "int8": _L, "bigserial": _L, "oid": _L, "xid": _L,
    "real": T.FloatType(), "float4": T.FloatType(), "double precision": _D, "float8": _D, "money": _L,
    "text": _TEXT, "varchar": _TEXT, "character varying": _TEXT, "char": _TEXT, "character": _TEXT, "bpchar": _TEXT, "name": _TEXT, "uuid": _TEXT, "inet": _TEXT, "cidr": _TEXT, "macaddr": _TEXT, "bit": _TEXT, "bit varying": _TEXT, "xml": _TEXT,
    "json": _TEXT, "jsonb": _TEXT, "super": _TEXT, "enum": _TEXT,
    "bytea": _BIN, "geometry": _BIN, "geography": _BIN, "boolean": _BOOL, "bool": _BOOL,
    "date": _DATE, "time": _TIME, "time without time zone": _TIME, "timestamp": _NTZ, "timestamp without time zone": _NTZ, "timestamptz": _TS, "timestamp with time zone": _TS,
    "interval": T.DayTimeIntervalType(), "point": T.ArrayType(_D), "int4range": _RANGE,
}
MYSQL = {
    "tinyint": T.ByteType(), "smallint": _S, "year": _S, "mediumint": _I, "int": _I, "integer": _I, "bigint": _L, "float": T.FloatType(), "double": _D, "real": _D,
    "tinyint unsigned": _S, "smallint unsigned": _I, "mediumint unsigned": _L, "int unsigned": _L, "bigint unsigned": T.DecimalType(20, 0), "bit": T.DecimalType(20, 0),
    "char": _TEXT, "varchar": _TEXT, "tinytext": _TEXT, "text": _TEXT, "mediumtext": _TEXT, "longtext": _TEXT, "enum": _TEXT, "set": _TEXT, "json": _TEXT,
    "binary": _BIN, "varbinary": _BIN, "tinyblob": _BIN, "blob": _BIN, "mediumblob": _BIN, "longblob": _BIN, "geometry": _BIN,
    "boolean": _BOOL, "bool": _BOOL, "date": _DATE, "time": _TIME, "datetime": _NTZ, "timestamp": _NTZ,
}
DUCKDB = {
    "tinyint": T.ByteType(), "smallint": _S, "integer": _I, "bigint": _L, "hugeint": T.DecimalType(38, 0), "utinyint": _S, "usmallint": _I, "uinteger": _L, "ubigint": T.DecimalType(20, 0), "float": T.FloatType(), "double": _D,
    "varchar": _TEXT, "json": _TEXT, "uuid": _TEXT, "enum": _TEXT, "blob": _BIN, "bit": _TEXT, "boolean": _BOOL, "date": _DATE, "time": _TIME, "interval": _TEXT,
    "timestamp": _NTZ, "timestamp_s": _NTZ, "timestamp_ms": _NTZ, "timestamp_ns": _NTZ, "timestamp with time zone": _TS,
}
CLICKHOUSE = {
    "int8": T.ByteType(), "int16": _S, "int32": _I, "int64": _L, "uint8": _S, "uint16": _I, "uint32": _L, "uint64": T.DecimalType(20, 0), "float32": T.FloatType(), "float64": _D,
    "string": _TEXT, "fixedstring": _TEXT, "uuid": _TEXT, "enum8": _TEXT, "enum16": _TEXT, "bool": _BOOL, "date": _DATE, "date32": _DATE, "datetime": _TS, "datetime64": _TS,
}
HIVE = {
    "tinyint": T.ByteType(), "smallint": _S, "int": _I, "integer": _I, "bigint": _L, "float": T.FloatType(), "real": T.FloatType(), "double": _D, "double precision": _D,
    "string": _TEXT, "varchar": _TEXT, "char": _TEXT, "binary": _BIN, "boolean": _BOOL, "date": _DATE, "timestamp": _NTZ,
}
BSON = {"double": _D, "string": _TEXT, "object": _TEXT, "array": T.ArrayType(_TEXT), "binData": _BIN, "objectId": _TEXT, "bool": _BOOL, "date": _TS, "null": T.NullType(), "int": _I, "long": _L, "decimal": T.DecimalType(18, 6), "timestamp": _TS}


def remote_type(system: str, name: str) -> T.DataType:
    """A column type of postgres, mysql, duckdb, clickhouse, hive, sqlite or bson as a Spark type."""
    if system == "sqlite":
        return sqlite_type(name)
    if system == "bson":
        if name not in BSON:
            raise UnsupportedType(f"bson type {name!r}")
        return BSON[name]
    table = {"postgres": POSTGRES, "mysql": MYSQL, "duckdb": DUCKDB, "clickhouse": CLICKHOUSE, "hive": HIVE}[system]
    text = name.strip()
    low = text.lower()
    if system in ("postgres", "duckdb") and text.endswith("[]"):
        return T.ArrayType(remote_type(system, text[:-2]))
    if system == "postgres" and low.startswith("_"):
        return T.ArrayType(remote_type(system, text[1:]))
    if system == "duckdb" and (m := re.match(r"^(.*)\[\d+\]$", text)):
        return T.ArrayType(remote_type(system, m[1]))
    if system == "duckdb" and low.startswith(("struct(", "map(")):
        inside = split_top(text[text.index("(") + 1 : -1])
        if low.startswith("map"):
            return T.MapType(remote_type(system, inside[0]), remote_type(system, inside[1]))
        return T.StructType([T.StructField(n.strip('"'), remote_type(system, t)) for n, t in (p.strip().split(None, 1) for p in inside)])
    if system == "duckdb" and low.startswith("enum"):
        return _TEXT
    if system == "clickhouse":
        for wrapper in ("nullable", "lowcardinality"):
            if low.startswith(wrapper + "("):
                return remote_type(system, text[len(wrapper) + 1 : -1])
        if low.startswith("array("):
            return T.ArrayType(remote_type(system, text[6:-1]))
        if low.startswith("map("):
            k, v = split_top(text[4:-1])
            return T.MapType(remote_type(system, k), remote_type(system, v))
        if low.startswith("tuple("):
            parts = [p.strip() for p in split_top(text[6:-1])]
            named = [p.split(None, 1) if re.match(r"^\w+\s+\w", p) else (f"_{i}", p) for i, p in enumerate(parts, 1)]
            return T.StructType([T.StructField(n, remote_type(system, t)) for n, t in named])
    if system == "hive" and "<" in text:
        return parse_hive_type(text)
    if low.startswith(("enum(", "set(", "enum8(", "enum16(", "fixedstring(", "datetime64(", "datetime(")):
        base, sizes = low.split("(")[0], []
    else:
        base, sizes = _sized(text)
    base = base.replace(" zerofill", "")
    if base in ("decimal", "numeric", "dec", "fixed", "decimal unsigned") or re.match(r"^decimal(32|64|128|256)$", base):
        if m := re.match(r"^decimal(32|64|128|256)$", base):
            return decimal_type({"32": 9, "64": 18, "128": 38, "256": 76}[m[1]], sizes[0] if sizes else 0)
        if not sizes:
            return {"mysql": T.DecimalType(10, 0), "hive": T.DecimalType(10, 0), "duckdb": T.DecimalType(18, 3)}.get(system, DEFAULT_DECIMAL)
        return decimal_type(sizes[0], sizes[1] if len(sizes) > 1 else 0)
    if system == "mysql" and base == "tinyint" and sizes == [1]:
        return _BOOL
    if base in table:
        return table[base]
    raise UnsupportedType(f"{system} type {name!r}")


def sqlite_type(declared: str | None) -> T.DataType:
    """A declared SQLite type by its name, else by the engine's affinity rules."""
    base, sizes = _sized(declared or "")
    exact = {"boolean": _BOOL, "bool": _BOOL, "date": _DATE, "timestamp": _NTZ, "datetime": _NTZ, "tinyint": T.ByteType(), "smallint": _S, "int": _L, "integer": _L, "float": _D}
    if base in exact:
        return exact[base]
    if base in ("decimal", "numeric") and sizes:
        return decimal_type(sizes[0], sizes[1] if len(sizes) > 1 else 0)
    if "int" in base:
        return _L
    if any(x in base for x in ("char", "clob", "text", "json", "uuid")):
        return _TEXT
    if "blob" in base:
        return _BIN
    if any(x in base for x in ("real", "floa", "doub", "numeric", "decimal")):
        return _D
    return _TEXT


def split_top(text: str, sep: str = ",") -> list[str]:
    """Split at separators outside brackets and quotes."""
    out, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "(<[":
            depth += 1
        elif c in ")>]":
            depth -= 1
        elif c == sep and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


def parse_hive_type(text: str, depth: int = 0) -> T.DataType:
    """``array<struct<a:int NOT NULL COMMENT 'x',b:map<string,decimal(9,2)>>>``; nesting ends at 100."""
    if depth > 100:
        raise InvalidOption("a type is nested more than 100 deep")
    text = text.strip()
    m = re.match(r"^(array|map|struct)\s*<(.*)>$", text, re.IGNORECASE | re.DOTALL)
    if not m:
        if "<" in text or ">" in text:
            raise InvalidOption(f"not a type: {text!r}")
        return remote_type("hive", text)
    parts = split_top(m[2])
    kind = m[1].lower()
    if kind == "array" and len(parts) == 1:
        return T.ArrayType(parse_hive_type(parts[0], depth + 1))
    if kind == "map" and len(parts) == 2:
        return T.MapType(parse_hive_type(parts[0], depth + 1), parse_hive_type(parts[1], depth + 1))
    if kind == "struct":
        fields = []
        for part in parts:
            name, colon, rest = part.partition(":")
            if not colon:
                raise InvalidOption(f"a field of {text!r} has no type")
            rest = re.sub(r"\s+COMMENT\s+'(?:[^']|'')*'\s*$", "", rest, flags=re.IGNORECASE)
            nullable = not re.search(r"\s+NOT\s+NULL\s*$", rest, re.IGNORECASE)
            rest = re.sub(r"\s+NOT\s+NULL\s*$", "", rest, flags=re.IGNORECASE)
            fields.append(T.StructField(name.strip(" `"), parse_hive_type(rest, depth + 1), nullable))
        return T.StructType(fields)
    raise InvalidOption(f"not a type: {text!r}")


# ---- schemas


def build_schema(columns: Iterable[tuple[str, str, bool]], system: str, unsupported: str = "error", log: Callable[[str], None] = print) -> T.StructType:
    """(name, type name, nullable) as a schema. Unsupported types: ``error``, ``warn`` and ``ignore`` (drop the column), ``string``."""
    if unsupported not in ("error", "warn", "ignore", "string"):
        raise InvalidOption(f"unknown policy for unsupported types: {unsupported!r}")
    fields = []
    for name, kind, nullable in columns:
        try:
            fields.append(T.StructField(name, remote_type(system, kind), nullable))
        except UnsupportedType:
            if unsupported == "error":
                raise
            if unsupported == "string":
                fields.append(T.StructField(name, T.StringType(), nullable))
            elif unsupported == "warn":
                log(f"column {name} is left out: type {kind} is not supported")
    return T.StructType(fields)


def merge_schemas(inferred: T.StructType, declared: T.StructType | None) -> T.StructType:
    """Declared fields override inferred ones of the same name, in place; the others follow."""
    if declared is None:
        return inferred
    over = {f.name: f for f in declared}
    known = {f.name for f in inferred}
    return T.StructType([over.get(f.name, f) for f in inferred] + [f for f in declared if f.name not in known])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: extra ones go, types are cast, missing nullable ones are null, others an error."""
    have = {f.name: f for f in df.schema}
    out = []
    for f in schema:
        if f.name not in have:
            if not f.nullable:
                raise SchemaMismatch(f"column {f.name!r} is required but missing")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            column = F.col(f"`{f.name}`")
            out.append((column if have[f.name].dataType == f.dataType else column.cast(f.dataType)).alias(f.name))
    return df.select(*out)


# ---- column types for DDL

_PLAIN_DDL = {
    T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION",
    T.StringType: "TEXT", T.BinaryType: "BLOB", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP",
}
_DDL = {
    "sqlite": {T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.TimestampType: "TIMESTAMP"},
    "duckdb": {T.StringType: "VARCHAR", T.DoubleType: "DOUBLE"},
    "postgres": {T.ByteType: "SMALLINT", T.BinaryType: "BYTEA"},
    "mysql": {T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.StringType: "LONGTEXT", T.BinaryType: "LONGBLOB", T.TimestampType: "TIMESTAMP(6)", T.TimestampNTZType: "DATETIME(6)"},
}


def column_type(t: T.DataType, system: str, table: str = "t", name: str = "c") -> str:
    """A Spark type in a system's DDL. SQLite and MySQL keep nested values as JSON; PostgreSQL structs are composite types."""
    kind = type(t)
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if kind.__name__ == "TimeType":
        return "TIME"
    if isinstance(t, T.DayTimeIntervalType):
        return "INTERVAL" if system in ("postgres", "duckdb") else "BIGINT"
    if isinstance(t, T.NullType):
        return column_type(T.StringType(), system)
    if isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
        if system in ("sqlite", "mysql"):
            return "JSON"
        if isinstance(t, T.ArrayType):
            return column_type(t.elementType, system, table, name) + "[]"
        if isinstance(t, T.MapType):
            if system == "duckdb":
                return f"MAP({column_type(t.keyType, system)}, {column_type(t.valueType, system)})"
            raise UnsupportedType(f"maps can't be written to {system}")
        if system == "postgres":
            return f"struct_{table}_{name}"
        return "STRUCT(" + ", ".join(f'"{f.name}" {column_type(f.dataType, system)}' for f in t) + ")"
    for table_ in (_DDL.get(system, {}), _PLAIN_DDL):
        if kind in table_:
            return table_[kind]
    raise UnsupportedType(f"{t.simpleString()} can't be written to {system}")

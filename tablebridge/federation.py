"""Whole queries where the data is: tables with one compute context become one remote query.

A :class:`RemoteFrame` is a query in the making. As long as its tables share a context it stays one SELECT
in their dialect; joined with a frame of another context, both become DataFrames and Spark joins them.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge import sqlgen as q
from tablebridge.dialects import parse_reference
from tablebridge.errors import InvalidOption

if TYPE_CHECKING:
    from tablebridge.catalog import Database


# ---- contexts


def file_context(system: str, path: str, attached: Iterable[str] = ()) -> str:
    """A database file and what is attached to it, in any order."""
    return "|".join([system, os.path.realpath(path), *sorted(map(os.path.realpath, attached))])


def server_context(system: str, host: str, port: int, db: str, user: str) -> str:
    return f"{system}://{user}@{host}:{port}/{db}"


def odbc_context(connection_string: str) -> str:
    """A digest, as the string holds secrets."""
    return "odbc|" + hashlib.sha256(connection_string.encode()).hexdigest()


def no_context() -> str:
    """For systems that must not join remotely: every table is alone."""
    return f"alone|{uuid.uuid4().hex}"


# ---- frames


@dataclass(frozen=True)
class RemoteFrame:
    database: Database
    select: q.Select
    context: str

    @classmethod
    def table(cls, database: Database, reference: str, alias: str | None = None) -> RemoteFrame:
        source = q.Aliased(reference, alias) if alias else reference
        return cls(database, q.Select(source), database.context)

    def where(self, *predicates: q.Expr) -> RemoteFrame:
        return replace(self, select=self.select.filtered(*predicates))

    def project(self, *columns: object) -> RemoteFrame:
        base = self.select if self.select.columns is None and not self.select.group else q.Select(q.Aliased(self.select, "t"))
        return replace(self, select=replace(base, columns=columns))

    def group_by(self, keys: Iterable[q.Expr], *columns: object, having: tuple[q.Expr, ...] = ()) -> RemoteFrame:
        base = self.select
        if base.group or base.fetch is not None or base.columns is not None:
            base = q.Select(q.Aliased(base, "t"))
        return replace(self, select=replace(base, group=tuple(keys), columns=columns, having=having))

    def order_by(self, *order: q.Order) -> RemoteFrame:
        return replace(self, select=self.select.sorted(*order))

    def limit(self, n: int) -> RemoteFrame:
        return replace(self, select=self.select.limited(n))

    def join(self, other: RemoteFrame, on: q.Expr, kind: str = "inner", aliases: tuple[str, str] = ("a", "b")) -> RemoteFrame | None:
        """One remote frame if contexts agree, else None: then :func:`join` runs in Spark."""
        if self.context != other.context:
            return None
        left = q.Aliased(self.select if _shaped(self.select) else self.select.source, aliases[0])
        right = q.Aliased(other.select if _shaped(other.select) else other.select.source, aliases[1])
        return RemoteFrame(self.database, q.Select(q.Join(kind, left, right, on)), self.context)

    def sql(self) -> str:
        return self.select.sql(self.database.dialect)

    def to_df(self) -> DataFrame:
        return self.database.query(self.select)


def _shaped(s: q.Select) -> bool:
    return s.columns is not None or bool(s.where or s.group or s.order) or s.fetch is not None or s.distinct


def join(left: RemoteFrame, right: RemoteFrame, pairs: Iterable[tuple[str, str]], kind: str = "inner") -> DataFrame:
    """Join on pairs of columns: remotely when contexts agree, else in Spark over both reads."""
    pairs = list(pairs)
    on = q.all_of([q.Binary("=", q.Column(a, "a"), q.Column(b, "b")) for a, b in pairs])
    remote = left.join(right, on, kind)
    if remote is not None:
        return remote.to_df()
    l_, r = left.to_df().alias("a"), right.to_df().alias("b")
    condition = [F.col(f"a.`{a}`") == F.col(f"b.`{b}`") for a, b in pairs]
    return l_.join(r, condition, kind)


def federated_join(frames: Mapping[str, RemoteFrame], pairs: Iterable[tuple[tuple[str, str], tuple[str, str]]], columns: Iterable[tuple[str, str]]) -> tuple[DataFrame, int]:
    """An inner join of any number of frames, split by context: frames of one context that pairs connect become one remote
    query, which brings only the columns that are asked for or joined on elsewhere; Spark joins the results.

    ``pairs``: ((frame, column), (frame, column)) that must be equal; ``columns``: (frame, column) of the result, under the
    column's name. Returns the result and the number of remote reads. Frames that no pair connects are refused, as a cross
    join would follow.
    """
    pairs, columns = list(pairs), list(columns)
    group = {n: n for n in frames}
    for (a, _), (b, _) in pairs:
        if frames[a].context == frames[b].context and group[a] != group[b]:
            group = {n: group[a] if g == group[b] else g for n, g in group.items()}
    across = [p for p in pairs if group[p[0][0]] != group[p[1][0]]]
    wanted = list(dict.fromkeys([*columns, *(side for p in across for side in p)]))
    reads = {g: _group_query([n for n in frames if group[n] == g], frames, pairs, [c for c in wanted if group[c[0]] == g]) for g in dict.fromkeys(group.values())}
    named = lambda side: F.col(f"`{side[0]}__{side[1]}`")
    first, *left = reads
    out, done = reads[first], {first}
    while left:
        ready = next((g for g in left if any({group[a[0]], group[b[0]]} <= done | {g} and g in (group[a[0]], group[b[0]]) for a, b in across)), None)
        if ready is None:
            raise InvalidOption(f"nothing joins {', '.join(sorted(left))} with the rest")
        done.add(ready)
        on = [named(a) == named(b) for a, b in across if ready in (group[a[0]], group[b[0]]) and {group[a[0]], group[b[0]]} <= done]
        out = out.join(reads[ready], on)
        left.remove(ready)
    return out.select(*(named(c).alias(c[1]) for c in columns)), len(reads)


def _group_query(names: list[str], frames: Mapping[str, RemoteFrame], pairs: list, wanted: list[tuple[str, str]]) -> DataFrame:
    """Frames of one context as one remote query."""
    source_of = lambda n: q.Aliased(frames[n].select if _shaped(frames[n].select) else frames[n].select.source, n)
    first, *left = names
    source, done = source_of(first), {first}
    while left:
        n = next(n for n in left if any(n in (a[0], b[0]) and {a[0], b[0]} <= done | {n} for a, b in pairs))
        done.add(n)
        on = [q.Binary("=", q.Column(a[1], a[0]), q.Column(b[1], b[0])) for a, b in pairs if n in (a[0], b[0]) and {a[0], b[0]} <= done]
        source = q.Join("inner", source, source_of(n), q.all_of(on))
        left.remove(n)
    return frames[first].database.query(q.Select(source, tuple((q.Column(c, n), f"{n}__{c}") for n, c in wanted)))


def _mentioned(sql: str, columns: Iterable[str]) -> list[str] | None:
    """The columns whose names occur in the text, or None (all) where a star may mean them. Names in quoted text only make
    the list longer."""
    if re.search(r"(?:select|distinct|,|\.)\s*\*", sql, re.IGNORECASE):
        return None
    words = {w.lower() for w in re.findall(r"\w+", sql)}
    columns = list(columns)
    return [c for c in columns if c.lower() in words or not c.isidentifier()] or columns[:1]


def federate(spark: SparkSession, sql: str, tables: Mapping[str, Database]) -> tuple[DataFrame, int]:
    """SQL over named remote tables. If all live in one context the text runs there; else each becomes a view of the columns
    that the text names, and Spark runs it. Views of the session that have those names are as they were afterwards.

    Returns the result and the number of remote reads.
    """
    contexts = {d.context for d in tables.values()}
    if len(contexts) == 1:
        return next(iter(tables.values())).query(sql), 1
    kept = {name: spark.table(name) for name in tables if any(t.isTemporary and t.name.lower() == name.lower() for t in spark.catalog.listTables())}
    try:
        for name, d in tables.items():
            d.table(name, columns=_mentioned(sql, d.schema(name).names)).createOrReplaceTempView(name)
        return spark.sql(sql), len(tables)
    finally:
        # The plan holds the tables themselves; the names were for the parser.
        for name in tables:
            if name in kept:
                kept[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


# ---- parameterised views


def replace_arguments(sql: str, arguments: Mapping[str, Mapping[str, object]], literal: Callable[[object], str]) -> str:
    """Table names in FROM and JOIN followed by their (name = value) arguments and, if they have none, an alias.

    Quoted text and comments are passed over.
    """
    token = re.compile(r"('(?:[^']|'')*')|(--[^\n]*|/\*.*?\*/)|(\b(?:from|join)\s+|,\s*)((?:\"[^\"]+\"|[\w`]+)(?:\.(?:\"[^\"]+\"|[\w`]+))*)(?=(\s*\(|\s+as\s+|\s+(?!on\b|where\b|group\b|order\b|limit\b|join\b|inner\b|left\b|right\b|full\b|cross\b|having\b|union\b)\w+)?)", re.IGNORECASE | re.DOTALL)
    wanted = {parse_reference(k): v for k, v in arguments.items()}

    def put(m: re.Match) -> str:
        if m[1] or m[2] or m[4] is None:
            return m[0]
        name = parse_reference(m[4].replace("`", '"'))
        if name not in wanted or (m[5] or "").strip() == "(":
            return m[0]
        given = ", ".join(f"{k} = {literal(v)}" for k, v in wanted[name].items())
        return f"{m[3]}{m[4]}({given})" + ("" if m[5] else f" AS {name[-1]}")

    return token.sub(put, sql)


_DUMMY = (("int", "0"), ("float", "0.0"), ("decimal", "0"), ("bool", "false"), ("datetime", "'1970-01-01 00:00:00'"), ("date", "'1970-01-01'"), ("array", "[]"), ("uuid", "'00000000-0000-0000-0000-000000000000'"))


def probe_parameters(sql: str) -> str:
    """``{name:Type}`` replaced by a literal of the type, so that a view's schema can be asked for."""

    def put(m: re.Match) -> str:
        kind = m[2].lower()
        while (w := re.match(r"^(?:nullable|lowcardinality)\((.*)\)$", kind)) is not None:
            kind = w[1]
        kind = kind.removeprefix("u") if kind.startswith("uint") else kind
        return next((v for k, v in _DUMMY if kind.startswith(k)), "''")

    return re.sub(r"\{\s*(\w+)\s*:\s*([^{}]+?)\s*\}", put, sql)


def bind_parameters(sql: str, values: Mapping[str, object], literal: Callable[[object], str]) -> str:
    """``{name:Type}`` replaced by the literal of its value."""

    def put(m: re.Match) -> str:
        if m[1] not in values:
            raise InvalidOption(f"no value for the parameter {m[1]!r}")
        return literal(values[m[1]])

    return re.sub(r"\{\s*(\w+)\s*:\s*([^{}]+?)\s*\}", put, sql)

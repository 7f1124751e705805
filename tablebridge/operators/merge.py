"""Merges, deletes and updates of DataFrames: new DataFrames, for tables that Spark itself holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.errors import InvalidOption
from tablebridge.operators.constraints import validate
from tablebridge.options import OnConflict


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows)


def insert(target: DataFrame, rows: DataFrame, rule: OnConflict, key: Sequence[str] = ()) -> DataFrame:
    """``target`` with ``rows`` merged by a conflict rule. Keys are compared null-safely; rows must not share one.

    Do nothing keeps the old row, upsert the new one. One shuffle of each side on the key.
    """
    on = list(rule.columns or key)
    if not on:
        raise InvalidOption("a conflict rule needs key columns")
    validate(rows, [on])
    if rule.action == "do_nothing":
        return target.unionByName(_without(rows, target, on))
    return _without(target, rows, on).unionByName(rows)


def _without(rows: DataFrame, others: DataFrame, key: Sequence[str]) -> DataFrame:
    a, b = rows.alias("a"), others.select(*key).alias("b")
    on = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in key]
    return a.join(b, on, "left_anti")


def delete(target: DataFrame, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(what stays, one row ``count`` of what went). A row goes if the predicate is true, not if it is null."""
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return target.where(~hit), target.where(hit).agg(F.count(F.lit(1)).alias("count"))


def update(target: DataFrame, assignments: Mapping[str, Column], where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(the new rows, one row ``count`` of changed ones). All assignments see the old values; none changes nothing."""
    if not assignments:
        return target, target.limit(0).agg(F.count(F.lit(1)).alias("count"))
    unknown = set(assignments) - set(target.columns)
    if unknown:
        raise InvalidOption(f"no such columns: {', '.join(sorted(unknown))}")
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    kinds = dict(zip(target.columns, (f.dataType for f in target.schema), strict=True))
    new = [F.when(hit, assignments[c].cast(kinds[c])).otherwise(F.col(f"`{c}`")).alias(c) if c in assignments else F.col(f"`{c}`") for c in target.columns]
    return target.select(*new), target.where(hit).agg(F.count(F.lit(1)).alias("count"))

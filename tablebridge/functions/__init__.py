"""Expressions that the queries share; all are built-in functions underneath."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: str | Column) -> Column:
    """A double as an exact amount, so that sums don't depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, x: t + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))

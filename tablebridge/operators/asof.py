"""Joins on nearness in an ordered column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], take: Sequence[str], right_on: str | None = None) -> DataFrame:
    """Each left row with ``take`` of the last right row of the same ``by`` at or before its ``on``; nulls if there is none.

    Both sides become one stream in order, in which right values are carried forward: one shuffle on ``by`` and no pairs.
    Of right rows at one time the largest (by the taken values) holds.
    """
    right_on = right_on or on
    value = F.struct(*(F.col(c) for c in take))
    r = right.groupBy(*by, F.col(right_on).alias("_at")).agg(F.max(value).alias("_value")).withColumn("_left", F.lit(None).cast(left.select(F.struct(*map(F.col, left.columns))).schema[0].dataType)).withColumn("_side", F.lit(0))
    l_ = left.select(*by, F.col(on).alias("_at"), F.lit(None).cast(r.schema["_value"].dataType).alias("_value"), F.struct(*map(F.col, left.columns)).alias("_left"), F.lit(1).alias("_side"))
    stream = l_.unionByName(r.select(*by, "_at", "_value", "_left", "_side"))
    w = Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = stream.withColumn("_value", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")
    return carried.select("_left.*", *(F.col(f"_value.{c}").alias(c) for c in take))


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: int) -> DataFrame:
    """Pairs with low <= point < high. Both sides meet in buckets of ``width``, so no row meets all others; ranges of many
    buckets are repeated in each."""
    p = points.withColumn("_bucket", F.floor(F.col(point) / width))
    r = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high)) / width))))
    return p.join(r, "_bucket").where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("_bucket")

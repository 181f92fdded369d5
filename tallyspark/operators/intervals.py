"""Range joins between points and intervals, by time buckets.

A point falls into one bucket of ``width`` seconds; an interval [low, high], bounds included, asks for all the buckets it
touches. Rows meet by an equi join on (keys, bucket); the residual on the bounds only matters in the
interval's first and last bucket. A width near the intervals' usual length gives two or three buckets an
interval.

``with_point`` and ``without_point`` only ask whether a point exists. Points are reduced to the earliest and the
latest of each (keys, bucket) first, so a crowded bucket is one row. That decides all intervals but those
inside one bucket whose points lie on both sides; these look at the bucket's distinct times.

Null keys match nothing; an interval with a null bound or with low > high holds no point. Results do not depend on ``width``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400


def bucket(at: Column, width: int) -> Column:
    """Number of the ``width``-second bucket of a timestamp without zone (or a date)."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", start, at.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(width * 1_000_000).cast("decimal(20,0)")).cast("long")


def _spread(intervals: DataFrame, low: str, high: str, width: int) -> DataFrame:
    """A row per bucket that the interval touches, its first and last marked."""
    x = intervals.where(F.col(low) <= F.col(high))
    x = x.withColumns({"_iv_first": bucket(F.col(low), width), "_iv_last": bucket(F.col(high), width)})
    return x.withColumn("_iv_b", F.explode(F.sequence("_iv_first", "_iv_last")))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, low: str, high: str, width: int = DAY) -> DataFrame:
    """Every (point, interval) of equal ``keys`` with low <= at <= high. Other columns must not clash."""
    right = _spread(intervals, low, high, width).drop("_iv_first", "_iv_last")
    left = points.withColumn("_iv_b", bucket(F.col(at), width))
    return left.join(right, [*keys, "_iv_b"]).where((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("_iv_b")


def _found(points: DataFrame, intervals: DataFrame, ids: list[str], keys: list[str], at: str, low: str, high: str, width: int) -> DataFrame:
    """The ids of the intervals that hold a point."""
    times = points.select(*keys, F.col(at).alias("_iv_at")).withColumn("_iv_b", bucket(F.col("_iv_at"), width))
    ends = times.groupBy(*keys, "_iv_b").agg(F.min("_iv_at").alias("_iv_min"), F.max("_iv_at").alias("_iv_max"))
    wanted = intervals.select(*dict.fromkeys([*ids, *keys, low, high]))
    met = _spread(wanted, low, high, width).join(ends, [*keys, "_iv_b"])
    first, last = F.col("_iv_b") == F.col("_iv_first"), F.col("_iv_b") == F.col("_iv_last")
    possible = met.where((~first | (F.col("_iv_max") >= F.col(low))) & (~last | (F.col("_iv_min") <= F.col(high))))
    around = first & last & (F.col("_iv_min") < F.col(low)) & (F.col("_iv_max") > F.col(high))
    sure = possible.where(~around).select(*ids)
    open_ = possible.where(around).select(*dict.fromkeys([*ids, *keys, low, high, "_iv_b"]))
    inside = open_.join(times.distinct(), [*keys, "_iv_b"]).where((F.col("_iv_at") >= F.col(low)) & (F.col("_iv_at") <= F.col(high)))
    return sure.unionByName(inside.select(*ids)).distinct()


def with_point(points: DataFrame, intervals: DataFrame, ids: list[str], keys: list[str], at: str, low: str, high: str, width: int = DAY) -> DataFrame:
    """The rows of ``intervals`` (unique by ``ids``) that hold a point of equal ``keys``."""
    return intervals.join(_found(points, intervals, ids, keys, at, low, high, width), ids, "left_semi")


def without_point(points: DataFrame, intervals: DataFrame, ids: list[str], keys: list[str], at: str, low: str, high: str, width: int = DAY) -> DataFrame:
    """The rows of ``intervals`` (unique by ``ids``) that hold no point of equal ``keys``."""
    return intervals.join(_found(points, intervals, ids, keys, at, low, high, width), ids, "left_anti")

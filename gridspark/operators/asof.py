"""Nearest time on a long axis, as a merge of both in buckets of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 86_400_000_000


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def nearest_times(times: DataFrame, axis: DataFrame, time: str = "juld", at: str = "at", width: int = DAY) -> DataFrame:
    """(time, at) for every distinct non-null time: the nearest time of the axis, of two as near the later one; there is no greatest distance.

    Times and axis are cut into buckets of ``width`` microseconds. Each bucket also gets the last axis time before it and the first one behind
    it, from a scan over one row a bucket; then the merge is a window inside each bucket, and neither a task nor a row holds the
    axis. The axis' times are given in its column ``at``, of dates or timestamps, and come back with that type. An empty axis
    gives missing times; an empty table gives no rows.
    """
    asked = times.select(time).where(F.col(time).isNotNull()).distinct().withColumn("t", _micros(F.col(time)))
    points = axis.select(_micros(F.col(at)).alias("t")).where("t is not null").distinct()
    bucket = F.floor(F.col("t") / F.lit(width))
    points, asked = points.withColumn("bucket", bucket), asked.withColumn("bucket", bucket)
    # One row a bucket that has anything; what lies before and behind it.
    ends = points.groupBy("bucket").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    some = ends.unionByName(asked.select("bucket").distinct(), allowMissingColumns=True).groupBy("bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    order = W.orderBy("bucket")
    carried = some.select(
        "bucket", F.last("high", True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("before"), F.first("low", True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("behind")
    ).select("bucket", F.explode(F.array("before", "behind")).alias("t")).where("t is not null")
    known = points.unionByName(carried.select("t", "bucket")).withColumn("x", F.col("t"))
    both = known.unionByName(asked, allowMissingColumns=True)
    inside = W.partitionBy("bucket").orderBy("t")
    before = F.last("x", True).over(inside.rangeBetween(W.unboundedPreceding, W.currentRow))
    behind = F.first("x", True).over(inside.rangeBetween(W.currentRow, W.unboundedFollowing))
    found = both.select(time, "t", before.alias("before"), behind.alias("behind")).where(F.col(time).isNotNull())
    later = F.col("before").isNull() | (F.col("behind") - F.col("t") <= F.col("t") - F.col("before"))
    best = F.timestamp_micros(F.when(later & F.col("behind").isNotNull(), F.col("behind")).otherwise(F.col("before")))
    return found.select(time, best.cast(axis.schema[at].dataType).alias(at))

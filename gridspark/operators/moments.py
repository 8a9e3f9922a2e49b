"""Statistics that are kept and merged: count, mean, sum of squared deviations, least and greatest value of a day.

Moments of parts give those of the whole exactly, so a new month is read alone and the rest comes from the small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.operators.normalize import LEAST_STD
from gridspark.sources.snapshots import MonthTable


def day_moments(df: DataFrame, channels: list[str], by: list[str] | None = None, date: str = "date") -> DataFrame:
    """(date, by, channel, n, missing, mean, m2, low, high): one wide aggregate a day, a row a channel. Null and NaN are missing."""
    keys = [date, *(by or [])]
    valid = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in channels}
    one = lambda c, x: F.struct(
        F.lit(c).alias("channel"), F.count(x).alias("n"), (F.count("*") - F.count(x)).alias("missing"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high")
    )
    wide = df.groupBy(*keys).agg(*(one(c, x).alias(f"__{i}") for i, (c, x) in enumerate(valid.items())))
    return wide.select(*keys, F.explode(F.array(*(F.col(f"__{i}") for i in range(len(channels))))).alias("r")).select(*keys, "r.*")


def merged(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, channel, n, missing, mean, m2, low, high): the moments of all rows behind ``parts``. Squares are taken about the whole's mean, so
    nothing cancels."""
    keys = [*(by or []), "channel"]
    whole = W.partitionBy(*keys)
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    rows = parts.withColumn("__mean", mean)
    shift = F.col("n") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.first("__mean", True).alias("mean"), F.sum(F.col("m2") + shift).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def summary(moments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, channel, min, max, mean, std, missing, n); the deviation is the population's."""
    std = F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0)))
    return moments.select(*(by or []), "channel", F.col("low").alias("min"), F.col("high").alias("max"), "mean", std.alias("std"), "missing", "n")


def stats_of(moments: DataFrame, channels: list[str]) -> DataFrame:
    """One row, <channel>_mean and <channel>_std, as ``normalize.train_stats`` gives it."""
    rows = summary(moments)
    of = lambda c, x: F.max(F.when(F.col("channel") == c, F.col(x)))
    sd = lambda c: F.when(of(c, "std") >= LEAST_STD, of(c, "std")).otherwise(1.0)
    return rows.agg(*(x for c in channels for x in (of(c, "mean").alias(f"{c}_mean"), sd(c).alias(f"{c}_std"))))


def add_months(table: MonthTable, rows: DataFrame, channels: list[str], by: list[str] | None = None) -> int:
    """Stores the moments of the months in ``rows`` in place of what the table has of them; other months are neither read nor
    written."""
    return table.replace(day_moments(rows, channels, by))

"""Statistics of the training part and z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import CHANNELS

LEAST_STD = 1e-8


def train_stats(df: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """One row, <channel>_mean and <channel>_std, over train rows on the ocean: a single wide aggregate. Missing values
    are skipped, the deviation is the population's, and one that is tiny or undefined becomes 1."""
    rows = df.where((F.col("split") == "train") & F.col("is_ocean"))
    sd = lambda c: F.when(F.stddev_pop(c) >= LEAST_STD, F.stddev_pop(c)).otherwise(1.0)
    return rows.agg(*(x for c in channels for x in (F.avg(c).alias(f"{c}_mean"), sd(c).alias(f"{c}_std"))))


def long_stats(stats: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """(channel, mean, std)."""
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std")) for c in channels)))
    return stats.select(rows.alias("r")).select("r.*")


def z_score(x: Column, mean: Column, std: Column, is_ocean: Column) -> Column:
    """Scaled; then land and missing values become 0."""
    return F.when(is_ocean, F.coalesce((x - mean) / std, F.lit(0.0))).otherwise(0.0)


def normalize(df: DataFrame, stats: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """All splits by the train statistics; the one-row table is broadcast."""
    rows = df.join(F.broadcast(stats), how="cross")
    names = set(stats.columns)
    out = {c: z_score(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_std"), F.col("is_ocean")) for c in channels}
    return rows.withColumns(out).select(*(c for c in rows.columns if c not in names))


def denormalize(df: DataFrame, stats: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    rows = df.join(F.broadcast(stats), how="cross")
    names = set(stats.columns)
    return rows.withColumns({c: F.col(c) * F.col(f"{c}_std") + F.col(f"{c}_mean") for c in channels}).select(*(c for c in rows.columns if c not in names))


def fill_target(temp: Column) -> Column:
    """Missing becomes 0, below the sea floor too; the target is not scaled."""
    return F.coalesce(temp, F.lit(0.0))


def channel_summary(df: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """Min, max, mean, population deviation and missing count of each channel, from one wide aggregate."""
    wide = df.agg(*(F.struct(F.lit(c).alias("channel"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count(F.when(F.col(c).isNull(), 1)).alias("missing")).alias(c) for c in channels))
    return wide.select(F.explode(F.array(*channels)).alias("r")).select("r.*")


def missing_share(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(value).isNull(), 1.0).otherwise(0.0)).alias("missing_share"), F.min(value).alias("min"), F.max(value).alias("max"))

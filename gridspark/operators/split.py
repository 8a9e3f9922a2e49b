"""Chronological splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.functions.grid import TARGET, Grid


def split_by_dates(date: Column, train_end: str, val_end: str) -> Column:
    """train to ``train_end``, val to ``val_end`` (both included), then test."""
    return F.when(date <= F.to_date(F.lit(train_end)), "train").when(date <= F.to_date(F.lit(val_end)), "val").otherwise("test")


def split_dates(df: DataFrame, train: float = 0.7, val: float = 0.15, split: bool = True, date: str = "date") -> DataFrame:
    """(date, split) by shares of the distinct dates. Sizes round half to even; val has one date at least (exactly one
    under five dates); if nothing would be left for test, train gives up one date. Under three dates, or with
    ``split=False``, all is train. The window runs over distinct dates (thousands of rows at most)."""
    days = df.select(date).distinct()
    n = F.count("*").over(W.partitionBy(F.lit(1)))
    rows = days.select(date, n.alias("n"), F.row_number().over(W.partitionBy(F.lit(1)).orderBy(date)).alias("i"))
    first = F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(train)).cast("int"))
    second = F.when(F.col("n") >= 5, F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(val)).cast("int"))).otherwise(1)
    full = F.col("n") - (first + second) <= 0
    first = F.when(full & (first > 1), first - 1).otherwise(first)
    name = F.when(F.lit(not split) | (F.col("n") < 3), "train").when(F.col("i") <= first, "train").when(F.col("i") <= first + second, "val").otherwise("test")
    return rows.select(date, name.alias("split"))


def with_split(df: DataFrame, dates: DataFrame, date: str = "date") -> DataFrame:
    return df.join(F.broadcast(dates), date)


def split_summary(df: DataFrame, date: str = "date", channels: int = 7, depths: int = 15, grid: Grid = TARGET) -> DataFrame:
    """Days, first and last date of each split, and the shapes of its inputs and targets."""
    days = F.countDistinct(date)
    shape = lambda n: F.array(days.cast("int"), *(F.lit(x) for x in (n, grid.ny, grid.nx)))
    return df.groupBy("split").agg(days.alias("num_timesteps"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), shape(channels).alias("input_shape"), shape(depths).alias("target_shape"))

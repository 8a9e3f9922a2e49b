"""Writing partitions, tensors, side files and tables, and catching up with what is missing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir). In local mode, as in tests, a temporary
    one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def with_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def write_months(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """One partition a month; only the months in ``df`` are replaced. Rows are dealt by month and a salt of the date,
    so one long month is written by several tasks."""
    rows = with_month(df)
    order = sort or [c for c in ("date", "lat_idx", "lon_idx") if c in df.columns]
    rows = rows.repartition("year", "month", F.dayofmonth("date") % 4).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def missing_months(wanted: DataFrame, *done: DataFrame) -> DataFrame:
    """The (year, month) of ``wanted`` that are not in all of ``done``."""
    both = None
    for d in done:
        months = d.select("year", "month").distinct()
        both = months if both is None else both.intersect(months)
    months = wanted.select("year", "month").distinct()
    return months if both is None else months.join(both, ["year", "month"], "left_anti")


def months_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(year, month) from ``YYYY-MM`` to ``YYYY-MM``, both included."""
    if start > end:
        raise ValueError("start must not be after end")
    first, last = F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01"))
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("d")).select(F.year("d").alias("year"), F.month("d").alias("month"))


def stats_json(stats: DataFrame, channels: list[str]) -> DataFrame:
    """One row with the statistics as JSON, keys in channel order. ``stats(channel, mean, std)`` has a row a channel."""
    order = F.array(*(F.lit(c) for c in channels))
    entries = F.array_sort(F.collect_list(F.struct(F.array_position(order, F.col("channel")).alias("i"), "channel", F.struct("mean", "std").alias("s"))))
    made = stats.agg(entries.alias("e")).select(F.map_from_entries(F.transform("e", lambda x: F.struct(x["channel"], x["s"]))).alias("m"))
    return made.select(F.to_json("m").alias("value"))


def split_json(summary: DataFrame) -> DataFrame:
    """One row a split: its days, date range and shapes as JSON. ``summary`` as ``split.split_summary`` gives it."""
    dates = F.array(F.col("first_date").cast("string"), F.col("last_date").cast("string"))
    return summary.select("split", F.to_json(F.struct("num_timesteps", dates.alias("date_range"), "input_shape", "target_shape")).alias("value"))


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """With header; missing values are empty. ``compression`` as Spark names it: a collocation repeats a profile's fields for each depth, and as gzip it takes a
    small part of the plain text. A compressed file is read by one task, so it should be as large as a task's share."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("compression", compression).csv(path)

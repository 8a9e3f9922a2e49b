"""Crops, ranges and slices; all are plain filters that reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import TARGET, Grid

BOX = (5.0, 30.0, 45.0, 105.0)


def crop_box(df: DataFrame, box: tuple[float, float, float, float] = BOX, buffer: float = 0.0, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows in (lat_min, lat_max, lon_min, lon_max) widened by the buffer; ends included, in any order of the axes."""
    a, b, c, d = box
    return df.where(F.col(lat).between(a - buffer, b + buffer) & F.col(lon).between(c - buffer, d + buffer))


def depth_range(df: DataFrame, low: float, high: float, depth: str = "depth") -> DataFrame:
    return df.where(F.col(depth).between(low, high))


def surface_level(df: DataFrame, depth: str = "depth", high: float = 0.5) -> DataFrame:
    """The level within ``high`` metres of the surface, without its depth column. Rows of a second level there are an
    error in the product: each key keeps the shallowest."""
    keys = [c for c in ("time", "date", "lat", "lon", "lat_idx", "lon_idx", "src_lat_idx", "src_lon_idx") if c in df.columns]
    values = [c for c in df.columns if c not in keys and c != depth]
    low = depth_range(df, 0.0, high, depth).groupBy(*keys).agg(F.min(F.struct(depth, *values)).alias("s"))
    return low.select(*keys, *(F.col(f"s.{c}").alias(c) for c in values))


def date_range(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    if start > end:
        raise ValueError("start must not be after end")
    return df.where(F.col(date).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def month_range(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """From the first day of ``YYYY-MM`` to the last day of ``YYYY-MM``."""
    if start > end:
        raise ValueError("start must not be after end")
    return df.where(F.col(date).between(F.to_date(F.lit(start + "-01")), F.last_day(F.to_date(F.lit(end + "-01")))))


def kelvin_to_celsius(k: Column) -> Column:
    return k - 273.15


def day_map(df: DataFrame, date: str, value: str) -> DataFrame:
    return df.where(F.col("date") == F.to_date(F.lit(date))).select("lat_idx", "lon_idx", value)


def section(target: DataFrame, date: str, lon: float, grid: Grid = TARGET) -> DataFrame:
    """Latitude by depth at the meridian nearest to ``lon``."""
    _, at = grid.nearest(F.lit(grid.lat0), F.lit(lon))
    return target.where((F.col("date") == F.to_date(F.lit(date))) & (F.col("lon_idx") == at)).select("lat_idx", "depth_idx", "depth_m", "temp")


def depth_profile(target: DataFrame, date: str, lat: float, lon: float, grid: Grid = TARGET) -> DataFrame:
    i, j = grid.nearest(F.lit(lat), F.lit(lon))
    return target.where((F.col("date") == F.to_date(F.lit(date))) & (F.col("lat_idx") == i) & (F.col("lon_idx") == j)).select("depth_idx", "depth_m", "temp")

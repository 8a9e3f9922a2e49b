"""Ocean masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_water(flag: Column) -> Column:
    """Exactly 1; combined flags such as 9 (water and ice) are not ocean."""
    return F.coalesce(flag == 1, F.lit(False))


def mask_value(df: DataFrame, value: str, flag: str = "mask") -> DataFrame:
    """``value`` becomes missing outside the ocean, the row stays; ``is_ocean`` is kept as 0 or 1."""
    return df.withColumns({value: F.when(is_water(F.col(flag)), F.col(value)), "is_ocean": is_water(F.col(flag)).cast("tinyint")})


def ocean_mask(target: DataFrame, depth_m: float = 0.0) -> DataFrame:
    """(lat_idx, lon_idx, is_ocean) from the first date and the level nearest to ``depth_m``."""
    first = target.agg(F.min("date").alias("date"))
    day = target.join(F.broadcast(first), "date", "left_semi")
    level = day.agg(F.min(F.struct(F.abs(F.col("depth_m") - depth_m), "depth_idx"))["depth_idx"].alias("depth_idx"))
    return day.join(F.broadcast(level), "depth_idx", "left_semi").select("lat_idx", "lon_idx", F.col("temp").isNotNull().alias("is_ocean"))


def coverage(mask: DataFrame) -> DataFrame:
    return mask.agg(F.count("*").alias("n_cells"), F.sum(F.col("is_ocean").cast("long")).alias("n_ocean"), F.avg(F.col("is_ocean").cast("double")).alias("share"))


def flag_values(df: DataFrame, flag: str = "mask") -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("n"))


def with_mask(df: DataFrame, mask: DataFrame) -> DataFrame:
    """The mask has one row a grid cell, so it is broadcast; cells that it lacks are not ocean."""
    return df.join(F.broadcast(mask.select("lat_idx", "lon_idx", "is_ocean")), ["lat_idx", "lon_idx"], "left").withColumn("is_ocean", F.coalesce("is_ocean", F.lit(False)))


def ocean_in_box(mask: DataFrame, grid, box: tuple[float, float, float, float]) -> DataFrame:
    """Ocean cells in a box that should be land; passes with none."""
    a, b, c, d = box
    inside = grid.lat(F.col("lat_idx")).between(a, b) & grid.lon(F.col("lon_idx")).between(c, d)
    n = F.coalesce(F.sum((inside & F.col("is_ocean")).cast("long")), F.lit(0))
    return mask.agg(n.alias("ocean_cells"), (n == 0).alias("passed"))

"""Synthetic fields on the target grid for given dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import DEPTHS, TARGET, Grid

#: Range of each channel.
RANGES = {"sst": (20.0, 33.0), "sss": (30.0, 38.0), "ssh": (-0.5, 0.5), "u_curr": (-1.5, 1.5), "v_curr": (-1.5, 1.5), "u_wind": (-15.0, 15.0), "v_wind": (-15.0, 15.0)}


def unit(seed: str, *keys: str) -> Column:
    """A number in [0, 1) that depends on the seed and the keys alone, so that any engine can make the same."""
    text = F.concat_ws(":", F.lit(seed), *(F.col(k).cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def surface(dates: DataFrame, grid: Grid = TARGET, seed: int = 42) -> DataFrame:
    """Seven channels, uniform in their ranges, for each date and cell."""
    rows = grid.dense(dates)
    return rows.select("date", "lat_idx", "lon_idx", *((F.lit(lo) + unit(f"{seed}{c}", "date", "lat_idx", "lon_idx") * (hi - lo)).alias(c) for c, (lo, hi) in RANGES.items()))


def target(dates: DataFrame, grid: Grid = TARGET, depths: list[int] = DEPTHS, seed: int = 42) -> DataFrame:
    """4 + 24 exp(-depth / 500) plus noise of standard deviation one half (twelve uniform numbers less six)."""
    levels = F.explode(F.array(*(F.struct(F.lit(i).alias("depth_idx"), F.lit(d).alias("depth_m")) for i, d in enumerate(depths))))
    rows = grid.dense(dates).withColumn("l", levels).select("date", "l.depth_idx", "l.depth_m", "lat_idx", "lon_idx")
    noise = sum((unit(f"{seed}n{i}", "date", "depth_idx", "lat_idx", "lon_idx") for i in range(12)), F.lit(0.0)) - 6.0
    return rows.withColumn("temp", 4.0 + 24.0 * F.exp(-F.col("depth_m") / 500.0) + 0.5 * noise)

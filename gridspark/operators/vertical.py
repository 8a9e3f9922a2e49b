"""Vertical interpolation of grids and of profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.functions.grid import DEPTHS, depth_axis
from gridspark.operators.regrid import axis_weights


def depth_weights(native_depths: DataFrame, depths: list[float] = DEPTHS) -> DataFrame:
    """Weights from ``native_depths(idx, coord)``; a first level below the surface also serves the depths above it."""
    dst = depth_axis(native_depths.sparkSession, depths).select(F.col("depth_idx").alias("idx"), F.col("depth_m").cast("double").alias("coord"))
    return axis_weights(native_depths, dst, pad_first=True)


def interpolate_depths(native: DataFrame, value: str, weights: DataFrame, keys: list[str]) -> DataFrame:
    """``native(keys, src_depth_idx, value)`` at the weights' depths; missing where a needed level is missing."""
    w = F.broadcast(weights.select(F.col("src_idx").alias("src_depth_idx"), F.col("dst_idx").alias("depth_idx"), "w", "need"))
    sums = native.join(w, "src_depth_idx").groupBy(*keys, "depth_idx").agg(F.max("need").alias("need"), F.sum(F.col("w") * F.col(value)).alias("s"), F.count(value).alias("n"))
    return sums.select(*keys, "depth_idx", F.when(F.col("n") == F.col("need"), F.col("s")).alias(value))


def nearest_depth(native: DataFrame, depth_m: float, keys: list[str], value: str, depth: str = "depth") -> DataFrame:
    """Each key's value at the level nearest to ``depth_m``; of two as near the shallower."""
    best = F.min(F.struct(F.abs(F.col(depth) - depth_m).alias("far"), F.col(depth).alias("level"), F.col(value).alias("v")))
    return native.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.level").alias(depth), F.col("b.v").alias(value))


def valid_levels(levels: DataFrame) -> DataFrame:
    """Levels that have both parts."""
    return levels.where("pres is not null and temp is not null")


def _legs(levels: DataFrame, key: str) -> DataFrame:
    """Each level with the next deeper one (pres2, temp2) and the pressure before it (pres0)."""
    points = valid_levels(levels).groupBy(key, "pres").agg(F.avg("temp").alias("temp"))
    order = W.partitionBy(key).orderBy("pres")
    return points.select(key, "pres", "temp", F.lead("pres").over(order).alias("pres2"), F.lead("temp").over(order).alias("temp2"), F.lag("pres").over(order).alias("pres0"))


def _inside(depth: Column) -> Column:
    """Whether a leg gives the value at ``depth``; of a profile's legs one does at most."""
    return (depth >= F.col("pres")) & ((depth < F.col("pres2")) | (F.col("pres2").isNull() & F.col("pres0").isNotNull() & (depth == F.col("pres"))))


def _between(depth: Column) -> Column:
    return F.when(F.col("pres2").isNull(), F.col("temp")).otherwise(F.col("temp") + (F.col("temp2") - F.col("temp")) * (depth - F.col("pres")) / (F.col("pres2") - F.col("pres")))


def profile_values(levels: DataFrame, depths: list[float] = DEPTHS, key: str = "profile_idx") -> DataFrame:
    """(key, temps): the values of ``profile_at_depths`` as one array a profile; profiles without a valid level have no row."""
    at = [F.lit(int(d)) for d in depths]
    wide = _legs(levels, key).groupBy(key).agg(*(F.max(F.when(_inside(d), _between(d))).alias(f"__{i}") for i, d in enumerate(at)))
    return wide.select(key, F.array(*(f"__{i}" for i in range(len(depths)))).alias("temps"))


def profile_at_depths(levels: DataFrame, profiles: DataFrame, depths: list[float] = DEPTHS, key: str = "profile_idx") -> DataFrame:
    """(key, depth_idx, depth_m, temp): a row for every profile and depth.

    Levels with either part missing are dropped and equal pressures averaged; with fewer than two left, or outside
    the range, the value is missing. The order of levels doesn't matter.
    """
    wanted = F.array(*(F.struct(F.lit(i).alias("depth_idx"), F.lit(int(d)).alias("depth_m")) for i, d in enumerate(depths)))
    here = F.filter(wanted, lambda d: _inside(d["depth_m"]))
    found = _legs(levels, key).select(key, "pres", "temp", "pres2", "temp2", F.explode(here).alias("d"))
    value = _between(F.col("d.depth_m"))
    at = found.select(key, F.col("d.depth_idx").alias("depth_idx"), value.alias("temp"))
    spine = profiles.select(key).select(key, F.explode(wanted).alias("d")).select(key, "d.depth_idx", "d.depth_m")
    return spine.join(at, [key, "depth_idx"], "left")

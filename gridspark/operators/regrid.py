"""Regridding as joins with small weight tables.

A weight table of an axis has (dst_idx, src_idx, w, need): the one or two source indices that a target index needs.
Weights of zero are dropped, so a target that sits on a source node needs that node only. Latitude and longitude
(and depth) stay separate tables; their product is formed in the join and never stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.functions.grid import Grid


def axis_weights(src: DataFrame, dst: DataFrame, pad_first: bool = False) -> DataFrame:
    """Linear weights from ``src(idx, coord)`` to ``dst(idx, coord)``, in any order of either axis. Targets outside
    the source have none; with ``pad_first`` those below the first coordinate take it whole. Axes have thousands of
    rows at most."""
    order = W.orderBy("coord")
    legs = src.select("idx", "coord", F.lead("idx").over(order).alias("idx2"), F.lead("coord").over(order).alias("coord2"), F.row_number().over(order).alias("n"))
    d = dst.select(F.col("idx").alias("dst_idx"), F.col("coord").alias("x"))
    hit = (F.col("x") >= F.col("coord")) & ((F.col("x") < F.col("coord2")) | (F.col("coord2").isNull() & (F.col("x") == F.col("coord"))))
    if pad_first:
        hit = hit | ((F.col("n") == 1) & (F.col("x") < F.col("coord")))
    part = F.greatest(F.coalesce((F.col("x") - F.col("coord")) / (F.col("coord2") - F.col("coord")), F.lit(0.0)), F.lit(0.0))
    both = F.array(F.struct(F.col("idx").alias("src_idx"), (1 - part).alias("w")), F.struct(F.col("idx2").alias("src_idx"), part.alias("w")))
    used = F.filter(both, lambda c: c["w"] > 0)
    return d.join(F.broadcast(legs), hit).select("dst_idx", F.size(used).alias("need"), F.explode(used).alias("c")).select("dst_idx", "c.src_idx", "c.w", "need")


def nearest_index(src: DataFrame, dst: DataFrame) -> DataFrame:
    """(dst_idx, src_idx): the nearest source index of each target index inside the source's ends; halfway points go to the lower
    coordinate."""
    order = W.orderBy("coord")
    legs = src.select("idx", "coord", F.lead("idx").over(order).alias("idx2"), F.lead("coord").over(order).alias("coord2"))
    d = dst.select(F.col("idx").alias("dst_idx"), F.col("coord").alias("x"))
    hit = (F.col("x") >= F.col("coord")) & ((F.col("x") < F.col("coord2")) | (F.col("coord2").isNull() & (F.col("x") == F.col("coord"))))
    nearer = F.when(F.col("coord2").isNotNull() & (F.col("x") - F.col("coord") > F.col("coord2") - F.col("x")), F.col("idx2")).otherwise(F.col("idx"))
    return d.join(F.broadcast(legs), hit).select("dst_idx", nearer.alias("src_idx"))


def _named(weights: DataFrame, axis: str) -> DataFrame:
    return F.broadcast(weights.select(F.col("src_idx").alias(f"src_{axis}_idx"), F.col("dst_idx").alias(f"{axis}_idx"), F.col("w").alias(f"w_{axis}"), F.col("need").alias(f"need_{axis}")))


def regrid(native: DataFrame, values: list[str], lat_weights: DataFrame, lon_weights: DataFrame, keys: list[str] | None = None, depth_weights: DataFrame | None = None) -> DataFrame:
    """Linear regrid of ``native(keys, [src_depth_idx], src_lat_idx, src_lon_idx, values)``. One aggregation for all
    values and, with depth weights, for the vertical as well. A target cell is missing if any node with a weight over
    zero is absent or missing; cells with no rows at all are left to ``onto_grid``."""
    keys = keys or ["date"]
    axes = ["lat", "lon"] + (["depth"] if depth_weights is not None else [])
    rows = native
    for axis, weights in zip(axes, (lat_weights, lon_weights, depth_weights)):
        rows = rows.join(_named(weights, axis), f"src_{axis}_idx")
    w, need = F.lit(1.0), F.lit(1)
    for axis in axes:
        w, need = w * F.col(f"w_{axis}"), need * F.col(f"need_{axis}")
    rows = rows.withColumns({"__w": w, "__need": need})
    group = [*keys, *(f"{a}_idx" for a in (["depth"] if depth_weights is not None else []) + ["lat", "lon"])]
    sums = rows.groupBy(*group).agg(F.max("__need").alias("__need"), *(x for v in values for x in (F.sum(F.col("__w") * F.col(v)).alias(f"__s_{v}"), F.count(v).alias(f"__n_{v}"))))
    return sums.select(*group, *(F.when(F.col(f"__n_{v}") == F.col("__need"), F.col(f"__s_{v}")).alias(v) for v in values))


def regrid_with_weights(native: DataFrame, values: list[str], weights: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The same contract with given sparse weights (src_lat_idx, src_lon_idx, lat_idx, lon_idx, w), of any method. The table may be large:
    it is joined as Spark sees fit."""
    keys = keys or ["date"]
    used = weights.where("w <> 0")
    need = used.groupBy("lat_idx", "lon_idx").agg(F.count("*").alias("__need"))
    rows = native.join(used.join(need, ["lat_idx", "lon_idx"]), ["src_lat_idx", "src_lon_idx"])
    group = [*keys, "lat_idx", "lon_idx"]
    sums = rows.groupBy(*group).agg(F.max("__need").alias("__need"), *(x for v in values for x in (F.sum(F.col("w") * F.col(v)).alias(f"__s_{v}"), F.count(v).alias(f"__n_{v}"))))
    return sums.select(*group, *(F.when(F.col(f"__n_{v}") == F.col("__need"), F.col(f"__s_{v}")).alias(v) for v in values))


def nearest_regrid(native: DataFrame, value: str, lat_index: DataFrame, lon_index: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Each target cell takes the value of its nearest node; categories are never blended."""
    keys = keys or ["date"]
    lat = F.broadcast(lat_index.select(F.col("src_idx").alias("src_lat_idx"), F.col("dst_idx").alias("lat_idx")))
    lon = F.broadcast(lon_index.select(F.col("src_idx").alias("src_lon_idx"), F.col("dst_idx").alias("lon_idx")))
    return native.join(lat, "src_lat_idx").join(lon, "src_lon_idx").select(*keys, "lat_idx", "lon_idx", value)


def onto_grid(regridded: DataFrame, grid: Grid, keys: list[str] | None = None, spine: DataFrame | None = None) -> DataFrame:
    """Every cell of the grid for every key of ``spine`` (by default those that occur); cells without data are missing."""
    keys = keys or ["date"]
    days = regridded.select(*keys).distinct() if spine is None else spine
    return grid.dense(days).join(regridded, [*keys, "lat_idx", "lon_idx"], "left")


def completeness(df: DataFrame, cells: int, date: str = "date", index: tuple[str, ...] = ("lat_idx", "lon_idx")) -> DataFrame:
    """(date, n_cells, complete): distinct cells a day against the number expected."""
    n = df.select(date, *index).distinct().groupBy(date).agg(F.count("*").alias("n_cells"))
    return n.withColumn("complete", F.col("n_cells") == cells)

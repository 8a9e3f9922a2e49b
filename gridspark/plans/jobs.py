"""End-to-end jobs: harmonise, export tensors, collocate and score, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import CHANNELS, TARGET, Grid
from gridspark.operators import align, chunks, collocate, crop, mask, merge, metrics, normalize, qa, regrid, split, tensor, tiled, vertical


def harmonize_surface(sources: list[tuple[DataFrame, list[str], DataFrame, DataFrame]], grid: Grid = TARGET, start: str | None = None, end: str | None = None) -> DataFrame:
    """``sources``: (native rows with time or date and source indices, variables, latitude weights, longitude weights), the preferred
    first. Each is floored to days, regridded once for all its variables, and merged on (date, cell): the regrid's
    aggregation already has the keys of the merge."""
    parts = []
    for rows, values, lat_w, lon_w in sources:
        if "date" not in rows.columns:
            rows = rows.withColumn("date", align.floor_day(F.col("time")))
        if start and end:
            rows = crop.date_range(rows, start, end)
        parts.append(regrid.regrid(rows, values, lat_w, lon_w))
    return merge.merge_sources(parts)


def harmonize_target(native: DataFrame, native_depths: DataFrame, lat_w: DataFrame, lon_w: DataFrame, grid: Grid = TARGET) -> DataFrame:
    """Vertical and horizontal weights in one pass: one exchange of the largest table instead of two."""
    out = regrid.regrid(native, ["temp"], lat_w, lon_w, depth_weights=vertical.depth_weights(native_depths))
    from gridspark.functions.grid import depth_axis

    return out.join(F.broadcast(depth_axis(native.sparkSession)), "depth_idx").select("date", "depth_idx", "depth_m", "lat_idx", "lon_idx", "temp")


def harmonize_target_tiled(native: DataFrame, native_depths: DataFrame, src_lat: list[float], src_lon: list[float], grid: Grid = TARGET) -> DataFrame:
    """The same for fine target grids, where a node serves many cells: the vertical first, over the few native nodes, then tiles, which
    multiply no rows. Cells that can't be made are there with a missing value."""
    from gridspark.functions.grid import depth_axis

    levels = vertical.interpolate_depths(native, "temp", vertical.depth_weights(native_depths), ["date", "src_lat_idx", "src_lon_idx"])
    dst = [grid.lat0 + grid.step * i for i in range(grid.ny)], [grid.lon0 + grid.step * i for i in range(grid.nx)]
    out = tiled.regrid_tiled(levels, ["temp"], src_lat, src_lon, *dst, keys=["date", "depth_idx"])
    return out.join(F.broadcast(depth_axis(native.sparkSession)), "depth_idx").select("date", "depth_idx", "depth_m", "lat_idx", "lon_idx", "temp")


def export_chunks(surface: DataFrame, target: DataFrame, n_depths: int, grid: Grid = TARGET, train: float = 0.7, val: float = 0.15, channels: list[str] = CHANNELS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(inputs, targets, statistics): as ``export_tensors``, but as rows of chunks; the inputs' positions are cells, the targets' depths and cells."""
    surface, target = align.common_dates(surface, target)
    rows, filled, stats = _scaled(surface, target, train, val, channels)
    keys, cell = ["split", "date"], F.col("lat_idx") * grid.nx + F.col("lon_idx")
    inputs = chunks.chunked(rows, channels, keys, cell, grid.ny * grid.nx)
    deep = filled.where(F.col("depth_idx") < n_depths)
    return inputs, chunks.chunked(deep, ["temp"], keys, F.col("depth_idx") * (grid.ny * grid.nx) + cell, n_depths * grid.ny * grid.nx), stats


def _scaled(surface: DataFrame, target: DataFrame, train: float, val: float, channels: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    dates = split.split_dates(surface, train, val)
    rows = split.with_split(mask.with_mask(surface, mask.ocean_mask(target)), dates)
    stats = normalize.train_stats(rows, channels)
    filled = split.with_split(target, dates).withColumn("temp", normalize.fill_target(F.col("temp")))
    return normalize.normalize(rows, stats, channels), filled, stats


def export_tensors(surface: DataFrame, target: DataFrame, n_depths: int, grid: Grid = TARGET, train: float = 0.7, val: float = 0.15, channels: list[str] = CHANNELS) -> tuple[DataFrame, DataFrame]:
    """(tensors, statistics): common dates, mask, split, train-only statistics, scaled inputs and filled targets."""
    surface, target = align.common_dates(surface, target)
    rows, filled, stats = _scaled(surface, target, train, val, channels)
    inputs = tensor.input_tensor(rows, ["split", "date"], channels, grid)
    return inputs.join(tensor.target_tensor(filled, ["split", "date"], n_depths, grid), ["split", "date"]), stats


def validate(profiles: DataFrame, levels: DataFrame, target: DataFrame, grid: Grid = TARGET) -> DataFrame:
    """Skill of the grid against profiles, per depth and overall."""
    return metrics.skill(collocate.collocate(profiles, levels, target, grid), "argo_temp", "glorys_temp")


def audit(surface: DataFrame, target: DataFrame, ocean: DataFrame, normalized: DataFrame, filled: DataFrame | None = None, grid: Grid = TARGET) -> DataFrame:
    """The scorecard of the seven checks, one aggregation a table; ``filled`` are the targets as they are exported, with ``is_ocean``."""
    apart = {"dates": qa.date_sync(surface, target), "integrity": qa.integrity(normalized, [c for c in CHANNELS if c in normalized.columns], filled)}
    return qa.scorecard(apart, qa.surface_checks(surface, ocean, grid), qa.target_checks(target, ocean))


def write_audited(surface: DataFrame, target: DataFrame, ocean: DataFrame, path: str, grid: Grid = TARGET, channels: list[str] = CHANNELS) -> DataFrame:
    """Writes surface, normalised inputs and filled targets under ``path`` and gives the scorecard of what was written: each check is a metric of
    the job that writes its rows."""
    spark, seen = surface.sparkSession, qa.ObservedCard()
    masked = mask.with_mask(surface, ocean)
    seen.surface(masked, grid).write.parquet(f"{path}/surface")
    rows = split.with_split(spark.read.parquet(f"{path}/surface"), split.split_dates(surface))
    inputs = normalize.normalize(rows, normalize.train_stats(rows, channels), channels)
    seen.inputs(inputs, channels).write.parquet(f"{path}/inputs")
    filled = F.when(F.col("is_ocean"), normalize.fill_target(F.col("temp"))).otherwise(0.0)
    seen.target(mask.with_mask(target, ocean), filled).withColumn("temp", filled).write.parquet(f"{path}/target")
    return seen.card(spark)

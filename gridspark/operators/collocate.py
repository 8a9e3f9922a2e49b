"""Matching profiles with the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import DEPTHS, TARGET, Grid
from gridspark.operators.asof import nearest_times
from gridspark.operators.crop import crop_box
from gridspark.operators.vertical import profile_values
from gridspark.sources.bucketed import CELL
from gridspark.sources.ingest import float_name
from gridspark.sources.sinks import scratch_path

#: Rows up to which a table of profiles, dates or grid cells is broadcast: up to some 400 bytes each, in a table that the driver builds.
WANTED_ROWS = 100_000
HALF_DAY = 43_200_000_000


def nearest_dates(times: DataFrame, dates: DataFrame, time: str = "juld", date: str = "date", mode: str = "nearest") -> DataFrame:
    """(time, grid_date) for every distinct time: the date whose midnight is nearest, of two as near the later one; there is
    no greatest distance. ``same_day`` takes the day itself if it is on the axis.

    The axis has thousands of dates at most and travels as one array; times are looked up once each.
    """
    asked = times.select(time).distinct()
    if mode == "same_day":
        days = dates.select(F.col(date).alias("grid_date")).distinct()
        return asked.withColumn("grid_date", F.to_date(time)).join(F.broadcast(days), "grid_date", "left_semi").select(time, "grid_date")
    axis = dates.select(date).distinct().agg(F.collect_list(date).alias("axis"))
    far = lambda d: F.abs(F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(d.cast("timestamp")))
    best = F.array_min(F.transform("axis", lambda d: F.struct(far(d).alias("far"), (-F.unix_date(d)).alias("day"))))
    found = asked.join(F.broadcast(axis), how="cross").select(time, best.alias("b"))
    return found.select(time, F.date_from_unix_date(-F.col("b.day")).alias("grid_date"))


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _dated(at: DataFrame, target: DataFrame, mode: str) -> DataFrame:
    """``at`` with the ``date`` of the target; missing where there is none. Midway between two midnights is a midnight or a noon, so all
    times of a half day have the same nearest date, and the table of these is as long as the calendar."""
    if mode == "same_day":
        return at.withColumn("date", F.to_date("juld"))
    if mode == "long":
        when = _kept(nearest_times(at, target.select("date"), at="date"), "nearest-dates")
        return at.join(_side(when, when.count() <= WANTED_ROWS), "juld", "left")
    micros = F.unix_micros(F.col("juld").cast("timestamp"))
    at = at.withColumn("half", F.timestamp_micros(micros - F.pmod(micros, F.lit(HALF_DAY))))
    when = nearest_dates(at, target.select("date"), time="half").withColumnRenamed("grid_date", "date")
    return at.join(F.broadcast(_kept(when, "nearest-dates")), "half", "left")


def _side(df: DataFrame, small: bool) -> DataFrame:
    """As counted: Spark would judge by the size of compressed files, and broadcast far more than it takes them for."""
    return F.broadcast(df) if small else df.hint("merge")


def _near(dated: DataFrame, target: DataFrame, n_depths: int, stored: bool) -> DataFrame:
    """(date, lat_idx, lon_idx, found, values): the target's depths and values at each cell that a profile asks for, then the depths it lacks; broadcast up to
    the bound."""
    cells = _kept(dated.where("date is not null").select(*CELL).distinct(), "wanted-cells")
    n, first, last = cells.agg(F.count("*"), F.min("date"), F.max("date")).first()
    small = n <= WANTED_ROWS
    inside = target.where(F.col("date").between(F.lit(first), F.lit(last)) & F.col("depth_idx").between(0, n_depths - 1))
    near = inside.select(*CELL, F.struct(F.col("depth_idx").cast("int").alias("depth_idx"), F.round("temp", 4).alias("temp")).alias("x")).join(_side(cells, small and not stored), CELL)
    lists = near.groupBy(*CELL).agg(F.collect_list("x").alias("x"))
    lacking = F.array_except(F.array(*(F.lit(i) for i in range(n_depths))), F.col("x.depth_idx"))
    return _side(lists.select(*CELL, F.concat("x.depth_idx", lacking).alias("found"), F.col("x.temp").alias("values")), small)


def collocate(profiles: DataFrame, levels: DataFrame, target: DataFrame | None = None, grid: Grid = TARGET, depths: list[float] = DEPTHS, mode: str = "nearest", stored: bool = False) -> DataFrame:
    """A row per profile in the box and depth: date, float_id, argo_lat, argo_lon, grid_lat, grid_lon, depth_m,
    argo_temp, glorys_temp, model_prediction. Grid data that is absent gives missing values, never fewer rows.

    A profile is one row until the end: its levels become an array of its depths, the grid's depths at its cell another, and only
    then a row is made of each depth. No join or exchange is of rows by depth.

    The grid side is cut to the profiles' dates by their range, which reaches the scan, and to their cells and dates by a
    table of the different ones, which the number of profiles doesn't lengthen. It is written once and counted. Up to
    ``WANTED_ROWS`` it is broadcast, so the large table is filtered where it is read, not moved, and what is found there is
    broadcast to the profiles. Beyond the bound the same joins shuffle; with ``stored``, for a target that is bucketed by
    date, lat_idx and lon_idx (``bucketed.write_bucketed``), the target stays in place whatever its size.
    ``mode`` is that of ``nearest_dates``, or ``long`` for an axis that is too long for one row.
    """
    inside = crop_box(profiles)
    lat, lon = grid.nearest(F.col("lat"), F.col("lon"))
    at = inside.select("profile_idx", "juld", "lat", "lon", lat.alias("lat_idx"), lon.alias("lon_idx"), float_name(F.col("float_id"), F.col("profile_idx")).alias("name"))
    few = at.count() <= WANTED_ROWS
    ids = at.select("profile_idx")
    temps = profile_values(levels.join(_side(ids, few), "profile_idx", "left_semi"), depths)
    every = F.array(*(F.lit(i) for i in range(len(depths))))
    dated = at if target is None else _dated(at, target, mode)
    rows = ids.join(temps if few else temps.hint("merge"), "profile_idx", "left").join(dated if few else dated.hint("merge"), "profile_idx")
    if target is None:
        rows = rows.withColumns({"found": every, "values": F.lit(None).cast("array<double>")})
    else:
        rows = rows.join(_near(dated, target, len(depths), stored), CELL, "left")
    rows = rows.select(
        F.date_format("juld", "yyyy-MM-dd").alias("date"), F.col("name").alias("float_id"), F.round("lat", 3).alias("argo_lat"), F.round("lon", 3).alias("argo_lon"),
        F.round(grid.lat(F.col("lat_idx")), 3).alias("grid_lat"), F.round(grid.lon(F.col("lon_idx")), 3).alias("grid_lon"), "temps", "values",
        F.posexplode(F.coalesce("found", every)).alias("i", "depth_idx"),
    )
    return rows.select(
        "date", "float_id", "argo_lat", "argo_lon", "grid_lat", "grid_lon", F.get(F.array(*(F.lit(int(d)) for d in depths)), F.col("depth_idx")).alias("depth_m"),
        F.round(F.get("temps", F.col("depth_idx")), 4).alias("argo_temp"), F.get("values", F.col("i")).alias("glorys_temp"), F.lit(None).cast("double").alias("model_prediction"),
    )


def totals(collocated: DataFrame) -> DataFrame:
    return collocated.agg(F.count("*").alias("n_rows"), F.count("argo_temp").alias("n_argo"), F.count("glorys_temp").alias("n_grid"))



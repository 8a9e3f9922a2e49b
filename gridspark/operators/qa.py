"""Quality checks; boxes and bounds are fixed values of the contract. Each gives rows (check, passed, and its measures); the scorecard counts them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.functions.grid import TARGET, Grid
from gridspark.operators.mask import with_mask


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def date_sync(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """Both tables have the same dates, one at least."""
    x = a.select(date).distinct().withColumn("in_a", F.lit(1))
    y = b.select(date).distinct().withColumn("in_b", F.lit(1))
    both = x.join(y, date, "full_outer")
    n = both.agg(F.count("*").alias("n_dates"), F.count(F.when(F.col("in_b").isNull(), 1)).alias("only_a"), F.count(F.when(F.col("in_a").isNull(), 1)).alias("only_b"))
    return n.withColumn("passed", (F.col("n_dates") > 0) & (F.col("only_a") == 0) & (F.col("only_b") == 0))


def _ocean(c: Column | str) -> Column:
    return F.when(F.col("is_ocean"), F.col(c) if isinstance(c, str) else c)


def _speed(u: str, v: str) -> Column:
    return F.sqrt(F.col(u) * F.col(u) + F.col(v) * F.col(v))


def salinity_measures(grid: Grid = TARGET, west=(10.0, 22.0, 55.0, 72.0), east=(10.0, 22.0, 82.0, 95.0)) -> dict[str, Column]:
    lat, lon = grid.lat(F.col("lat_idx")), grid.lon(F.col("lon_idx"))
    box = lambda b: lat.between(b[0], b[1]) & lon.between(b[2], b[3])
    return {"west": F.avg(F.when(box(west), _ocean("sss"))), "east": F.avg(F.when(box(east), _ocean("sss")))}


SALINITY = "west - east >= 1.5 and west >= 34.5 and east <= 34.0"


def salinity_contrast(surface: DataFrame, mask: DataFrame, grid: Grid = TARGET, west=(10.0, 22.0, 55.0, 72.0), east=(10.0, 22.0, 82.0, 95.0)) -> DataFrame:
    """Mean salinity of two ocean boxes: contrast 1.5 at least, west 34.5 at least, east 34.0 at most."""
    out = _measured(with_mask(surface, mask).where("is_ocean"), salinity_measures(grid, west, east))
    return out.withColumn("contrast", F.col("west") - F.col("east")).withColumn("passed", _true(F.expr(SALINITY)))


def wind_measures() -> dict[str, Column]:
    speed = _ocean(_speed("u_wind", "v_wind"))
    return {"mean_u": F.avg(_ocean("u_wind")), "mean_v": F.avg(_ocean("v_wind")), "mean_speed": F.avg(speed), "max_speed": F.max(speed)}


WIND = "mean_u < 0 and mean_v < 0 and mean_speed between 1.0 and 15.0"


def wind_vector(surface: DataFrame, mask: DataFrame) -> DataFrame:
    """Mean wind from the north-east and a mean speed of 1 to 15."""
    return _measured(with_mask(surface, mask).where("is_ocean"), wind_measures()).withColumn("passed", _true(F.expr(WIND)))


def current_measures() -> dict[str, Column]:
    speed = _ocean(_speed("u_curr", "v_curr"))
    return {"mean_speed": F.avg(speed), "max_speed": F.max(speed)}


CURRENTS = "mean_speed < 0.5 and max_speed < 2.5"


def current_bounds(surface: DataFrame, mask: DataFrame) -> DataFrame:
    return _measured(with_mask(surface, mask).where("is_ocean"), current_measures()).withColumn("passed", _true(F.expr(CURRENTS)))


def _measured(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return rows.agg(*(m.alias(name) for name, m in measures.items()))


def depth_summary(target: DataFrame, mask: DataFrame) -> DataFrame:
    """Per depth on the ocean: mean, min, max, and valid points a day (whole)."""
    days = target.agg(F.countDistinct("date").alias("days"))
    rows = with_mask(target, mask).where("is_ocean").groupBy("depth_idx", "depth_m").agg(F.avg("temp").alias("mean"), F.min("temp").alias("min"), F.max("temp").alias("max"), F.count("temp").alias("n"))
    return rows.join(F.broadcast(days), how="cross").select("depth_idx", "depth_m", "mean", "min", "max", F.floor(F.col("n") / F.col("days")).cast("long").alias("points_a_day"))


def stratification_measures(levels: tuple[int, int, int] = (0, 100, 1000)) -> dict[str, Column]:
    return {n: F.avg(F.when(F.col("depth_m") == d, _ocean("temp"))) for n, d in zip(("top", "middle", "deep"), levels)}


STRATIFICATION = "top > middle and middle > deep and deep between 4.0 and 12.0"


def stratification(target: DataFrame, mask: DataFrame, levels: tuple[int, int, int] = (0, 100, 1000)) -> DataFrame:
    """Warm above cold, and the deepest of the three between 4 and 12 degrees."""
    return _measured(with_mask(target, mask).where("is_ocean"), stratification_measures(levels)).withColumn("passed", _true(F.expr(STRATIFICATION)))


def with_lower(target: DataFrame) -> DataFrame:
    """``target`` with ``lower_m`` and ``diff``: the depth below of the same day and cell, and its temperature less the row's own; missing unless both
    are there and adjacent."""
    cell = W.partitionBy("date", "lat_idx", "lon_idx").orderBy("depth_idx")
    below = F.lead(F.struct("depth_idx", "depth_m", "temp")).over(cell)
    rows = target.withColumn("__below", below)
    adjacent = F.col("__below.depth_idx") == F.col("depth_idx") + 1
    diff = F.col("__below.temp") - F.col("temp")
    return rows.withColumn("lower_m", F.when(adjacent & diff.isNotNull(), F.col("__below.depth_m"))).withColumn("diff", F.when(adjacent, diff)).drop("__below")


def depth_differences(target: DataFrame, mask: DataFrame) -> DataFrame:
    """(date, cell, depth_m, lower_m, diff): lower less upper temperature of adjacent depths, both valid, on the ocean."""
    rows = with_lower(with_mask(target, mask).where("is_ocean")).where("diff is not null")
    return rows.select("date", "lat_idx", "lon_idx", "depth_m", "lower_m", "diff")


def inversion_measures() -> dict[str, Column]:
    """Over rows with ``depth_m``, ``lower_m`` and ``diff``."""
    bound = F.when(F.col("lower_m") <= 50, 5.0).when(F.col("depth_m") >= 500, 1.0).otherwise(4.0)
    count = lambda c: F.count(F.when(c, 1))
    return {"pairs": F.count("diff"), "inversions": count(F.col("diff") > 0.1), "barrier_layers": count((F.col("diff") > 0.1) & (F.col("lower_m") <= 50)), "anomalies": count(F.col("diff") > bound)}


def inversions(target: DataFrame, mask: DataFrame) -> DataFrame:
    """Pairs of adjacent depths where the lower is warmer by over 0.1 degrees, those of them down to 50 m, and those that are anomalous: by over 5.0
    down to 50 m, over 1.0 from 500 m, over 4.0 between. Passes without anomalies."""
    out = _measured(depth_differences(target, mask), inversion_measures())
    return out.withColumn("inversion_pct", F.col("inversions") * 100.0 / F.greatest(F.col("pairs"), F.lit(1))).withColumn("passed", F.col("anomalies") == 0)


def integrity_measures(names: list[str]) -> dict[str, Column]:
    broken = reduce(lambda a, b: a | b, (F.col(v).isNull() | F.isnan(v) for v in names))
    stray = ~F.col("is_ocean") & reduce(lambda a, b: a | b, (F.coalesce(F.col(v) != 0, F.lit(True)) for v in names))
    return {"broken": F.count(F.when(broken, 1)), "land_not_zero": F.count(F.when(stray, 1))}


def integrity(rows: DataFrame, values: list[str], targets: DataFrame | None = None, target: str = "temp") -> DataFrame:
    """Normalised rows with ``is_ocean``, and filled targets with it: no missing or NaN value, and land exactly 0."""

    def faults(df: DataFrame, names: list[str], kind: str) -> DataFrame:
        return df.agg(F.count("*").alias(f"n_{kind}"), *(m.alias(f"{kind}_{name}") for name, m in integrity_measures(names).items()))

    out = faults(rows, values, "inputs")
    if targets is not None:
        out = out.join(F.broadcast(faults(targets, [target], "targets")), how="cross")
    clean = [F.col(c) == 0 for c in out.columns if not c.startswith("n_")]
    return out.withColumn("passed", reduce(lambda a, b: a & b, clean))


def _at_once(rows: DataFrame, measures: dict[str, dict[str, Column]], rules: dict[str, str]) -> DataFrame:
    """(check, passed) of several checks by one aggregation."""
    wide = rows.agg(*(F.struct(*(m.alias(n) for n, m in of.items())).alias(check) for check, of in measures.items()))
    own = lambda check: re.sub(rf"\b({'|'.join(measures[check])})\b", rf"{check}.\1", rules[check])
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check"), _true(F.expr(own(c))).alias("passed")) for c in measures))).alias("r")).select("r.*")


def surface_checks(surface: DataFrame, mask: DataFrame, grid: Grid = TARGET) -> DataFrame:
    """Salinity, winds and currents."""
    measures = {"salinity": salinity_measures(grid), "winds": wind_measures(), "currents": current_measures()}
    return _at_once(with_mask(surface, mask).where("is_ocean"), measures, {"salinity": SALINITY, "winds": WIND, "currents": CURRENTS})


def target_checks(target: DataFrame, mask: DataFrame) -> DataFrame:
    """Stratification and inversions."""
    measures = {"stratification": stratification_measures(), "inversions": inversion_measures()}
    return _at_once(with_lower(with_mask(target, mask).where("is_ocean")), measures, {"stratification": STRATIFICATION, "inversions": "anomalies = 0"})


class ObservedCard:
    """The scorecard from metrics that the jobs which write the data observe on the way: no check scans anything itself.

    Each method gives its table back, to be written as usual; the metrics are those of the rows that are written. A table must
    be written once before ``card`` is asked for."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def _observe(self, df: DataFrame, kind: str, measures: dict[str, dict[str, Column]]) -> DataFrame:
        self._seen[kind] = Observation(f"{kind}-{id(self)}")
        return df.observe(self._seen[kind], *(m.alias(f"{check}_{name}") for check, of in measures.items() for name, m in of.items()))

    def surface(self, df: DataFrame, grid: Grid = TARGET) -> DataFrame:
        """Daily channels with ``is_ocean``. The days, thousands at most, come as one set."""
        return self._observe(df, "surface", {"days": {"a": F.collect_set("date")}, "salinity": salinity_measures(grid), "winds": wind_measures(), "currents": current_measures()})

    def inputs(self, df: DataFrame, values: list[str]) -> DataFrame:
        return self._observe(df, "inputs", {"inputs": integrity_measures(values)})

    def target(self, df: DataFrame, filled: Column) -> DataFrame:
        """Temperatures with ``is_ocean``; ``filled`` is the value that is exported. The window for the depth below has the keys by which the
        table is stored."""
        rows = with_lower(df).withColumns({"__filled": filled, "lower_m": _ocean("lower_m"), "diff": _ocean("diff")})
        seen = self._observe(rows, "target", {"days": {"b": F.collect_set("date")}, "stratification": stratification_measures(), "inversions": inversion_measures(), "targets": integrity_measures(["__filled"])})
        return seen.drop("lower_m", "diff", "__filled")

    def card(self, spark: SparkSession) -> DataFrame:
        """total_checks, passed_checks, success."""
        got = {k: v for seen in self._seen.values() for k, v in seen.get.items()}
        days_a, days_b = set(got.pop("days_a")), set(got.pop("days_b"))
        clean = not any(v for k, v in got.items() if k.startswith(("inputs_", "targets_")))
        rows = [spark.createDataFrame([("dates", bool(days_a) and days_a == days_b), ("integrity", clean)], "check string, passed boolean")]
        for check, rule in (("salinity", SALINITY), ("winds", WIND), ("currents", CURRENTS), ("stratification", STRATIFICATION), ("inversions", "anomalies = 0")):
            own = {k.removeprefix(f"{check}_"): v for k, v in got.items() if k.startswith(f"{check}_")}
            measured = spark.createDataFrame([tuple(None if v is None else float(v) for v in own.values())], ", ".join(f"{k} double" for k in own))
            rows.append(measured.select(F.lit(check).alias("check"), _true(F.expr(rule)).alias("passed")))
        return _card(reduce(DataFrame.unionByName, rows))


def continuity(df: DataFrame, must_have: list[str] = (), date: str = "date") -> DataFrame:
    """Days are strictly consecutive and hold the given ones."""
    days = df.select(date).distinct()
    gaps = days.select(date, F.datediff(date, F.lag(date).over(W.orderBy(date))).alias("gap"))
    wanted = [F.count(F.when(F.col(date) == F.to_date(F.lit(d)), 1)) > 0 for d in must_have]
    out = gaps.agg(F.count("*").alias("n_dates"), F.count(F.when(F.col("gap") > 1, 1)).alias("breaks"), reduce(lambda a, b: a & b, wanted, F.lit(True)).alias("has_wanted"), (F.datediff(F.max(date), F.min(date)) + 1).alias("calendar_days"))
    return out.withColumn("passed", (F.col("n_dates") > 0) & (F.col("breaks") == 0) & F.col("has_wanted"))


def missing_days(df: DataFrame, date: str = "date") -> DataFrame:
    """The calendar's days that the table lacks."""
    days = df.select(date).distinct()
    return days.agg(F.min(date).alias("a"), F.max(date).alias("b")).select(F.explode(F.sequence("a", "b")).alias(date)).exceptAll(days)


def calendar(df: DataFrame, start: str, periods: int, date: str = "date") -> DataFrame:
    """The table's days against the ``periods`` days from ``start``, both ways."""
    first = F.to_date(F.lit(start))
    wanted = df.sparkSession.range(periods).select(F.date_add(first, F.col("id").cast("int")).alias(date), F.lit(1).alias("wanted"))
    both = df.select(date).distinct().withColumn("there", F.lit(1)).join(wanted, date, "full_outer")
    out = both.agg(F.count("there").alias("n_dates"), F.count(F.when(F.col("there").isNull(), 1)).alias("missing"), F.count(F.when(F.col("wanted").isNull(), 1)).alias("unexpected"))
    return out.withColumn("passed", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def scorecard(checks: dict[str, DataFrame], *more: DataFrame) -> DataFrame:
    """total_checks, passed_checks, success; ``more`` are rows (check, passed)."""
    rows = [df.select(F.lit(name).alias("check"), "passed") for name, df in checks.items()]
    return _card(reduce(DataFrame.unionByName, [*rows, *more]))


def _card(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total_checks"), F.sum(F.col("passed").cast("long")).alias("passed_checks"), F.every("passed").alias("success"))

"""Registered queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.grid import CHANNELS, COARSE, TARGET, depth_axis
from gridspark.operators import align, asof, chunks, collocate, coverage, crop, mask, merge, metrics, moments, normalize, qa, regrid, split, tensor, tiled, vertical
from gridspark.plans import fixtures as fx
from gridspark.plans import jobs
from gridspark.sources import bucketed, clustered, ingest, sinks, snapshots, synthetic
from gridspark.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _QUERIES[name] = query
        if sql:
            _SQL[name] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _r(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _weights(spark: SparkSession, grid=COARSE) -> tuple[DataFrame, DataFrame]:
    (slat, slon), (dlat, dlon) = fx.native_axes(spark), grid.axes(spark)
    return regrid.axis_weights(slat, dlat), regrid.axis_weights(slon, dlon)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i1_bilinear(spark, sf_dir)


# -- sources and sinks


@register("s1_read_source", "SELECT l_orderkey, l_linenumber, l_quantity AS lat, CASE WHEN l_discount > 0.05 THEN l_discount END AS lon FROM lineitem")
def s1_read_source(spark, d):
    nan = F.when(F.col("l_discount") > 0.05, F.col("l_discount")).otherwise(F.lit(float("nan")))
    raw = fx.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("Latitude"), nan.alias("nav_lon"))
    path = sinks.scratch_path(spark, "source")
    raw.write.parquet(path)
    return ingest.read_source(spark, path, "l_orderkey long, l_linenumber int, Latitude double, nav_lon double")


@register("s2_read_many", "SELECT 'o' AS kind, CAST(o_orderkey AS BIGINT) AS key, CAST(o_totalprice AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b FROM orders UNION ALL SELECT 'c', CAST(c_custkey AS BIGINT), NULL, CAST(c_acctbal AS DOUBLE) FROM customer")
def s2_read_many(spark, d):
    path = sinks.scratch_path(spark, "many")
    fx.read(spark, d, "orders").select(F.lit("o").alias("kind"), F.col("o_orderkey").cast("long").alias("key"), F.col("o_totalprice").cast("double").alias("a")).write.parquet(f"{path}/one")
    fx.read(spark, d, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").cast("long").alias("key"), F.col("c_acctbal").cast("double").alias("b")).write.parquet(f"{path}/two")
    return ingest.read_many(spark, [f"{path}/one", f"{path}/two"])


@register("s3_load_variable", fx.sql("surface") + "SELECT date, lat_idx, lon_idx, 'sst' AS variable, round(sst, 6) AS value FROM surface")
def s3_load_variable(spark, d):
    path = sinks.scratch_path(spark, "variables")
    s = fx.surface(spark, d)
    long = s.select("date", "lat_idx", "lon_idx", F.explode(F.create_map(F.lit("sst"), F.col("sst"), F.lit("sss"), F.col("sss"))).alias("variable", "value"))
    long.write.partitionBy("variable").parquet(path)
    return _r(ingest.load_variable(spark.read.parquet(path), "sst"), "value")


@register("s4_profile_levels", fx.sql("levels") + "SELECT profile_idx, count(*) AS n_levels, count(temp) AS n_temps, round(sum(pres), 6) AS sum_pres FROM levels GROUP BY profile_idx")
def s4_profile_levels(spark, d):
    packed = fx.levels(spark, d).groupBy("profile_idx").agg(F.collect_list(F.struct("pres", "temp")).alias("levels"))
    return _r(ingest.profile_levels(packed).groupBy("profile_idx").agg(F.count("*").alias("n_levels"), F.count("temp").alias("n_temps"), F.sum("pres").alias("sum_pres")), "sum_pres")


@register("s4_adjusted_levels", fx.sql("levels") + "SELECT profile_idx, count(*) AS n_levels, count(temp) AS n_temps, round(sum(pres), 6) AS sum_pres, round(sum(temp + 0.5), 6) AS sum_temp FROM levels GROUP BY profile_idx")
def s4_adjusted_levels(spark, d):
    """Adjusted temperatures with raw pressures: each is chosen apart."""
    packed = fx.levels(spark, d).groupBy("profile_idx").agg(F.collect_list(F.struct("pres", "temp")).alias("l"))
    packed = packed.select("profile_idx", F.col("l.pres").alias("pres"), F.col("l.temp").alias("temp"), F.transform("l.temp", lambda t: t + 0.5).alias("temp_adjusted"))
    out = ingest.profile_levels(packed).groupBy("profile_idx").agg(F.count("*").alias("n_levels"), F.count("temp").alias("n_temps"), F.sum("pres").alias("sum_pres"), F.sum("temp").alias("sum_temp"))
    return _r(out, "sum_pres", "sum_temp")


@register("s5_month_partitions", fx.sql("surface") + "SELECT year(date) AS year, month(date) AS month, count(*) AS n, round(sum(sst), 4) AS sst FROM surface GROUP BY 1, 2")
def s5_month_partitions(spark, d):
    path = sinks.scratch_path(spark, "months")
    sinks.write_months(fx.surface(spark, d), path)
    return _r(sinks.read_months(spark, path).groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("sst").alias("sst")), "sst", digits=4)


@register("s5_snapshot_months", fx.sql("surface") + "SELECT year(date) AS year, month(date) AS month, count(*) AS n, round(sum(CASE WHEN year(date) = 1996 THEN sst + 1 ELSE sst END), 4) AS sst FROM surface GROUP BY 1, 2")
def s5_snapshot_months(spark, d):
    """All months are committed, then those of one year replaced."""
    s = fx.surface(spark, d)
    table = snapshots.MonthTable(spark, sinks.scratch_path(spark, "snapshots"))
    table.replace(s)
    table.replace(s.where(F.year("date") == 1996).withColumn("sst", F.col("sst") + 1))
    return _r(table.read().groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("sst").alias("sst")), "sst", digits=4)


@register("s11_missing_by_manifest", "WITH a AS (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month FROM lineitem) SELECT year, month FROM a WHERE (year, month) NOT IN (SELECT (year(o_orderdate), month(o_orderdate)) FROM orders)")
def s11_missing_by_manifest(spark, d):
    table = snapshots.MonthTable(spark, sinks.scratch_path(spark, "snapshots"))
    table.replace(fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderkey"))
    return table.missing(sinks.with_month(fx.read(spark, d, "lineitem").select("l_shipdate"), "l_shipdate"))


@register("s9_mask_table", fx.sql("mask", "surface") + "SELECT count(*) AS n, CAST(sum(CASE WHEN m.is_ocean THEN 1 ELSE 0 END) AS BIGINT) AS n_ocean FROM surface s JOIN mask m USING (lat_idx, lon_idx)")
def s9_mask_table(spark, d):
    path = sinks.scratch_path(spark, "mask")
    fx.mask(spark).write.parquet(path)
    return mask.with_mask(fx.surface(spark, d), spark.read.parquet(path)).agg(F.count("*").alias("n"), F.sum(F.col("is_ocean").cast("long")).alias("n_ocean"))


@register(
    "s10_synthetic_surface",
    """WITH dates AS (SELECT DISTINCT CAST(date_trunc('year', l_shipdate) AS DATE) AS date FROM lineitem),
    cells AS (SELECT a.i AS lat_idx, b.i AS lon_idx FROM range(21) a(i), range(49) b(i)),
    v AS (SELECT date, 20.0 + 13.0 * CAST('0x' || substr(md5('42sst:' || CAST(date AS VARCHAR) || ':' || lat_idx || ':' || lon_idx), 1, 8) AS BIGINT) / 4294967296.0 AS sst,
      -0.5 + CAST('0x' || substr(md5('42ssh:' || CAST(date AS VARCHAR) || ':' || lat_idx || ':' || lon_idx), 1, 8) AS BIGINT) / 4294967296.0 AS ssh FROM dates, cells)
    SELECT date, count(*) AS n, round(avg(sst), 6) AS sst, round(max(sst), 6) AS sst_max, round(avg(ssh), 6) AS ssh FROM v GROUP BY date""",
)
def s10_synthetic_surface(spark, d):
    dates = fx.read(spark, d, "lineitem").select(F.trunc("l_shipdate", "year").alias("date")).distinct()
    s = synthetic.surface(dates, COARSE)
    return _r(s.groupBy("date").agg(F.count("*").alias("n"), F.avg("sst").alias("sst"), F.max("sst").alias("sst_max"), F.avg("ssh").alias("ssh")), "sst", "sst_max", "ssh")


_NOISE = " + ".join(f"CAST('0x' || substr(md5('42n{i}:' || CAST(date AS VARCHAR) || ':' || depth_idx || ':' || lat_idx || ':' || lon_idx), 1, 8) AS BIGINT) / 4294967296.0" for i in range(12))


@register(
    "s10_synthetic_target",
    f"""WITH dates AS (SELECT DISTINCT CAST(date_trunc('year', l_shipdate) AS DATE) AS date FROM lineitem),
    cells AS (SELECT a.i AS lat_idx, b.i AS lon_idx FROM range(21) a(i), range(49) b(i)),
    dep AS (SELECT CAST(i AS INT) AS depth_idx, CAST([0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000][i + 1] AS INT) AS depth_m FROM range(15) t(i)),
    v AS (SELECT depth_idx, depth_m, 4.0 + 24.0 * exp(-depth_m / 500.0) + 0.5 * ({_NOISE} - 6.0) AS temp FROM dates, cells, dep)
    SELECT depth_idx, depth_m, count(*) AS n, round(avg(temp), 6) AS temp FROM v GROUP BY 1, 2""",
)
def s10_synthetic_target(spark, d):
    """The mean of each depth; tests hold it against the decay law too."""
    dates = fx.read(spark, d, "lineitem").select(F.trunc("l_shipdate", "year").alias("date")).distinct()
    return synthetic.target(dates, COARSE).groupBy("depth_idx", "depth_m").agg(F.count("*").alias("n"), F.round(F.avg("temp"), 6).alias("temp"))


@register("s11_missing_months", "WITH a AS (SELECT DISTINCT year(l_shipdate) AS year, month(l_shipdate) AS month FROM lineitem), b AS (SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders WHERE o_orderstatus = 'P') SELECT CAST(a.year AS INT) AS year, CAST(a.month AS INT) AS month FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.year = a.year AND b.month = a.month)")
def s11_missing_months(spark, d):
    wanted = sinks.with_month(fx.read(spark, d, "lineitem").select("l_shipdate"), "l_shipdate")
    done = sinks.with_month(fx.read(spark, d, "orders").where("o_orderstatus = 'P'").select("o_orderdate"), "o_orderdate")
    return sinks.missing_months(wanted, done)


@register("s8_collocation_csv", None)
def s8_collocation_csv(spark, d):
    """Written as CSV and read back as text fields."""
    path = sinks.scratch_path(spark, "collocation-csv")
    sinks.write_csv(collocate.collocate(fx.profiles(spark, d), fx.levels(spark, d), None), path)
    return spark.read.option("header", True).csv(path).groupBy("depth_m").agg(F.count("*").alias("n_rows"), F.count("argo_temp").alias("n_temps"), F.count("model_prediction").alias("n_pred"))


_SQL["s8_collocation_csv"] = (
    fx.sql("profiles", "levels")
    + """, p AS (SELECT profile_idx FROM profiles WHERE lat BETWEEN 5 AND 30 AND lon BETWEEN 45 AND 105),
    pts AS (SELECT profile_idx, pres, avg(temp) AS temp FROM levels JOIN p USING (profile_idx) WHERE temp IS NOT NULL GROUP BY 1, 2),
    rng AS (SELECT profile_idx, min(pres) AS lo, max(pres) AS hi, count(*) AS n FROM pts GROUP BY 1),
    dep AS (SELECT unnest([0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000]) AS depth_m)
    SELECT CAST(depth_m AS VARCHAR) AS depth_m, count(*) AS n_rows, count(CASE WHEN n >= 2 AND depth_m BETWEEN lo AND hi THEN 1 END) AS n_temps, CAST(0 AS BIGINT) AS n_pred
    FROM p CROSS JOIN dep LEFT JOIN rng USING (profile_idx) GROUP BY depth_m"""
)


# -- projections, filters, predicates


@register("p1_names", "SELECT l_suppkey % 11 AS lat, l_partkey % 25 AS lon, l_linenumber AS depth, l_shipdate AS time, l_quantity AS sst, l_tax AS u_wind FROM lineitem")
def p1_names(spark, d):
    raw = fx.read(spark, d, "lineitem").select((F.col("l_suppkey") % 11).alias("Latitude"), (F.col("l_partkey") % 25).alias("NAV_LON"), F.col("l_linenumber").alias("deptht"), F.col("l_shipdate").alias("valid_time"), F.col("l_quantity").alias("thetao"), F.col("l_tax").alias("u10"))
    return ingest.rename_variables(ingest.normalize_names(raw))


@register("p2_rename", "SELECT l_orderkey, l_linenumber, l_quantity AS sst, l_discount AS sss, l_tax AS ssh, l_extendedprice AS v_wind FROM lineitem")
def p2_rename(spark, d):
    raw = fx.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("thetao"), F.col("l_discount").alias("sss_smap"), F.col("l_tax").alias("zos"), F.col("l_extendedprice").alias("v10"))
    return ingest.rename_variables(raw)


@register("p4_keep_standard", fx.sql("surface") + "SELECT date, lat_idx, lon_idx, round(sst, 6) AS sst, round(v_wind, 6) AS v_wind FROM surface")
def p4_keep_standard(spark, d):
    return _r(ingest.keep_standard(fx.surface(spark, d), ["date", "lat_idx", "lon_idx"], ["sst", "v_wind", "absent"]), "sst", "v_wind")


@register("p3_canonical_channels", fx.sql("surface") + "SELECT date, lat_idx, lon_idx, round(sst, 6) AS sst, round(sss, 6) AS sss, round(ssh, 6) AS ssh, round(u_curr, 6) AS u_curr, round(v_curr, 6) AS v_curr, round(u_wind, 6) AS u_wind, round(v_wind, 6) AS v_wind FROM surface")
def p3_canonical_channels(spark, d):
    raw = fx.surface(spark, d).withColumnsRenamed({"sst": "thetao", "sss": "sss_smap", "u_curr": "uo", "u_wind": "u10"}).withColumn("analysed_sst", F.lit(0.0))
    return _r(ingest.keep_standard(ingest.canonical_channels(raw, ["date", "lat_idx", "lon_idx"]), ["date", "lat_idx", "lon_idx"], CHANNELS), *CHANNELS)


@register("p5_crop_box", fx.sql("native") + "SELECT date, src_lat_idx, src_lon_idx, round(v, 6) AS v FROM native WHERE 5 + 2.5 * src_lat_idx BETWEEN 9 AND 21 AND 45 + 2.5 * src_lon_idx BETWEEN 54 AND 73")
def p5_crop_box(spark, d):
    return _r(crop.crop_box(fx.native_points(spark, d), (10.0, 20.0, 55.0, 72.0), buffer=1.0).select("date", "src_lat_idx", "src_lon_idx", "v"), "v")


@register("p6_depths", fx.sql("target_native") + "SELECT 'range' AS kind, src_depth_idx, count(*) AS n, round(avg(temp), 6) AS temp FROM target_native WHERE depth BETWEEN 9.5 AND 320 GROUP BY 2 UNION ALL SELECT 'surface', NULL, count(*), round(avg(temp), 6) FROM target_native WHERE depth BETWEEN 0 AND 0.5")
def p6_depths(spark, d):
    t = fx.target_native(spark, d)
    wide = crop.depth_range(t, 9.5, 320.0).groupBy(F.lit("range").alias("kind"), "src_depth_idx").agg(F.count("*").alias("n"), F.avg("temp").alias("temp"))
    top = crop.surface_level(t.drop("src_depth_idx")).agg(F.lit("surface").alias("kind"), F.lit(None).cast("int").alias("src_depth_idx"), F.count("*").alias("n"), F.avg("temp").alias("temp"))
    return _r(wide.unionByName(top), "temp")


@register("p7_celsius", "SELECT l_orderkey, l_linenumber, round(l_quantity + 280.0 - 273.15, 6) AS sst FROM lineitem")
def p7_celsius(spark, d):
    return fx.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(crop.kelvin_to_celsius(F.col("l_quantity") + 280.0), 6).alias("sst"))


@register("p8_ocean_predicate", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN l_quantity END AS sst, CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS TINYINT) AS is_ocean FROM lineitem")
def p8_ocean_predicate(spark, d):
    rows = fx.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("sst"), F.col("l_linenumber").alias("mask"))
    return mask.mask_value(rows, "sst").drop("mask")


@register("p9_floor_day", fx.sql("subdaily") + "SELECT CAST(time AS DATE) AS date, count(*) AS n FROM subdaily GROUP BY 1")
def p9_floor_day(spark, d):
    return fx.subdaily(spark, d).groupBy(align.floor_day(F.col("time")).alias("date")).agg(F.count("*").alias("n"))


@register("p10_date_range", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1996-04-30' GROUP BY 1")
def p10_date_range(spark, d):
    rows = fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"))
    return crop.date_range(crop.month_range(rows, "1996-02", "1996-04"), "1996-01-15", "1996-12-31").groupBy("date").agg(F.count("*").alias("n"))


@register("p12_fill_target", fx.sql("levels") + "SELECT profile_idx, round(sum(coalesce(temp, 0)), 6) AS temp FROM levels GROUP BY 1")
def p12_fill_target(spark, d):
    return _r(fx.levels(spark, d).groupBy("profile_idx").agg(F.sum(normalize.fill_target(F.col("temp"))).alias("temp")), "temp")


@register("p14_valid_levels", fx.sql("levels") + "SELECT profile_idx, count(*) AS n FROM levels WHERE pres IS NOT NULL AND temp IS NOT NULL GROUP BY 1")
def p14_valid_levels(spark, d):
    return vertical.valid_levels(fx.levels(spark, d)).groupBy("profile_idx").agg(F.count("*").alias("n"))


@register("p15_slices", fx.sql("target_sparse") + "SELECT 'section' AS kind, lat_idx, depth_idx, round(temp, 6) AS temp FROM target_sparse WHERE date = DATE '1997-01-01' AND lon_idx = 7 UNION ALL SELECT 'profile', lat_idx, depth_idx, round(temp, 6) FROM target_sparse WHERE date = DATE '1997-01-01' AND lat_idx = 4 AND lon_idx = 7 UNION ALL SELECT 'map', lat_idx, CAST(lon_idx AS INT), round(temp, 6) FROM target_sparse WHERE date = DATE '1997-01-01' AND depth_idx = 0")
def p15_slices(spark, d):
    t = fx.target_sparse(spark, d)
    lon, lat = 45 + 1.25 * 7 + 0.3, 5 + 1.25 * 4 - 0.3
    section = crop.section(t, "1997-01-01", lon, COARSE).select(F.lit("section").alias("kind"), "lat_idx", "depth_idx", "temp")
    profile = crop.depth_profile(t, "1997-01-01", lat, lon, COARSE).select(F.lit("profile").alias("kind"), F.lit(4).alias("lat_idx"), "depth_idx", "temp")
    day = crop.day_map(t.where("depth_idx = 0"), "1997-01-01", "temp").select(F.lit("map").alias("kind"), "lat_idx", F.col("lon_idx").alias("depth_idx"), "temp")
    return _r(section.unionByName(profile).unionByName(day), "temp")


@register("p15_clustered_slices", _SQL["p15_slices"])
def p15_clustered_slices(spark, d):
    """The slices from files clustered by day and cell; each opens only the files whose ranges it meets."""
    path, day = sinks.scratch_path(spark, "clustered"), dt.date(1997, 1, 1)
    clustered.write_clustered(fx.target_sparse(spark, d), path, ["date", "lat_idx", "lon_idx"], 16)
    kind = lambda k: F.lit(k).alias("kind")
    section = clustered.read_range(spark, path, {"date": (day, day), "lon_idx": (7, 7)}).select(kind("section"), "lat_idx", "depth_idx", "temp")
    profile = clustered.read_range(spark, path, {"date": (day, day), "lat_idx": (4, 4), "lon_idx": (7, 7)}).select(kind("profile"), "lat_idx", "depth_idx", "temp")
    whole = clustered.read_range(spark, path, {"date": (day, day)}).where("depth_idx = 0").select(kind("map"), "lat_idx", F.col("lon_idx").alias("depth_idx"), "temp")
    return _r(section.unionByName(profile).unionByName(whole), "temp")


# -- interpolation

_REGRID = fx.sql("native", "corners") + (
    ", r AS (SELECT n.date, a.lat_idx, b.lon_idx, sum(a.w * b.w * n.v) AS v, count(n.v) AS c FROM native n JOIN lat_w a USING (src_lat_idx) JOIN lon_w b USING (src_lon_idx) GROUP BY 1, 2, 3),"
    " days AS (SELECT DISTINCT date FROM native),"
    " i1 AS (SELECT d.date, CAST(q.lat_idx AS INT) AS lat_idx, CAST(q.lon_idx AS INT) AS lon_idx, CASE WHEN r.c = q.n THEN r.v END AS v FROM days d CROSS JOIN need q LEFT JOIN r ON r.date = d.date AND r.lat_idx = q.lat_idx AND r.lon_idx = q.lon_idx)"
)


@register("i1_bilinear_regrid", _REGRID + " SELECT date, lat_idx, lon_idx, round(v, 6) AS v FROM i1")
def i1_bilinear(spark, d):
    native = fx.native_grid(spark, d)
    out = regrid.regrid(native, ["v"], *_weights(spark))
    return _r(regrid.onto_grid(out, COARSE, spine=native.select("date").distinct()), "v")


@register("i1_regrid_daily_means", _REGRID + " SELECT date, count(*) AS n_cells, count(v) AS n_valid, round(avg(v), 6) AS mean FROM i1 GROUP BY date")
def i1_regrid_daily_means(spark, d):
    out = regrid.regrid(fx.native_grid(spark, d), ["v"], *_weights(spark))
    return _r(regrid.onto_grid(out, COARSE).groupBy("date").agg(F.count("*").alias("n_cells"), F.count("v").alias("n_valid"), F.avg("v").alias("mean")), "mean")


@register("i1_contract_grid", _REGRID.replace(fx.SQL["corners"], fx.SQL["corners10"]) + " SELECT date, count(*) AS n_cells, count(v) AS n_valid, round(avg(v), 6) AS mean FROM i1 GROUP BY date")
def i1_contract_grid(spark, d):
    """The contract's 101 by 241 cells."""
    out = regrid.regrid(fx.native_grid(spark, d), ["v"], *_weights(spark, TARGET))
    return _r(regrid.onto_grid(out, TARGET).groupBy("date").agg(F.count("*").alias("n_cells"), F.count("v").alias("n_valid"), F.avg("v").alias("mean")), "mean")


def _coords(first: float, step: float, n: int) -> list[float]:
    return [first + step * i for i in range(n)]


@register("i1_tiled_contract", _SQL["i1_contract_grid"])
def i1_tiled_contract(spark, d):
    """The same cells from tiles of four nodes a side."""
    out = tiled.regrid_tiled(fx.native_grid(spark, d), ["v"], _coords(5.0, 2.5, 11), _coords(45.0, 2.5, 25), _coords(5.0, 0.25, 101), _coords(45.0, 0.25, 241), tile=4)
    return _r(regrid.onto_grid(out, TARGET).groupBy("date").agg(F.count("*").alias("n_cells"), F.count("v").alias("n_valid"), F.avg("v").alias("mean")), "mean")


_NATIVE_SIZE = (
    "WITH years AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS date, avg(l_quantity) AS q FROM lineitem GROUP BY 1),"
    " node AS (SELECT a.i AS i, b.j AS j, CASE WHEN (a.i * 31 + b.j * 17) % 97 > 0 THEN (a.i * 7 + b.j * 13) % 101 / 10.0 END AS f FROM range(950, 1201) a(i), range(2250, 2851) b(j)),"
    " la AS (SELECT k, 950 + 5 * k // 2 AS i, CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.5 END AS w FROM range(101) t(k) UNION ALL SELECT k, 950 + 5 * k // 2 + 1, 0.5 FROM range(101) t(k) WHERE k % 2 = 1),"
    " lo AS (SELECT k, 2250 + 5 * k // 2 AS j, CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.5 END AS w FROM range(241) t(k) UNION ALL SELECT k, 2250 + 5 * k // 2 + 1, 0.5 FROM range(241) t(k) WHERE k % 2 = 1),"
    " cell AS (SELECT la.k AS a, lo.k AS b, CASE WHEN count(f) = count(*) THEN sum(la.w * lo.w * f) END AS f FROM la JOIN node ON node.i = la.i JOIN lo ON lo.j = node.j GROUP BY 1, 2)"
)


@register("i1_native_size", _NATIVE_SIZE + " SELECT date, count(*) AS n_cells, count(f) AS n_valid, round(avg(f) + any_value(q), 6) AS mean FROM years CROSS JOIN cell GROUP BY date")
def i1_native_size(spark, d):
    """A product of 1801 by 3600 nodes a day, a tenth of a degree apart; nodes that no cell needs are dropped before they are dealt."""
    years = fx.read(spark, d, "lineitem").groupBy(F.trunc("l_shipdate", "year").alias("date")).agg(F.avg("l_quantity").alias("q"))
    i, j = F.col("src_lat_idx"), F.col("src_lon_idx")
    nodes = years.repartition("date").withColumn("src_lat_idx", F.explode(F.sequence(F.lit(0), F.lit(1800)))).where(i.between(*tiled.Axis(_NATIVE_LAT, _TARGET_LAT).used()))
    nodes = nodes.withColumn("src_lon_idx", F.explode(F.sequence(F.lit(0), F.lit(3599)))).withColumn("v", F.when((i * 31 + j * 17) % 97 > 0, (i * 7 + j * 13) % 101 / 10.0) + F.col("q"))
    out = tiled.regrid_tiled(nodes, ["v"], _NATIVE_LAT, _NATIVE_LON, _TARGET_LAT, _TARGET_LON)
    return _r(out.groupBy("date").agg(F.count("*").alias("n_cells"), F.count("v").alias("n_valid"), F.avg("v").alias("mean")), "mean")


#: Coordinates of a tenth of a degree, and those of the contract.
_NATIVE_LAT, _NATIVE_LON = [k / 10 - 90 for k in range(1801)], [k / 10 - 180 for k in range(3600)]
_TARGET_LAT, _TARGET_LON = _coords(5.0, 0.25, 101), _coords(45.0, 0.25, 241)


@register("i2_nearest_regrid", fx.sql("native") + "SELECT n.date, CAST(a.j AS INT) AS lat_idx, CAST(b.j AS INT) AS lon_idx, CAST(round(n.v) AS INT) AS flag FROM native n JOIN range(21) a(j) ON a.j // 2 = n.src_lat_idx JOIN range(49) b(j) ON b.j // 2 = n.src_lon_idx")
def i2_nearest_regrid(spark, d):
    (slat, slon), (dlat, dlon) = fx.native_axes(spark), COARSE.axes(spark)
    rows = fx.native_grid(spark, d).withColumn("flag", F.round("v").cast("int"))
    return regrid.nearest_regrid(rows, "flag", regrid.nearest_index(slat, dlat), regrid.nearest_index(slon, dlon))


@register("i3_vertical", fx.sql("target_native", "depth_w") + ", n AS (SELECT depth_idx, count(*) AS need FROM depth_w GROUP BY 1), s AS (SELECT t.date, t.src_lat_idx, t.src_lon_idx, w.depth_idx, sum(w.w * t.temp) AS v, count(t.temp) AS c FROM target_native t JOIN depth_w w USING (src_depth_idx) GROUP BY 1, 2, 3, 4) SELECT date, src_lat_idx, src_lon_idx, depth_idx, CASE WHEN c = need THEN round(v, 6) END AS temp FROM s JOIN n USING (depth_idx)")
def i3_vertical(spark, d):
    return _r(vertical.interpolate_depths(fx.target_native(spark, d), "temp", vertical.depth_weights(fx.native_depths(spark)), ["date", "src_lat_idx", "src_lon_idx"]), "temp")


_TARGET = fx.sql("target_native", "corners", "depth_w") + (
    ", nd AS (SELECT depth_idx, count(*) AS dn FROM depth_w GROUP BY 1),"
    " s AS (SELECT t.date, w.depth_idx, a.lat_idx, b.lon_idx, sum(w.w * a.w * b.w * t.temp) AS v, count(t.temp) AS c FROM target_native t JOIN depth_w w USING (src_depth_idx) JOIN lat_w a USING (src_lat_idx) JOIN lon_w b USING (src_lon_idx) GROUP BY 1, 2, 3, 4),"
    " tgt AS (SELECT s.date, s.depth_idx, dp.depth_m, s.lat_idx, s.lon_idx, CASE WHEN s.c = nd.dn * q.n THEN s.v END AS temp FROM s JOIN nd USING (depth_idx) JOIN need q ON q.lat_idx = s.lat_idx AND q.lon_idx = s.lon_idx JOIN depths dp ON dp.depth_idx = s.depth_idx)"
)


def _target(spark, d):
    return jobs.harmonize_target(fx.target_native(spark, d), fx.native_depths(spark), *_weights(spark), COARSE)


def _written(df: DataFrame, label: str) -> DataFrame:
    """Written once, as between two jobs, where a query reads a table several times."""
    path = sinks.scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@register("i3_target_regrid", _TARGET + " SELECT date, depth_idx, depth_m, lat_idx, lon_idx, round(temp + 1e-9, 6) AS temp FROM tgt")
def i3_target_regrid(spark, d):
    """The nudge makes ties go up whatever the order of the sums."""
    return _target(spark, d).withColumn("temp", F.round(F.col("temp") + 1e-9, 6))


_PROFILE = fx.sql("profiles", "levels") + (
    ", pts AS (SELECT profile_idx, pres, avg(temp) AS temp FROM levels WHERE temp IS NOT NULL GROUP BY 1, 2),"
    " segs AS (SELECT profile_idx, pres, temp, lead(pres) OVER w AS pres2, lead(temp) OVER w AS temp2 FROM pts WINDOW w AS (PARTITION BY profile_idx ORDER BY pres)),"
    " dep AS (SELECT CAST(i AS INT) AS depth_idx, CAST([0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000][i + 1] AS INT) AS depth_m FROM range(15) t(i)),"
    " vals AS (SELECT g.profile_idx, d.depth_idx, max(g.temp + (g.temp2 - g.temp) * (d.depth_m - g.pres) / (g.pres2 - g.pres)) AS temp FROM segs g JOIN dep d ON d.depth_m >= g.pres AND d.depth_m <= g.pres2 WHERE g.pres2 IS NOT NULL GROUP BY 1, 2),"
    " at_depth AS (SELECT p.profile_idx, d.depth_idx, d.depth_m, v.temp FROM profiles p CROSS JOIN dep d LEFT JOIN vals v ON v.profile_idx = p.profile_idx AND v.depth_idx = d.depth_idx)"
)


@register("i4_profile_depths", _PROFILE + " SELECT profile_idx, depth_idx, depth_m, round(temp, 5) AS temp FROM at_depth")
def i4_profile_depths(spark, d):
    return _r(vertical.profile_at_depths(fx.levels(spark, d), fx.profiles(spark, d)), "temp", digits=5)


_GAPS = fx.sql("native") + (
    ", cells AS (SELECT DISTINCT src_lat_idx, src_lon_idx FROM native), days AS (SELECT DISTINCT date FROM native),"
    " f AS (SELECT c.src_lat_idx, c.src_lon_idx, d.date, n.v FROM cells c CROSS JOIN days d LEFT JOIN native n USING (src_lat_idx, src_lon_idx, date)),"
    " g AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN date END) OVER p AS d1, min(CASE WHEN v IS NOT NULL THEN date END) OVER q AS d2 FROM f"
    " WINDOW p AS (PARTITION BY src_lat_idx, src_lon_idx ORDER BY date ROWS UNBOUNDED PRECEDING), q AS (PARTITION BY src_lat_idx, src_lon_idx ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),"
    " h AS (SELECT g.*, a.v AS v1, b.v AS v2 FROM g LEFT JOIN f a ON a.src_lat_idx = g.src_lat_idx AND a.src_lon_idx = g.src_lon_idx AND a.date = g.d1 LEFT JOIN f b ON b.src_lat_idx = g.src_lat_idx AND b.src_lon_idx = g.src_lon_idx AND b.date = g.d2)"
)


def _gappy(spark, d):
    n = fx.native_grid(spark, d)
    days = n.select("date").distinct()
    spine = n.select("src_lat_idx", "src_lon_idx").distinct().join(F.broadcast(days.agg(F.collect_list("date").alias("ds"))), how="cross").select("src_lat_idx", "src_lon_idx", F.explode("ds").alias("date"))
    return spine.join(n, ["src_lat_idx", "src_lon_idx", "date"], "left")


@register("i5_fill_linear", _GAPS + " SELECT src_lat_idx, src_lon_idx, date, round(CASE WHEN v IS NOT NULL THEN v WHEN d1 IS NOT NULL AND d2 IS NOT NULL THEN v1 + (v2 - v1) * CAST(date - d1 AS DOUBLE) / (d2 - d1) END, 6) AS v FROM h")
def i5_fill_linear(spark, d):
    return _r(align.fill_gaps(_gappy(spark, d), ["src_lat_idx", "src_lon_idx"], "v"), "v")


@register("i5_fill_by_month", _SQL["i5_fill_linear"])
def i5_fill_by_month(spark, d):
    return _r(align.fill_gaps_by_month(_gappy(spark, d), ["src_lat_idx", "src_lon_idx"], "v"), "v")


@register("i5_fill_forward", _GAPS + " SELECT src_lat_idx, src_lon_idx, date, round(CASE WHEN v IS NOT NULL THEN v WHEN date - d1 <= 62 THEN v1 END, 6) AS v FROM h")
def i5_fill_forward(spark, d):
    return _r(align.fill_gaps(_gappy(spark, d), ["src_lat_idx", "src_lon_idx"], "v", method="forward", max_days=62), "v")


@register("i6_nearest_depth", fx.sql("target_native") + "SELECT date, src_lat_idx, src_lon_idx, depth, round(temp, 6) AS temp FROM (SELECT *, row_number() OVER (PARTITION BY date, src_lat_idx, src_lon_idx ORDER BY abs(depth - 100.0), depth) AS i FROM target_native) WHERE i = 1")
def i6_nearest_depth(spark, d):
    return _r(vertical.nearest_depth(fx.target_native(spark, d), 100.0, ["date", "src_lat_idx", "src_lon_idx"], "temp"), "temp")


@register("i7_given_weights", _REGRID + " SELECT r.date, r.lat_idx, r.lon_idx, CASE WHEN r.c = q.n THEN round(r.v, 6) END AS v FROM r JOIN need q USING (lat_idx, lon_idx)")
def i7_given_weights(spark, d):
    lat_w, lon_w = _weights(spark)
    # Both axes have a fixed number of weights.
    product = lat_w.select(F.col("src_idx").alias("src_lat_idx"), F.col("dst_idx").alias("lat_idx"), F.col("w").alias("w1")).join(F.broadcast(lon_w.select(F.col("src_idx").alias("src_lon_idx"), F.col("dst_idx").alias("lon_idx"), F.col("w").alias("w2"))), how="cross")
    return _r(regrid.regrid_with_weights(fx.native_grid(spark, d), ["v"], product.select("src_lat_idx", "src_lon_idx", "lat_idx", "lon_idx", (F.col("w1") * F.col("w2")).alias("w"))), "v")


# -- joins


@register("j1_merge", fx.sql("surface") + "SELECT date, lat_idx, lon_idx, round(sst, 6) AS sst, round(sss, 6) AS sss, round(u_wind, 6) AS u_wind FROM surface WHERE sst < 32 AND u_wind > -14")
def j1_merge(spark, d):
    """Sides that lack rows as products do: one has no warm cells, the other none of a low wind."""
    s = fx.surface(spark, d)
    a = s.where("sst < 32").select("date", "lat_idx", "lon_idx", "sst")
    b = s.where("u_wind > -14").select("date", "lat_idx", "lon_idx", (F.col("sst") + 1).alias("sst"), "sss")
    return _r(merge.merge_sources([a, b, s.select("date", "lat_idx", "lon_idx", "sss", "u_wind")]), "sst", "sss", "u_wind")


@register("j1_stored_merge", _SQL["j1_merge"])
def j1_stored_merge(spark, d):
    """Sources that are stored by day and cell: the merge moves none of them."""
    s = fx.surface(spark, d)
    a = s.where("sst < 32").select("date", "lat_idx", "lon_idx", "sst")
    b = s.where("u_wind > -14").select("date", "lat_idx", "lon_idx", (F.col("sst") + 1).alias("sst"), "sss")
    stored = [spark.table(bucketed.write_bucketed(x, buckets=8)) for x in (a, b, s.select("date", "lat_idx", "lon_idx", "sss", "u_wind"))]
    return _r(merge.merge_sources(stored), "sst", "sss", "u_wind")


@register("j2_common_dates", "WITH a AS (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem), b AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders) SELECT date, count(*) AS n FROM a WHERE date IN (SELECT date FROM b) GROUP BY 1")
def j2_common_dates(spark, d):
    a = fx.read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    b = fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"))
    return align.common_dates(a, b)[0].groupBy("date").agg(F.count("*").alias("n"))


_DATES = "axis AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS day FROM lineitem)"


@register("j3_nearest_date", fx.sql("profiles") + ", " + _DATES + ", t AS (SELECT DISTINCT juld FROM profiles) SELECT juld, day AS grid_date FROM (SELECT t.juld, a.day, row_number() OVER (PARTITION BY t.juld ORDER BY abs(epoch_us(t.juld) - epoch_us(CAST(a.day AS TIMESTAMP))), a.day DESC) AS i FROM t CROSS JOIN axis a) WHERE i = 1")
def j3_nearest_date(spark, d):
    return collocate.nearest_dates(fx.profiles(spark, d), fx.native_grid(spark, d))


_HOURS = "axis AS (SELECT DISTINCT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) AS hour FROM lineitem), t AS (SELECT DISTINCT juld + to_minutes(CAST(profile_idx % 60 AS INT)) AS juld FROM profiles)"


@register(
    "j3_long_axis",
    fx.sql("profiles") + ", " + _HOURS + ", b AS (SELECT t.juld, a.hour FROM t ASOF LEFT JOIN axis a ON t.juld >= a.hour), f AS (SELECT t.juld, a.hour FROM t ASOF LEFT JOIN axis a ON t.juld <= a.hour)"
    " SELECT b.juld, CASE WHEN f.hour IS NOT NULL AND (b.hour IS NULL OR f.hour - b.juld <= b.juld - b.hour) THEN f.hour ELSE b.hour END AS hour FROM b JOIN f ON f.juld = b.juld",
)
def j3_long_axis(spark, d):
    """An axis by the hour over seven years, times by the minute."""
    hours = F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"), F.lit(0), F.lit(0))
    axis = fx.read(spark, d, "lineitem").select((F.col("l_shipdate").cast("timestamp") + hours).alias("hour"))
    times = fx.profiles(spark, d).select((F.col("juld") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("profile_idx") % 60).cast("int"), F.lit(0))).alias("juld"))
    return asof.nearest_times(times, axis, at="hour")


@register("j3_long_axis_dates", None)
def j3_long_axis_dates(spark, d):
    """The dates of ``j3_nearest_date``, by the merge."""
    return asof.nearest_times(fx.profiles(spark, d), fx.native_grid(spark, d).select(F.col("date").alias("grid_date")), at="grid_date")


_SQL["j3_long_axis_dates"] = _SQL["j3_nearest_date"]


@register("j4_nearest_cell", fx.sql("profiles") + "SELECT profile_idx, CAST(least(greatest(ceil((lat - 5) / 0.25 - 0.5), 0), 100) AS INT) AS lat_idx, CAST(least(greatest(ceil((lon - 45) / 0.25 - 0.5), 0), 240) AS INT) AS lon_idx FROM profiles")
def j4_nearest_cell(spark, d):
    lat, lon = TARGET.nearest(F.col("lat"), F.col("lon"))
    return fx.profiles(spark, d).select("profile_idx", lat.alias("lat_idx"), lon.alias("lon_idx"))


_COLLOCATED = _PROFILE.replace("profiles AS (", "profiles0 AS (", 1).replace(" FROM orders)", " FROM orders), profiles AS (SELECT * FROM profiles0 WHERE lat BETWEEN 5 AND 30 AND lon BETWEEN 45 AND 105)", 1) + (
    ", " + _TARGET.removeprefix("WITH ").replace("depths AS (", "depths AS (", 1)
    + ", axis AS (SELECT DISTINCT date AS day FROM tgt),"
    " cell AS (SELECT *, CAST(least(greatest(ceil((lat - 5) / 1.25 - 0.5), 0), 20) AS INT) AS lat_idx, CAST(least(greatest(ceil((lon - 45) / 1.25 - 0.5), 0), 48) AS INT) AS lon_idx FROM profiles),"
    " times AS (SELECT DISTINCT juld FROM profiles), nearest AS (SELECT juld, day FROM (SELECT t.juld, a.day, row_number() OVER (PARTITION BY t.juld ORDER BY abs(epoch_us(t.juld) - epoch_us(CAST(a.day AS TIMESTAMP))), a.day DESC) AS i FROM times t CROSS JOIN axis a) WHERE i = 1),"
    " col AS (SELECT strftime(c.juld, '%Y-%m-%d') AS date, trim(c.float_id) AS float_id, round(c.lat, 3) AS argo_lat, round(c.lon, 3) AS argo_lon, round(CAST(5 + 1.25 * c.lat_idx AS DOUBLE), 3) AS grid_lat, round(CAST(45 + 1.25 * c.lon_idx AS DOUBLE), 3) AS grid_lon, x.depth_m, round(x.temp + 1e-9, 4) AS argo_temp, round(g.temp + 1e-9, 4) AS glorys_temp, CAST(NULL AS DOUBLE) AS model_prediction"
    " FROM at_depth x JOIN cell c ON c.profile_idx = x.profile_idx JOIN nearest n ON n.juld = c.juld LEFT JOIN tgt g ON g.date = n.day AND g.lat_idx = c.lat_idx AND g.lon_idx = c.lon_idx AND g.depth_idx = x.depth_idx)"
)


def _nudged(df: DataFrame) -> DataFrame:
    """Data that has no ties at the fourth digit, in either engine and whatever the order of the sums; the SQL nudges alike."""
    return df.withColumn("temp", F.col("temp") + 1e-9)


def _collocated(spark, d):
    target = jobs.harmonize_target_tiled(fx.target_native(spark, d), fx.native_depths(spark), _coords(5.0, 2.5, 11), _coords(45.0, 2.5, 25), COARSE)
    return collocate.collocate(fx.profiles(spark, d), _nudged(fx.levels(spark, d)), _nudged(_written(target, "target")), COARSE)


@register("j5_collocate", _COLLOCATED + " SELECT date, float_id, argo_lat, argo_lon, grid_lat, grid_lon, depth_m, argo_temp, glorys_temp, model_prediction FROM col")
def j5_collocate(spark, d):
    return _collocated(spark, d)


@register("j5_stored_collocate", _SQL["j5_collocate"])
def j5_stored_collocate(spark, d):
    """The target stored by day and cell, which the join then leaves in place; the axis is merged, not sent."""
    name = bucketed.write_bucketed(_target(spark, d), buckets=8)
    return collocate.collocate(fx.profiles(spark, d), _nudged(fx.levels(spark, d)), _nudged(spark.table(name)), COARSE, mode="long", stored=True)


@register("s8_collocation_csv_grid", _COLLOCATED + " SELECT CAST(depth_m AS VARCHAR) AS depth_m, count(*) AS n_rows, count(argo_temp) AS n_temps, count(glorys_temp) AS n_grid, round(sum(glorys_temp), 4) AS sum_grid, count(model_prediction) AS n_pred FROM col GROUP BY 1")
def s8_collocation_csv_grid(spark, d):
    """With the grid's side; values are parsed from the text, which is whole and lies compressed: as plain text it would be over six times the input."""
    path = sinks.scratch_path(spark, "collocation-csv")
    sinks.write_csv(_collocated(spark, d), path, "gzip")
    return spark.read.option("header", True).csv(path).groupBy("depth_m").agg(F.count("*").alias("n_rows"), F.count("argo_temp").alias("n_temps"), F.count("glorys_temp").alias("n_grid"), F.round(F.sum(F.col("glorys_temp").cast("double")), 4).alias("sum_grid"), F.count("model_prediction").alias("n_pred"))


@register("j6_mask_join", fx.sql("surface", "mask") + "SELECT date, count(*) AS n, round(avg(sst), 6) AS sst FROM surface JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean GROUP BY date")
def j6_mask_join(spark, d):
    return _r(mask.with_mask(fx.surface(spark, d), fx.mask(spark)).where("is_ocean").groupBy("date").agg(F.count("*").alias("n"), F.avg("sst").alias("sst")), "sst")


@register("j9_source_preference", "WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) AS sst FROM orders GROUP BY 1), b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_quantity) AS sst FROM lineitem GROUP BY 1), n AS (SELECT count(DISTINCT date) AS n FROM a), k AS (SELECT count(DISTINCT date) AS k FROM b) SELECT date, round(sst, 4) AS sst FROM a WHERE (SELECT n FROM n) >= (SELECT k FROM k) UNION ALL SELECT date, round(sst, 4) FROM b WHERE (SELECT n FROM n) < (SELECT k FROM k)")
def j9_source_preference(spark, d):
    a = fx.read(spark, d, "orders").groupBy(F.trunc("o_orderdate", "month").alias("date")).agg(F.avg("o_totalprice").alias("sst"))
    b = fx.read(spark, d, "lineitem").groupBy(F.trunc("l_shipdate", "month").alias("date")).agg(F.avg("l_quantity").alias("sst"))
    days = b.select("date").distinct().count()
    return _r(merge.prefer_source(a, b, days), "sst", digits=4)


@register("j10_fixed_split", "SELECT CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1998-12-31' THEN 'train' WHEN CAST(l_shipdate AS DATE) <= DATE '1999-12-31' THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM lineitem GROUP BY 1")
def j10_fixed_split(spark, d):
    return fx.read(spark, d, "lineitem").groupBy(split.split_by_dates(F.to_date("l_shipdate"), "1998-12-31", "1999-12-31").alias("split")).agg(F.count("*").alias("n"))


# -- aggregations

_SPLIT = fx.sql("surface", "mask") + (
    ", days AS (SELECT date, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM surface)),"
    " sizes AS (SELECT *, greatest(1, CAST(round_even(n * 0.7, 0) AS INT)) AS a, CASE WHEN n >= 5 THEN greatest(1, CAST(round_even(n * 0.15, 0) AS INT)) ELSE 1 END AS b FROM days),"
    " sp AS (SELECT date, CASE WHEN n < 3 OR i <= CASE WHEN n - a - b <= 0 AND a > 1 THEN a - 1 ELSE a END THEN 'train' WHEN i <= CASE WHEN n - a - b <= 0 AND a > 1 THEN a - 1 ELSE a END + b THEN 'val' ELSE 'test' END AS split FROM sizes),"
    " rows AS (SELECT s.*, m.is_ocean, sp.split FROM surface s JOIN mask m USING (lat_idx, lon_idx) JOIN sp ON sp.date = s.date)"
)


def _rows(spark, d):
    s = fx.surface(spark, d)
    return split.with_split(mask.with_mask(s, fx.mask(spark)), split.split_dates(s))


@register("a1_daily_mean", fx.sql("subdaily") + "SELECT CAST(time AS DATE) AS date, src_lat_idx, src_lon_idx, round(avg(u10), 6) AS u10, round(avg(v10), 6) AS v10 FROM subdaily WHERE hour(time) IN (0, 6, 12, 18) GROUP BY 1, 2, 3")
def a1_daily_mean(spark, d):
    return _r(align.daily_mean(fx.subdaily(spark, d), ["src_lat_idx", "src_lon_idx"], ["u10", "v10"]), "u10", "v10")


@register("a1_daily_mean_dense", fx.sql("subdaily") + ", m AS (SELECT CAST(time AS DATE) AS date, src_lat_idx, src_lon_idx, avg(u10) AS u10 FROM subdaily GROUP BY 1, 2, 3), c AS (SELECT DISTINCT src_lat_idx, src_lon_idx FROM m), e AS (SELECT min(date) AS a, max(date) AS b FROM m), ds AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM e) SELECT ds.date, c.src_lat_idx, c.src_lon_idx, round(m.u10, 6) AS u10 FROM ds CROSS JOIN c LEFT JOIN m ON m.date = ds.date AND m.src_lat_idx = c.src_lat_idx AND m.src_lon_idx = c.src_lon_idx")
def a1_daily_mean_dense(spark, d):
    return _r(align.daily_mean(fx.subdaily(spark, d), ["src_lat_idx", "src_lon_idx"], ["u10"], hours=None, dense=True), "u10")


@register("a2_train_stats", _SPLIT + " SELECT round(avg(sst), 6) AS sst_mean, round(stddev_pop(sst), 6) AS sst_std, round(avg(sss), 6) AS sss_mean, round(stddev_pop(sss), 6) AS sss_std, round(avg(v_wind), 6) AS v_wind_mean, round(stddev_pop(v_wind), 6) AS v_wind_std FROM rows WHERE split = 'train' AND is_ocean")
def a2_train_stats(spark, d):
    out = normalize.train_stats(_rows(spark, d), ["sst", "sss", "v_wind"])
    return _r(out, *out.columns)


@register("a2_moments", _SQL["a2_train_stats"])
def a2_moments(spark, d):
    """Moments of the days up to 1998 are stored, those of later years added; the train days' ones are merged."""
    rows = _rows(spark, d)
    ocean, channels = rows.where("is_ocean"), ["sst", "sss", "v_wind"]
    table = snapshots.MonthTable(spark, sinks.scratch_path(spark, "moments"))
    moments.add_months(table, ocean.where("year(date) < 1998"), channels)
    moments.add_months(table, ocean.where("year(date) >= 1998"), channels)
    train = split.split_dates(fx.surface(spark, d)).where("split = 'train'")
    out = moments.stats_of(moments.merged(table.read().join(F.broadcast(train), "date", "left_semi")), channels)
    return _r(out, *out.columns)


@register("p11_normalize", _SPLIT + ", st AS (SELECT avg(sst) AS m, stddev_pop(sst) AS s, avg(u_wind) AS m2, stddev_pop(u_wind) AS s2 FROM rows WHERE split = 'train' AND is_ocean) SELECT date, lat_idx, lon_idx, split, CASE WHEN is_ocean THEN round(coalesce((sst - m) / s, 0), 6) ELSE 0 END AS sst, CASE WHEN is_ocean THEN round(coalesce((u_wind - m2) / s2, 0), 6) ELSE 0 END AS u_wind FROM rows CROSS JOIN st")
def p11_normalize(spark, d):
    rows = _rows(spark, d)
    return _r(normalize.normalize(rows, normalize.train_stats(rows, ["sst", "u_wind"]), ["sst", "u_wind"]).select("date", "lat_idx", "lon_idx", "split", "sst", "u_wind"), "sst", "u_wind")


@register("p13_denormalize", _SPLIT + " SELECT date, lat_idx, lon_idx, round(sst, 6) AS sst FROM rows WHERE is_ocean")
def p13_denormalize(spark, d):
    rows = _written(_rows(spark, d), "rows")
    stats = normalize.train_stats(rows, ["sst"])
    back = normalize.denormalize(normalize.normalize(rows, stats, ["sst"]), stats, ["sst"])
    return _r(back.where("is_ocean").select("date", "lat_idx", "lon_idx", "sst"), "sst")


@register("a3_channel_summary", fx.sql("surface") + " ".join(f"{'UNION ALL' if i else ''} SELECT '{c}' AS channel, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, count(*) - count({c}) AS missing FROM surface" for i, c in enumerate(CHANNELS)))
def a3_channel_summary(spark, d):
    return _r(normalize.channel_summary(fx.surface(spark, d)), "min", "max", "mean", "std")


@register("a4_depth_summary", fx.sql("target_sparse", "mask") + ", n AS (SELECT count(DISTINCT date) AS days FROM target_sparse) SELECT depth_idx, depth_m, round(avg(temp), 6) AS mean, round(min(temp), 6) AS min, round(max(temp), 6) AS max, count(temp) // any_value(days) AS points_a_day FROM target_sparse JOIN mask USING (lat_idx, lon_idx) CROSS JOIN n WHERE is_ocean GROUP BY 1, 2")
def a4_depth_summary(spark, d):
    return _r(qa.depth_summary(fx.target_sparse(spark, d), fx.mask(spark)), "mean", "min", "max")


@register("a3_moments", _SQL["a3_channel_summary"])
def a3_moments(spark, d):
    out = moments.summary(moments.merged(moments.day_moments(fx.surface(spark, d), CHANNELS))).drop("n")
    return _r(out, "min", "max", "mean", "std")


@register("a4_moments", _SQL["a4_depth_summary"])
def a4_moments(spark, d):
    """Depths' figures from the moments of days."""
    t, by = mask.with_mask(fx.target_sparse(spark, d), fx.mask(spark)), ["depth_idx", "depth_m"]
    days = _written(moments.day_moments(t.withColumn("temp", F.when(F.col("is_ocean"), F.col("temp"))), ["temp"], by), "moments")
    n = days.agg(F.countDistinct("date").alias("days"))
    out = moments.summary(moments.merged(days.where("n > 0"), by), by).join(F.broadcast(n), how="cross")
    return _r(out.select(*by, "mean", "min", "max", F.floor(F.col("n") / F.col("days")).alias("points_a_day")), "mean", "min", "max")


@register("a5_ocean_mask", _TARGET + " SELECT lat_idx, lon_idx, temp IS NOT NULL AS is_ocean FROM tgt WHERE depth_idx = 0 AND date = (SELECT min(date) FROM tgt)")
def a5_ocean_mask(spark, d):
    return mask.ocean_mask(_written(_target(spark, d), "target"))


@register("a5_coverage", _TARGET + " SELECT count(*) AS n_cells, count(temp) AS n_ocean, round(count(temp) / count(*), 6) AS share FROM tgt WHERE depth_idx = 0 AND date = (SELECT min(date) FROM tgt)")
def a5_coverage(spark, d):
    return _r(mask.coverage(mask.ocean_mask(_written(_target(spark, d), "target"))), "share")


@register("a6_missing_share", fx.sql("subdaily") + "SELECT round(1 - count(u10) / count(*), 6) AS missing_share, round(min(u10), 6) AS min, round(max(u10), 6) AS max FROM subdaily")
def a6_missing_share(spark, d):
    return _r(normalize.missing_share(fx.subdaily(spark, d), "u10"), "missing_share", "min", "max")


@register("a7_flag_values", "SELECT l_linenumber AS mask, count(*) AS n FROM lineitem GROUP BY 1")
def a7_flag_values(spark, d):
    return mask.flag_values(fx.read(spark, d, "lineitem").withColumnRenamed("l_linenumber", "mask"))


@register("a8_completeness", fx.sql("native") + "SELECT date, count(*) AS n_cells, count(*) = 275 AS complete FROM native GROUP BY 1")
def a8_completeness(spark, d):
    return regrid.completeness(fx.native_grid(spark, d), 275, index=("src_lat_idx", "src_lon_idx"))


def _native_maps(spark, d) -> DataFrame:
    return coverage.bitmaps(fx.native_grid(spark, d), F.col("src_lat_idx") * 25 + F.col("src_lon_idx"), ["date"], F.col("v").isNotNull())


@register("a8_bitmaps", _SQL["a8_completeness"])
def a8_bitmaps(spark, d):
    return coverage.completeness(_native_maps(spark, d), 275, ["date"])


@register("a8_lacking_cells", fx.sql("native") + "SELECT d.date, CAST(c.i AS BIGINT) AS cell FROM (SELECT DISTINCT date FROM native) d CROSS JOIN range(275) c(i) WHERE NOT EXISTS (SELECT 1 FROM native n WHERE n.date = d.date AND n.src_lat_idx * 25 + n.src_lon_idx = c.i)")
def a8_lacking_cells(spark, d):
    return coverage.lacking(_native_maps(spark, d), 275, ["date"])


@register("a5_year_coverage", fx.sql("surface") + "SELECT year(date) AS year, count(DISTINCT lat_idx * 241 + lon_idx) AS n_cells, count(DISTINCT lat_idx * 241 + lon_idx) = 24341 AS complete FROM surface GROUP BY 1")
def a5_year_coverage(spark, d):
    """Cells that a year has on any day: bitmaps of days, combined."""
    days = coverage.bitmaps(fx.surface(spark, d), F.col("lat_idx") * 241 + F.col("lon_idx"), ["date"])
    return coverage.completeness(coverage.combined(days.withColumn("year", F.year("date")), ["year"]), 24341, ["year"])


@register("a9_split_summary", _SPLIT + " SELECT split, count(DISTINCT date) AS num_timesteps, min(date) AS first_date, max(date) AS last_date, [CAST(count(DISTINCT date) AS INT), 7, 101, 241] AS input_shape, [CAST(count(DISTINCT date) AS INT), 15, 101, 241] AS target_shape FROM rows GROUP BY 1")
def a9_split_summary(spark, d):
    return split.split_summary(_rows(spark, d))


@register("a10_skill", _COLLOCATED + ", k AS (SELECT depth_m, argo_temp AS t, glorys_temp AS p FROM col WHERE argo_temp IS NOT NULL AND glorys_temp IS NOT NULL) SELECT depth_m, count(*) AS n, round(sqrt(avg((p - t) * (p - t))), 3) AS rmse, round(avg(p - t), 3) AS bias, round(1 - sum((p - t) * (p - t)) / nullif(var_pop(t) * count(*), 0), 2) AS r2, round(CASE WHEN stddev_pop(t) > 0 AND stddev_pop(p) > 0 THEN corr(t, p) END, 3) AS corr FROM k GROUP BY ROLLUP (depth_m)")
def a10_skill(spark, d):
    return _r(_r(metrics.skill(_collocated(spark, d), "argo_temp", "glorys_temp"), "rmse", "bias", "corr", digits=3), "r2", digits=2)


@register("a11_masked_mse", fx.sql("target_sparse", "mask") + ", w AS (SELECT *, 1.0 / (1 + depth_idx) AS weight, 28.0 - 3.0 * depth_idx AS pred FROM target_sparse JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean) SELECT 'plain' AS kind, round(avg((pred - temp) * (pred - temp)), 6) AS mse, count(*) AS n FROM w UNION ALL SELECT 'weighted', round(sum(weight * (pred - temp) * (pred - temp)) / sum(weight), 6), count(*) FROM w")
def a11_masked_mse(spark, d):
    rows = mask.with_mask(fx.target_sparse(spark, d), fx.mask(spark)).withColumn("pred", 28.0 - 3.0 * F.col("depth_idx"))
    w = depth_axis(spark).select("depth_idx", (1.0 / (1 + F.col("depth_idx"))).alias("weight"))
    plain = metrics.masked_mse(rows, "temp", "pred").select(F.lit("plain").alias("kind"), "mse", "n")
    return _r(plain.unionByName(metrics.masked_mse(rows, "temp", "pred", w).select(F.lit("weighted").alias("kind"), "mse", "n")), "mse")


@register("a12_totals", _COLLOCATED + " SELECT count(*) AS n_rows, count(argo_temp) AS n_argo, count(glorys_temp) AS n_grid FROM col")
def a12_totals(spark, d):
    return collocate.totals(_collocated(spark, d))


# -- quality checks


@register("q1_date_sync", "WITH a AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem), b AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), f AS (SELECT coalesce(a.date, b.date) AS date, a.date AS x, b.date AS y FROM a FULL JOIN b ON a.date = b.date) SELECT count(*) AS n_dates, count(*) - count(y) AS only_a, count(*) - count(x) AS only_b, count(*) > 0 AND count(*) = count(x) AND count(*) = count(y) AS passed FROM f")
def q1_date_sync(spark, d):
    return qa.date_sync(fx.read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date")), fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")))


_BOX = "5 + 0.25 * lat_idx BETWEEN 10 AND 22 AND 45 + 0.25 * lon_idx BETWEEN"


@register("q2_salinity", fx.sql("surface", "mask") + f", c AS (SELECT avg(CASE WHEN {_BOX} 55 AND 72 THEN sss END) AS west, avg(CASE WHEN {_BOX} 82 AND 95 THEN sss END) AS east FROM surface JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean) SELECT round(west, 6) AS west, round(east, 6) AS east, round(west - east, 6) AS contrast, coalesce(west - east >= 1.5 AND west >= 34.5 AND east <= 34.0, false) AS passed FROM c")
def q2_salinity(spark, d):
    return _r(qa.salinity_contrast(fx.surface(spark, d), fx.mask(spark)), "west", "east", "contrast")


@register("q3_wind", fx.sql("surface", "mask") + ", c AS (SELECT avg(u_wind) AS u, avg(v_wind) AS v, avg(sqrt(u_wind * u_wind + v_wind * v_wind)) AS s, max(sqrt(u_wind * u_wind + v_wind * v_wind)) AS x FROM surface JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean) SELECT round(u, 6) AS mean_u, round(v, 6) AS mean_v, round(s, 6) AS mean_speed, round(x, 6) AS max_speed, u < 0 AND v < 0 AND s BETWEEN 1 AND 15 AS passed FROM c")
def q3_wind(spark, d):
    return _r(qa.wind_vector(fx.surface(spark, d), fx.mask(spark)), "mean_u", "mean_v", "mean_speed", "max_speed")


@register("q4_currents", fx.sql("surface", "mask") + ", c AS (SELECT avg(sqrt(u_curr * u_curr + v_curr * v_curr)) AS s, max(sqrt(u_curr * u_curr + v_curr * v_curr)) AS x FROM surface JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean) SELECT round(s, 6) AS mean_speed, round(x, 6) AS max_speed, s < 0.5 AND x < 2.5 AS passed FROM c")
def q4_currents(spark, d):
    return _r(qa.current_bounds(fx.surface(spark, d), fx.mask(spark)), "mean_speed", "max_speed")


@register("q5_stratification", fx.sql("target_sparse", "mask") + ", c AS (SELECT avg(CASE WHEN depth_m = 0 THEN temp END) AS a, avg(CASE WHEN depth_m = 100 THEN temp END) AS b, avg(CASE WHEN depth_m = 1000 THEN temp END) AS e FROM target_sparse JOIN mask USING (lat_idx, lon_idx) WHERE is_ocean) SELECT round(a, 6) AS top, round(b, 6) AS middle, round(e, 6) AS deep, coalesce(a > b AND b > e AND e BETWEEN 4 AND 12, false) AS passed FROM c")
def q5_stratification(spark, d):
    return _r(qa.stratification(fx.target_sparse(spark, d), fx.mask(spark)), "top", "middle", "deep")


@register("q6_inversions", fx.sql("target_sparse", "mask") + ", p AS (SELECT t.temp AS hi, u.temp AS lo, t.depth_m AS z, u.depth_m AS z2 FROM target_sparse t JOIN target_sparse u ON u.date = t.date AND u.lat_idx = t.lat_idx AND u.lon_idx = t.lon_idx AND u.depth_idx = t.depth_idx + 1 JOIN mask m ON m.lat_idx = t.lat_idx AND m.lon_idx = t.lon_idx WHERE m.is_ocean), c AS (SELECT count(*) AS pairs, count(CASE WHEN lo - hi > 0.1 THEN 1 END) AS inversions, count(CASE WHEN lo - hi > 0.1 AND z2 <= 50 THEN 1 END) AS barrier_layers, count(CASE WHEN lo - hi > CASE WHEN z2 <= 50 THEN 5.0 WHEN z >= 500 THEN 1.0 ELSE 4.0 END THEN 1 END) AS anomalies FROM p) SELECT pairs, inversions, barrier_layers, anomalies, round(inversions * 100.0 / greatest(pairs, 1), 6) AS inversion_pct, anomalies = 0 AS passed FROM c")
def q6_inversions(spark, d):
    return _r(qa.inversions(fx.target_sparse(spark, d), fx.mask(spark)), "inversion_pct")


def _zs(table: str) -> str:
    """SQL: ``z`` has the scaled channels of ``table``."""
    stats = ", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) >= 1e-8 THEN stddev_pop({c}) ELSE 1 END AS {c}_s" for c in CHANNELS)
    scaled = ", ".join(f"CASE WHEN is_ocean THEN coalesce(({c} - {c}_m) / {c}_s, 0) ELSE 0 END AS {c}" for c in CHANNELS)
    return f", st AS (SELECT {stats} FROM {table} WHERE split = 'train' AND is_ocean), z AS (SELECT date, split, lat_idx, lon_idx, is_ocean, {scaled} FROM {table} CROSS JOIN st)"


_BROKEN, _STRAY = (f" {op} ".join(f"({c} {test})" for c in CHANNELS) for op, test in (("OR", "IS NULL"), ("OR", "<> 0")))


@register(
    "q7_integrity",
    _SPLIT.replace("WITH ", "WITH " + fx.SQL["target_sparse"] + ", ", 1)
    + _zs("rows")
    + ", f AS (SELECT coalesce(temp, 0) AS temp, is_ocean FROM target_sparse JOIN mask USING (lat_idx, lon_idx))"
    + f", a AS (SELECT count(*) AS n_inputs, count(CASE WHEN {_BROKEN} OR isnan(sst) THEN 1 END) AS inputs_broken, count(CASE WHEN NOT is_ocean AND ({_STRAY}) THEN 1 END) AS inputs_land_not_zero FROM z)"
    + ", b AS (SELECT count(*) AS n_targets, count(CASE WHEN temp IS NULL OR isnan(temp) THEN 1 END) AS targets_broken, count(CASE WHEN NOT is_ocean AND temp <> 0 THEN 1 END) AS targets_land_not_zero FROM f)"
    " SELECT *, inputs_broken = 0 AND inputs_land_not_zero = 0 AND targets_broken = 0 AND targets_land_not_zero = 0 AS passed FROM a CROSS JOIN b",
)
def q7_integrity(spark, d):
    """The targets here don't fit the mask, so their land is found not to be 0."""
    rows = _written(_rows(spark, d), "rows")
    targets = mask.with_mask(fx.target_sparse(spark, d), fx.mask(spark)).withColumn("temp", normalize.fill_target(F.col("temp")))
    return qa.integrity(normalize.normalize(rows, normalize.train_stats(rows)), CHANNELS, targets)


@register("q9_continuity", "WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), g AS (SELECT date, date - lag(date) OVER (ORDER BY date) AS gap FROM a), c AS (SELECT count(*) AS n, count(CASE WHEN gap > 1 THEN 1 END) AS b, count(CASE WHEN date = DATE '1996-02-29' THEN 1 END) > 0 AS w, max(date) - min(date) + 1 AS k FROM g) SELECT n AS n_dates, b AS breaks, w AS has_wanted, CAST(k AS INT) AS calendar_days, n > 0 AND b = 0 AND w AS passed FROM c")
def q9_continuity(spark, d):
    return qa.continuity(fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")), ["1996-02-29"])


@register("q9_missing_days", "WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT'), e AS (SELECT min(date) AS x, max(date) AS y FROM a) SELECT date FROM (SELECT CAST(unnest(generate_series(x, y, INTERVAL 1 DAY)) AS DATE) AS date FROM e) WHERE date NOT IN (SELECT date FROM a)")
def q9_missing_days(spark, d):
    return qa.missing_days(fx.read(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("date")))


@register("q9_calendar", "WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), w AS (SELECT CAST(DATE '1996-01-01' + CAST(i AS INT) AS DATE) AS date FROM range(365) t(i)) SELECT (SELECT count(*) FROM a) AS n_dates, (SELECT count(*) FROM w WHERE date NOT IN (SELECT date FROM a)) AS missing, (SELECT count(*) FROM a WHERE date NOT IN (SELECT date FROM w)) AS unexpected, (SELECT count(*) FROM w WHERE date NOT IN (SELECT date FROM a)) = 0 AND (SELECT count(*) FROM a WHERE date NOT IN (SELECT date FROM w)) = 0 AS passed")
def q9_calendar(spark, d):
    return qa.calendar(fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")), "1996-01-01", 365)


@register("q11_land_box", _TARGET + ", m AS (SELECT lat_idx, lon_idx, temp IS NOT NULL AS is_ocean FROM tgt WHERE depth_idx = 0 AND date = (SELECT min(date) FROM tgt)) SELECT count(CASE WHEN is_ocean AND 5 + 1.25 * lat_idx BETWEEN 20 AND 26 AND 45 + 1.25 * lon_idx BETWEEN 75 AND 82 THEN 1 END) AS ocean_cells, count(CASE WHEN is_ocean AND 5 + 1.25 * lat_idx BETWEEN 20 AND 26 AND 45 + 1.25 * lon_idx BETWEEN 75 AND 82 THEN 1 END) = 0 AS passed FROM m")
def q11_land_box(spark, d):
    return mask.ocean_in_box(mask.ocean_mask(_written(_target(spark, d), "target")), COARSE, (20.0, 26.0, 75.0, 82.0))


_CHECKS = [
    fx.sql("surface", "target_sparse") + "SELECT count(*) > 0 AND count(*) = count(x) AND count(*) = count(y) AS passed FROM (SELECT a.date AS x, b.date AS y FROM (SELECT DISTINCT date FROM surface) a FULL JOIN (SELECT DISTINCT date FROM target_sparse) b ON a.date = b.date)",
    *(_SQL[q] for q in ("q2_salinity", "q3_wind", "q4_currents", "q5_stratification", "q6_inversions")),
    _SQL["q7_integrity"].replace("SELECT coalesce(temp, 0) AS temp, is_ocean FROM target_sparse", "SELECT CASE WHEN is_ocean THEN coalesce(temp, 0) ELSE 0 END AS temp, is_ocean FROM target_sparse"),
]


@register("q10_scorecard", "SELECT count(*) AS total_checks, CAST(sum(CAST(passed AS INT)) AS BIGINT) AS passed_checks, bool_and(passed) AS success FROM (" + " UNION ALL ".join(f"SELECT passed FROM ({sql})" for sql in _CHECKS) + ")")
def q10_scorecard(spark, d):
    """Inputs that several checks read are written once."""
    s, t, m = _written(fx.surface(spark, d), "surface"), _written(fx.target_sparse(spark, d), "target"), fx.mask(spark)
    rows = split.with_split(mask.with_mask(s, m), split.split_dates(s))
    filled = mask.with_mask(t, m).withColumn("temp", F.when(F.col("is_ocean"), normalize.fill_target(F.col("temp"))).otherwise(0.0))
    return jobs.audit(s, t, m, normalize.normalize(rows, normalize.train_stats(rows)), filled)


@register("q10_observed_scorecard", _SQL["q10_scorecard"])
def q10_observed_scorecard(spark, d):
    """The same card from what the writing jobs observe."""
    s, t, m = _written(fx.surface(spark, d), "surface"), fx.target_sparse(spark, d), fx.mask(spark)
    return jobs.write_audited(s, t, m, sinks.scratch_path(spark, "audited"))


# -- windows


@register("w1_first_file", "WITH e AS (SELECT date_trunc('hour', ts) AS time, event_type AS source_file, event_id, value FROM events), w AS (SELECT time, min(source_file) AS f FROM e GROUP BY 1) SELECT e.time, e.source_file, count(*) AS n FROM e JOIN w ON w.time = e.time AND w.f = e.source_file GROUP BY 1, 2")
def w1_first_file(spark, d):
    e = fx.read(spark, d, "events").select(F.date_trunc("hour", "ts").alias("time"), F.col("event_type").alias("source_file"), "value")
    return align.first_file_per_time(e).groupBy("time", "source_file").agg(F.count("*").alias("n"))


@register("w2_day_gaps", "WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) SELECT date, CAST(date - lag(date) OVER (ORDER BY date) AS INT) AS gap FROM a")
def w2_day_gaps(spark, d):
    return align.day_gaps(fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")))


@register("w3_depth_differences", fx.sql("target_sparse", "mask") + "SELECT t.date, t.lat_idx, t.lon_idx, t.depth_m, u.depth_m AS lower_m, round(u.temp - t.temp + 1e-9, 6) AS diff FROM target_sparse t JOIN target_sparse u ON u.date = t.date AND u.lat_idx = t.lat_idx AND u.lon_idx = t.lon_idx AND u.depth_idx = t.depth_idx + 1 JOIN mask m ON m.lat_idx = t.lat_idx AND m.lon_idx = t.lon_idx WHERE m.is_ocean")
def w3_depth_differences(spark, d):
    return qa.depth_differences(fx.target_sparse(spark, d), fx.mask(spark)).withColumn("diff", F.round(F.col("diff") + 1e-9, 6))


@register("w6_profile_names", "SELECT o_orderkey AS profile_idx, CASE WHEN o_custkey % 7 = 0 THEN 'profile_' || o_orderkey ELSE CAST(o_custkey AS VARCHAR) END AS float_id FROM orders")
def w6_profile_names(spark, d):
    o = fx.read(spark, d, "orders")
    raw = F.when(F.col("o_custkey") % 7 != 0, F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit(" ")))
    return o.select(F.col("o_orderkey").alias("profile_idx"), ingest.float_name(raw, F.col("o_orderkey")).alias("float_id"))


@register("w4_ratio_split", _SPLIT + " SELECT date, split FROM sp")
def w4_ratio_split(spark, d):
    return split.split_dates(fx.surface(spark, d))


# -- sorts and sets


@register("o4_date_sets", "WITH a AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem), b AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) SELECT 'both' AS kind, count(*) AS n, min(date) AS first, max(date) AS last FROM (SELECT date FROM a INTERSECT SELECT date FROM b) UNION ALL SELECT 'only_a', count(*), min(date), max(date) FROM (SELECT date FROM a EXCEPT SELECT date FROM b) UNION ALL SELECT 'union', count(*), min(date), max(date) FROM (SELECT date FROM a UNION ALL SELECT date FROM b)")
def o4_date_sets(spark, d):
    a = fx.read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    b = fx.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    row = lambda kind, df: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    return row("both", a.intersect(b)).unionByName(row("only_a", a.exceptAll(b))).unionByName(row("union", a.unionByName(b)))


@register("o1_sorted_days", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def o1_sorted_days(spark, d):
    return fx.read(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n")).orderBy("date")


@register("o2_first_last", "SELECT l_linestatus AS variable, min(CAST(l_shipdate AS DATE)) AS first, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1")
def o2_first_last(spark, d):
    return fx.read(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("variable")).agg(F.min(F.to_date("l_shipdate")).alias("first"), F.max(F.to_date("l_shipdate")).alias("last"))


@register("j7_attach_stats", _SPLIT + ", st AS (SELECT avg(sst) AS m, stddev_pop(sst) AS s FROM rows WHERE split = 'train' AND is_ocean) SELECT split, count(*) AS n, round(avg((sst - m) / s), 6) AS mean_z FROM rows CROSS JOIN st WHERE is_ocean GROUP BY split")
def j7_attach_stats(spark, d):
    rows = _written(_rows(spark, d), "rows")
    z = normalize.normalize(rows, normalize.train_stats(rows, ["sst"]), ["sst"]).where("is_ocean")
    return _r(z.groupBy("split").agg(F.count("*").alias("n"), F.avg("sst").alias("mean_z")), "mean_z")


# -- side files and tensors


@register("s7_stats_json", _SPLIT + " " + " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS place, '{c}' AS channel, round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) >= 1e-8 THEN stddev_pop({c}) ELSE 1 END, 6) AS std FROM rows WHERE split = 'train' AND is_ocean" for i, c in enumerate(CHANNELS)))
def s7_stats_json(spark, d):
    """Written as text and read again: the place of each key and its values."""
    path = sinks.scratch_path(spark, "stats")
    sinks.stats_json(normalize.long_stats(normalize.train_stats(_rows(spark, d))), CHANNELS).coalesce(1).write.text(path)
    text = spark.read.text(path).select("value", F.posexplode(F.json_object_keys("value")).alias("place", "channel"))
    of = lambda name: F.round(F.element_at(F.from_json("value", "map<string,struct<mean:double,std:double>>"), F.col("channel"))[name], 6).alias(name)
    return text.select("place", "channel", of("mean"), of("std"))


_EXPORT = (
    _TARGET.replace(fx.SQL["corners"], fx.SQL["corners10"]).replace("WITH ", "WITH " + fx.SQL["surface"] + ", ", 1)
    + ", s0 AS (SELECT CAST(date_trunc('year', date) AS DATE) AS date, lat_idx, lon_idx, " + ", ".join(f"avg({c}) AS {c}" for c in CHANNELS) + " FROM surface GROUP BY 1, 2, 3)"
    ", shared AS (SELECT DISTINCT date FROM s0 WHERE date IN (SELECT date FROM tgt))"
    ", ocean AS (SELECT lat_idx, lon_idx, temp IS NOT NULL AS is_ocean FROM tgt WHERE depth_idx = 0 AND date = (SELECT min(date) FROM shared))"
    ", days AS (SELECT date, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM shared)"
    ", sizes AS (SELECT *, greatest(1, CAST(round_even(n * 0.7, 0) AS INT)) AS a, CASE WHEN n >= 5 THEN greatest(1, CAST(round_even(n * 0.15, 0) AS INT)) ELSE 1 END AS b FROM days)"
    ", sp AS (SELECT date, CASE WHEN n < 3 OR i <= CASE WHEN n - a - b <= 0 AND a > 1 THEN a - 1 ELSE a END THEN 'train' WHEN i <= CASE WHEN n - a - b <= 0 AND a > 1 THEN a - 1 ELSE a END + b THEN 'val' ELSE 'test' END AS split FROM sizes)"
    ", rows AS (SELECT s.*, coalesce(o.is_ocean, false) AS is_ocean, sp.split FROM s0 s JOIN sp ON sp.date = s.date LEFT JOIN ocean o ON o.lat_idx = s.lat_idx AND o.lon_idx = s.lon_idx)"
    + _zs("rows")
)


def _yearly(spark, d) -> tuple[DataFrame, DataFrame]:
    """Yearly surface and target on the contract's 101 by 241 cells."""
    s = fx.surface(spark, d).withColumn("date", F.trunc("date", "year"))
    s = s.groupBy("date", "lat_idx", "lon_idx").agg(*(F.avg(c).alias(c) for c in CHANNELS))
    target = jobs.harmonize_target_tiled(fx.target_native(spark, d), fx.native_depths(spark), _coords(5.0, 2.5, 11), _coords(45.0, 2.5, 25), TARGET)
    return _written(s, "surface"), _written(target, "target")


def _tensors(spark, d):
    return jobs.export_tensors(*_yearly(spark, d), 15, TARGET)[0]


_SUM_Z = " + ".join(f"CAST({c} AS FLOAT)::DOUBLE" for c in CHANNELS)


@register("s6_tensors", _EXPORT + f", a AS (SELECT split, date, sum({_SUM_Z}) AS x FROM z GROUP BY 1, 2), b AS (SELECT date, sum(CAST(coalesce(temp, 0) AS FLOAT)::DOUBLE) AS y FROM tgt GROUP BY 1) SELECT a.split, a.date, CAST(7 * 101 * 241 AS INT) AS n_inputs, CAST(15 * 101 * 241 AS INT) AS n_targets, round(a.x, 2) AS sum_inputs, round(b.y, 1) AS sum_targets FROM a JOIN b ON a.date = b.date")
def s6_tensors(spark, d):
    """One row a year: the tensors' sizes and sums; tests hold positions against numpy."""
    total = lambda c, n: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double")), n)
    return _tensors(spark, d).select("split", "date", F.size("inputs").alias("n_inputs"), F.size("targets").alias("n_targets"), total("inputs", 2).alias("sum_inputs"), total("targets", 1).alias("sum_targets"))


@register("s6_chunks", _EXPORT + f", a AS (SELECT split, date, count(*) AS n, sum({_SUM_Z}) AS x FROM z GROUP BY 1, 2), b AS (SELECT date, sum(CAST(coalesce(temp, 0) AS FLOAT)::DOUBLE) AS y FROM tgt GROUP BY 1) SELECT a.split, a.date, a.n AS n_input_cells, CAST(365115 AS BIGINT) AS n_target_cells, CAST(0 AS BIGINT) AS damaged, round(a.x, 2) AS sum_inputs, round(b.y, 1) AS sum_targets FROM a JOIN b ON a.date = b.date")
def s6_chunks(spark, d):
    """The tensors as chunk rows, stored and verified chunk by chunk; no row is a whole day."""
    inputs, targets, _ = jobs.export_chunks(*_yearly(spark, d), 15, TARGET)
    keys, cells = ["split", "date"], TARGET.ny * TARGET.nx
    x = chunks.verify(_written(inputs, "inputs"), len(CHANNELS), keys, cells).select(*keys, F.col("n_cells").alias("n_input_cells"), F.col("damaged").alias("bad"), F.round("total", 2).alias("sum_inputs"))
    y = chunks.verify(_written(targets, "targets"), 1, keys, 15 * cells).select(*keys, F.col("n_cells").alias("n_target_cells"), "damaged", F.round("total", 1).alias("sum_targets"))
    return x.join(y, keys).withColumn("damaged", (F.col("bad") + F.col("damaged")).cast("long")).drop("bad")


@register("q8_verify_tensors", _EXPORT + f", a AS (SELECT count(DISTINCT date) AS days, count(CASE WHEN {_BROKEN} OR isnan(sst) THEN 1 END) = 0 AS inputs_ok FROM z), b AS (SELECT count(CASE WHEN isnan(temp) THEN 1 END) = 0 AS targets_ok, max((depth_idx * 101 + lat_idx) * 241 + lon_idx) < 15 * 101 * 241 AS inside FROM tgt) SELECT days, inside AS shape_ok, inputs_ok AND targets_ok AS values_ok, true AS dtype_ok, inside AND inputs_ok AND targets_ok AS ok FROM a CROSS JOIN b")
def q8_verify_tensors(spark, d):
    return tensor.verify(_tensors(spark, d), 7 * 101 * 241, 15 * 101 * 241)


@register("s7_split_json", _SPLIT + """ SELECT split, '{"num_timesteps":' || n || ',"date_range":["' || a || '","' || b || '"],"input_shape":[' || n || ',7,101,241],"target_shape":[' || n || ',15,101,241]}' AS value FROM (SELECT split, count(DISTINCT date) AS n, min(date) AS a, max(date) AS b FROM rows GROUP BY 1)""")
def s7_split_json(spark, d):
    return sinks.split_json(split.split_summary(_rows(spark, d)))


# -- streaming


@register("st1_daily_stream", fx.sql("subdaily") + ", l AS (SELECT max(time) - INTERVAL 2 DAY AS mark FROM subdaily) SELECT CAST(time AS DATE) AS date, src_lat_idx, src_lon_idx, round(avg(u10), 6) AS u10, count(*) AS n FROM subdaily, l WHERE CAST(CAST(time AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= mark GROUP BY 1, 2, 3")
def st1_daily_stream(spark, d):
    """Events through a file stream: a day's means are appended, and its state is dropped, once the watermark has passed its
    end; the last days stay open."""
    path = sinks.scratch_path(spark, "stream")
    fx.subdaily(spark, d).write.parquet(f"{path}/in")
    stream = daily.read_files(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema)
    daily.write_days(daily.daily_mean_stream(stream, ["src_lat_idx", "src_lon_idx"], ["u10"], delay="2 days"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return _r(spark.read.parquet(f"{path}/out"), "u10")


@register("st2_catch_up", fx.sql("surface") + "SELECT year(date) AS year, month(date) AS month, count(*) AS n, round(sum(sst), 4) AS sst FROM surface GROUP BY 1, 2")
def st2_catch_up(spark, d):
    """Every month comes in three batches."""
    path = sinks.scratch_path(spark, "catch-up")
    fx.surface(spark, d).repartition(3, "lat_idx").write.parquet(f"{path}/in")
    stream = daily.read_files(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, files_at_once=1)
    table = snapshots.MonthTable(spark, f"{path}/out")
    daily.catch_up_table(stream, lambda df: df, table, ["date", "lat_idx", "lon_idx"], f"{path}/checkpoint", "surface").awaitTermination()
    return _r(table.read().groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("sst").alias("sst")), "sst", digits=4)


# -- whole jobs


@register("wa_harmonize", _REGRID.replace("v FROM i1", "v FROM i1") + ", m AS (SELECT date, count(*) AS n, round(avg(v), 6) AS sst, round(avg(2 * v), 6) AS sss FROM i1 WHERE v IS NOT NULL GROUP BY date) SELECT date, n, sst, sss FROM m")
def wa_harmonize(spark, d):
    lat_w, lon_w = _weights(spark)
    n = fx.native_grid(spark, d)
    out = jobs.harmonize_surface([(n.withColumnRenamed("v", "sst"), ["sst"], lat_w, lon_w), (n.select("date", "src_lat_idx", "src_lon_idx", (2 * F.col("v")).alias("sss")), ["sss"], lat_w, lon_w)])
    return _r(out.where("sst is not null").groupBy("date").agg(F.count("*").alias("n"), F.avg("sst").alias("sst"), F.avg("sss").alias("sss")), "sst", "sss")

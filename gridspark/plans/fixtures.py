"""Ocean-shaped views over the star-schema tables; each is given as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.grid import TARGET, axis


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def native_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2.5 degree product, 11 by 25, monthly, with nodes missing."""
    li = read(spark, sf_dir, "lineitem")
    keys = [F.trunc("l_shipdate", "month").alias("date"), (F.col("l_suppkey") % 11).cast("int").alias("src_lat_idx"), (F.col("l_partkey") % 25).cast("int").alias("src_lon_idx")]
    return li.groupBy(*keys).agg(F.avg("l_quantity").alias("v"))


def native_axes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return axis(spark, 5.0, 2.5, 11), axis(spark, 45.0, 2.5, 25)


def native_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The native grid with coordinates instead of indices."""
    g = native_grid(spark, sf_dir)
    return g.withColumns({"lat": 5.0 + 2.5 * F.col("src_lat_idx"), "lon": 45.0 + 2.5 * F.col("src_lon_idx")})


def subdaily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular observations; errors are the missing values."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("timestamp").alias("time"), (F.col("user_id") % 11).cast("int").alias("src_lat_idx"), ((F.col("user_id") * 7) % 25).cast("int").alias("src_lon_idx"),
        F.when(F.col("event_type") != "error", F.col("value") - 50.0).alias("u10"), F.get_json_object("props", "$.k").cast("double").alias("v10"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"), F.lit(0), F.lit(0))
    return o.select(
        F.col("o_orderkey").alias("profile_idx"), F.col("o_custkey").cast("string").alias("float_id"), (F.col("o_orderdate").cast("timestamp") + hours).alias("juld"),
        (4.0 + (F.col("o_custkey") % 270).cast("double") / 10).alias("lat"), (44.0 + (F.col("o_orderkey") % 6200).cast("double") / 100).alias("lon"),
    )


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    pres = F.col("l_quantity") * 20.0
    return li.select(F.col("l_orderkey").alias("profile_idx"), pres.alias("pres"), F.when(F.col("l_tax") < 0.075, 4.0 + 24.0 * F.exp(-pres / 500.0) + (F.col("l_discount") - 0.05) * 10.0).alias("temp"))


def target_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven native depths on the native grid, yearly."""
    li = read(spark, sf_dir, "lineitem")
    depth = F.element_at(F.array(*(F.lit(d) for d in NATIVE_DEPTHS)), F.col("l_linenumber").cast("int"))
    keys = [F.trunc("l_shipdate", "year").alias("date"), (F.col("l_linenumber") - 1).cast("int").alias("src_depth_idx"), depth.alias("depth"), (F.col("l_suppkey") % 11).cast("int").alias("src_lat_idx"), (F.col("l_partkey") % 25).cast("int").alias("src_lon_idx")]
    return li.groupBy(*keys).agg(F.avg(28.0 - 3.0 * F.col("l_linenumber") + (F.col("l_discount") - 0.05) * 10.0).alias("temp"))


NATIVE_DEPTHS = [0.5, 9.5, 47.0, 130.0, 320.0, 760.0, 1060.0]


def native_depths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(NATIVE_DEPTHS)), "idx int, coord double")


def mask(spark: SparkSession, grid=TARGET) -> DataFrame:
    return grid.cells(spark).select("lat_idx", "lon_idx", (((F.col("lat_idx") * 7 + F.col("lon_idx") * 13) % 10) < 5).alias("is_ocean"))


def surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven channels on the target grid, sparse and daily."""
    li = read(spark, sf_dir, "lineitem")
    flow = 3.0 * (F.col("l_extendedprice") / 105000.0)
    return li.groupBy(F.to_date("l_shipdate").alias("date"), (F.col("l_suppkey") % 101).cast("int").alias("lat_idx"), (F.col("l_partkey") % 241).cast("int").alias("lon_idx")).agg(
        F.avg(20.0 + 0.26 * F.col("l_quantity")).alias("sst"), F.avg(30.0 + 80.0 * F.col("l_discount")).alias("sss"), F.avg(12.5 * F.col("l_tax") - 0.5).alias("ssh"),
        F.avg(flow - 1.5).alias("u_curr"), F.avg(1.5 - flow).alias("v_curr"), F.avg(0.6 * F.col("l_quantity") - 15.0).alias("u_wind"), F.avg(15.0 - 0.6 * F.col("l_quantity")).alias("v_wind"),
    )


def target_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven of the fifteen depths at single cells of the target grid, yearly."""
    li = read(spark, sf_dir, "lineitem")
    depth_idx = F.element_at(F.array(*(F.lit(i) for i in SPARSE_DEPTH_IDX)), F.col("l_linenumber").cast("int"))
    depth_m = F.element_at(F.array(*(F.lit(d) for d in SPARSE_DEPTHS)), F.col("l_linenumber").cast("int"))
    return li.groupBy(F.trunc("l_shipdate", "year").alias("date"), depth_idx.alias("depth_idx"), depth_m.alias("depth_m"), (F.col("l_suppkey") % 21).cast("int").alias("lat_idx"), (F.col("l_partkey") % 49).cast("int").alias("lon_idx")).agg(
        F.avg(28.0 - 3.0 * F.col("l_linenumber") + (F.col("l_discount") - 0.05) * 60.0).alias("temp")
    )


SPARSE_DEPTH_IDX = [0, 1, 2, 3, 7, 13, 14]
SPARSE_DEPTHS = [0, 5, 10, 20, 100, 700, 1000]

SQL = {
    "native": """native AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(l_suppkey % 11 AS INT) AS src_lat_idx,
      CAST(l_partkey % 25 AS INT) AS src_lon_idx, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)""",
    "subdaily": """subdaily AS (SELECT ts AS time, CAST(user_id % 11 AS INT) AS src_lat_idx, CAST((user_id * 7) % 25 AS INT) AS src_lon_idx,
      CASE WHEN event_type <> 'error' THEN value - 50.0 END AS u10, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v10 FROM events)""",
    "profiles": """profiles AS (SELECT o_orderkey AS profile_idx, CAST(o_custkey AS VARCHAR) AS float_id,
      o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS juld, CAST(4 AS DOUBLE) + CAST(o_custkey % 270 AS DOUBLE) / 10 AS lat,
      CAST(44 AS DOUBLE) + CAST(o_orderkey % 6200 AS DOUBLE) / 100 AS lon FROM orders)""",
    "levels": """levels AS (SELECT l_orderkey AS profile_idx, l_quantity * 20.0 AS pres, CASE WHEN l_tax < 0.075
      THEN 4.0 + 24.0 * exp(-(l_quantity * 20.0) / 500.0) + (l_discount - 0.05) * 10.0 END AS temp FROM lineitem)""",
    "target_native": """target_native AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS date, CAST(l_linenumber - 1 AS INT) AS src_depth_idx,
      CAST(CASE l_linenumber WHEN 1 THEN 0.5 WHEN 2 THEN 9.5 WHEN 3 THEN 47.0 WHEN 4 THEN 130.0 WHEN 5 THEN 320.0 WHEN 6 THEN 760.0 ELSE 1060.0 END AS DOUBLE) AS depth,
      CAST(l_suppkey % 11 AS INT) AS src_lat_idx, CAST(l_partkey % 25 AS INT) AS src_lon_idx,
      avg(28.0 - 3.0 * l_linenumber + (l_discount - 0.05) * 10.0) AS temp FROM lineitem GROUP BY 1, 2, 3, 4, 5)""",
    "mask": """mask AS (SELECT CAST(a.i AS INT) AS lat_idx, CAST(b.i AS INT) AS lon_idx, ((a.i * 7 + b.i * 13) % 10) < 5 AS is_ocean
      FROM range(101) a(i), range(241) b(i))""",
    "surface": """surface AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 101 AS INT) AS lat_idx, CAST(l_partkey % 241 AS INT) AS lon_idx,
      avg(20.0 + 0.26 * l_quantity) AS sst, avg(30.0 + 80.0 * l_discount) AS sss, avg(12.5 * l_tax - 0.5) AS ssh,
      avg(3.0 * (l_extendedprice / 105000.0) - 1.5) AS u_curr, avg(1.5 - 3.0 * (l_extendedprice / 105000.0)) AS v_curr,
      avg(0.6 * l_quantity - 15.0) AS u_wind, avg(15.0 - 0.6 * l_quantity) AS v_wind FROM lineitem GROUP BY 1, 2, 3)""",
    "target_sparse": """target_sparse AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS date,
      CAST(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 7 WHEN 6 THEN 13 ELSE 14 END AS INT) AS depth_idx,
      CAST(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 5 WHEN 3 THEN 10 WHEN 4 THEN 20 WHEN 5 THEN 100 WHEN 6 THEN 700 ELSE 1000 END AS INT) AS depth_m,
      CAST(l_suppkey % 21 AS INT) AS lat_idx, CAST(l_partkey % 49 AS INT) AS lon_idx,
      avg(28.0 - 3.0 * l_linenumber + (l_discount - 0.05) * 60.0) AS temp FROM lineitem GROUP BY 1, 2, 3, 4, 5)""",
    "grid": """grid AS (SELECT CAST(a.i AS INT) AS lat_idx, CAST(b.i AS INT) AS lon_idx, 5 + 1.25 * a.i AS lat, 45 + 1.25 * b.i AS lon
      FROM range(21) a(i), range(49) b(i))""",
    # Corner nodes of each coarse cell: the native index is half the coarse index.
    "corners": """lat_w AS (SELECT CAST(j AS INT) AS lat_idx, CAST(i AS INT) AS src_lat_idx, w FROM (
        SELECT j, j // 2 AS i, CASE WHEN j % 2 = 0 THEN 1.0 ELSE 0.5 END AS w FROM range(21) t(j) UNION ALL SELECT j, j // 2 + 1, 0.5 FROM range(21) t(j) WHERE j % 2 = 1)),
      lon_w AS (SELECT CAST(j AS INT) AS lon_idx, CAST(i AS INT) AS src_lon_idx, w FROM (
        SELECT j, j // 2 AS i, CASE WHEN j % 2 = 0 THEN 1.0 ELSE 0.5 END AS w FROM range(49) t(j) UNION ALL SELECT j, j // 2 + 1, 0.5 FROM range(49) t(j) WHERE j % 2 = 1)),
      need AS (SELECT a.j AS lat_idx, b.j AS lon_idx, (1 + a.j % 2) * (1 + b.j % 2) AS n FROM range(21) a(j), range(49) b(j))""",
    # The same on the contract's grid, of a tenth of the native step.
    "corners10": """lat_w AS (SELECT CAST(j AS INT) AS lat_idx, CAST(i AS INT) AS src_lat_idx, w FROM (
        SELECT j, j // 10 AS i, 1 - (j % 10) / 10.0 AS w FROM range(101) t(j) UNION ALL SELECT j, j // 10 + 1, (j % 10) / 10.0 FROM range(101) t(j) WHERE j % 10 > 0)),
      lon_w AS (SELECT CAST(j AS INT) AS lon_idx, CAST(i AS INT) AS src_lon_idx, w FROM (
        SELECT j, j // 10 AS i, 1 - (j % 10) / 10.0 AS w FROM range(241) t(j) UNION ALL SELECT j, j // 10 + 1, (j % 10) / 10.0 FROM range(241) t(j) WHERE j % 10 > 0)),
      need AS (SELECT a.j AS lat_idx, b.j AS lon_idx, CASE WHEN a.j % 10 > 0 THEN 2 ELSE 1 END * CASE WHEN b.j % 10 > 0 THEN 2 ELSE 1 END AS n FROM range(101) a(j), range(241) b(j))""",
    # Nodes and weights of the fifteen depths on the seven native ones.
    "depth_w": """depths AS (SELECT CAST(i AS INT) AS depth_idx, CAST([0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000][i + 1] AS INT) AS depth_m FROM range(15) t(i)),
      nodes AS (SELECT i, [0.5, 9.5, 47.0, 130.0, 320.0, 760.0, 1060.0][i + 1] AS z FROM range(7) t(i)),
      legs AS (SELECT a.i, a.z, b.z AS z2 FROM nodes a JOIN nodes b ON b.i = a.i + 1),
      depth_w AS (SELECT d.depth_idx, CAST(0 AS INT) AS src_depth_idx, 1.0 AS w FROM depths d WHERE d.depth_m < 0.5
        UNION ALL SELECT d.depth_idx, CAST(l.i AS INT), (l.z2 - d.depth_m) / (l.z2 - l.z) FROM depths d JOIN legs l ON d.depth_m >= l.z AND d.depth_m < l.z2
        UNION ALL SELECT d.depth_idx, CAST(l.i + 1 AS INT), (d.depth_m - l.z) / (l.z2 - l.z) FROM depths d JOIN legs l ON d.depth_m > l.z AND d.depth_m < l.z2)""",
}


def sql(*names: str) -> str:
    """``WITH`` the named views."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"

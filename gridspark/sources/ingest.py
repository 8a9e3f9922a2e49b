"""Reading native products: names, missing values, unions and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names under which coordinates and variables appear.
COORDINATES = {"lat": "lat", "latitude": "lat", "nav_lat": "lat", "lon": "lon", "longitude": "lon", "nav_lon": "lon", "valid_time": "time", "depth": "depth", "deptht": "depth"}
VARIABLES = {"thetao": "sst", "so": "sss", "zos": "ssh", "uo": "u_curr", "vo": "v_curr", "sss_smap": "sss", "u10": "u_wind", "v10": "v_wind", "analysed_sst": "sst"}
ALIASES = {
    "sst": ["sst", "thetao", "analysed_sst"],
    "sss": ["sss", "so", "sss_smap"],
    "ssh": ["ssh", "zos", "sla"],
    "u_curr": ["u_curr", "uo"],
    "v_curr": ["v_curr", "vo"],
    "u_wind": ["u_wind", "u10"],
    "v_wind": ["v_wind", "v10"],
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL from here on: averages skip NULL but would spread NaN."""
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def read_source(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One product's long table; with ``schema`` nothing is inferred from the files, and only its columns are read."""
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_to_null(normalize_names(reader.parquet(path)))


def read_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several tables of one product as one; columns that some lack are NULL there."""
    if not paths:
        raise ValueError("no input to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (read_source(spark, p) for p in paths))


def load_variable(df: DataFrame, variable: str, sort: bool = True) -> DataFrame:
    """The rows of one variable of a table partitioned by ``variable``; raises if there are none."""
    rows = df.where(F.col("variable") == variable)
    if rows.isEmpty():
        raise ValueError(f"no data for {variable}")
    return rows.orderBy("date") if sort else rows


def normalize_names(df: DataFrame) -> DataFrame:
    """Coordinate names to time, depth, lat, lon, in any case of letters."""
    return df.withColumnsRenamed({c: COORDINATES[c.lower()] for c in df.columns if COORDINATES.get(c.lower(), c) != c and COORDINATES[c.lower()] not in df.columns})


def rename_variables(df: DataFrame, names: dict[str, str] = VARIABLES) -> DataFrame:
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names and names[c] not in df.columns})


def canonical_channels(df: DataFrame, keys: list[str], aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """The keys and each channel from the first of its aliases that the table has; raises if a channel has none."""
    found = {c: next((a for a in names if a in df.columns), None) for c, names in aliases.items()}
    if missing := [c for c, a in found.items() if a is None]:
        raise ValueError(f"missing channels: {', '.join(missing)}")
    return df.select(*keys, *(F.col(a).alias(c) for c, a in found.items()))


def keep_standard(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.select(*keys, *(c for c in names if c in df.columns))


def profile_levels(df: DataFrame) -> DataFrame:
    """(profile columns, level, pres, temp): one row per level, from array columns ``pres`` and ``temp``. Each of them
    gives way to ``pres_adjusted`` or ``temp_adjusted`` if the table has that, for the whole table and also where the
    adjusted values are missing. An array ``levels`` of (pres, temp) is taken as both."""
    rest = [c for c in df.columns if not c.startswith(("levels", "pres", "temp"))]
    if "levels" in df.columns:
        df = df.withColumns({"pres": F.col("levels.pres"), "temp": F.col("levels.temp")})
    name = {c: f"{c}_adjusted" if f"{c}_adjusted" in df.columns else c for c in ("pres", "temp")}
    both = F.arrays_zip(F.col(name["pres"]).alias("pres"), F.col(name["temp"]).alias("temp"))
    return df.select(*rest, F.posexplode_outer(both).alias("level", "l")).select(*rest, "level", F.col("l")["pres"].alias("pres"), F.col("l")["temp"].alias("temp"))


def float_name(float_id: Column, profile_idx: Column) -> Column:
    """The trimmed id, or profile_<index> where there is none."""
    name = F.trim(float_id)
    return F.when(name.isNotNull() & (name != ""), name).otherwise(F.concat(F.lit("profile_"), profile_idx.cast("string")))

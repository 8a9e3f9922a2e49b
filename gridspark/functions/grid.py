"""The fixed target grid, the standard depths and index arithmetic on regular axes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the data contract.
DEPTHS = [0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000]
CHANNELS = ["sst", "sss", "ssh", "u_curr", "v_curr", "u_wind", "v_wind"]


@dataclass(frozen=True)
class Grid:
    """A regular grid; steps that are multiples of 1/4 are exact in binary, so coordinates don't drift."""

    lat0: float = 5.0
    lon0: float = 45.0
    step: float = 0.25
    ny: int = 101
    nx: int = 241

    def lat(self, idx: Column) -> Column:
        return F.lit(self.lat0) + F.lit(self.step) * idx

    def lon(self, idx: Column) -> Column:
        return F.lit(self.lon0) + F.lit(self.step) * idx

    def cells(self, spark: SparkSession) -> DataFrame:
        """(lat_idx, lon_idx, lat, lon): ny * nx rows, small enough to broadcast."""
        ids = spark.range(self.ny * self.nx)
        idx = ids.select((F.col("id") / self.nx).cast("int").alias("lat_idx"), (F.col("id") % self.nx).cast("int").alias("lon_idx"))
        return idx.withColumns({"lat": self.lat(F.col("lat_idx")), "lon": self.lon(F.col("lon_idx"))})

    def axes(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(idx, coord) of latitude and longitude."""
        return axis(spark, self.lat0, self.step, self.ny), axis(spark, self.lon0, self.step, self.nx)

    def nearest(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Indices of the nearest cell; halfway points go to the lower index, points outside to the edge."""

        def at(x: Column, first: float, n: int) -> Column:
            return F.least(F.greatest(F.ceil((x - first) / self.step - 0.5), F.lit(0)), F.lit(n - 1)).cast("int")

        return at(lat, self.lat0, self.ny), at(lon, self.lon0, self.nx)

    def dense(self, dates: DataFrame, *more: Column) -> DataFrame:
        """Every cell for every row of ``dates``, by exploding index ranges."""
        rows = dates.select("*", *more).withColumn("lat_idx", F.explode(F.sequence(F.lit(0), F.lit(self.ny - 1))))
        return rows.withColumn("lon_idx", F.explode(F.sequence(F.lit(0), F.lit(self.nx - 1))))


TARGET = Grid()
COARSE = Grid(step=1.25, ny=21, nx=49)


def axis(spark: SparkSession, first: float, step: float, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("idx"), (F.lit(first) + F.lit(step) * F.col("id")).alias("coord"))


def depth_axis(spark: SparkSession, depths: list[float] = DEPTHS) -> DataFrame:
    """(depth_idx, depth_m)."""
    return spark.createDataFrame([(i, int(d)) for i, d in enumerate(depths)], "depth_idx int, depth_m int")

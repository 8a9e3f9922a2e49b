"""One row per day: the channels and the target as flat float arrays in channel, lat, lon order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.grid import CHANNELS, TARGET, Grid
from gridspark.operators import chunks


def _flat(df: DataFrame, values: list[str], keys: list[str], position: Column, size: int, name: str) -> DataFrame:
    """The chunks of a day, some dozens of byte strings, put one behind the other in one dense array a value; what is absent or
    missing is 0. A day is one row of the result, so it is also the largest group; its size is fixed by the grid. Two rows of
    one day and position raise."""
    parts = chunks.chunked(df, values, keys, position, size)
    kinds = dict(df.dtypes)
    got = parts.groupBy(*keys).agg(F.collect_list(F.struct("chunk", "data")).alias("parts")).select(*keys, F.col("parts.chunk").alias("chunk"), F.col("parts.data").alias("data"))
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for r in range(whole.num_rows):
                b = whole.slice(r, 1)
                out = np.zeros((len(values), -(-size // chunks.BLOCK) * chunks.BLOCK), np.float32)
                for at, raw in zip(b.column(n)[0].as_py(), b.column(n + 1)[0].values):
                    out[:, at * chunks.BLOCK : (at + 1) * chunks.BLOCK] = np.frombuffer(raw.as_buffer(), "<f4").reshape(len(values), chunks.BLOCK)
                flat = pa.ListArray.from_arrays(pa.array([0, len(values) * size], pa.int32()), pa.array(out[:, :size].ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns[:n], flat], names=[*keys, name])

    return got.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), f"{name} array<float>"]))


def input_tensor(df: DataFrame, keys: list[str], channels: list[str] = CHANNELS, grid: Grid = TARGET) -> DataFrame:
    """(keys, inputs); position is (channel * ny + lat_idx) * nx + lon_idx."""
    return _flat(df, channels, keys, F.col("lat_idx") * grid.nx + F.col("lon_idx"), grid.ny * grid.nx, "inputs")


def target_tensor(df: DataFrame, keys: list[str], depths: int, grid: Grid = TARGET) -> DataFrame:
    """(keys, targets); position is (depth_idx * ny + lat_idx) * nx + lon_idx; missing values are 0."""
    rows = df.where(F.col("depth_idx") < depths)
    return _flat(rows, ["temp"], keys, (F.col("depth_idx") * grid.ny + F.col("lat_idx")) * grid.nx + F.col("lon_idx"), depths * grid.ny * grid.nx, "targets")


def write_tensors(inputs: DataFrame, targets: DataFrame, path: str) -> None:
    """Days of one split in ascending order within each file."""
    rows = inputs.join(targets, ["split", "date"])
    rows.repartition("split", "date").sortWithinPartitions("split", "date").write.mode("overwrite").partitionBy("split").parquet(path)


def verify(tensors: DataFrame, inputs: int, targets: int) -> DataFrame:
    """One row: right lengths, float elements, no NaN or missing element; ``ok`` is all of them."""
    kinds = dict(tensors.dtypes)
    typed = kinds.get("inputs") == "array<float>" and kinds.get("targets") == "array<float>"
    bad = lambda c: F.exists(c, lambda v: v.isNull() | F.isnan(v))
    row = tensors.agg(
        F.count("*").alias("days"),
        F.coalesce(F.every((F.size("inputs") == inputs) & (F.size("targets") == targets)), F.lit(False)).alias("shape_ok"),
        F.coalesce(F.every(~bad("inputs") & ~bad("targets")), F.lit(False)).alias("values_ok"),
    )
    return row.withColumn("dtype_ok", F.lit(typed)).withColumn("ok", F.col("shape_ok") & F.col("values_ok") & F.col("dtype_ok"))

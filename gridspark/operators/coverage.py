"""Which cells a day has, as bitmaps: 32,768 cells in 4 KB, combined by or, counted without a distinct over cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of Spark's bitmaps, a fixed value.
BITS = 32_768


def bitmaps(df: DataFrame, cell: Column, keys: list[str], valid: Column | None = None) -> DataFrame:
    """(keys, part, cells): a bit for each cell number (0 and up) that has a row, or a valid one. Rows of a cell may repeat."""
    rows = df if valid is None else df.where(valid)
    at = rows.select(*keys, cell.cast("long").alias("__cell")).where("__cell >= 0")
    part = F.floor(F.col("__cell") / BITS).cast("int")
    return at.groupBy(*keys, part.alias("part")).agg(F.bitmap_construct_agg((F.col("__cell") % BITS)).alias("cells"))


def combined(maps: DataFrame, keys: list[str]) -> DataFrame:
    """The cells that any of the combined bitmaps has, by fewer keys: days to months, sources to all."""
    return maps.groupBy(*keys, "part").agg(F.bitmap_or_agg("cells").alias("cells"))


def completeness(maps: DataFrame, cells: int, keys: list[str]) -> DataFrame:
    """(keys, n_cells, complete)."""
    n = maps.groupBy(*keys).agg(F.sum(F.bitmap_count("cells")).alias("n_cells"))
    return n.withColumn("complete", F.col("n_cells") == cells)


def lacking(maps: DataFrame, cells: int, keys: list[str]) -> DataFrame:
    """(keys, cell): the cells of ``cells`` that a key lacks; keys without any bitmap are not there. Parts that have no bitmap lack all."""
    parts = -(-cells // BITS)
    there = maps.select(*keys).distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    every = there.join(maps, [*keys, "part"], "left").select(*keys, "part", "cells")
    kinds = dict(every.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, found = [], []
            for i, (part, raw) in enumerate(zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist())):
                size = min(BITS, cells - part * BITS)
                on = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:size] if raw else np.zeros(size, np.uint8)
                off = np.flatnonzero(on == 0)
                rows.append(np.full(len(off), i))
                found.append(part * BITS + off)
            take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
            cell = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(take) for k in range(len(keys))), cell], names=[*keys, "cell"])

    return every.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "cell long"]))

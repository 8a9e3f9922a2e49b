"""Dense arrays as rows of chunks: of every day and block of cells the values as float32 bytes, with their checksum.

A chunk is what a task makes, moves and reads; a whole day is never one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a chunk.
BLOCK = 4096


def chunked(df: DataFrame, values: list[str], keys: list[str], position: Column, size: int, block: int = BLOCK) -> DataFrame:
    """(keys, chunk, data, n_cells, checksum): ``data`` has the values of the cells from ``chunk`` * ``block`` on, value by value, little-endian
    float32; cells without a row and missing values are 0. A chunk without any row isn't there and counts as zeros.

    ``size`` cells make an array; a position outside raises. Two rows of one key and cell raise as well.
    """
    kinds = dict(df.dtypes)
    rows = df.select(*keys, position.cast("long").alias("__p"), *(F.col(v).cast("float").alias(v) for v in values))
    rows = rows.withColumn("chunk", F.floor(F.col("__p") / block).cast("int"))
    order = [*keys, "chunk"]
    dealt = rows.repartition(*order).sortWithinPartitions(*order, "__p").select(*order, "__p", *values)
    n = len(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            first = _first(b, n)[-1]
            # The last group may go on in the next batch.
            if first or (held and not _same(held[-1], b, n)):
                if held and not _same(held[-1], b, n):
                    yield made(held)
                    held = [b.slice(0, first)] if first else []
                else:
                    held.append(b.slice(0, first))
                if held:
                    yield made(held)
                held = []
            held.append(b.slice(first))
        if held:
            yield made(held)

    def made(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        first = _first(b, n)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, b.num_rows)))
        p = b.column(n).to_numpy()
        if len(p) and (p.min() < 0 or p.max() >= size):
            raise ValueError(f"a cell lies outside the {size} cells of the array")
        if (np.diff(p)[np.diff(group) == 0] == 0).any():
            raise ValueError("two rows of one cell")
        data = np.zeros((len(first), len(values), block), "<f4")
        for k in range(len(values)):
            data[group, k, p % block] = b.column(n + 1 + k).fill_null(0).to_numpy(zero_copy_only=False)
        step = 4 * len(values) * block
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(np.arange(len(first) + 1, dtype=np.int64) * step), pa.py_buffer(data)]).cast(pa.binary())
        heads = [b.column(k).take(pa.array(first)) for k in range(n)]
        return pa.RecordBatch.from_arrays([*heads, raw, pa.array(np.bincount(group), pa.int64())], names=[*order, "data", "n_cells"])

    out = dealt.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "chunk int, data binary, n_cells long"]))
    return out.withColumn("checksum", F.crc32("data"))


def _first(b: pa.RecordBatch, n: int) -> np.ndarray:
    """Where groups of equal first ``n`` columns begin."""
    change = np.zeros(b.num_rows, bool)
    for k in range(n):
        code = b.column(k).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    change[0] = True
    return np.flatnonzero(change)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, n: int) -> bool:
    return all(a.column(k)[-1].as_py() == b.column(k)[0].as_py() for k in range(n))


def cells(chunks: DataFrame, values: list[str], keys: list[str], size: int, block: int = BLOCK) -> DataFrame:
    """(keys, position, values): the arrays' cells again, a row each."""
    kinds = dict(chunks.dtypes)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                chunk = b.column(n)[i].as_py()
                data = np.frombuffer(b.column(n + 1)[i].as_buffer(), "<f4").reshape(len(values), block)[:, : max(0, size - chunk * block)]
                place = chunk * block + np.arange(data.shape[1])
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(np.full(len(place), i))) for k in range(n)), pa.array(place, pa.int64()), *(pa.array(x, pa.float32()) for x in data)], names=[*keys, "position", *values])

    rows = chunks.select(*keys, "chunk", "data")
    return rows.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "position long", *(f"{v} float" for v in values)]))


def measured(chunks: DataFrame, values: int, keys: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, chunk, n_cells, intact, sized, n_bad, total): each chunk's checksum and length, its NaN and infinite values, and the sum of the others."""
    kinds = dict(chunks.dtypes)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bad, total = [], []
            for raw in b.column(n + 4):
                x = np.frombuffer(raw.as_buffer(), np.uint8)
                x = x[: len(x) // 4 * 4].view("<f4").astype(float)
                fine = np.isfinite(x)
                bad.append(int((~fine).sum()))
                total.append(float(x[fine].sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[: n + 4], pa.array(bad, pa.int64()), pa.array(total, pa.float64())], names=[*keys, "chunk", "n_cells", "intact", "sized", "n_bad", "total"])

    rows = chunks.select(*keys, "chunk", "n_cells", (F.crc32("data") == F.col("checksum")).alias("intact"), (F.octet_length("data") == 4 * values * block).alias("sized"), "data")
    return rows.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "chunk int, n_cells long, intact boolean, sized boolean, n_bad long, total double"]))


def verify(chunks: DataFrame, values: int, keys: list[str], size: int, block: int = BLOCK) -> DataFrame:
    """(keys, n_chunks, n_cells, damaged, total, ok) a key: every chunk has its length and checksum, its number lies inside the array and is there
    once, and no value is NaN or infinite."""
    last = -(-size // block)
    rows = measured(chunks, values, keys, block)
    damaged = ~F.col("intact") | ~F.col("sized") | (F.col("n_bad") > 0) | ~F.col("chunk").between(0, last - 1)
    out = rows.groupBy(*keys, "chunk").agg(F.count("*").alias("times"), F.sum("n_cells").alias("n_cells"), F.max(damaged.cast("int")).alias("bad"), F.sum("total").alias("total"))
    out = out.groupBy(*keys).agg(F.count("*").alias("n_chunks"), F.sum("n_cells").alias("n_cells"), F.sum(F.greatest("bad", (F.col("times") > 1).cast("int"))).alias("damaged"), F.sum("total").alias("total"))
    return out.withColumn("ok", F.col("damaged") == 0)

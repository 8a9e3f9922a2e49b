"""Files clustered along a space-filling key, with a table of the ranges that each file holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of each dimension in the key; larger numbers are cut to their upper bits.
BITS = 10


def morton_key(numbers: list[Column], wide: list[int], bits: int = BITS) -> Column:
    """The bits of several non-negative numbers in turn, the highest first. ``wide`` are the numbers' widths in bits."""
    parts = []
    for k, (x, w) in enumerate(zip(numbers, wide)):
        top = F.shiftright(x.cast("long"), max(0, w - bits))
        for b in range(min(w, bits)):
            # A narrow number's highest bit goes with the highest of the others.
            to = (b + bits - min(w, bits)) * len(numbers) + len(numbers) - 1 - k
            parts.append(F.shiftleft(F.shiftright(top, b).bitwiseAND(F.lit(1)), to))
    return reduce(Column.bitwiseOR, parts)


def write_clustered(df: DataFrame, path: str, dims: list[str], files: int) -> None:
    """Writes ``df`` in ``files`` files along the key of ``dims`` (dates or non-negative whole numbers), and the least and greatest value of each
    dimension in each file. Rows that lack a dimension are stored, and every range reads them."""
    number = {c: F.datediff(F.col(c), F.lit("1900-01-01").cast("date")) if dict(df.dtypes)[c] in ("date", "timestamp", "timestamp_ntz") else F.col(c) for c in dims}
    ends = df.agg(*(x for c, n in number.items() for x in (F.min(n).alias(f"low_{c}"), F.max(n).alias(f"high_{c}")))).first()
    low = {c: ends[f"low_{c}"] or 0 for c in dims}
    wide = [max(1, int((ends[f"high_{c}"] or 0) - low[c]).bit_length()) for c in dims]
    key = morton_key([F.coalesce(n, F.lit(low[c])) - F.lit(low[c]) for c, n in number.items()], wide)
    rows = df.withColumn("__key", key)
    rows.repartitionByRange(files, "__key", *dims).sortWithinPartitions("__key").drop("__key").write.mode("overwrite").parquet(f"{path}/rows")
    stored = df.sparkSession.read.parquet(f"{path}/rows").withColumn("file", F.input_file_name())
    ranges = [x for c in dims for x in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.max(F.col(c).isNull()).alias(f"open_{c}"))]
    stored.groupBy("file").agg(F.count("*").alias("n_rows"), *ranges).coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_rows, low_, high_ and open_ of each dimension)."""
    return spark.read.parquet(f"{path}/zones")


def files_in(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> list[str]:
    """The files that may have rows inside all ``ranges`` (column to its first and last value, both included)."""
    meets = [((F.col(f"low_{c}") <= F.lit(b)) & (F.col(f"high_{c}") >= F.lit(a))) | F.col(f"open_{c}") for c, (a, b) in ranges.items()]
    return [r.file for r in zones(spark, path).where(reduce(Column.__and__, meets, F.lit(True))).select("file").collect()]


def read_range(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """The rows inside all ``ranges``, from the files that may have them; no other file is opened."""
    found = files_in(spark, path, ranges)
    schema = spark.read.parquet(f"{path}/rows").schema
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    inside = [F.col(c).between(F.lit(a), F.lit(b)) for c, (a, b) in ranges.items()]
    return rows.where(reduce(Column.__and__, inside, F.lit(True)))

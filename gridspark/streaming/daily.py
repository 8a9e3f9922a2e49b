"""Structured Streaming: daily means of late observations, and incremental catch-up by file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridspark.sources.snapshots import MonthTable


def daily_mean_stream(stream: DataFrame, keys: list[str], values: list[str], time: str = "time", delay: str = "2 days") -> DataFrame:
    """Mean per day and cell; samples later than the watermark allows are dropped. The state is one sum and count a
    value, cell and open day."""
    rows = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", delay)
    out = rows.groupBy(F.window("__t", "1 day"), *keys).agg(*(F.avg(v).alias(v) for v in values), F.count("*").alias("n"))
    return out.select(F.to_date("window.start").alias("date"), *keys, *values, "n")


def read_files(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def write_days(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Finished days, appended; ends when the files there are have been read."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def catch_up_table(stream: DataFrame, job: Callable[[DataFrame], DataFrame], table: MonthTable, keys: list[str], checkpoint: str, name: str) -> StreamingQuery:
    """Runs the batch job on each new set of files and merges the result into a month table by its keys. The table's manifest holds
    the number of the stream's last batch, so one that is run again after a failure changes nothing, and an ended job leaves
    the version before. ``name`` must be the stream's own, as long as its checkpoint lasts."""

    def batch(df: DataFrame, number: int) -> None:
        table.merge(job(df), keys, (name, number))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def catch_up(stream: DataFrame, job: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Runs the batch job on each new set of files and hands the result to ``write``; the checkpoint knows what has been
    done. A batch may be run again after a failure and a month may come in several batches, so ``write`` must add to
    what is stored and replace only rows of equal keys, as ``catch_up_table`` does."""

    def batch(df: DataFrame, _: int) -> None:
        write(job(df))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

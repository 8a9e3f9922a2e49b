"""Tables stored by a hash of their keys, so that joins on these keys move none of them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from gridspark.sources.sinks import scratch_path

CELL = ["date", "lat_idx", "lon_idx"]


def write_bucketed(df: DataFrame, keys: list[str] = CELL, buckets: int = 32, name: str | None = None, path: str | None = None) -> str:
    """Stores ``df`` as a table of ``buckets`` files by the hash of ``keys``, each sorted by them, and gives its name. Tables of the same keys and
    number of buckets join without an exchange, and so does an aggregation by the keys. Choose the number so that a
    bucket fits a task. The files lie under ``path`` (by default in the shared folder); an existing table of that name is
    replaced."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    path = path or scratch_path(spark, name)
    # The same hash as the buckets': a file a bucket.
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return name

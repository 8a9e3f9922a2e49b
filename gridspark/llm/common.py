"""What the corpus operators share: scratch tables, table reads and small expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side made of a few longs a row is broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 400_000

LAST_ID = 2**63 - 1


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. In local mode, as in tests, a temporary one where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: What Spark hands to a Python worker at once: texts are long, so fewer rows than its default, and bytes are bounded too.
BATCH_ROWS, BATCH_BYTES = 2000, "16m"


def bound_batches(spark: SparkSession) -> None:
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there, so a lost executor
    costs a re-read and not a recomputation."""
    bound_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if parent.startswith(("file:", "hdfs:", "s3", "abfs", "gs:", "viewfs:")) and "-" in parent.rsplit("/", 1)[1]:
                path = jvm.org.apache.hadoop.fs.Path(parent)
                path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the limit, else unchanged (a shuffle join)."""
    return F.broadcast(df) if rows <= limit else df


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % n, F.lit(0)).cast("int")


def unused(names: list[str], *wanted: str) -> list[str]:
    """The wanted names, with as many underscores before them as it takes to clash with none of ``names``."""
    taken = {n.lower() for n in names}
    prefix = "__"
    while any(prefix + w in taken for w in wanted):
        prefix += "_"
    return [prefix + w for w in wanted]


#: SQL of the oracles: CRC32 by its table of 256 remainders, ``tab(t)``, over the bytes that ``x`` has in hex.
SQL_CRC32_TABLE = """tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""
SQL_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS BIGINT))"""

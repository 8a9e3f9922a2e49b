"""Shards by a permutation-filled look-up table.

Every shard has an order of preference over the slots of a table of prime size; in turns each shard claims its next
free slot until the table is full. A row's slot is its key's hash modulo the size. Shards get equal numbers of
slots up to one, and adding or removing a shard moves few other keys.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import scratch_path, table

TABLE_SIZE = 65537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard (its place in the list) of each slot."""
    if not is_prime(size) or not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("the size must be prime and at least the number of shards; names must differ")
    offset = [xxhash.xxh64_intdigest(s, 1) % size for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (size - 1) + 1 for s in shards]
    out, turn, left = [-1] * size, [0] * len(shards), size
    while True:
        for i in range(len(shards)):
            slot = (offset[i] + turn[i] * skip[i]) % size
            while out[slot] >= 0:
                turn[i] += 1
                slot = (offset[i] + turn[i] * skip[i]) % size
            out[slot] = i
            turn[i] += 1
            left -= 1
            if not left:
                return out


def lookup(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard, shard_name): exactly ``size`` rows, so it is always fit to broadcast."""
    rows = [(slot, i, shards[i]) for slot, i in enumerate(fill(shards, size))]
    return F.broadcast(spark.createDataFrame(rows, "slot long, shard int, shard_name string"))


def assign(rows: DataFrame, keys: list[str], shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``rows`` with ``slot``, ``shard`` and ``shard_name`` (names that are taken get underscores before them).

    The slot is XXH64 of the keys modulo the size. Rows with equal keys share a shard; null keys hash like any value;
    repeated rows stay; an empty table gives an empty result. The join is against the broadcast table: no shuffle.
    """
    names, taken = ["slot", "shard", "shard_name"], {c.lower() for c in rows.columns}
    while set(names) & taken:
        names = ["_" + n for n in names]
    slot = F.pmod(F.xxhash64(*keys), F.lit(size))
    return rows.withColumn(names[0], slot).join(lookup(rows.sparkSession, shards, size).toDF(*names), names[0]).select(*rows.columns, *names)


#: Tasks that write one shard at least, if it is large enough, and bytes of the input for each.
SALTS, TASK_BYTES = 8, 256 << 20


def salts_of(rows: DataFrame, shards: int) -> tuple[int, int]:
    """Tasks for a shard and in all, by the input's size as Spark estimates it (that of its files, for a table)."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # An input that Spark knows nothing of counts as endless.
    tasks = -(-size // TASK_BYTES) if size < 1 << 60 else 0
    return max(SALTS, -(-tasks // shards)), max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def write_shards(rows: DataFrame, keys: list[str], shards: list[str], path: str, size: int = TABLE_SIZE) -> list[str]:
    """Writes all columns, one folder per shard, and gives the names of slot, shard and shard name there. Rows are dealt
    by shard and their place in the input, so a large shard, even one of equal rows, is written by as many tasks as its bytes
    want. Rows should come from files or another stored table: of those each has its place, also when a task runs again."""
    out = assign(rows, keys, shards, size)
    names = out.columns[-3:]
    salt = "_" + names[1] + "_salt"
    salts, tasks = salts_of(rows, len(shards))
    dealt = out.withColumn(salt, F.monotonically_increasing_id() % salts).repartition(tasks, names[1], salt).drop(salt)
    dealt.write.option("compression", "zstd").partitionBy(names[1]).parquet(path)
    return names


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is written to its shard with all columns; what is returned is read back."""
    path = scratch_path(spark, "shards")
    slot, shard, name = write_shards(table(spark, sf_dir, "documents"), ["doc_id"], shard_names(), path)
    return spark.read.parquet(path).select("doc_id", F.col(slot).alias("slot"), F.col(shard).cast("int").alias("shard"), F.col(name).alias("shard_name"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))

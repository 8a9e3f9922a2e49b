"""Five corpus stages in a row; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm.common import materialize, table
from gridspark.llm.decontaminate import drop_contaminated
from gridspark.llm.line_dedup import line_dedup
from gridspark.llm.packing import pack
from gridspark.llm.simhash_tables import keep_one_similar
from gridspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars is counted anew."""
    from pyspark.sql import functions as F

    out = line_dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) stays."""
    return keep_one_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", dedup_lines), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]

#: Model scores, fingerprints and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

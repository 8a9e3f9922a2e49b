"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: query name -> module of this subpackage that has its query(spark, sf_dir) and, where SQL can express it, ORACLE_SQL
MODULES = {
    "op1_line_dedup": "line_dedup",
    "op2_url_filter": "url_filter",
    "op3_simhash_dedup": "simhash_dedup",
    "op4_toxicity": "toxicity",
    "op5_decontaminate": "decontaminate",
    "op6_warc": "warc",
    "op7_quality": "quality",
    "op8_media": "media",
    "op9_sharding": "sharding",
    "op10_packing": "packing",
    "op11_periodic_runs": "periodic_runs",
    "op12_best_fit": "best_fit",
    "op13_spelling_groups": "spelling",
}


def _module(name: str):
    return import_module(f"gridspark.llm.{MODULES[name]}")


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _module(name).query for name in MODULES} | {"pipeline": _pipeline}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {name: getattr(_module(name), "ORACLE_SQL", None) for name in MODULES} | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in found.items() if sql}

"""Skill of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skill(df: DataFrame, truth: str, pred: str, by: str = "depth_m") -> DataFrame:
    """n, rmse, bias, r2, corr for each value of ``by`` and overall (``by`` NULL), over pairs with both values.
    Bias is prediction less truth; r2 and corr are missing where the truth, or either side, is constant."""
    rows = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull()).select(by, F.col(truth).cast("double").alias("t"), F.col(pred).cast("double").alias("p"))
    d = F.col("p") - F.col("t")
    out = rows.rollup(by).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(d).alias("bias"),
        (1 - F.sum(d * d) / F.nullif(F.var_pop("t") * F.count("*"), F.lit(0.0))).alias("r2"),
        F.when((F.stddev_pop("t") > 0) & (F.stddev_pop("p") > 0), F.corr("t", "p")).alias("corr"),
    )
    return out


def masked_mse(df: DataFrame, truth: str, pred: str, weights: DataFrame | None = None) -> DataFrame:
    """Mean of squared errors over ocean rows (``is_ocean``); ``weights(depth_idx, weight)`` weighs depths."""
    rows = df.where("is_ocean")
    w: Column = F.lit(1.0)
    if weights is not None:
        rows, w = rows.join(F.broadcast(weights), "depth_idx"), F.col("weight")
    d = F.col(pred) - F.col(truth)
    return rows.agg((F.sum(w * d * d) / F.nullif(F.sum(w), F.lit(0.0))).alias("mse"), F.count("*").alias("n"))

"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled web text train a classifier by minimising the non-negative unbiased risk (Kiryo et
al., 2017): pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)). Labels of low quality are never used. The class prior pi is
estimated from the same two samples: the unlabelled share of any region is at least pi times the positives' share, so
the least ratio over the regions that a first classifier ranks as most positive is taken.

The classifier is logistic over standardised text statistics and their squares. Bounds: at most ``positives`` and
``unlabelled`` rows, those of the smallest hashes of id and text, reach the driver as a few numbers each; every row is
then scored in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import fold, table, unused

#: Rows of the fit. It has 37 weights, so their error from the draw is under 2 in 100 at this size and more rows change no
#: decision; rows are described by numbers of their own text only, so nothing else depends on the draw.
POSITIVES = 6_000
UNLABELLED = 24_000
NAMES = ["log_bytes", "upper", "digits", "spaces", "marks", "bangs", "ascii_marks_run", "non_ascii", "newlines", "log_words", "word_len", "distinct_words", "marked_words", "upper_words", "repeated_lines", "top_word", "short_words", "control"]

_CLASS = np.zeros(256, dtype=np.int64)  # 0 lower and other, 1 upper, 2 digit, 3 space, 4 mark, 5 non-ASCII, 6 control
_CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 5
_CLASS[:32] = 6
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 4


def statistics(text: str | None) -> list[float]:
    """The numbers of ``NAMES``; all 0 for an empty or null text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(NAMES)
    n = len(raw)
    kind = _CLASS[np.frombuffer(raw, np.uint8)]
    by = np.bincount(kind, minlength=7) / n
    mark = kind == 4
    words = raw.split()
    k = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = raw.split(b"\n")
    marked = sum(not w[-2:-1].isalnum() and w[-2:-1] < b"\x80" for w in words if len(w) > 1)
    return [
        float(np.log1p(n)), by[1], by[2], by[3], by[4], raw.count(b"!") / n, float((mark[1:] & mark[:-1]).sum() / n), by[5], raw.count(b"\n") / n,
        float(np.log1p(len(words))), (n - by[3] * n) / k, len(counts) / k, marked / k, sum(map(bytes.isupper, words)) / k,
        1 - len(set(lines)) / len(lines), max(counts.values(), default=0) / k, sum(len(w) <= 2 for w in words) / k, by[6],
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(expand(x, self.mean, self.std) @ self.weights, -40, 40)))


def expand(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / std, -6, 6)
    return np.concatenate([z, z * z - 1, np.ones((len(z), 1))], axis=1)


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -40, 40)))


def risks(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The positive and the negative part of the unbiased logistic risk; their sum is the risk, in which a negative part under
    zero counts as zero."""
    gp, gu = p @ w, u @ w
    return float(prior * np.logaddexp(0, -gp).mean()), float(np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())


def gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Of the risk. Where its negative part is under zero, the step goes against that part, as in the paper."""
    gp, gu = p @ w, u @ w
    negative = (u * _sigmoid(gu)[:, None]).mean(0) - prior * (p * _sigmoid(gp)[:, None]).mean(0)
    if risks(w, p, u, prior)[1] < 0:
        return -negative
    return negative - prior * (p * (1 - _sigmoid(gp))[:, None]).mean(0)


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 800, rate: float = 0.03, ridge: float = 1e-4) -> np.ndarray:
    """Weights of least non-negative unbiased risk, by Adam."""
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    for i in range(1, steps + 1):
        grad = gradient(w, p, u, prior) + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return w


def estimate_prior(sp: np.ndarray, su: np.ndarray, least: float = 0.2) -> float:
    """Least ratio of shares, unlabelled to positive, over regions {score >= t} with at least ``least`` positives."""
    cuts = np.quantile(sp, np.linspace(0, 1 - least, 60))
    ratios = [(su >= t).mean() / max((sp >= t).mean(), 1e-9) for t in cuts]
    return float(np.clip(min(ratios), 0.05, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel:
    """With no positives or no unlabelled rows every score is 0.5."""
    width = len(NAMES)
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(2 * width + 1), 0.5)
    mean, std = positive.mean(0), np.maximum(positive.std(0), 1e-6 + 0.02 * np.abs(positive.mean(0)))
    p, u = expand(positive, mean, std), expand(unlabelled, mean, std)
    first = fit_nnpu(p, u, 0.5, steps=300)
    prior = estimate_prior(p @ first, u @ first)
    return QualityModel(mean, std, fit_nnpu(p, u, prior), prior)


def features(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept long columns and ``x``, the statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    rows = docs.select(*(F.col(c).cast("long").alias(c) for c in keep), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, ", ".join([*(f"{c} long" for c in keep), "x array<double>"]))


def drawn_features(rows: DataFrame, most: int, id_col: str, text_col: str) -> pa.Table:
    """The statistics of at most ``most`` rows, those of the smallest hashes: a few numbers a row."""
    [at] = unused(rows.columns, "at")
    hashed = rows.select(F.xxhash64(id_col, text_col, F.lit("draw")).alias(at), F.col(text_col))
    return features(hashed, [at], text_col).orderBy(at).limit(most).toArrow()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> QualityModel:
    """``labels`` must hold only rows that may be learned from; of them only the positive ones are used."""
    trusted = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("y")).where("y = 1").select("__id")
    n_p, n_u = trusted.count(), docs.count()
    drawn = lambda c, salt, rate: F.pmod(F.xxhash64(*c, F.lit(salt)), F.lit(1_000_000)) < min(1.0, rate) * 1_000_000
    picked = F.broadcast(trusted.where(drawn(["__id"], "positive", 1.2 * positives / max(n_p, 1))))
    pos = drawn_features(docs.join(picked, docs[id_col] == picked["__id"], "left_semi"), positives, id_col, text_col)
    unl = drawn_features(docs.where(drawn([id_col, text_col], "unlabelled", 1.2 * unlabelled / max(n_u, 1))), unlabelled, id_col, text_col)
    matrix = lambda t: np.array(t.column("x").to_pylist(), dtype=float).reshape(-1, len(NAMES))
    # Sorted, so that the fit doesn't depend on the order in which Spark returns rows.
    ordered = lambda x: x[np.lexsort(x.T)] if len(x) else x
    return train(ordered(matrix(pos)), ordered(matrix(unl)))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``id, score, predicted`` for every row: empty and null texts, repeated rows and null ids too; equal texts have
    equal scores; an empty table gives an empty result."""
    fitted = (model.mean, model.std, model.weights, model.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(*fitted)
        for b in batches:
            x = np.array([statistics(t) for t in b.column(1).to_pylist()], dtype=float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.scores(x))], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(fold("doc_id", 5) != 0))
    return score(docs, model).select(F.col("id").alias("doc_id"), (fold("id", 5) == 0).alias("held_out"), "score", "predicted")

"""Toxicity by two class-conditional Kneser-Ney bigram models.

A text is scored by log P(text | toxic) - log P(text | ordinary), divided by its number of words, and a logistic
curve fitted on labelled texts that the models have not seen maps this to 0..1.

Each class has an interpolated Kneser-Ney model; every level takes a discount from its counts and gives exactly the mass
that this frees to the level below:

* bigrams of the class, counted by the documents that have them (a text that repeats itself counts once);
* bigrams of both classes together, which the classes share, so that standing phrases pull to neither side;
* words of the class by continuation counts: before how many different words they were seen;
* words of the WHOLE corpus, which the classes share and which smooths all rare expressions.

On the shared level the discount is absolute. On a class's own levels it is ``discount`` plus ``factor`` times what the
level below expects: what the classes use alike, even unevenly, then falls to the shared counts, and only clear
excess stays with the class. (With a discount under one alone, F1 on held-out rows at sf0.1 is under 0.1: toxic words
are a fiftieth of a toxic text, and the noise of all other words outweighs them.) Discount and factor are taken from
``DISCOUNTS`` and ``FACTORS`` by the loss on the labelled texts kept for the curve.

Bounds: at most ``max_docs`` different labelled texts a class are learned from, drawn by hash. No n-gram of them is left
out; those whose whole count is discounted need no entry, as all of it is in the freed mass. The corpus counts have no
bound: they take every word of all documents, are summed by word within each task and then in Spark, and the mass and
the rarest word are those of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import fold, materialize, table

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: Column) -> Column:
    """XXH64 of each lower-cased word, in order; words are runs of letters and digits."""
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def mix(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One 64-bit key for a pair of words."""
    with np.errstate(over="ignore"):
        x = (prev * _MIX) ^ (word + _MIX)
        x ^= x >> np.uint64(31)
        return x * np.uint64(0xBF58476D1CE4E5B9)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a batch and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets - offsets[0]


#: Words that one step of numpy work takes, whatever the size of Spark's batches.
STEP_WORDS = 200_000


def steps(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``STEP_WORDS`` words (a longer text is a run of its own)."""
    ends = b.column(column).offsets.to_numpy()[1:].astype(np.int64)
    base, lo = int(b.column(column).offsets[0].as_py()), 0
    while lo < b.num_rows:
        start = base if lo == 0 else int(ends[lo - 1])
        hi = max(lo + 1, int(np.searchsorted(ends, start + STEP_WORDS, "right")))
        yield b.slice(lo, hi - lo)
        lo = hi


def starts(n: int, offsets: np.ndarray) -> np.ndarray:
    """True where a text's first word is, which has no word before it."""
    first = np.zeros(n, dtype=bool)
    own = offsets[:-1]
    first[own[own < offsets[1:]]] = True
    return first


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in sorted keys; -1 if absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted
    word_p: np.ndarray  # (2, words + 1): by class; the last is the rarest other word
    contexts: np.ndarray  # sorted: first words of listed pairs
    class_free: np.ndarray  # (2, contexts + 1): what a class's own bigrams leave to the shared ones
    shared_free: np.ndarray  # (contexts + 1,): what the shared ones leave to words
    pairs: np.ndarray  # sorted
    class_p: np.ndarray  # (2, pairs + 1): the class's own part
    shared_p: np.ndarray  # (pairs + 1,): the shared part
    slope: float = 1.0
    intercept: float = 0.0

    def probabilities(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(2, words): each word's probability after the one before it, alone where ``first``."""
        prev = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
        w = find(self.words, h)
        c = np.where(first, -1, find(self.contexts, prev))
        k = np.full(len(h), -1)
        at = np.nonzero((c >= 0) & (w >= 0))[0]
        k[at] = find(self.pairs, mix(prev[at], h[at]))
        return self.class_p[:, k] + self.class_free[:, c] * (self.shared_p[k] + self.shared_free[c] * self.word_p[:, w])

    def ratios(self, h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log-likelihood ratio of each text; 0 for a text without words."""
        n = np.diff(offsets)
        if not len(h):
            return np.zeros(len(n))
        p = self.probabilities(h, starts(len(h), offsets))
        sums = np.concatenate([[0.0], np.cumsum(np.log(p[1]) - np.log(p[0]))])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(n, 1)

    def scores(self, ratios: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * ratios + self.intercept, -40, 40)))


def shared_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often every word is in all rows of ``docs``. No Python takes part, so an executor needs no memory
    beside its heap."""
    return docs.select(F.explode(word_hashes(F.col(text_col))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def only(counts: DataFrame, words: np.ndarray) -> DataFrame:
    """The rows of ``counts`` for the given sorted words, which are broadcast; their number is bounded by the sample's."""
    sent = counts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(find(sent.value, b.column(0).to_numpy().view(np.uint64)) >= 0))

    return counts.select("word", "n").mapInArrow(run, "word long, n long")


def sampled_labels(labels: DataFrame, label_col: str, max_docs: int, id_col: str = "doc_id") -> tuple[DataFrame, list[float], float]:
    """(id, y) for about ``max_docs`` ids of each class, drawn by hash, the share drawn of each class, and the share of
    label 1 among all labels; of repeated labels the largest counts."""
    y = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    share = {r["y"]: r["n"] for r in y.where("y in (0, 1)").groupBy("y").agg(F.count("*").alias("n")).collect()}
    drawn = [max_docs / max(max_docs, share.get(c, 0)) for c in (0, 1)]
    rate = F.when(F.col("y") == 1, F.lit(drawn[1])).otherwise(F.lit(drawn[0]))
    rows = y.where("y in (0, 1)").where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < rate * 1_000_000)
    return rows, drawn, share.get(1, 0) / max(1, sum(share.values()))


def sample_texts(docs: DataFrame, picked: DataFrame, max_docs: int, id_col: str, text_col: str) -> DataFrame:
    """(y, held, h): the different texts of the picked ids, at most ``max_docs`` of a class; those of the smallest hashes
    stay. A fifth is held for the curve."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    texts = texts.select("y", word_hashes(F.col("text")).alias("h")).withColumn("key", F.xxhash64("h", F.lit("sample")))
    texts = materialize(texts.dropDuplicates(["y", "key"]), "toxicity-texts")
    last = {c: texts.where(F.col("y") == c).select("key").orderBy("key").limit(max_docs).agg(F.max("key")).first()[0] for c in (0, 1)}
    inside = [(F.col("y") == c) & (F.col("key") <= F.lit(k)) for c, k in last.items() if k is not None]
    rows = texts.where(inside[0] if len(inside) == 1 else inside[0] | inside[1]) if inside else texts.limit(0)
    return rows.select("y", F.when(F.pmod(F.xxhash64("h", F.lit("curve")), F.lit(5)) == 0, 1).otherwise(0).alias("held"), "h")


def bigrams(sample: DataFrame) -> DataFrame:
    """(v, w, n0, n1): by how many texts of each class word v is followed by w."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for batch in batches for s in steps(batch, 1)):
            h, offsets = flat(b.column(1))
            for y, lo, hi in zip(b.column(0).to_numpy(zero_copy_only=False), offsets, offsets[1:]):
                if hi - lo > 1:
                    both = np.unique(np.stack([h[lo : hi - 1], h[lo + 1 : hi]], axis=1), axis=0)
                    v, w = (np.ascontiguousarray(both[:, i]).view(np.int64) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), y, dtype=np.int32)), pa.array(v), pa.array(w)], names=["y", "v", "w"])

    return sample.select("y", "h").mapInArrow(run, "y int, v long, w long").groupBy("v", "w").agg(*(F.count(F.when(F.col("y") == c, 1)).alias(f"n{c}") for c in (0, 1)))


@dataclass
class Counts:
    """What the smoothing needs of the sample and the corpus."""

    words: np.ndarray  # sorted
    continued: np.ndarray  # (2, words): different words before each
    all_continued: np.ndarray  # (2,): the same of all words
    shared: np.ndarray  # (words + 1,): the corpus's distribution; the last is the rarest other word
    v: np.ndarray
    w: np.ndarray
    n: np.ndarray  # (2, pairs)
    of: np.ndarray  # (2, pairs): all bigrams that begin with v


def count(docs: DataFrame, fit: DataFrame, text_col: str) -> Counts:
    counted = materialize(bigrams(fit), "toxicity-bigrams")
    number = lambda t, c: t.column(c).to_numpy().astype(np.int64) if t.num_rows else np.zeros(0, np.int64)
    totals = counted.groupBy("v").agg(F.sum("n0").alias("of0"), F.sum("n1").alias("of1"))
    kept = counted.where(F.col("n0") + F.col("n1") > PAIR_DISCOUNT).join(totals, "v").toArrow()
    after = [F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"c{c}") for c in (0, 1)]
    all_continued = np.array(counted.agg(*after).first(), dtype=float)
    # Words whose count may outlast a discount, and those of the listed pairs.
    pairs = counted.where(F.col("n0") + F.col("n1") > PAIR_DISCOUNT).select("w").distinct().withColumn("paired", F.lit(True))
    uni = counted.groupBy("w").agg(*after).join(pairs, "w", "left").where((F.greatest("c0", "c1") > min(DISCOUNTS)) | F.col("paired")).toArrow()
    words = number(uni, "w").view(np.uint64)
    order = np.argsort(words)
    words, continued = words[order], np.stack([number(uni, f"c{c}")[order].astype(float) for c in (0, 1)])
    corpus = materialize(shared_counts(docs, text_col), "toxicity-words")
    mass, least = (float(x or 1) for x in corpus.agg(F.sum("n"), F.min("n")).first())
    everywhere = only(corpus, words).toArrow()
    n = np.full(len(words), least)
    n[find(words, number(everywhere, "word").view(np.uint64))] = number(everywhere, "n")
    # A word that the corpus doesn't have weighs as much as its rarest.
    shared = np.append(n, least) / (mass + least)
    v, w = number(kept, "v").view(np.uint64), number(kept, "w").view(np.uint64)
    return Counts(words, continued, all_continued, shared, v, w, *(np.stack([number(kept, f"{x}{c}").astype(float) for c in (0, 1)]) for x in ("n", "of")))


#: Documents taken off every bigram, and what is tried for continuation counts: the discount and how many times what
#: the shared counts expect is taken off as well.
PAIR_DISCOUNT = 4
DISCOUNTS = (1.5, 2.0, 3.0)
FACTORS = (1.2, 2.0, 3.0, 4.0)


def smoothed(c: Counts, discount: float, factor: float) -> ToxicityModel:
    """Both class models."""
    total = np.maximum(c.all_continued, 1)[:, None]
    own = np.maximum(c.continued - discount - factor * total * c.shared[:-1], 0) / total
    word_p = np.pad(own, ((0, 0), (0, 1))) + (1 - own.sum(1, keepdims=True)) * c.shared
    keys = mix(c.v, c.w)
    order = np.argsort(keys)
    keys, v, n, of = keys[order], c.v[order], c.n[:, order], c.of[:, order]
    word = find(c.words, c.w[order])
    contexts, where = np.unique(v, return_inverse=True)
    summed = lambda x: np.bincount(where, weights=x, minlength=len(contexts))
    shared_p = np.maximum(n.sum(0) - PAIR_DISCOUNT, 0) / of.sum(0)
    shared_free = np.append(1 - summed(shared_p), 1.0)
    lower = shared_p + shared_free[where] * word_p[:, word]
    class_p = np.maximum(n - PAIR_DISCOUNT - factor * of * lower, 0) / np.maximum(of, 1)
    class_free = np.stack([np.append(1 - summed(x), 1.0) for x in class_p])
    return ToxicityModel(c.words, word_p, contexts, class_free, shared_free, keys, np.pad(class_p, ((0, 0), (0, 1))), np.append(shared_p, 0.0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = 4000) -> ToxicityModel:
    """``labels(id, label)`` must hold only rows that may be learned from. Of repeated labels of an id the largest
    counts, and equal texts of a class count once. Without labels of both classes every ratio is 0 and the score is the
    share of label 1."""
    picked, drawn, base = sampled_labels(labels, label_col, max_docs, id_col)
    sample = materialize(sample_texts(docs, picked, max_docs, id_col, text_col), "toxicity-sample")
    counts = count(docs, sample.where("held = 0"), text_col)
    models = [smoothed(counts, d, f) for d in DISCOUNTS for f in FACTORS]

    sent = docs.sparkSession.sparkContext.broadcast(models)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for batch in batches for s in steps(batch, 1)):
            r = np.stack([m.ratios(*flat(b.column(1))) for m in sent.value], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(r), pa.list_(pa.float64()))], names=["y", "r"])

    points = sample.where("held = 1").select("y", "h").mapInArrow(tried, "y int, r array<double>").toArrow()
    sent.destroy()
    y = points.column("y").to_numpy().astype(float) if points.num_rows else np.zeros(0)
    x = np.array(points.column("r").to_pylist(), dtype=float).reshape(len(y), len(models))
    # A class that was drawn more thinly counts for more, so that scores keep the share that all labels have.
    weight = np.where(y == 1, 1 / drawn[1], 1 / drawn[0])
    weight *= len(y) / max(weight.sum(), 1e-9)
    best, lowest = models[0], np.inf
    for i, model in enumerate(models):
        model.slope, model.intercept = logistic(x[:, i], y, weight, base)
        p = np.clip(model.scores(x[:, i]), 1e-9, 1 - 1e-9)
        loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        if loss < lowest - 1e-9:
            best, lowest = model, loss
    return best


#: Rows of ratio 0 with the labels' own share of label 1 that join the curve's, so that a few rows don't decide it.
PRIOR_ROWS = 20.0


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, base: float) -> tuple[float, float]:
    """Slope and intercept of a logistic curve by Newton steps, with a slight ridge on the slope."""
    if len(set(y.tolist())) < 2:
        p = (base * PRIOR_ROWS + (weight * y).sum() + 1e-3) / (PRIOR_ROWS + weight.sum() + 2e-3)
        return 0.0, float(np.log(p / (1 - p)))
    x, y = np.concatenate([x, [0.0, 0.0]]), np.concatenate([y, [1.0, 0.0]])
    weight = np.concatenate([weight, [PRIOR_ROWS * base, PRIOR_ROWS * (1 - base)]])
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones_like(x)], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -40, 40)))
        g = z.T @ (weight * (y - p)) - np.array([1e-2 * b[0], 0])
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6]), g)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0] / scale), float(b[1])


def with_ratio(rows: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The kept columns, ``ratio`` and ``score`` of rows that have the word hashes ``h``; the model has a fixed bound."""
    names = [k.split()[0] for k in keep]
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in (s for batch in batches for s in steps(batch, len(names))):
            r = m.ratios(*flat(b.column(len(names))))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(r), pa.array(m.scores(r))], names=[*names, "ratio", "score"])

    return rows.select(*names, "h").mapInArrow(run, ", ".join([*keep, "ratio double", "score double"]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``id, ratio, score, predicted`` for every row. Empty and null texts have ratio 0; repeated rows and null ids
    each give a row; equal texts have equal scores; an empty table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), word_hashes(F.col(text_col)).alias("h"))
    return with_ratio(rows, model, ["id long"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.select("doc_id", "text"), labels.where(fold("doc_id", 4) != 2))
    return score(docs, model).select(F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "score", "predicted", F.col("ratio").alias("log_likelihood_ratio"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under the threshold, all columns unchanged, learned from all given labels.

    The verdict is computed per row beside the row itself, so nothing is joined or shuffled to apply it.
    """
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in (s for batch in batches for s in steps(batch, len(names))):
            r = m.scores(m.ratios(*flat(b.column(len(names)))))
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names=[f"c{i}" for i in range(len(names))]).filter(pa.array(r < threshold))

    rows = plain.withColumn("h", word_hashes(plain[f"c{names.index(text_col)}"]))
    return rows.mapInArrow(run, plain.schema).toDF(*names)

"""Benchmark decontamination by greedy string tiling.

A document is held against benchmark items by their shared seeds, runs of ``SEED_TOKENS`` tokens with equal rolling
(Karp-Rabin) hashes. For a document and an item, equal seeds on one diagonal grow to matches. The longest match is marked
first, what is left of others is cut to its unmarked parts, and so on until no match of a seed is left. The share of the
item's tokens that are marked is its coverage; as matches may come in any order, passages whose parts were moved around
are found too.

Spark does this in joins:

* the seeds of all different item texts are a table (hash, text, how many of the text's seeds it is);
* each document keeps the places of those of its windows that are a seed of any item. Seeds are looked up in a sorted
  array of hashes if the counted seeds fit ``SEEDS_SENT``, which nearly no window outlasts; beyond it all windows go
  into the join;
* seeds are ranked by how many texts have them. A pair that covers enough shares a number of seeds that is known, so it
  shares one that is not among the text's commonest; only the rarer ones are joined. A phrase that all items have brings no
  pairs so;
* the pairs that are left fetch both sides' seeds; those that share enough are tiled, in the tasks where the join puts them.

An item of fewer tokens than a seed is one seed of its own width: it must be there whole.

Hashes of tokens and seeds are 64-bit and stand for them. Memory for a pair goes with its matches, not with its pairs
of equal seeds: 20,000 equal tokens against 1,000 of them are 21,000 matches, not 20 million.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.llm.common import bounded, materialize, table, unused

SEED_TOKENS = 5
COVERAGE = 0.6
#: Distinct seeds up to which they are sent to all tasks, 8 bytes each.
SEEDS_SENT = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK_BITS = 22


def token_hashes(text: Column) -> Column:
    """XXH64 of each lower-cased token, in order; tokens are runs of letters, digits and underscores."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}_]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("2"), text).alias("t2")]


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of every window of ``width`` tokens; arithmetic is modulo 2**64."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        x = tokens * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        out = np.zeros(n, np.uint64)
        for j in range(width):
            out *= _BASE
            out += x[j : j + n]
    return out


def runs(places: np.ndarray, hashes: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal diagonal runs of equal seeds, as first place in the document, first place in the item and number of
    seeds. ``hashes`` are the document's seeds at ``places``; ``item`` has all of the item's seeds."""
    order = np.lexsort((places, hashes))
    places, hashes = places[order], hashes[order]
    lo, hi = np.searchsorted(hashes, item, "left"), np.searchsorted(hashes, item, "right")
    none = np.zeros(0, np.int64)
    starts, ends, before = [none], [none], none
    start_q, end_q = [none], [none]
    for q in range(len(item) + 1):
        now = places[lo[q] : hi[q]] if q < len(item) else none
        if len(before) or len(now):
            begun = np.setdiff1d(now, before + 1, assume_unique=True)
            over = np.setdiff1d(before, now - 1, assume_unique=True)
            starts.append(begun)
            start_q.append(np.full(len(begun), q))
            ends.append(over)
            end_q.append(np.full(len(over), q - 1))
        before = now
    p, q, e, r = (np.concatenate(x) for x in (starts, start_q, ends, end_q))
    # On each diagonal starts and ends alternate.
    a, b = np.lexsort((p, p - q)), np.lexsort((e, e - r))
    return p[a], q[a], e[b] - p[a] + 1


def tile(p: np.ndarray, q: np.ndarray, seeds: np.ndarray, size: int, seed: int) -> int:
    """Marked tokens of an item of ``size`` tokens; of equally long matches the first in the document comes first."""
    heap = [(-(n + seed - 1), a, b) for a, b, n in zip(p.tolist(), q.tolist(), seeds.tolist())]
    heapq.heapify(heap)
    first = int(p.min()) if len(p) else 0
    on_a = np.zeros(int((p + seeds).max()) - first + seed if len(p) else 0, bool)
    on_b = np.zeros(size, bool)
    left = size
    while heap and left >= seed:
        length, a, b = heapq.heappop(heap)
        length = -length
        taken = on_b[b : b + length] | on_a[a - first : a - first + length]
        if not taken.any():
            on_a[a - first : a - first + length] = on_b[b : b + length] = True
            left -= length
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[1], taken.view(np.int8), [1]])))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= seed:
                heapq.heappush(heap, (lo - hi, a + lo, b + lo))
    return size - left


def seed_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows; those of different widths differ."""
    return window_hashes(tokens, width) ^ np.uint64(0x9FB21C651E98DF25 * width % 2**64)


def item_texts(benchmark: DataFrame, text_col: str, seed: int) -> DataFrame:
    """(t1, t2, size, width, seeds): every different item text with a token, the width of its seeds, and these in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = [np.array(h.as_py(), dtype=np.int64).view(np.uint64) for h in b.column(2)]
            width = [min(seed, len(x)) for x in tokens]
            lists = [seed_hashes(x, w).view(np.int64) for x, w in zip(tokens, width)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in tokens], pa.int32()), pa.array(width, pa.int32()), pa.array(lists, pa.list_(pa.int64()))], names=["t1", "t2", "size", "width", "seeds"])

    text = F.col(text_col).cast("string")
    rows = benchmark.where(text.isNotNull()).select(*text_key(text), token_hashes(text).alias("h")).dropDuplicates(["t1", "t2"]).where(F.size("h") > 0)
    return rows.mapInArrow(run, "t1 long, t2 long, size int, width int, seeds array<long>")


def seed_places(docs: DataFrame, wanted: np.ndarray | None, text_col: str, widths: list[int]) -> DataFrame:
    """(t1, t2, places, seeds) of the texts that have a seed; of all windows of the widths if ``wanted`` (sorted) is None."""
    sent = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value if sent else None
        if known is not None:
            maybe = np.zeros(1 << _MASK_BITS, bool)
            maybe[known >> np.uint64(64 - _MASK_BITS)] = True
        for b in batches:
            column = b.column(2)
            offsets = column.offsets.to_numpy().astype(np.int64)
            tokens = column.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]]
            offsets -= offsets[0]
            found = []
            for width in widths:
                hashes = seed_hashes(tokens, width)
                if known is None:
                    at = np.arange(len(hashes))
                elif len(known):
                    at = np.flatnonzero(maybe[hashes >> np.uint64(64 - _MASK_BITS)])
                    at = at[known[np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)] == hashes[at]]
                else:
                    at = np.zeros(0, np.int64)
                row = np.searchsorted(offsets, at, "right") - 1
                inside = at + width <= offsets[row + 1]
                found.append((row[inside], at[inside], hashes[at[inside]]))
            row, at, hashes = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
            order = np.argsort(row, kind="stable")
            row, at, hashes = row[order], at[order], hashes[order]
            rows, n = np.unique(row, return_counts=True)
            cuts = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            places = pa.ListArray.from_arrays(cuts, pa.array((at - offsets[row]).astype(np.int32)))
            seeds = pa.ListArray.from_arrays(cuts, pa.array(hashes.view(np.int64)))
            some = pa.array(rows)
            yield pa.RecordBatch.from_arrays([b.column(0).take(some), b.column(1).take(some), places, seeds], names=["t1", "t2", "places", "seeds"])

    text = F.col(text_col).cast("string")
    rows = docs.where(text.isNotNull()).select(*text_key(text), token_hashes(text).alias("h"))
    return rows.mapInArrow(run, "t1 long, t2 long, places array<int>, seeds array<long>")


def rare_seeds(seeds: DataFrame, coverage: float) -> DataFrame:
    """Of ``seeds(t1, t2, size, width, seed, times)`` those that a text that covers an item enough must have one of. Each shared seed covers
    at most its own tokens, so it takes ``need`` of them; the commonest that are fewer than that are left out."""
    common = seeds.groupBy("seed").agg(F.count("*").alias("texts"))
    need = F.ceil(F.lit(coverage) * F.col("size") / F.col("width"))
    upto = F.sum("times").over(W.partitionBy("t1", "t2").orderBy(F.desc("texts"), "seed").rowsBetween(W.unboundedPreceding, 0))
    return seeds.join(common, "seed").withColumn("upto", upto).where(F.col("upto") >= need).select("t1", "t2", "seed")


def candidates(placed: DataFrame, rare: DataFrame) -> DataFrame:
    """(d1, d2, t1, t2): texts and items that share one of the item's rarer seeds."""
    return placed.select("d1", "d2", F.explode(F.array_distinct("seeds")).alias("seed")).join(rare, "seed").select("d1", "d2", "t1", "t2").distinct()


def covered(docs: DataFrame, items: DataFrame, text_col: str, seed: int, coverage: float) -> DataFrame:
    """(d1, d2, t1, t2, matched, size): the document texts, by key, that cover item texts enough."""
    seeds = items.select("t1", "t2", "size", "width", F.explode("seeds").alias("seed")).groupBy("t1", "t2", "size", "width", "seed").agg(F.count("*").alias("times"))
    seeds = materialize(seeds, "benchmark-seeds")
    distinct = seeds.select("seed").distinct()
    few = distinct.count() <= SEEDS_SENT
    wanted = np.sort(distinct.toArrow().column("seed").to_numpy().astype(np.int64).view(np.uint64)) if few else None
    widths = [r.width for r in seeds.select("width").distinct().orderBy("width").collect()]
    placed = seed_places(docs, wanted, text_col, widths).withColumnsRenamed({"t1": "d1", "t2": "d2"})
    # Equal texts are tiled once.
    placed = materialize(placed, "document-seeds").dropDuplicates(["d1", "d2"])
    pairs = materialize(candidates(placed, rare_seeds(seeds, coverage)), "benchmark-pairs")
    both = pairs.join(placed, ["d1", "d2"]).withColumnRenamed("seeds", "own").join(items.select("t1", "t2", "size", "width", "seeds"), ["t1", "t2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marked = []
            for size, width, places, own, item in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), *(b.column(i) for i in (6, 7, 8))):
                places, own, item = (x.values.to_numpy(zero_copy_only=False) for x in (places, own, item))
                could = width * int(np.isin(item, own).sum()) >= coverage * size
                marked.append(tile(*runs(places.astype(np.int64), own, item), size, width) if could else 0)
            enough = pa.array(np.array(marked) >= coverage * b.column(4).to_numpy(zero_copy_only=False)) if marked else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(marked, pa.int32()), b.column(4)], names=["d1", "d2", "t1", "t2", "matched", "size"]).filter(enough)

    return both.select("d1", "d2", "t1", "t2", "size", "width", "places", "own", "seeds").mapInArrow(run, "d1 long, d2 long, t1 long, t2 long, matched int, size int")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED_TOKENS, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, matched_tokens, item_tokens, coverage``: one row for each row of ``docs`` and item it covers.

    Defined cases: null texts and texts without tokens match nothing; items of fewer tokens than a seed are found where
    they are there whole; repeated rows and items each give their own rows; null ids are carried; texts that repeat themselves, however long, are tiled like others; other
    columns are ignored; empty tables give an empty result.
    """
    items = materialize(item_texts(benchmark, "text", seed), "benchmark-texts")
    found = materialize(covered(docs, items, text_col, seed, coverage), "benchmark-covered")
    n = found.count()
    text = F.col(text_col).cast("string")
    rows = docs.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), *(k.alias(f"d{i}") for i, k in enumerate(text_key(text), 1)))
    named = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), *text_key(F.col("text").cast("string")))
    out = rows.join(bounded(found, n), ["d1", "d2"]).join(named, ["t1", "t2"])
    return out.select("doc_id", "item_id", F.col("matched").alias("matched_tokens"), F.col("size").alias("item_tokens"), F.round(F.col("matched") / F.col("size"), 6).alias("coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", seed: int = SEED_TOKENS, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` whose text covers no item, all columns unchanged. The keys of the texts that go are broadcast
    if their count is within the bound; beyond it the rows are shuffled once."""
    items = materialize(item_texts(benchmark, "text", seed), "benchmark-texts")
    d1, d2 = unused(docs.columns, "d1", "d2")
    gone = materialize(covered(docs, items, text_col, seed, coverage).select(F.col("d1").alias(d1), F.col("d2").alias(d2)).distinct(), "benchmark-gone")
    keys = text_key(F.col(text_col).cast("string"))
    return docs.join(bounded(gone, gone.count()), (keys[0] == F.col(d1)) & (keys[1] == F.col(d2)), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

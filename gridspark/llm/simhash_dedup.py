"""SimHash near-duplicates, searched with a hierarchical index in Gray order.

Fingerprints are 64-bit. Two link when they differ in at most ``radius`` bits. The index works on the distinct
fingerprints:

* upper nodes: the 64 bits are cut into ``radius + 1`` blocks; at least one block of two linked fingerprints is equal,
  and among the bits outside it at least one sub-block is equal as well. Such a pair of equal blocks is a masked bit
  pattern that many fingerprints share; it is the key under which they are filed (``(radius + 1) ** 2`` keys each);
* a key with over ``RUN`` fingerprints goes down another level in the same way, and so on: its fingerprints are filed
  under ``radius + 1`` longer patterns. Each level leaves fewer free bits, so keys become small, however alike the
  fingerprints are, and none is lost;
* below a key, fingerprints are sorted by their Gray rank and searched in the tree of ``gray_index``, which drops whole
  groups by the differences accumulated from the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import materialize, unused
from gridspark.llm.components import connected_components
from gridspark.llm.gray_index import SMALL, Tree, sized, small_pairs, whole_groups

RUN = 8192
SEED = 42


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words; a shorter text is one shingle, an empty one none. Lower-cases A-Z only;
    words are runs without the six white-space bytes."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(w) > words:
        parts = [b" ".join(t) for t in zip(*(w[i:] for i in range(words)))]
    else:
        parts = [b" ".join(w)] if w else []
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in parts), dtype="<u8", count=len(parts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half the hashes; 0 for no hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, -(-len(hashes) // 65536)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long) for every row; null and empty texts have fingerprint 0."""
    kind = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(shingle_hashes(t, words)) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return kind.mapInArrow(run, "id long, fp long")


def masks(radius: int, depth: int = 2) -> list[int]:
    """Masked patterns such that two codes within ``radius`` bits agree on at least one of them. Pattern ``i`` of a depth
    is part of the patterns ``(radius + 1) * i`` and following of the next."""
    out = [0]
    for _ in range(depth):
        rest = [[b for b in range(64) if not m >> b & 1] for m in out]
        out = [m | sum(1 << int(b) for b in block) for m, bits in zip(out, rest) for block in np.array_split(np.array(bits), radius + 1)]
    return out


def filed(rows: DataFrame, radius: int, depth: int, wide: int) -> DataFrame:
    """(mask_id, key, fp): ``rows(mask_id, fp)`` of a depth under the patterns of a deeper one, ``wide`` for each."""
    patterns = np.array(masks(radius, depth), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False) * wide, wide) + np.tile(np.arange(wide, dtype=np.int32), b.num_rows)
            fp = np.repeat(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64), wide)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array((fp & patterns[ids]).view(np.int64)), pa.array(fp.view(np.int64))], names=["mask_id", "key", "fp"])

    return rows.select("mask_id", "fp").mapInArrow(run, "mask_id int, key long, fp long")


def searched(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the components of all pairs of a key within the radius."""
    for group, (_, _, fps) in whole_groups(batches, 2):
        codes = fps.view(np.uint64)[:, None]
        is_small, large = sized(group, SMALL)
        at = np.nonzero(is_small)[0]
        x, y = small_pairs(group[at], codes[at], radius)
        found = [(at[x], at[y])]
        for lo, hi in large:
            x, y, _ = Tree(codes[lo:hi]).forest(radius)
            found.append((x + lo, y + lo))
        for x, y in found:
            yield pa.RecordBatch.from_arrays([pa.array(fps[x]), pa.array(fps[y])], names=["a", "b"])


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct ``fp`` longs -> edges (a, b) whose components are those of all pairs within ``radius`` bits."""
    # Patterns of a depth are (radius + 1) ** depth; hot keys go down until few bits are left.
    if not 0 <= radius <= 3:
        raise ValueError("radius must be 0 to 3")
    wide, depth = radius + 1, 2
    rows, ready = filed(fps.select(F.lit(0).alias("mask_id"), "fp"), radius, depth, wide**depth), []
    while True:
        hot = materialize(rows.groupBy("mask_id", "key").count().where(F.col("count") > RUN).select("mask_id", "key"), "gray-hot-keys")
        if hot.isEmpty():
            break
        ready.append(rows.join(hot, ["mask_id", "key"], "left_anti"))
        depth += 1
        rows = materialize(filed(rows.join(hot, ["mask_id", "key"], "left_semi"), radius, depth, wide), "gray-hot-rows")
    for part in ready:
        rows = rows.unionByName(part)
    dealt = rows.repartition("mask_id", "key").sortWithinPartitions("mask_id", "key")
    return dealt.mapInArrow(lambda batches: searched(batches, radius), "a long, b long")


def components(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``prints(id, fp)`` -> (fp, component_id): the smallest non-null id of all rows whose fingerprints are linked."""
    classes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(links(classes.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Defined cases: null or empty texts have fingerprint zero and link like any other; repeated rows each give a row;
    null ids give rows whose component is the smallest non-null id linked to them (null if there is none); other
    columns are ignored; an empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    return prints.join(components(prints, radius), "fp").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, without those in whose component a smaller id exists. Rows with a
    null id stay; rows that repeat the smallest id stay."""
    found = simhash_components(docs, id_col, text_col, words, radius)
    [own] = unused(docs.columns, "gone")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(own), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    from gridspark.llm.common import table

    return simhash_components(table(spark, sf_dir, "documents"))

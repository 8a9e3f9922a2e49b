"""Media columns in content-defined chunks.

A payload is stored as an 8-bit mono WAV. Its bytes are cut where a rolling gear hash of the last 32 bytes has enough
zero bits, so equal passages give equal chunks wherever they stand. A chunk's SHA-256 names it. Spark finds for each
digest its first place (the owner); only the owner's row stores the bytes, all others keep the digest in their
ordered chunk list. To read, the bytes of chunks that other rows need are joined in by digest.

Chunk bytes that nobody else has never leave their row, so dedup shuffles digests, and reading shuffles only the
bytes that are shared.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import LAST_ID, bounded, materialize, scratch_path, table

UNIT = 576
LEAST, MASK_BITS, MOST = 512, 11, 16_384
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def payload(text: str | None) -> bytes:
    """UTF-8, then bytes 255 up to a positive multiple of 576."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


def wav(samples: bytes, rate: int = 8000) -> bytes:
    """8-bit unsigned mono PCM; an even number of samples needs no pad byte."""
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples


def samples(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[36:40] != b"data" or struct.unpack("<I", media[40:44])[0] != len(media) - 44:
        raise ValueError("not a WAV of this form")
    return media[44:]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks: where the gear hash has its ``MASK_BITS`` top bits zero, at least ``LEAST`` and at most
    ``MOST`` bytes apart. The hash sum(gear[b[i-k]] << k) over 32 bytes is built by doubling."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
    at = (np.nonzero(h < np.uint32(1 << (32 - MASK_BITS)))[0] + 1).tolist()
    out, last, n = [], 0, len(data)
    for p in at:
        while p - last > MOST:
            last += MOST
            out.append(last)
        if p - last >= LEAST and p < n:
            out.append(p)
            last = p
    while n - last > MOST:
        last += MOST
        out.append(last)
    return [*out, n]


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _keys(id_col: str, text_col: str) -> list[Column]:
    parts = [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), F.coalesce(F.col(text_col).cast("string"), F.lit(""))]
    return [F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit("2"), *parts).alias("r2")]


def chunk_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, r1, r2, seq, digest): the chunks of every row, without their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [[hashlib.sha256(c).digest() for c in chunks(wav(payload(t)))] for t in b.column(3).to_pylist()]
            n = np.array([len(x) for x in lists])
            rows = pa.array(np.repeat(np.arange(b.num_rows), n))
            seq = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in b.columns[:3]), pa.array(seq.astype(np.int32)), pa.array([d for x in lists for d in x], pa.binary())], names=["id", "r1", "r2", "seq", "digest"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), *_keys(id_col, text_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "id long, r1 long, r2 long, seq int, digest binary")


def write_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``path/lists`` (one row per row of ``docs``: id, its chunk digests in order, the bytes of the chunks it
    owns) and ``path/borrowed`` (which rows take which chunks from others)."""
    spark = docs.sparkSession
    places = materialize(chunk_places(docs, id_col, text_col), "media-places")
    owners = places.groupBy("digest").agg(F.min(F.struct("id", "r1", "r2", "seq")).alias("owner"), F.count("*").alias("n")).where("n > 1").select("digest", "owner")
    borrowed = places.join(owners, "digest").where("owner <> struct(id, r1, r2, seq)").select("r1", "r2", "seq", "digest").distinct()
    borrowed.write.option("compression", "zstd").parquet(f"{path}/borrowed")
    borrowed = spark.read.parquet(f"{path}/borrowed")
    takes = materialize(borrowed.groupBy("r1", "r2").agg(F.collect_set("seq").alias("takes")), "media-takes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                digests, own = [], []
                for t, s in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                    parts, s = chunks(wav(payload(t))), set(s or ())
                    digests.append([hashlib.sha256(c).digest() for c in parts])
                    own.append([None if i in s else c for i, c in enumerate(parts)])
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(digests, pa.list_(pa.binary())), pa.array(own, pa.list_(pa.binary()))], names=["doc_id", "r1", "r2", "digests", "own"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    joined = rows.join(bounded(takes, takes.count(), 200_000), ["r1", "r2"], "left").select("doc_id", "r1", "r2", "text", "takes")
    joined.mapInArrow(run, "doc_id long, r1 long, r2 long, digests array<binary>, own array<binary>").write.option("compression", "zstd").parquet(f"{path}/lists")


def read_media(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, digests, parts): every stored row with the bytes of all its chunks in order."""
    lists, borrowed = spark.read.parquet(f"{path}/lists"), spark.read.parquet(f"{path}/borrowed")
    takers = F.exists("own", lambda c: c.isNull())
    wanted = materialize(borrowed.select("digest").distinct(), "media-wanted")
    stored = lists.select(F.explode(F.filter(F.arrays_zip("digests", "own"), lambda c: c["own"].isNotNull())).alias("c")).select(F.col("c.digests").alias("digest"), F.col("c.own").alias("bytes"))
    lent = stored.join(bounded(wanted, wanted.count(), 200_000), "digest", "left_semi").dropDuplicates(["digest"])
    filled = borrowed.join(lent, "digest").groupBy("r1", "r2").agg(F.map_from_entries(F.collect_list(F.struct("seq", "bytes"))).alias("got"))
    whole = lists.where(~takers).select("doc_id", "digests", F.col("own").alias("parts"))
    mixed = lists.where(takers).join(filled, ["r1", "r2"], "left")
    parts = F.transform("own", lambda c, i: F.coalesce(c, F.try_element_at("got", i)))
    return whole.unionByName(mixed.select("doc_id", "digests", parts.alias("parts")))


def describe(rows: DataFrame) -> DataFrame:
    """Reassembles, verifies and measures what ``read_media`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for digests, parts in zip(b.column(1), b.column(2)):
                digests, parts = digests.as_py(), parts.as_py()
                if None in parts or any(hashlib.sha256(p).digest() != d for d, p in zip(digests, parts)):
                    raise ValueError("a chunk is missing or damaged")
                media = b"".join(parts)
                data = samples(media)
                x = np.frombuffer(data, np.uint8).astype(np.int64)
                turns = int((np.diff((x >= 128).astype(np.int8)) != 0).sum())
                feature = f"mean={int(x.sum()) * 1000 // len(x)};power={int((x * x).sum()) // len(x)};turns={turns};peak={int(x.max())};chunks={len(parts)}"
                out.append((len(data.rstrip(b"\xff")), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return rows.select("doc_id", "digests", "parts").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def media_columns(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every row's text and describes what is read back.

    Defined cases: a null text is empty, an empty one is 576 bytes 255; repeated rows and null ids each give a row
    (rows that agree in id and text are one place, so each of them stores what that place owns); very long texts have
    as many chunks as they need; an empty table gives an empty result; other columns are ignored.
    """
    write_media(docs, path, id_col, text_col)
    return describe(read_media(docs.sparkSession, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"), scratch_path(spark, "media"))

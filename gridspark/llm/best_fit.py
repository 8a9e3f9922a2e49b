"""Packing of whole documents by bounded-space online best-fit.

A fixed number of sequences is open at a time. A bitset has a bit for each amount of free space that an open sequence has, so
the one with the least space that still holds a document is the lowest bit from the document's length on. Where none holds
it, a new sequence opens; if that is one too many, the fullest closes first. A document's place is known as soon as it
comes, so rows stream through a task, and what a task holds is the open sequences.

Documents come in random windows of as many pieces as sequences may be open, each window from the longest piece to the
shortest: then short ones fill what long ones leave, and no sequence closes before its window's short pieces have come. A
document longer than a sequence is cut into full sequences, with the shorter piece first.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import materialize, table
from gridspark.llm.packing import steps, tokenizer_path

LENGTH = 1024
END_ID = 2
#: Sequences open at a time in a task.
OPEN = 4096
#: Pieces that are packed by one task, about; a task's last open sequences stay as they are, so fewer tasks waste less.
PIECES = 50_000
#: Distinct chunks kept in a generation.
CHUNKS_KEPT = 250_000

#: White space that only Unicode counts as such, as UTF-8, and control characters that separate lines.
_ODD_SPACE = "[\x0b\x0c\x1c-\x1f\u0085   -     　]"


class ChunkIds:
    """Token ids of texts under a byte-level vocabulary. Its units never go on from other characters into white space, nor
    from letters into other characters, so a text may be cut there into chunks that are tokenized alone: chunks are
    numbered by Arrow and each distinct one is looked up once. Known chunks live in two generations: when the young one
    is full it becomes the old one, whose chunks return when they are met again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("ids must fit two bytes")
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # Ids of tokens that begin with a space: in chunks of a space and letters they are the first ones.
        self.begins = np.zeros(65536, bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as 16-bit numbers, each text's followed by the end id, and the offsets of the texts."""
        chunks, first = chunks_of(texts)
        numbered = chunks.dictionary_encode()
        # One more chunk, the last, stands for the end of a text.
        raw = pa.array([*self.ids_of(numbered.dictionary.to_pylist()), END_ID.to_bytes(2, "little")], pa.large_binary())
        chunk = np.insert(numbered.indices.to_numpy(zero_copy_only=False), first[1:], len(raw) - 1)
        got = raw.take(pa.array(chunk))
        upto = np.frombuffer(got.buffers()[1], np.int64) // 2
        return np.frombuffer(got.buffers()[2], "<u2")[: upto[len(chunk)]], upto[first + np.arange(len(first))]

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.known) > CHUNKS_KEPT:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        new = [c for c in chunks if c not in known]
        known.update((c, old[c]) for c in new if c in old)
        self.learn([c for c in new if c not in known])
        return [known[c] for c in chunks]

    def learn(self, chunks: list[bytes]) -> None:
        """Adds chunks. Those of a space and letters go many at once through the tokenizer as one text, whose ids are cut
        before each id that begins with a space."""
        each = pa.array(chunks, pa.binary())
        plain = pc.match_substring_regex(each.cast(pa.string()), _PLAIN)
        self.together(each.filter(plain).to_pylist())
        self.singly(each.filter(pc.invert(plain)).to_pylist())

    def together(self, chunks: list[bytes]) -> None:
        for lo in range(0, len(chunks), 100_000):
            some = chunks[lo : lo + 100_000]
            texts = [b"".join(some[i : i + 200]).decode() for i in range(0, len(some), 200)]
            ids = np.concatenate([np.array(e.ids, "<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            at = (2 * np.flatnonzero(self.begins[ids])).tolist()
            if len(at) != len(some):
                self.singly(some)
            else:
                raw = ids.tobytes()
                self.known.update((c, raw[i:j]) for c, i, j in zip(some, at, [*at[1:], len(raw)]))

    def singly(self, chunks: list[bytes]) -> None:
        for c, e in zip(chunks, self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)):
            self.known[c] = np.array(e.ids, "<u2").tobytes()


#: A space and letters below U+0100.
_PLAIN = r"^ [a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
_LETTER, _OTHER = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER[33:127] = ~_LETTER[33:127]


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts over the texts' own bytes, and where each text's begin (and the last ones end). A text with white space
    other than that of ASCII is one chunk."""
    large = pa.large_string()
    texts = pc.binary_join_element_wise(texts.cast(large).fill_null(""), pa.scalar("", large), pa.scalar("", large))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[: int(offsets[-1])] if len(texts) and offsets[-1] else np.zeros(0, np.uint8)
    space = (raw == 32) | (raw == 10) | (raw == 9) | (raw == 13)
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | (_LETTER[raw[:-1]] & _OTHER[raw[1:]])
    odd = np.flatnonzero(pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False))
    for i in odd:
        cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets] = True
    cuts = np.flatnonzero(cut)
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)])
    return chunks, np.searchsorted(cuts, offsets)


@functools.cache
def chunk_ids(path: str) -> ChunkIds:
    """One a Python worker, which serves many tasks."""
    return ChunkIds(path)


def encoded(docs: DataFrame, id_col: str, text_col: str, path: str, length: int) -> DataFrame:
    """(id, piece, start, ids): the pieces of every document, ids as little-endian 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = chunk_ids(path)
        for b in (s for whole in batches for s in steps(whole, 1)):
            ids, offsets = cache.encode(b.column(1))
            total = np.diff(offsets)
            pieces = -(-total // length)
            row = np.repeat(np.arange(b.num_rows), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.maximum(piece * length - (-total[row] % length), 0)
            cuts = np.append(offsets[:-1][row] + start, offsets[-1:])
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer((cuts * 2).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), packed.cast(pa.binary())], names=["id", "piece", "start", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, piece int, start long, ids binary")


class Bins:
    """The open sequences, by free space."""

    def __init__(self, length: int, most: int, serial: int):
        self.length, self.most, self.serial = length, most, serial
        self.free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits, self.count = 0, 0

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece: the fullest open sequence that holds it, or else a new one."""
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            sequence = self.free[space].pop()
            if not self.free[space]:
                self.bits ^= 1 << space
            self.count -= 1
        else:
            space, sequence = self.length, self.serial
            self.serial += 1
        left = space - size
        if left:
            if self.count == self.most:
                self.close()
            self.free[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
        return sequence, self.length - space

    def close(self) -> None:
        least = (self.bits & -self.bits).bit_length() - 1
        self.free[least].pop()
        if not self.free[least]:
            self.bits ^= 1 << least
        self.count -= 1


def best_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, most: int = OPEN) -> DataFrame:
    """One row per piece: ``id, piece, start, ids, sequence_id, offset``; ``ids`` are little-endian 32-bit numbers. ``most`` sequences are open
    at a time in each task.

    Pieces are written once and dealt to tasks and windows by a hash of their place in that table, not by their id, so that
    a document that repeats very often is spread, and a task that runs again gives the same rows.

    Defined cases: null and empty texts are one end token; repeated rows and null ids are packed like others; other columns are
    ignored, whatever their names; a text longer than a sequence is cut; an empty table gives no pieces.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    rows = materialize(encoded(docs, id_col, text_col, path, length), "best-fit-pieces").withColumn("size", F.octet_length("ids"))
    short = rows.where(F.col("size") < 2 * length).count()
    tasks = -(-short // PIECES) or 1
    windows = -(-short // (tasks * most)) or 1
    placed = rows.withColumn("place", F.xxhash64(F.monotonically_increasing_id())).withColumn("window", F.pmod(F.shiftright("place", 32), F.lit(windows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = Bins(length, most, TaskContext.get().partitionId() << 40)
        for b in batches:
            offsets = np.frombuffer(b.column(3).buffers()[1], np.int32)[b.column(3).offset :][: b.num_rows + 1] if b.num_rows else np.zeros(1, np.int32)
            at = [bins.place(n) for n in (np.diff(offsets) // 2).tolist()]
            sequence, offset = (pa.array(x, pa.int64()) for x in (zip(*at) if at else ((), ())))
            raw = np.frombuffer(b.column(3).buffers()[2], "<u2")[offsets[0] // 2 : offsets[-1] // 2] if at else np.zeros(0, "<u2")
            wide = pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(2 * (offsets - offsets[0])), pa.py_buffer(raw.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), wide, sequence, offset], names=["id", "piece", "start", "ids", "sequence_id", "offset"])

    dealt = placed.repartition(tasks, "place").sortWithinPartitions("window", F.desc("size"), "place")
    return dealt.select("id", "piece", "start", "ids").mapInArrow(run, "id long, piece int, start long, ids binary, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    packed = best_fit(table(spark, sf_dir, "documents"))
    length = (F.octet_length("ids") / 4).cast("long")
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")

"""Packing of documents into sequences along a Hilbert curve.

A document's token counts are a hashed vector (one place a token id); a fixed random projection takes it to a few
dimensions and its direction there is the point whose Hilbert key orders the documents. Spark range-sorts by that
key, so neighbours on the curve share a sequence. Within a range the documents form one stream of tokens that is cut
every ``length`` tokens; the rest at its end is cut to powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import materialize, table

LENGTH = 4096
END_ID = 2
DIMENSIONS = 3
BITS = 16
WORDS_KEPT = 200_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCache:
    """Token ids of texts. White space always ends a token in this vocabulary, so a text is cut into words, the words
    of many texts are numbered by Arrow, and each distinct word is looked up once; only words not met before are
    tokenized. Words live in two generations: when the young one is full it becomes the old one, whose words return
    when they are met again; the rest go."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("ids must fit two bytes")
        self.known[b""] = b""
        self.is_end = np.zeros(65536, bool)
        self.is_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id; the offsets of the texts; and each text's projected counts."""
        words, per_text = cut_words(texts)
        numbered = words.dictionary_encode()
        raw = self.ids_of([w.rstrip(_SPACE) for w in numbered.dictionary.to_pylist()])
        # One more word, the last, stands for the end of a text.
        ids = np.frombuffer(b"".join([*raw, struct.pack("<H", END_ID)]), dtype="<u2")
        size = np.array([*map(len, raw), 2], dtype=np.int64) // 2
        first = np.cumsum(size) - size
        ends = np.cumsum(per_text)
        word = np.insert(numbered.indices.to_numpy(), ends, len(raw))
        at = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        # The ids of all words in order: each is one further than the one before it but where a word begins.
        n = size[word]
        upto = np.cumsum(n)
        some = n > 0
        begins, n_some = first[word[some]], n[some]
        step = np.ones(int(n.sum()), dtype=np.int32)
        if len(begins):
            step[np.cumsum(n_some)[:-1]] = begins[1:] - begins[:-1] - n_some[:-1] + 1
            step[0] = begins[0]
        out = ids[np.cumsum(step, out=step)]
        offsets = np.concatenate([[0], upto[at[1:] - 1]]) if len(at) > 1 else np.zeros(1, np.int64)
        # Counts are projected word by word; the numbers are whole, so sums don't depend on their order. The end of a
        # text and words without ids weigh nothing.
        table = projection()
        points = np.zeros((len(texts), DIMENSIONS))
        used = np.flatnonzero(size[:-1])
        for d in range(DIMENSIONS if len(texts) else 0):
            weight = np.zeros(len(size), np.int64)
            if len(used):
                weight[used] = np.add.reduceat(table[d][ids[:-1]], first[used])
            points[:, d] = np.add.reduceat(weight[word], at[:-1])
        return out, offsets, points

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:
            self.known, self.old = {b"": b""}, self.known
        known, old = self.known, self.old
        new = dict.fromkeys(w for w in words if w not in known)
        if new:
            known.update((w, old[w]) for w in new if w in old)
            self.learn([w for w in new if w not in known])
        return [known[w] for w in words]

    def learn(self, words: list[bytes]) -> None:
        """Adds words to the young generation. A word of plain letters, with ASCII marks after it or not, is its letters
        in lower case and those marks; letters are one unit of the tokenizer, and so are the marks. Many such units
        go through it as one text, whose ids are cut behind each id that ends a unit. All other words go one by one."""
        text = pa.array(words, pa.binary()).cast(pa.string())
        is_plain = pc.match_substring_regex(text, _PLAIN)
        core = pc.utf8_rtrim(text.filter(is_plain), characters=_MARKS)
        plain = pa.array(words, pa.binary()).filter(is_plain).to_pylist()
        cores = pc.utf8_lower(core).cast(pa.binary()).to_pylist()
        marks = [w[n:] for w, n in zip(plain, pc.binary_length(core).to_pylist())]
        self.units([u for u in dict.fromkeys([*cores, *set(marks)]) if u not in self.known])
        self.singly(pa.array(words, pa.binary()).filter(pc.invert(is_plain)).to_pylist())
        known = self.known
        known.update((w, known[c] + known[m]) for w, c, m in zip(plain, cores, marks))

    def units(self, units: list[bytes]) -> None:
        for lo in range(0, len(units), 100_000):
            some = units[lo : lo + 100_000]
            texts = [b" ".join(some[i : i + 200]).decode() for i in range(0, len(some), 200)]
            ids = np.concatenate([np.array(e.ids, dtype="<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = (2 * np.flatnonzero(self.is_end[ids]) + 2).tolist()
            if len(ends) != len(some):
                self.singly(some)
            else:
                raw = ids.tobytes()
                self.known.update((u, raw[i:j]) for u, i, j in zip(some, [0, *ends], ends))

    def singly(self, words: list[bytes]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)):
            self.known[w] = struct.pack(f"<{len(e.ids)}H", *e.ids)


#: Letters below U+0100, whose lower case has one letter too, and ASCII marks.
_PLAIN = r"^[a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+[!-/:-@\[-`{-~]*$"
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = b" \n\t\r"


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, each with the white space behind it, over the texts' own bytes; and their number in each."""
    # One line feed behind each text: then every word ends in white space, an empty one too.
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[: int(offsets[-1])] if len(texts) else np.zeros(0, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10) | (raw == 9) | (raw == 13)) + 1
    cuts = np.concatenate([[0], ends])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
    return words, np.diff(np.searchsorted(cuts, offsets))


@functools.cache
def word_cache(path: str) -> WordCache:
    """One a Python worker, which serves many tasks."""
    return WordCache(path)


@functools.cache
def projection() -> np.ndarray:
    """Fixed random directions, one place a token id; whole numbers."""
    return np.round(np.random.default_rng(7).standard_normal((DIMENSIONS, 65536)) * 2**20).astype(np.int64)


def places(points: np.ndarray) -> np.ndarray:
    """Hilbert keys of the directions in which the points lie."""
    v = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1)
    return hilbert_keys(((np.round(v, 6) + 1) / 2 * (2**BITS - 1)).astype(np.int64), BITS)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions of integer points (n, d) on the Hilbert curve over (2**bits)**d, by Skilling's transform."""
    x = points.astype(np.uint64).T.copy()
    d = len(x)
    one = np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - one
        for i in range(d):
            hit = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            x[i] = np.where(hit, x[i], x[i] ^ t)
        q >>= one
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


#: Bytes of text that one step of numpy work takes; a longer text is a step of its own.
STEP_BYTES = 6_000_000


def steps(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(sizes.astype(np.int64)), 0
    while lo < b.num_rows:
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + STEP_BYTES, "right")))
        yield b.slice(lo, hi - lo)
        lo = hi


def encoded(docs: DataFrame, id_col: str, text_col: str, path: str, length: int = LENGTH) -> DataFrame:
    """(id, key, start, total, ids): every document's token ids as little-endian 16-bit numbers, in parts of at most
    ``length`` ids so that a long document is many rows, and its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path)
        for b in (s for whole in batches for s in steps(whole, 1)):
            ids, offsets, points = cache.encode(b.column(1))
            total = np.diff(offsets)
            parts = -(-total // length)
            row = np.repeat(np.arange(b.num_rows), parts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            cuts = np.append(offsets[:-1][row] + start, offsets[-1:])
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer((cuts * 2).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))])
            keys = places(points)[row]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(keys), pa.array(start), pa.array(total[row]), packed.cast(pa.binary())], names=["id", "key", "start", "total", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, key long, start long, total long, ids binary")


def powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_stream(parts: Iterator[tuple[int | None, int, int, np.ndarray]], first_sequence: int, length: int) -> Iterator[tuple]:
    """Pieces of one stream of (id, start, its document's ids, ids): full sequences first, then the rest in powers of
    two."""
    sequence, used = first_sequence, 0
    open_: list[tuple[int | None, int, np.ndarray, int]] = []

    def piece(doc: int | None, start: int, ids: np.ndarray, total: int, seq: int, offset: int) -> tuple:
        return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, seq, offset

    def close(parts: list, sizes: list[int], seq: int) -> Iterator[tuple]:
        offset, left = 0, sizes.pop(0)
        for doc, start, ids, total in parts:
            at = 0
            while at < len(ids):
                n = min(left, len(ids) - at)
                yield piece(doc, start + at, ids[at : at + n], total, seq, offset)
                at, offset, left = at + n, offset + n, left - n
                if not left and sizes:
                    seq, offset, left = seq + 1, 0, sizes.pop(0)

    for doc, start, total, ids in parts:
        at = 0
        while at < len(ids):
            n = min(length - used, len(ids) - at)
            open_.append((doc, start + at, ids[at : at + n], total))
            at, used = at + n, used + n
            if used == length:
                yield from close(open_, [length], sequence)
                open_, used, sequence = [], 0, sequence + 1
    if used:
        yield from close(open_, powers(used), sequence)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Defined cases: null and empty texts are one end token; repeated rows and null ids are packed like others (ties on
    the curve are ordered by id and then by the row's place in the table of ids, so that many equal rows are cut into
    ranges too); very long documents are cut over many sequences and may lie in several ranges; an empty table gives
    no pieces. ``length`` must be a power of two.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("length must be a power of two")
    path = path or tokenizer_path()
    rows = materialize(encoded(docs, id_col, text_col, path, length), "packing-ids").withColumn("place", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def stream() -> Iterator[tuple[int | None, int, int, np.ndarray]]:
            for b in batches:
                for doc, start, total, raw in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3)):
                    yield doc, start, total, np.frombuffer(raw.as_buffer(), dtype="<u2")

        held = []
        for p in pack_stream(stream(), TaskContext.get().partitionId() << 40, length):
            held.append(p)
            if len(held) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PIECES)], schema=_PIECES)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PIECES)], schema=_PIECES)

    order = ("key", "id", "start", "place")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "start", "total", "ids")
    return ordered.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

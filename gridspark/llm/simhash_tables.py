"""Near-duplicates by similarity of word shingles: SimHash finds most candidates, rare shingles the rest, the sets decide.

Two texts whose shingle sets have similarity s differ in each SimHash bit with probability acos(2s / (1 + s)) / pi: at
0.8 that is 0.15, so 64 bits are far apart in most pairs. A signature has 256 bits, and a table files it under the
masked bit pattern of some of them. The patterns have a bit more for each doubling of the texts, so a key keeps a few
chance texts whatever the input, and there are as many tables as it takes to find ``RECALL`` of the pairs at similarity
0.8 (by the formula; 0.998 at 0.85; fewer of very short texts, whose bits differ more). Below a key, signatures are searched as in ``gray_index``: in Gray order, in a tree
whose groups are dropped by their accumulated differences over the first 128 bits.

A key with more texts than a task should hold (variants of one text) is dealt out in Gray order; each part is searched
alone, and one text of each of its components goes on to the next round, until the rest fits. What doesn't shrink so
(unlike texts) is cut into blocks, and each pair of blocks is searched.

Candidates are verified on the shingle sets themselves: only pairs of similarity ``SIMILAR`` or more are edges. The first
tables are verified and joined before the others are searched, and these give no candidates that are joined already. Of
a key with more than a few texts only a forest is verified, nearest pairs first. A second look then takes the keys whose
forests were not confirmed: of their candidates whose ends are still apart those that a longer fingerprint holds likely
are verified too; so no group gives all of its pairs.

All this is by chance and only joins most texts early. The last search (``missed``) loses none: it takes an order of all
shingles, and two sets of the similarity share one among the first of either (a fifth of it and one more). Texts of different
roots that share such a shingle are candidates, unless their sizes or parities show that the sets differ too much.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import LAST_ID, bounded, materialize, unused
from gridspark.llm.components import connected_components
from gridspark.llm.gray_index import Tree, Unions, distance, sized, small_pairs, whole_groups
from gridspark.llm.simhash_dedup import shingle_hashes

WORDS, LANES = 5, 4
#: At least this similarity, as a fraction.
SIMILAR = (4, 5)
#: Share of the pairs at that similarity that the tables find at least, by the formula.
RECALL = 0.98
#: Of the 128 bits that are compared 19.4 differ at 0.8, with a deviation of 4.06; four of them are allowed for.
LIMIT = 36
#: Bits within which two texts have a similarity of some 0.92.
CLOSE = 12
#: Bits of the longer fingerprint that the second look compares, and how many may differ: 151 at 0.8, with a deviation of
#: 11.3, of which four are allowed for; 213 differ at 0.66 and 236 at 0.6.
SKETCH_BITS, SKETCH_LIMIT = 1024, 196
#: Bits of the parities, by which the last search drops pairs that can't have the similarity.
PARITY_BITS = 2048
#: Shingles that over two in a ``SAMPLE``-th of the texts have go last in the order, at most so many.
FREQUENT, SAMPLE = 1 << 18, 16
#: Texts of one key that a task holds.
RUN = 8192
#: Keys of up to so many texts give all their candidates.
FEW = 8
#: Tables that are verified before the others are searched.
FIRST = 2
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)


def plan(n: int) -> tuple[int, int]:
    """Bits of a pattern and number of tables for ``n`` texts: by chance, a key has 32 to 64 of them."""
    bits = min(max(8, math.ceil(math.log2(max(n, 2))) - 6), 48)
    total = 64 * LANES
    p, q = SIMILAR
    differs = math.acos(2 * p / (p + q)) / math.pi
    weight = [math.comb(total, d) * differs**d * (1 - differs) ** (total - d) for d in range(total - bits + 1)]
    equal = [math.comb(total - d, bits) / math.comb(total, bits) for d in range(total - bits + 1)]
    found = lambda tables: sum(w * (1 - (1 - e) ** tables) for w, e in zip(weight, equal))
    low, high = 1, 2
    while found(high) < RECALL:
        low, high = high, 2 * high
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if found(mid) >= RECALL else (mid + 1, high)
    return bits, low


def patterns(bits: int, tables: int) -> np.ndarray:
    """(signature bits, tables): what each bit weighs in each table's key; every table has ``bits`` bits of its own."""
    rng = np.random.default_rng(13)
    out = np.zeros((64 * LANES, tables))
    for t in range(tables):
        out[rng.choice(64 * LANES, bits, replace=False), t] = 2.0 ** np.arange(bits)
    return out


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingles; none for a text without words."""
    return np.unique(shingle_hashes(text, WORDS))


def signature(h: np.ndarray) -> np.ndarray:
    """Four 64-bit lanes over the distinct shingles; zero without any."""
    ones = np.zeros((LANES, 64), dtype=np.int64)
    for part in np.array_split(h, -(-len(h) // 16384) or 1):
        for k in range(LANES):
            with np.errstate(over="ignore"):
                x = (part ^ _ODD[k]) * _ODD[(k + 1) % LANES]
                x ^= x >> np.uint64(29)
                x *= _ODD[(k + 2) % LANES]
                x ^= x >> np.uint64(32)
            ones[k] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), axis=1, bitorder="little").view("<u8").ravel() if len(h) else np.zeros(LANES, np.uint64)


def sketch(h: np.ndarray) -> bytes:
    """A longer fingerprint over the distinct shingles, of bits of its own."""
    ones = np.zeros((SKETCH_BITS // 64, 64), dtype=np.int64)
    for part in np.array_split(h, -(-len(h) // 4096) or 1):
        for k in range(len(ones)):
            with np.errstate(over="ignore"):
                x = part + np.uint64(0x9E3779B97F4A7C15 * (k + 5) % 2**64)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x ^= x >> np.uint64(31)
            ones[k] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), axis=1, bitorder="little").tobytes()


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own, key, text): own and key name a row, rows of the same id and text alike."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("id", F.coalesce("id", F.lit(LAST_ID)).alias("own"), F.xxhash64("text").alias("key"), "text")


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own, key, vid, sig): vid names the set of shingles; sig is the lanes and the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vid, sigs = np.zeros(b.num_rows, dtype=np.uint64), []
            for i, t in enumerate(b.column(3).to_pylist()):
                h = shingles(t)
                vid[i] = xxhash.xxh64_intdigest(h.astype("<u8").tobytes(), 7)
                sigs.append(np.append(signature(h), np.uint64(len(h))).astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(vid.view(np.int64)), pa.array(sigs, pa.binary())], names=["id", "own", "key", "vid", "sig"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "id long, own long, key long, vid long, sig binary")


def unpacked(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), "<u8").reshape(-1, LANES + 1)


def filed(sigs: DataFrame, bits: int, tables: int, slots: range) -> DataFrame:
    """(slot, key, vid, root, s0, s1): every signature under its pattern in each of the tables ``slots``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = patterns(bits, tables)[:, slots.start : slots.stop]
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                n, sig = b.num_rows, unpacked(b.column(2).to_pylist())[:, :LANES]
                on = np.unpackbits(np.ascontiguousarray(sig).view(np.uint8), axis=1, bitorder="little")
                keys = (on.astype(np.float64) @ weights).astype(np.int64)
                again = pa.array(np.tile(np.arange(n), len(slots)))
                lanes = [pa.array(np.ascontiguousarray(sig[:, i]).view(np.int64)).take(again) for i in (0, 1)]
                slot = pa.array(np.repeat(np.arange(slots.start, slots.stop, dtype=np.int32), n))
                yield pa.RecordBatch.from_arrays([slot, pa.array(keys.T.ravel()), b.column(0).take(again), b.column(1).take(again), *lanes], names=["slot", "key", "vid", "root", "s0", "s1"])

    return sigs.select("vid", "root", "sig").mapInArrow(run, "slot int, key long, vid long, root long, s0 long, s1 long")


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("run", pa.int64()), ("members", pa.list_(pa.int64())), ("lanes", pa.list_(pa.int64())), ("slot", pa.int32()), ("key", pa.int64()), ("vid", pa.int64()), ("root", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64())])
_FOUND_SQL = "a long, b long, run long, members array<long>, lanes array<long>, slot int, key long, vid long, root long, s0 long, s1 long"


def _found(**columns: np.ndarray) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)


def searched(batches: Iterator[pa.RecordBatch], serial: int, parts: bool, run: int, few: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slot and key -> candidates (a, b) of different roots: all of a key of up to ``few`` texts, a forest of a larger one;
    and of a larger one also a row with its members and their lanes (run, members, lanes) for a second look. With
    ``parts``, keys go on in other tasks: each part of ``run`` rows also gives one row of each of its components
    (slot, key, vid, root, s0, s1)."""
    from pyspark import TaskContext

    serial = (serial << 57) + (TaskContext.get().partitionId() << 25)
    for group, (slot, key, vid, root, s0, s1) in whole_groups(batches, 2, run if parts else 4 * run):
        codes = np.stack([s0, s1], axis=1).view(np.uint64)
        is_small, large = sized(group, 0 if parts else few)
        at = np.nonzero(is_small)[0]
        x, y = small_pairs(group[at], codes[at], LIMIT)
        x, y = at[x], at[y]
        new = root[x] != root[y]
        yield _found(a=vid[x[new]], b=vid[y[new]])
        for lo, hi in ((a, min(a + run, hi)) for lo, hi in large for a in range(lo, hi, run)) if parts else large:
            unions, tree = Unions(hi - lo), Tree(codes[lo:hi])
            _, first, member = np.unique(root[lo:hi], return_index=True, return_inverse=True)
            unions.join(np.arange(hi - lo), first[member])
            before = unions.root
            found = [tree.forest(radius, unions)[:2] for radius in (CLOSE, LIMIT // 2, LIMIT)]
            x, y = starred(vid[lo:hi], codes[lo:hi], unions.root, *(np.concatenate(side) for side in zip(*found)))
            new = before[x] != before[y]
            x, y = x[new], y[new]
            yield _found(a=vid[lo + x], b=vid[lo + y])
            # Components of several roots and more than two texts.
            mixed = np.zeros(hi - lo, bool)
            mixed[unions.root[x]] = True
            some = lo + np.nonzero(mixed[unions.root] & (np.bincount(unions.root, minlength=hi - lo)[unions.root] > 2))[0]
            serial += 1
            if len(some):
                yield _found(run=[serial], members=[vid[some]], lanes=[np.stack([s0[some], s1[some]], axis=1).ravel()])
            if parts:
                one = lo + np.unique(unions.root)
                yield _found(slot=slot[one], key=key[one], vid=vid[one], root=root[one], s0=s0[one], s1=s1[one])


def starred(vid: np.ndarray, codes: np.ndarray, root: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of a forest, where texts close to the least one of their component link to that one instead: tables that
    find the same texts then give the same links, and these are counted once."""
    order = np.lexsort((vid, root))
    first = order[np.concatenate([[True], root[order][1:] != root[order][:-1]])]
    center = np.zeros(len(root), np.int64)
    center[root[first]] = first
    center = center[root]
    close = distance(codes, codes[center]) <= CLOSE
    to = np.flatnonzero(close & (center != np.arange(len(root))))
    rest = ~(close[x] & close[y])
    return np.concatenate([center[to], x[rest]]), np.concatenate([to, y[rest]])


def candidates(classes: DataFrame, bits: int, tables: int, slots: range, run: int = RUN, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """``classes(vid, root, sig)`` -> distinct candidates (a, b) of the tables ``slots``, and runs (run, members, lanes) of larger keys."""
    rows = filed(classes, bits, tables, slots)
    # Keys of over ``run`` texts show in a 64th of the texts; those that don't still fit a task, which holds four times as many.
    hot = filed(classes.where(F.pmod("vid", F.lit(64)) == 5), bits, tables, slots).groupBy("slot", "key").count().where(F.col("count") > run // 128).select("slot", "key")
    hot = materialize(hot, "simhash-hot-keys")
    n_hot = hot.count()
    # Of each search its own part of the run numbers.
    base, columns = 32 if slots.start else 0, ["slot", "key", "vid", "root", "s0", "s1"]
    out, serial = [], base
    if n_hot:
        parts = materialize(rows.join(bounded(hot, n_hot), ["slot", "key"], "left_semi"), "simhash-hot-rows")
        rows, before = rows.join(bounded(hot, n_hot), ["slot", "key"], "left_anti"), parts.count()
        while True:
            serial += 1
            dealt = parts.withColumn("rank", gray_column()).repartitionByRange("slot", "key", "rank", "vid").sortWithinPartitions("slot", "key", "rank", "vid").select(*columns)
            found = materialize(dealt.mapInArrow(lambda batches, n=serial: searched(batches, n, True, run, few), _FOUND_SQL), "simhash-parts")
            out.append(found)
            left = found.where("slot is not null").select(*columns)
            large = materialize(left.groupBy("slot", "key").count().where(F.col("count") > run).select("slot", "key", F.ceil(2 * F.col("count") / run).cast("int").alias("blocks")), "simhash-hot-keys")
            n_large, size = large.count(), left.count()
            rows = rows.unionByName(left.join(bounded(large, n_large), ["slot", "key"], "left_anti"))
            if not n_large:
                break
            parts = left.join(bounded(large, n_large), ["slot", "key"])
            if 2 * size > before:
                rows = rows.unionByName(block_pairs(parts).select(*columns))
                break
            parts, before = materialize(parts.select(*columns), "simhash-hot-rows"), size
    dealt = rows.repartition("slot", "key").sortWithinPartitions("slot", "key")
    out.append(materialize(dealt.mapInArrow(lambda batches: searched(batches, base, False, run, few), _FOUND_SQL), "simhash-found"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    pairs = found.where("a is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return materialize(pairs, "similar-candidates"), found.where("run is not null").select("run", "members", "lanes")


def block_pairs(rows: DataFrame) -> DataFrame:
    """Rows of keys that are cut into ``blocks``: a row for each pair of blocks that its own is in, the pair being a key of its own."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
    each = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return each.withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))


def gray_column() -> Column:
    """Gray rank of the signature's bits as an ordered long; each table begins with other bits."""
    turn = F.expr("(slot * 23) % 64")
    x = F.when(F.col("slot") % 2 == 0, F.col("s0")).otherwise(F.col("s1"))
    x = F.call_function("shiftleft", x, turn).bitwiseOR(F.call_function("shiftrightunsigned", x, (64 - turn) % 64))
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x.bitwiseXOR(F.lit(-(2**63)))


def still_apart(runs: DataFrame, roots: DataFrame, sketched: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidates (a, b) of large groups whose ends have different roots and whose longer fingerprints are close: the likely ones,
    ``missed`` gives the others. ``sketched`` gives (vid, sketch) of wanted texts (vid)."""
    rooted = runs.select("run", F.explode("members").alias("vid")).join(roots.select(F.col("node").alias("vid"), "root"), "vid", "left").select("run", "vid", F.coalesce("root", "vid").alias("root"))
    mixed = rooted.groupBy("run").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("run")
    # The lanes of mixed runs only.
    lanes = runs.join(mixed, "run", "left_semi").select("run", F.posexplode("members").alias("i", "vid"), "lanes").select("run", "vid", F.get("lanes", 2 * F.col("i")).alias("s0"), F.get("lanes", 2 * F.col("i") + 1).alias("s1"))
    named = materialize(rooted.join(lanes, ["run", "vid"]).select("run", "vid", "root", "s0", "s1"), "similar-mixed")
    named = named.join(materialize(sketched(named.select("vid").distinct()), "similar-sketches"), "vid").select("run", "vid", "root", "s0", "s1", "sketch")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, (_, vid, root, s0, s1, raw) in whole_groups(batches, 1):
            long = np.frombuffer(b"".join(raw), np.uint64).reshape(len(vid), -1)
            for lo, hi in sized(group, 0)[1]:
                _, first, member = np.unique(root[lo:hi], return_index=True, return_inverse=True)
                unions = Unions(hi - lo)
                unions.join(np.arange(hi - lo), first[member])
                for x, y in Tree(np.stack([s0[lo:hi], s1[lo:hi]], axis=1).view(np.uint64)).pairs(LIMIT, unions):
                    x, y = lo + x, lo + y
                    some = root[x] != root[y]
                    some[some] = distance(long[x[some]], long[y[some]]) <= SKETCH_LIMIT
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(vid[x], vid[y])[some]), pa.array(np.maximum(vid[x], vid[y])[some])], names=["a", "b"])

    dealt = named.repartition("run").sortWithinPartitions("run")
    return dealt.mapInArrow(look, "a long, b long").distinct()


def parity(h: np.ndarray) -> bytes:
    """For each remainder of the shingles, whether an odd number of them has it. Every differing bit takes a shingle that only
    one of two sets has."""
    return np.packbits((np.bincount((h % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1).astype(np.uint8)).tobytes()


def prefix(h: np.ndarray, last: np.ndarray, often: np.ndarray) -> np.ndarray:
    """As many of the first shingles as two sets of the similarity need to share one of either's. ``last`` (sorted) come after all others,
    by ``often``; any order does, this one keeps the candidates few."""
    if not len(h):
        return h
    p, q = SIMILAR
    n = len(h) - -(-len(h) * p // q) + 1
    at = np.searchsorted(last, h)
    late = np.append(last, np.uint64(0))[at] == h
    late[at == len(last)] = False
    return np.concatenate([h[~late], h[late][np.argsort(often[at[late]], kind="stable")]])[:n]


def opening(texts: DataFrame, last: np.ndarray, often: np.ndarray) -> DataFrame:
    """``texts(vid, root, text)`` -> (key, vid, root, size): a row for each shingle of a text's prefix, and the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(2).to_pylist()]
            first = [prefix(h, last, often) for h in sets]
            again = pa.array(np.repeat(np.arange(b.num_rows), [len(h) for h in first]))
            size = pa.array([len(h) for h in sets], pa.int64())
            keys = np.concatenate([np.zeros(0, np.uint64), *first]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), b.column(0).take(again), b.column(1).take(again), size.take(again)], names=["key", "vid", "root", "size"])

    return texts.select("vid", "root", "text").mapInArrow(run, "key long, vid long, root long, size long")


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, sorted, that several of the sampled ``texts(text)`` have, the most frequent ones only, and in how many. They only set the
    order of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.concatenate([np.zeros(0, np.uint64), *(shingles(t) for t in b.column(0).to_pylist())])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["key"])

    counted = texts.select("text").mapInArrow(run, "key long").groupBy("key").count().where("count > 2")
    some = counted.orderBy(F.desc("count"), "key").limit(FREQUENT).toArrow()
    keys, often = some.column(0).to_numpy().view(np.uint64), some.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], often[order]


def missed(texts: DataFrame, paritied: Callable[[DataFrame], DataFrame], run: int = RUN) -> DataFrame:
    """``texts(vid, root, text)`` -> distinct candidates (a, b): all pairs of different roots that have the similarity are among
    them. A shingle of over ``run`` texts is cut into blocks, and each pair of blocks is searched. ``paritied`` gives (vid, parity)
    of wanted texts (vid)."""
    last, often = frequent(texts.where(F.pmod("vid", F.lit(SAMPLE)) == 3))
    same = Window.partitionBy("key")
    rows = opening(texts, last, often).select("*", F.min("root").over(same).alias("low"), F.max("root").over(same).alias("high"), F.count("*").over(same).alias("n"))
    blocks = F.when(F.col("n") > run, F.ceil(2 * F.col("n") / run)).otherwise(1).cast("int").alias("blocks")
    shared = materialize(rows.where("low <> high").select("key", "vid", "root", "size", blocks), "similar-shared")
    parities = materialize(paritied(shared.select("vid").distinct()), "similar-parities")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q = SIMILAR
        for group, (_, size, vid, root, raw) in whole_groups(batches, 1):
            odd = np.frombuffer(b"".join(raw), np.uint64).reshape(len(vid), -1)
            at, found, held = np.arange(len(vid)), [], 0
            for d in range(1, len(vid)):
                # In a group sizes ascend, so what is too large for a text ends its search.
                at = at[at + d < len(vid)]
                at = at[(group[at + d] == group[at]) & (size[at + d] * p <= size[at] * q)]
                if not len(at):
                    break
                for lo in range(0, len(at), 1 << 15):
                    x = at[lo : lo + (1 << 15)]
                    x = x[root[x] != root[x + d]]
                    x = x[distance(odd[x], odd[x + d]) * (p + q) <= (size[x] + size[x + d]) * (q - p)]
                    found.append(np.stack([np.minimum(vid[x], vid[x + d]), np.maximum(vid[x], vid[x + d])], axis=1))
                    held += len(x)
                if held > 1 << 20:
                    yield ends(found)
                    found, held = [], 0
            if held:
                yield ends(found)

    dealt = block_pairs(shared.join(parities, "vid")).select("key", "size", "vid", "root", "parity").repartition("key").sortWithinPartitions("key", "size")
    return dealt.mapInArrow(search, "a long, b long").distinct()


def ends(pairs: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.concatenate(pairs), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)], names=["a", "b"])


def from_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, name: str, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """``wanted(vid, own, key)`` -> (vid, name): what ``make`` gives for the shingles of the row that is named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([make(shingles(t)) for t in b.column(1).to_pylist()], pa.binary())], names=["vid", name])

    texts = keyed(docs, id_col, text_col).join(bounded(wanted, wanted.count()), ["own", "key"]).select("vid", "text").dropDuplicates(["vid"])
    return texts.mapInArrow(run, f"vid long, {name} binary")


def raw_set(h: np.ndarray) -> bytes:
    return h.astype("<u8").tobytes()


def verified(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets have a similarity of at least ``SIMILAR``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q = SIMILAR
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * q >= (len(x) + len(y) - both) * p)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("a", "b").join(shingled.toDF("a", "x"), "a").join(shingled.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, few: int = FEW) -> DataFrame:
    """(id, component_id) for every row: the smallest non-null id of its group of near-duplicates. Texts without words
    are one group; repeated rows and null ids give rows; other columns are ignored; an empty table gives no rows. ``run`` and
    ``few`` bound what a task holds and what a key gives; any values give the same groups."""
    prints = materialize(signatures(docs, id_col, text_col), "signatures")
    classes = prints.groupBy("vid").agg(F.min("id").alias("least"), F.min("sig").alias("sig"), F.min(F.struct("own", "key")).alias("row"))
    classes = materialize(classes, "signature-classes")
    n = classes.count()
    bits, tables = plan(n)

    def made(texts: DataFrame, name: str, make: Callable[[np.ndarray], bytes]) -> DataFrame:
        wanted = materialize(classes.join(texts, "vid", "left_semi").select("vid", "row.own", "row.key"), "similar-rows")
        return from_texts(docs, wanted, id_col, text_col, name, make)

    def edges(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("vid")).unionByName(pairs.select(F.col("b").alias("vid"))).distinct()
        return materialize(verified(pairs, materialize(made(ends, "set", raw_set), "similar-sets")), "similar-pairs")

    def rooted(roots: DataFrame) -> DataFrame:
        return classes.join(roots.select(F.col("node").alias("vid"), "root"), "vid", "left").withColumn("root", F.coalesce("root", "vid"))

    found, runs = candidates(classes.withColumn("root", F.col("vid")), bits, tables, range(FIRST), run, few)
    near = edges(found)
    roots = materialize(connected_components(near), "similar-roots")
    found, more = candidates(materialize(rooted(roots).select("vid", "root", "sig"), "signature-roots"), bits, tables, range(FIRST, tables), run, few)
    runs = runs.unionByName(more)
    if not found.isEmpty():
        near = near.unionByName(edges(found))
        roots = materialize(connected_components(near), "similar-roots")
    apart = materialize(still_apart(runs, roots, lambda texts: made(texts, "sketch", sketch)), "similar-apart")
    if not apart.isEmpty():
        near = near.unionByName(edges(apart))
        roots = materialize(connected_components(near), "similar-roots")
    now = materialize(rooted(roots).select("vid", "root", "row.own", "row.key"), "similar-rows")
    texts = keyed(docs, id_col, text_col).join(bounded(now, n), ["own", "key"]).select("vid", "root", "text")
    found = materialize(missed(texts, lambda wanted: made(wanted, "parity", parity), run), "similar-missed")
    if not found.isEmpty() and not (late := edges(found)).isEmpty():
        roots = connected_components(near.unionByName(late))
    ended = materialize(rooted(roots).select("vid", "least", "root"), "signature-roots")
    least = ended.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("id", "vid").join(ended.join(least, "root").select("vid", "component_id"), "vid").select("id", "component_id")


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, without those in whose group a smaller id exists. Rows with a null id
    stay; rows that repeat the smallest id stay."""
    [own] = unused(docs.columns, "gone")
    gone = similar_groups(docs, id_col, text_col).where("id <> component_id").select(F.col("id").alias(own)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(own), "left_anti")

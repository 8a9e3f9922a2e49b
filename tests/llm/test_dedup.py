import random
import struct

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark.llm import gray_index
from gridspark.llm import simhash_dedup as sim
from gridspark.llm.components import connected_components
from gridspark.llm.line_dedup import MIN_WORDS, line_dedup

from .corpus import awkward, frame, words


def near(a, b):
    if min(len(a), len(b)) < 2 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def place(row):
    """Null ids last; rows of one id by the hash of text and id."""
    i, t = row
    i = 2**63 - 1 if i is None else i
    h = xxhash.xxh64_intdigest(struct.pack("<q", i), xxhash.xxh64_intdigest((t or "").encode(), 42))
    return i, h - 2**64 if h >= 2**63 else h


def brute_lines(rows):
    """(id, kept text, lines dropped) of every row, sorted."""
    seen, out = [], []
    for i, t in sorted(rows, key=place):
        kept, gone = [], 0
        for raw in (t or "").split("\n"):
            line = raw.strip(" ")
            w = line.split(" ")
            drop = line != "" and len(w) >= MIN_WORDS and any(line == u or near(w, v) for u, v in seen)
            if line and len(w) >= MIN_WORDS:
                seen.append((line, w))
            gone += drop
            if not drop:
                kept.append(raw)
        out.append((str(i), None if t is None else "\n".join(kept), gone))
    return sorted(out, key=str)


def shown(frame_):
    return sorted(((str(r.doc_id), r.text, r.lines_dropped) for r in frame_.collect()), key=str)


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(5)
    lines = [words(rng, n) for n in (2, 3, 4, 5, 9, 10, 11, 12, 25, 40)]
    extra = []
    for k, line in enumerate(lines):
        w = line.split(" ")
        variants = [w[1:], w[:-1], w + ["more"], ["more", *w], [*w[:2], "sub", *w[3:]], w[:4] + ["in"] + w[4:], w[::-1], [*w[:1], "a", *w[2:-1], "b"]]
        extra += [(1000 + 20 * k + j, f"{words(rng, 12)}\n{' '.join(v)}\n {line} ") for j, v in enumerate(variants)]
        extra.append((900 + k, line))
    # Repeated rows and ids, null ids, single words, blank lines.
    extra += [(3000, "one line here\nanother line there")] * 3 + [(3000, "another line there\nand more of them")] + [(None, "no id at all\none\n\n one")] * 2 + [(3001, "one"), (3002, "two words"), (3003, "two others\ntwo words more")]
    rows = awkward() + extra
    got = line_dedup(frame(spark, rows))
    assert {"key", "__row", "lines_total", "lines_dropped"} <= set(got.columns)
    assert shown(got) == brute_lines(rows)
    assert {(r["__row"], r.key, r.id) for r in got.collect()} == {(1, "k", "x")}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=5), max_size=4)), max_size=8))
def test_line_dedup_on_short_lines(spark, rows):
    rows = [(i, "\n".join(" ".join(line) for line in t)) for i, t in rows]
    assert shown(line_dedup(frame(spark, rows))) == brute_lines(rows)


def test_line_dedup_clashing_names(spark):
    docs = frame(spark, [(1, "a b c"), (2, "a b d")]).withColumn("Lines_Total", F.lit("mine"))
    got = line_dedup(docs).orderBy("doc_id").collect()
    assert [(r["Lines_Total"], r["_lines_total"], r["_lines_dropped"]) for r in got] == [("mine", 1, 0), ("mine", 1, 1)]


def test_line_dedup_empty_table(spark):
    assert line_dedup(frame(spark, [])).collect() == []
    assert [(r.text, r.lines_dropped) for r in line_dedup(frame(spark, [(1, None)])).collect()] == [(None, 0)]


def brute_print(text):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    fps = sorted(set(prints))
    root = {f: f for f in fps}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {f: top(f) for f in fps}


def test_simhash_against_brute_force(spark):
    rows = awkward(1)
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints, 2)
    least = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((str(i), f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, prints))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in sim.simhash_components(frame(spark, rows)).collect())
    assert got == want
    kept = sorted(str(r.doc_id) for r in sim.keep_one(frame(spark, rows)).collect())
    assert kept == sorted(str(i) for (i, _), f in zip(rows, prints) if i is None or least[root[f]] == i)
    assert sim.simhash_components(frame(spark, [])).collect() == []


def test_links_in_dense_groups(spark):
    """Many codes that share most bits: groups that span ranges and leaves."""
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**63))
    codes = {base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 40, (700, 3))} | {int(x) for x in rng.integers(0, 2**63, 300)}
    signed = [int(np.array(c, dtype=np.uint64).view(np.int64)) for c in codes]
    edges = sim.links(spark.createDataFrame([(c,) for c in signed], "fp long"), 2)
    got = {r.node: r.root for r in connected_components(edges).collect()}
    want = brute_components(list(codes), 2)
    size = {}
    for c, r in want.items():
        size.setdefault(r, set()).add(c)
    for group in size.values():
        keys = {got.get(int(np.array(c, dtype=np.uint64).view(np.int64)), c) for c in group}
        assert len(keys) == 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=2), st.integers(0, 3), st.data())
def test_masks_cover_every_pair_within_the_radius(pair, radius, data):
    bits = data.draw(st.lists(st.integers(0, 63), max_size=radius))
    a = pair[0]
    b = a
    for x in bits:
        b ^= 1 << x
    assert any(a & m == b & m for m in sim.masks(radius))


def test_components_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (500, 501), (501, 500)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 300)} == {100} and got[501] == 500
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_in_keys_of_many_codes(spark, monkeypatch):
    """Hot keys go down further levels and nothing is lost."""
    monkeypatch.setattr(sim, "RUN", 40)
    test_links_in_dense_groups(spark)


def test_gray_rank_orders_neighbours():
    n = np.arange(1024, dtype=np.uint64)
    codes = n ^ (n >> np.uint64(1))
    assert (gray_index.gray_rank(codes) == n).all()


def brute_pairs(codes, radius):
    apart = np.bitwise_count(codes[:, None] ^ codes[None]).sum(-1)
    return {tuple(p) for p in np.argwhere(np.triu(apart <= radius, 1)).tolist()}


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 400), st.integers(1, 3), st.integers(0, 70), st.integers(1, 60), st.integers(0, 99))
def test_tree_finds_every_pair(n, lanes, radius, spread, seed):
    """Clusters of different density, some codes equal."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 2**63, (3, lanes), dtype=np.uint64)[rng.integers(0, 3, n)]
    for _ in range(3):
        codes[np.arange(n), rng.integers(0, lanes, n)] ^= np.uint64(1) << rng.integers(0, spread, n).astype(np.uint64)
    want = brute_pairs(codes, radius)
    tree = gray_index.Tree(codes)
    got = [(min(p), max(p)) for x, y in tree.pairs(radius) for p in zip(x.tolist(), y.tolist())]
    assert len(got) == len(want) and set(got) == want
    x, y = gray_index.small_pairs(np.zeros(n, int), codes, radius)
    assert {*zip(x.tolist(), y.tolist())} == want
    unions = gray_index.Unions(n)
    unions.join(*(np.array([p[k] for p in want], dtype=int) for k in (0, 1)))
    x, y, found = tree.forest(radius)
    assert (found.root == unions.root).all() and len(x) == n - len(set(unions.root.tolist()))


def test_code_pairs_per_document_do_not_grow():
    """Random signatures: what the tables of the larger corpora compare, by document."""
    from gridspark.llm import simhash_tables

    rng = np.random.default_rng(1)
    compared, tables = [], []
    for n in (20_000, 40_000, 80_000):
        bits, count = simhash_tables.plan(n)
        size = np.bincount(rng.integers(0, 1 << bits, n), minlength=1 << bits).astype(float)
        compared.append((size * (size - 1) / 2).sum() / n)
        tables.append(count)
    assert max(compared) <= 40 and max(compared) <= 2.2 * min(compared)
    assert max(tables) <= 1.5 * min(tables)

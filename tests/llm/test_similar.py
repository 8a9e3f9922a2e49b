import random

import numpy as np
import pytest

from gridspark.llm import gray_index
from gridspark.llm import simhash_tables as sim

from .corpus import awkward, frame, words


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies_meet_and_others_do_not(spark):
    rng = random.Random(3)
    rows, pairs = [], []
    for k in range(120):
        w = words(rng, rng.randrange(60, 400), 100_000).split(" ")
        rows.append((k, " ".join(w)))
        edits = max(1, len(w) // 70)
        for e in range(edits):
            w[rng.randrange(len(w))] = f"e{k}x{e}"
        rows.append((1000 + k, " ".join(w)))
        a, b = sets(rows[-2][1]), sets(rows[-1][1])
        if len(a & b) / len(a | b) >= 0.8:
            pairs.append(k)
    got = {r.id: r.component_id for r in sim.similar_groups(frame(spark, rows)).collect()}
    assert len(pairs) > 60
    assert sum(got[1000 + k] == k for k in pairs) >= 0.95 * len(pairs)
    assert all(c in (i, i - 1000) for i, c in got.items())


def test_awkward_rows(spark):
    rows = awkward()
    got = sim.similar_groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    of = {r.id: r.component_id for r in got}
    assert {of[i] for i in (110, 115, 121)} == {7} and of[100] == 0 and {of[i] for i in (300, 301, 302, 303)} == {300}
    kept = {r.doc_id for r in sim.keep_one_similar(frame(spark, rows)).collect()}
    assert 7 in kept and not kept & {100, 110, 301, 302} and None in kept
    assert sim.similar_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("run", [16, 200])
def test_a_key_over_several_parts(spark, run):
    """Many variants of one text: a hot key in every table, dealt out in Gray order."""
    rng = random.Random(1)
    base = words(rng, 300, 100_000).split(" ")
    rows = []
    for k in range(400):
        w = list(base)
        w[rng.randrange(300)] = f"v{k}"
        rows.append((k, " ".join(w)))
    assert {r.component_id for r in sim.similar_groups(frame(spark, rows), run=run).collect()} == {0}


def test_many_variants_of_one_text(spark):
    """More than a task's part of one key with the default bounds; each variant is within the similarity of the base, most
    pairs of variants are too."""
    rng = random.Random(2)
    base = words(rng, 120, 100_000).split(" ")
    rows = [(0, " ".join(base))]
    for k in range(1, 9000):
        w = list(base)
        w[rng.randrange(120)] = f"v{k}"
        rows.append((k, " ".join(w)))
    others = [(20_000 + k, words(rng, 60, 100_000)) for k in range(300)]
    got = {r.id: r.component_id for r in sim.similar_groups(spark.createDataFrame(rows + others, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) + len(others)
    assert all(got[i] == 0 for i, _ in rows) and all(got[i] == i for i, _ in others)


def test_unlike_texts_under_one_key_are_compared_in_blocks(spark):
    """What no part shrinks: each pair of blocks is a key of its own, and no pair of rows is lost."""
    rows = spark.range(200).selectExpr("1 as slot", "7L as key", "id as vid", "id as root", "id as s0", "id as s1", "5 as blocks")
    pairs = sim.block_pairs(rows).select("key", "vid").collect()
    together = {}
    for r in pairs:
        together.setdefault(r.key, set()).add(r.vid)
    met = {(a, b) for s in together.values() for a in s for b in s}
    assert len(met) == 200 * 200 and len(together) == 15


def chains(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(150):
        w = words(rng, rng.randrange(80, 300), 100_000).split(" ")
        rows.append((10 * k, " ".join(w)))
        for c in range(1, 4):
            edits = max(1, round(len(w) * rng.uniform(0.012, 0.05)))
            for e in range(edits):
                w[rng.randrange(len(w))] = f"e{k}x{c}x{e}"
            rows.append((10 * k + c, " ".join(w)))
    return rows


@pytest.mark.parametrize(("few", "run"), [(8, 8192), (1, 8192), (1, 16)])
def test_only_pairs_of_the_similarity_are_joined(spark, few, run):
    """Pairs around 0.8, and chains of them: groups are the components of the pairs that brute force finds. With small
    bounds all keys are searched as large ones: a forest first, then what is still apart; or in parts."""
    rows = chains(7)
    want, recalled, near = {}, 0, 0
    got = {r.id: r.component_id for r in sim.similar_groups(frame(spark, rows), run=run, few=few).collect()}
    for k in range(0, len(rows), 4):
        ids, shingled = [i for i, _ in rows[k : k + 4]], [sets(t) for _, t in rows[k : k + 4]]
        want.update({i: i for i in ids})
        for x in range(4):
            for y in range(x):
                if len(shingled[x] & shingled[y]) / len(shingled[x] | shingled[y]) >= 0.8:
                    near += 1
                    recalled += got[ids[x]] == got[ids[y]]
                    old, new = max(want[ids[x]], want[ids[y]]), min(want[ids[x]], want[ids[y]])
                    want.update({i: new for i in ids if want[i] == old})
    assert near > 100 and recalled >= 0.98 * near
    # Nothing is joined that brute force keeps apart.
    assert all(want[i] == want[c] for i, c in got.items())


def test_longer_fingerprints_tell_the_similarity():
    """Pairs of 0.8 are within the bound, nearly all of 0.6 are not."""
    rng = np.random.default_rng(3)
    far = {0.8: [], 0.6: []}
    for s, out in far.items():
        shared = round(400 * s)
        for _ in range(150):
            h = rng.integers(0, 2**63, 400 + 400 - shared, dtype=np.uint64)
            a, b = (np.frombuffer(sim.sketch(np.sort(x)), np.uint64) for x in (h[:400], h[400 - shared :][:400]))
            out.append(int(gray_index.distance(a, b)))
    jaccard = {s: round(400 * s) / (800 - round(400 * s)) for s in far}
    assert 0.66 < jaccard[0.8] < 0.67 and np.mean(np.array(far[0.8]) <= sim.SKETCH_LIMIT) < 0.5
    same = rng.integers(0, 2**63, 444, dtype=np.uint64)
    near = [int(gray_index.distance(*(np.frombuffer(sim.sketch(np.sort(rng.permutation(same)[:400])), np.uint64) for _ in "ab"))) for _ in range(50)]
    assert max(near) <= sim.SKETCH_LIMIT and min(far[0.6]) > sim.SKETCH_LIMIT
    assert sim.sketch(np.zeros(0, np.uint64)) == bytes(sim.SKETCH_BITS // 8)


def test_starred_links_join_the_same_texts():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 2**63, (5, 2), dtype=np.uint64)[rng.integers(0, 5, 300)]
    for _ in range(5):
        codes[np.arange(300), rng.integers(0, 2, 300)] ^= np.uint64(1) << rng.integers(0, 60, 300).astype(np.uint64)
    vid = rng.permutation(300)
    x, y, unions = gray_index.Tree(codes).forest(sim.LIMIT)
    a, b = sim.starred(vid, codes, unions.root, x, y)
    again = gray_index.Unions(300)
    again.join(a, b)
    assert (again.root == unions.root).all() and (gray_index.distance(codes[a], codes[b]) <= sim.LIMIT).all()
    # Other tables see other parts of the texts and give mostly the same links.
    links = set()
    for _ in range(10):
        part = np.sort(rng.choice(300, 240, replace=False))
        x, y, unions = gray_index.Tree(codes[part]).forest(sim.LIMIT)
        a, b = sim.starred(vid[part], codes[part], unions.root, x, y)
        links |= {tuple(sorted(p)) for p in zip(vid[part][a].tolist(), vid[part][b].tolist())}
    assert len(links) < 4 * 300


def components(rows):
    """By brute force: the smallest id reached over pairs of the similarity."""
    shingled = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for x in range(len(rows)):
        for y in range(x):
            if 5 * len(shingled[x] & shingled[y]) >= 4 * len(shingled[x] | shingled[y]):
                root[top(x)] = top(y)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return {i: least[top(k)] for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize(("few", "run"), [(8, 8192), (1, 16)])
def test_no_link_of_short_texts_is_left_out(spark, few, run):
    """A text of four shingles and many of five that hold it: each has a similarity of exactly 0.8 with it alone. Near a fifth of all
    fingerprint bits differ, so more than a third of the longer fingerprints are over their bound."""
    rng = random.Random(11)
    rows = []
    for k in range(12):
        base = words(rng, 8, 100_000)
        rows += [(100 * k, base)] + [(100 * k + v, f"{base} v{k}x{v}") for v in range(1, 40)]
    got = {r.id: r.component_id for r in sim.similar_groups(frame(spark, rows), few=few, run=run).collect()}
    assert got == components(rows) and set(got.values()) == {100 * k for k in range(12)}


@pytest.mark.parametrize("few", [8, 1])
def test_no_link_of_chains_is_left_out(spark, few):
    """Pairs around 0.8: the groups are those of brute force, none is missed by chance."""
    for seed in (7, 8):
        rows = chains(seed)
        want = {}
        for k in range(0, len(rows), 4):
            want |= components(rows[k : k + 4])
        assert {r.id: r.component_id for r in sim.similar_groups(frame(spark, rows), few=few).collect()} == want


@pytest.mark.parametrize("run", [8192, 16])
def test_the_last_search_alone_finds_all_pairs(spark, run):
    """Few different words, so most shingles are frequent and many texts share them; all texts are still apart."""
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(1, 60), 3) for _ in range(120)] + [None]
    for t in texts[:100]:
        w = t.split(" ")
        for _ in range(rng.randrange(1, 3)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(w))
        texts.append(" ".join(w))
    h = [sim.shingles(t) for t in texts]
    parities = [(i, bytearray(sim.parity(x))) for i, x in enumerate(h)]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "vid long, root long, text string")
    found = {(r.a, r.b) for r in sim.missed(rows, lambda wanted: spark.createDataFrame(parities, "vid long, parity binary").join(wanted, "vid"), run).collect()}
    want = {(x, y) for y in range(len(h)) for x in range(y) if 0 < len(h[x]) and 5 * len(np.intersect1d(h[x], h[y])) >= 4 * len(np.union1d(h[x], h[y]))}
    assert len(want) >= 30 and want <= found and len(found) < 2 * len(want)


def test_any_order_of_shingles_leaves_a_shared_one():
    rng = np.random.default_rng(2)
    for _ in range(300):
        both, own = rng.integers(1, 60), rng.integers(0, 9, 2)
        h = rng.integers(0, 2**63, both + own.sum(), dtype=np.uint64)
        a, b = np.sort(h[: both + own[0]]), np.sort(np.concatenate([h[:both], h[both + own[0] :]]))
        last = np.sort(rng.choice(h, rng.integers(0, len(h) + 1), replace=False))
        often = rng.integers(3, 9, len(last))
        shared = np.intersect1d(sim.prefix(a, last, often), sim.prefix(b, last, often))
        assert len(shared) or 5 * both < 4 * len(h)
    assert len(sim.prefix(np.zeros(0, np.uint64), last, often)) == 0

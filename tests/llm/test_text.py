from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark.llm import decontaminate as dec
from gridspark.llm import quality, toxicity
from gridspark.llm.common import fold, table

from .corpus import awkward, frame

SF = "/root/testdata/sf0.01"


def f1(rows, label):
    tp = sum(1 for r in rows if r.predicted == 1 and r[label] == 1)
    wrong = sum(1 for r in rows if r.predicted != r[label])
    return 2 * tp / max(1, 2 * tp + wrong)


def test_toxicity_learns_planted_words(spark):
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(800)]

    def text(toxic):
        w = list(rng.choice(vocab, rng.integers(30, 120)))
        for _ in range(len(w) // 15 if toxic else 0):
            w[rng.integers(len(w))] = str(rng.choice(["vile", "nasty", "Vile,"]))
        return " ".join(w)

    y = {i: int(i % 5 == 0) for i in range(600)}
    docs = frame(spark, [(i, text(t)) for i, t in y.items()] + [(1000, None), (1001, ""), (None, "vile"), (1001, "")])
    labels = spark.createDataFrame([(i, t) for i, t in y.items() if i % 3] + [(None, 1), (2000, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 604
    held = [r for r in rows if r.id is not None and r.id < 600 and r.id % 3 == 0]
    right = sum(r.predicted == y[r.id] for r in held)
    assert right / len(held) > 0.95
    assert len({r.score for r in rows if r.id in (1000, 1001)}) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert {c for c in toxicity.drop_toxic(docs, labels).columns} == set(docs.columns)
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a b c"), (2, None)])
    rows = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))).collect()
    assert len(rows) == 2 and len({r.score for r in rows}) == 1


def brute_model(rows, fit, discount, factor):
    """P(w | v) of both classes from dictionaries; ``fit`` are (text, label), each different text once."""
    corpus = Counter(w for _, t in rows for w in (t or "").lower().split())
    least = min(corpus.values())
    mass = sum(corpus.values()) + least
    shared = lambda w: corpus.get(w, least) / mass
    n = {c: Counter(p for t, y in fit if y == c for p in {*zip(t.split(), t.split()[1:])}) for c in (0, 1)}
    both = n[0] + n[1]
    top = toxicity.PAIR_DISCOUNT

    def word(c, w):
        before = Counter(b for _, b in n[c])
        total = max(sum(before.values()), 1)
        own = {x: max(k - discount - factor * total * shared(x), 0) / total for x, k in before.items()}
        return own.get(w, 0) + (1 - sum(own.values())) * shared(w)

    def shared_pair(v, w):
        of = sum(k for (a, _), k in both.items() if a == v)
        left = {b: max(k - top, 0) / of for (a, b), k in both.items() if a == v}
        return left.get(w, 0), 1 - sum(left.values())

    def pair(c, v, w):
        of = sum(k for (a, _), k in n[c].items() if a == v)
        lower = lambda x: shared_pair(v, x)[0] + shared_pair(v, x)[1] * word(c, x)
        own = {b: max(k - top - factor * of * lower(b), 0) / max(of, 1) for (a, b), k in n[c].items() if a == v}
        return own.get(w, 0) + (1 - sum(own.values())) * lower(w)

    return word, pair


def test_toxicity_model_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(["all rights kept" if i % 3 else "all of it", *rng.choice(vocab, 8), *(["vile beast"] * (i % 2) + ["go away"] * (i % 4 == 1))])) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice([*vocab, "elsewhere"], 9))) for i in range(10)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    picked, _, _ = toxicity.sampled_labels(labels, "toxic", 1000)
    sample = toxicity.sample_texts(docs, picked, 1000, "doc_id", "text")
    fit = [(t, i % 2) for i, t in rows if i < 60]
    counts = toxicity.count(docs, sample, "text")
    code = lambda w: np.array([xxhash.xxh64_intdigest(x, 42) for x in w], dtype=np.uint64)
    everything = sorted({w for _, t in rows for w in t.split()})
    for discount, factor in ((1.5, 2.0), (1.5, 0.1)):
        m = toxicity.smoothed(counts, discount, factor)
        word, pair = brute_model(rows, fit, discount, factor)
        assert m.class_p.any() or factor > 1
        listed = [w for w in everything if toxicity.find(m.words, code([w]))[0] >= 0]
        assert {"vile", "beast", "rights", "kept", "go"} <= set(listed)
        for v in ("all", "rights", "vile", "w3", "elsewhere", "never"):
            for w in listed:
                got = m.probabilities(code([v, w]), np.array([True, False]))[:, 1]
                assert got == pytest.approx([pair(c, v, w) for c in (0, 1)]), (v, w)
            # Each class's probabilities of all words and the unseen one sum to one.
            assert sum(pair(0, v, w) for w in [*everything, "unseen"]) == pytest.approx(1)
        h = code("all rights kept vile beast go w1".split())
        t = "all rights kept vile beast go w1".split()
        want = np.mean([np.log((pair(1, a, b) if a else word(1, b)) / (pair(0, a, b) if a else word(0, b))) for a, b in zip([None, *t], t)])
        assert m.ratios(h, np.array([0, len(h)]))[0] == pytest.approx(want)


def test_toxicity_sample_is_bounded_and_without_copies(spark):
    docs = frame(spark, [(i // 3, f"text number {i}") for i in range(90)] + [(50 + i, "the same text") for i in range(40)])
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(90)], "doc_id long, toxic int")
    picked, _, _ = toxicity.sampled_labels(labels, "toxic", 20)
    rows = toxicity.sample_texts(docs, picked, 20, "doc_id", "text").collect()
    assert sum(r.y for r in rows) <= 20 and sum(1 - r.y for r in rows) <= 1 and len({tuple(r.h) for r in rows}) == len(rows)


def test_toxicity_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    held = toxicity.query(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(held) > 50 and f1(held, "toxic") > 0.5
    assert sum(r.predicted for r in held if r.toxic == 0) <= 0.02 * len(held)


def test_toxicity_long_texts_and_ties(spark):
    rng = np.random.default_rng(1)
    some = lambda n: list(rng.choice([f"w{i}" for i in range(5000)], n))
    rows = [(i, " ".join(x for w in some(40) for x in ([w, "vile"] if i % 4 == 0 and rng.random() < 0.1 else [w]))) for i in range(300)]
    plain = some(200_000)
    long = " ".join(x for i, w in enumerate(plain) for x in ([w, "vile"] if i % 10 == 0 else [w]))
    docs = frame(spark, [*rows, (900, long), (901, long), (902, " ".join(plain)), (903, "")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    # Where long unlabelled texts use the word too, the shared counts expect more of it.
    got = {r.id: r for r in toxicity.score(docs, toxicity.train(docs.where("coalesce(doc_id, 0) < 900"), labels)).collect()}
    assert got[900].score == got[901].score and got[900].predicted == 1 and got[900].ratio > got[902].ratio and got[902].predicted == 0


def test_toxicity_hash_agrees_with_spark(spark):
    got = spark.createDataFrame([("Ab, cd-EF 12 é",)], "t string").select(toxicity.word_hashes(F.col("t")).alias("h")).first().h
    want = [xxhash.xxh64_intdigest(w, 42) for w in ["ab", "cd", "ef", "12", "é"]]
    assert [x % 2**64 for x in got] == want


def test_steps_cover_a_batch(spark):
    import pyarrow as pa

    lists = [[1] * n for n in (0, 5, 300_000, 2, 0, 150_000, 60_000, 1)]
    b = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], names=["h"])
    for whole in (b, b.slice(1, 6)):
        parts = list(toxicity.steps(whole, 0))
        assert sum(p.num_rows for p in parts) == whole.num_rows
        assert [len(x) for p in parts for x in p.column(0).to_pylist()] == [len(x) for x in whole.column(0).to_pylist()]


def test_quality_held_out_accuracy(spark):
    rows = quality.query(spark, SF)
    labels = table(spark, SF, "labels")
    held = rows.join(labels, "doc_id").where("held_out").collect()
    assert rows.count() == table(spark, SF, "documents").count() and len(held) > 50
    assert f1(held, "quality") > 0.95
    low = [r for r in held if r.quality == 0]
    assert sum(r.predicted == 0 for r in low) >= 0.8 * len(low)


@pytest.mark.parametrize("scale", [0.1, 3.0])
def test_quality_gradient_is_that_of_the_risk(scale):
    """By finite differences; with large weights the negative part is under zero and the step goes against it."""
    rng = np.random.default_rng(5)
    p, u = rng.normal(1, 1, (200, 4)), rng.normal(0, 1, (300, 4))
    w = scale * np.ones(4) if scale < 1 else -scale * np.array([0.1, 0.1, 0.1, -1.5])
    seen = set()
    for prior in (0.3, 0.95):
        for v in (w, -w, w * 0):
            positive, negative = quality.risks(v, p, u, prior)
            seen.add(negative < 0)
            of = lambda x, prior=prior, negative=negative: -quality.risks(x, p, u, prior)[1] if negative < 0 else sum(quality.risks(x, p, u, prior))
            step = 1e-6
            want = [(of(v + step * e) - of(v - step * e)) / (2 * step) for e in np.eye(4)]
            assert np.allclose(quality.gradient(v, p, u, prior), want, atol=1e-6)
    assert True in seen


def test_quality_fit_recovers_the_classes():
    """Unlabelled rows are a mixture; the risk is lowest where positives and negatives part."""
    rng = np.random.default_rng(6)
    good, bad = rng.normal(1.5, 1, (600, 3)), rng.normal(-1.5, 1, (400, 3))
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = quality.fit_nnpu(one(rng.normal(1.5, 1, (500, 3))), one(np.concatenate([good, bad])), 0.6)
    assert (one(good) @ w > 0).mean() > 0.95 and (one(bad) @ w < 0).mean() > 0.95
    start, end = (quality.risks(x, one(good), one(np.concatenate([good, bad])), 0.6) for x in (w * 0, w))
    assert end[0] + max(0, end[1]) < start[0] + max(0, start[1])


def plain_statistics(text):
    raw = text.encode()
    n, words, lines = len(raw), raw.split(), raw.split(b"\n")
    k = max(len(words), 1)
    share = lambda f: sum(map(f, raw)) / n
    letter = lambda c: 97 <= c < 123
    upper, digit, space = (lambda c: 65 <= c < 91), (lambda c: 48 <= c < 58), (lambda c: c in b"\t\n\x0b\x0c\r ")
    mark = lambda c: 32 < c < 127 and not (letter(c) or upper(c) or digit(c))
    return {
        0: np.log1p(n), 1: share(upper), 2: share(digit), 3: share(space), 4: share(mark), 5: raw.count(b"!") / n, 6: sum(mark(a) and mark(b) for a, b in zip(raw, raw[1:])) / n,
        7: share(lambda c: c >= 128), 8: raw.count(b"\n") / n, 9: np.log1p(len(words)), 11: len(set(words)) / k, 13: sum(w.isupper() for w in words) / k, 14: 1 - len(set(lines)) / len(lines),
        15: max(Counter(words).values(), default=0) / k, 16: sum(len(w) <= 2 for w in words) / k,
    }


def test_quality_features_against_plain_counts():
    rng = np.random.default_rng(7)
    for _ in range(200):
        text = "".join(rng.choice(list("abcXYZ 019 \n\n.,!?é ß")) for _ in range(int(rng.integers(1, 60))))
        got = quality.statistics(text)
        for i, x in plain_statistics(text).items():
            assert got[i] == pytest.approx(x), (i, quality.NAMES[i], text)
    assert quality.statistics(None) == quality.statistics("") == [0.0] * len(quality.NAMES)


def test_quality_awkward_rows(spark):
    docs = frame(spark, awkward())
    model = quality.learn(docs, spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 1)], "doc_id long, quality int"))
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    none = quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(frame(spark, []), none).count() == 0


def test_nnpu_recovers_the_prior():
    rng = np.random.default_rng(4)
    pos = lambda n: rng.normal(2, 1, (n, 2))
    neg = lambda n: rng.normal(-2, 1, (n, 2))
    p, u = pos(1500), np.concatenate([pos(2100), neg(900)])
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = quality.fit_nnpu(one(p), one(u), 0.5, steps=300)
    prior = quality.estimate_prior(one(p) @ w, one(u) @ w)
    assert prior == pytest.approx(0.7, abs=0.05)
    w = quality.fit_nnpu(one(p), one(u), prior)
    assert (one(pos(500)) @ w > 0).mean() > 0.97 and (one(neg(500)) @ w < 0).mean() > 0.97


def brute_tiling(a, b, least):
    """Greedy string tiling as in the paper: longest unmarked match first."""
    on_a, on_b = [False] * len(a), [False] * len(b)
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not on_a[i + k] and not on_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return sum(on_b)
        k, i, j = best
        on_a[i : i + k] = [True] * k
        on_b[j : j + k] = [True] * k


def hashed(tokens):
    return np.array([xxhash.xxh64_intdigest(str(t), 42) for t in tokens], dtype=np.uint64)


def tiled(doc, item, seed):
    h, mine = dec.window_hashes(hashed(doc), seed), dec.window_hashes(hashed(item), seed)
    at = np.flatnonzero(np.isin(h, mine))
    return dec.tile(*dec.runs(at, h[at], mine), len(item), seed)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=3, max_size=30), st.lists(st.integers(0, 5), max_size=40), st.integers(1, 4), st.integers(0, 9))
def test_tiling_against_brute_force(item, doc, seed, cut):
    """Texts of few words, so with many ties; the item's parts are in the document in another order."""
    if len(item) >= seed:
        doc = doc[:cut] + item[cut:] + doc[cut:] + item[:cut]
        assert tiled(doc, item, seed) == brute_tiling(doc, item, seed)


def test_tiling_of_texts_that_repeat_themselves():
    import tracemalloc

    tracemalloc.start()
    assert tiled(["a"] * 20_000, ["a"] * 1_000, 5) == 1_000
    assert tiled(["a", "b"] * 10_000, ["a", "b"] * 500, 5) == 1_000
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_decontaminate_against_brute_force(spark):
    rng = np.random.default_rng(4)
    word = lambda n, size: [f"t{x}" for x in rng.integers(0, size, n)]
    items = [(k, word(int(rng.integers(2, 40)), 40)) for k in range(25)]
    rows = []
    for k in range(80):
        parts = [word(30, 40)]
        for _, t in [items[i] for i in rng.integers(0, 25, 3)]:
            cut = int(rng.integers(0, len(t)))
            parts += [t[cut:], word(3, 40), t[: cut if k % 2 else cut // 2]]
        rows.append((k, " ".join(w for p in parts for w in p)))
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string")
    want = {}
    for d, text in rows:
        for k, t in items:
            marked = brute_tiling(text.split(), t, min(len(t), dec.SEED_TOKENS))
            if marked >= dec.COVERAGE * len(t):
                want[d, k] = marked
    assert len(want) > 50
    for sent in (dec.SEEDS_SENT, 10):  # seeds sent to the tasks, and all windows joined
        dec_sent, dec.SEEDS_SENT = dec.SEEDS_SENT, sent
        try:
            got = {(r.doc_id, r.item_id): r.matched_tokens for r in dec.contaminated(frame(spark, rows), bench).collect()}
        finally:
            dec.SEEDS_SENT = dec_sent
        assert got == want


def test_decontaminate_cases(spark):
    item = " ".join(f"b{i}" for i in range(30))
    moved = " ".join(f"b{i}" for i in [*range(20, 30), *range(0, 10), *range(10, 20)])
    part = " ".join(f"b{i}" for i in range(12))
    rows = [(1, f"x y {item.upper()}! z"), (2, f"q {moved} q"), (3, f"a {part} c"), (4, "clean text"), (5, None), (6, ""), (None, item), (1, item), (7, "short one two"), (8, "b1 " * 500), (9, "w " * 200_000)]
    bench = spark.createDataFrame([(10, item), (11, "One, two"), (12, None), (13, ""), (None, "zz yy xx ww vv uu"), (10, item), (14, "w " * 300)], "item_id long, text string")
    want = sorted([("1", "10"), ("1", "10"), ("1", "10"), ("1", "10"), ("2", "10"), ("2", "10"), ("None", "10"), ("None", "10"), ("9", "14"), ("7", "11")])
    got = dec.contaminated(frame(spark, rows), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == want
    kept = dec.drop_contaminated(frame(spark, rows), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6", "8"] and kept.columns == frame(spark, []).columns
    assert dec.contaminated(frame(spark, []), bench).count() == 0
    assert dec.contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def test_a_phrase_that_all_items_have_makes_no_pairs(spark):
    """500 items and 3,000 documents share one phrase; each tenth document holds an item, parts swapped."""
    rng = np.random.default_rng(11)
    phrase = "choose the one correct answer below"
    words = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 50_000, n))
    texts = [f"{words(20)} {phrase} {words(14)}" for _ in range(500)]
    rows = []
    for d in range(3000):
        half = texts[d % 500].split(" ")
        held = " ".join([*half[22:], "between", *half[:22]]) if d % 10 == 0 else ""
        rows.append((d, f"{words(10)} {phrase} {held} {words(10)}"))
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = dec.item_texts(bench, "text", dec.SEED_TOKENS)
    seeds = items.select("t1", "t2", "size", "width", F.explode("seeds").alias("seed")).groupBy("t1", "t2", "size", "width", "seed").agg(F.count("*").alias("times"))
    placed = dec.seed_places(docs, None, "text", [5]).withColumnsRenamed({"t1": "d1", "t2": "d2"})
    joined = placed.select("d1", "d2", F.explode(F.array_distinct("seeds")).alias("seed")).join(dec.rare_seeds(seeds, dec.COVERAGE), "seed").count()
    assert joined < 10 * len(rows)
    got = {(r.doc_id, r.item_id) for r in dec.contaminated(docs, bench).collect()}
    assert got == {(d, d % 500) for d in range(0, 3000, 10)}

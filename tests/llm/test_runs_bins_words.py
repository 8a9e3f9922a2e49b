"""Periodic runs, best-fit packing and spelling groups against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridspark.llm import best_fit, periodic_runs, spelling
from gridspark.llm.packing import tokenizer_path

from .corpus import awkward, frame

# -- periodic runs


def brute_runs(w):
    """Every maximal stretch of every period; of those with the same ends the smallest period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted(((b, e - b, q) for (b, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(rng):
    n, k = rng.randrange(0, 110), rng.choice([1, 2, 2, 3, 4, 50])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 3:
            a, p = rng.randrange(n), rng.randrange(1, max(2, n // 2))
            for i in range(a, min(n, a + rng.randrange(n))):
                w[i] = w[a + (i - a) % p]
    if rng.random() < 0.2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        w = b[:n]
    return [f"w{x}" for x in w]


def test_runs_equal_brute_force():
    rng, total = random.Random(1), 0
    for _ in range(60):
        docs = [repetitive(rng) for _ in range(20)]
        found, text = periodic_runs.searched(pa.array([" ".join(d) + rng.choice(["", " ", "\n\t"]) for d in docs]))
        for d, got, t in zip(docs, found.to_pylist(), text.to_pylist()):
            want = brute_runs(d)
            assert [(r["start"], r["length"], r["period"]) for r in got] == want
            assert t == collapsed(d, want)
            total += len(want)
    assert total > 1000


def test_long_keys_sort_alike(monkeypatch):
    """Positions and names that don't fit one number are sorted apart."""
    rng = np.random.default_rng(3)
    a, b, at = rng.integers(0, 9, 200), rng.integers(0, 9, 200), np.arange(200)
    x = periodic_runs._sorted(a, b, at)
    y = periodic_runs._sorted(a << 40, b << 40, at)
    assert (x[0] == y[0]).all() and (x[1] == y[1]).all()


def test_proposals_stay_few():
    """Texts of one word, and of Fibonacci words, whose runs are as many as can be."""
    a, b = [0], [0, 1]
    while len(b) < 5000:
        a, b = b, b + a
    for w in (np.zeros(5000, np.int64), np.array(b[:5000])):
        levels = periodic_runs.dictionary(w, np.array([0, 5000]))
        assert all(len(periodic_runs.proposals(levels[k], 1 << k)[0]) <= 4 * 5000 for k in range(2, len(levels)))


def test_periodic_runs_of_awkward_rows(spark):
    rows = awkward() + [(900, " ".join(["one"] * 20)), (901, "a b c d " * 4), (901, "a b c d " * 4)]
    got = Counter((r.id, tuple(tuple(x) for x in r.runs), r.text) for r in periodic_runs.periodic_runs(frame(spark, rows)).collect())
    want = Counter()
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = brute_runs(w)
        want[(i, tuple(runs), collapsed(w, runs))] += 1
    assert got == want
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(3, np.int64), np.array([0, 3]), least=4)


def test_op11_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(repetitive(rng) * rng.randrange(1, 3))) for i in range(250)] + [(1000, None), (1001, "  "), (None, "a b c")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    some = 0
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        if i is not None:
            h = zlib.crc32(str(i).encode())
            g, n = h // 10, len(w)
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
                some += 1
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        text = hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        want = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest, text)
        assert got[i] == want
    assert some > 10


# -- best-fit packing


@pytest.fixture(scope="module")
def plain():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, best_fit.END_ID]


PARTS = ["a", "Word", " ", "  ", "\n", "\t", "\r\n", "don't", "we'll", "'s", "' s", "é", "ß", "×", " ", "　", "\x0b", "\x1c", " ", "12", "!", "...", "<|endoftext|>", "日本", "\u0085", "I'M", "Ġ", "​", "😀", "_"]


def test_chunks_give_the_tokenizers_ids(plain, monkeypatch):
    monkeypatch.setattr(best_fit, "CHUNKS_KEPT", 50)
    cache, rng = best_fit.ChunkIds(tokenizer_path("byte_bpe_50k.json")), random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(6)] + [None, ""]
        ids, offsets = cache.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain(t) for t in texts]


def slow_best_fit(sizes, length, most):
    """The same rule by looking at every open sequence."""
    opened, serial, places = [], 0, []
    for n in sizes:
        fits = [b for b in opened if length - b[1] >= n]
        if fits:
            least = min(length - b[1] for b in fits)
            b = [b for b in fits if length - b[1] == least][-1]
            opened.remove(b)
        else:
            b = [serial, 0]
            serial += 1
        places.append((b[0], b[1]))
        b[1] += n
        if b[1] < length:
            if len(opened) == most:
                fullest = max(x[1] for x in opened)
                opened.remove([x for x in opened if x[1] == fullest][-1])
            opened.append(b)
    return places


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_are_best_fit(most):
    rng = random.Random(most)
    sizes = [rng.randrange(1, 65) for _ in range(600)]
    bins = best_fit.Bins(64, most, 0)
    assert [bins.place(n) for n in sizes] == slow_best_fit(sizes, 64, most)


def test_best_fit_packs_every_token_once(spark, plain):
    rows = awkward() + [(400 + i, "word " * (37 * i)) for i in range(40)]
    got = best_fit.best_fit(frame(spark, rows), length=128).collect()
    want = Counter((i, tuple(plain(t))) for i, t in rows)
    by_doc, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        by_doc.setdefault(r.id, []).append((r.start, r.piece, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, len(ids)))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 128
    for i, pieces in by_doc.items():
        for start, piece, ids in pieces:
            fits = [t for (j, t), _ in want.items() if j == i and list(t[start : start + len(ids)]) == ids and start == (0 if piece == 0 else start)]
            assert fits
    alone = Counter(i for i, _ in rows)
    for (i, ids), _ in want.items():
        if alone[i] == 1:
            pieces = sorted(by_doc[i])
            assert [p for _, p, _ in pieces] == list(range(len(pieces)))
            assert [x for _, _, part in pieces for x in part] == list(ids)
            assert all(len(part) == 128 for _, _, part in pieces[1:]) and len(pieces) == -(-len(ids) // 128)
    tokens = sum(len(t) * n for (_, t), n in want.items())
    assert len(sequences) <= 1.05 * tokens / 128 + 1
    assert sum(len(r.ids) // 4 for r in got) == tokens
    assert best_fit.best_fit(frame(spark, [])).count() == 0


# -- spelling groups


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), counts[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        r[1] = root
    return {w: tuple(r) for w, r in out.items()}


@pytest.mark.parametrize("block", [1024, 3])
def test_spelling_groups_equal_brute_force(spark, block):
    """With a small block most halves are cut into pairs of blocks."""
    rng = random.Random(block)
    words = set()
    while len(words) < 500:
        w = [rng.choice("abé") for _ in range(rng.randrange(5, 9))]
        words.add("".join(w))
    words |= {"a" * n for n in (5, 6, 7, 30)} | {"aaaab", "baaaa", "a", "b", "ab", "ÿÀ÷×ß"}
    counts = {w: rng.choice([3, 4, 7, 15, 40, 40, 100]) for w in words}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n int")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(vocabulary, block=block).collect()}
    assert got == brute_groups(counts)
    assert any(r[0] and r[1] != r[0] for r in got.values())


def test_spelling_defined_cases(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_groups(none).count() == 0
    odd = spark.createDataFrame([(None, 5), ("abcde", 5)], "word string, n long")
    assert sorted(tuple(r) for r in spelling.spelling_groups(odd).collect() if r.word) == [("abcde", None, "abcde", 5, 0, None)]
    with pytest.raises(ValueError):
        spelling.spelling_groups(odd, times=1)


def test_op13_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    stems = ["garden", "gardens", "hardens", "CAFÉSÉ", "straße", "thing", "things", "think", "thinks", "ab"]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(["", ",", "-x", "1"]) for _ in range(rng.randrange(60)))) for i in range(200)] + [(500, None), (501, "")]
    frame(spark, rows + [(None, "garden garden")]).write.parquet(str(tmp_path / "documents.parquet"))
    counts, cut = Counter(), 0
    for i, t in [*rows, (None, "garden garden")]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % 97 == 0:
                at = h % len(w)
                w, cut = w[:at] + w[at + 1 :], cut + 1
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.query(spark, str(tmp_path)).collect()}
    assert got == brute_groups(counts) and cut > 10


@pytest.mark.parametrize("module", [periodic_runs, spelling])
def test_queries_equal_their_sql(spark, module):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = c.execute(module.ORACLE_SQL)
    names = [d[0] for d in want.description]
    got = module.query(spark, "/root/testdata/sf0.01")
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())

"""Small corpora with awkward rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __row int, key string, id string"


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "k", "x") for i, t in rows], SCHEMA)


def words(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def awkward(seed=0):
    rng = random.Random(seed)
    base = [(i, "\n".join(words(rng, rng.randrange(3, 40)) for _ in range(rng.randrange(1, 6)))) for i in range(30)]
    copies = [(100 + i, base[i][1]) for i in range(5)] + [(110 + i, base[7][1]) for i in range(12)]
    edited = []
    for i in range(8):
        w = base[i + 8][1].split(" ")
        w[len(w) // 2] = "changed"
        edited.append((200 + i, " ".join(w)))
    odd = [(300, None), (301, ""), (302, "   "), (303, "\n\n"), (304, words(rng, 3000)), (305, "Ünïcödé  ß\tİ end"), (306, "a"), (None, "no id at all here"), (None, base[0][1]), (307, "x " * 400), (3, base[3][1])]
    return base + copies + edited + odd

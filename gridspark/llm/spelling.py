"""Grouping of spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are one inserted, deleted or replaced character apart exactly if their common prefix and common suffix together
reach the longer one's length less one. One edit leaves the first or the second half of the longer word whole, so such
words share that half: a word is filed under its half for its own length and for one more. The words of a half are laid
out as matrices of padded code points, one row a word, once from the left and once from the right; two blocks of rows are
compared column by column for all their pairs at once, which gives the two lengths. A half that many words share is cut
into blocks by a hash, and each pair of blocks is a tile of its own, so a task holds two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import SQL_CRC32, SQL_CRC32_TABLE, bounded, materialize, table

#: Letters of a word: those of ASCII and U+00C0 to U+00FF, all of one byte in Latin-1.
RUN = "[A-Za-zÀ-ÿ]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Shortest word, fewest occurrences, and how often a form must be more frequent than the word.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: Words of a block.
BLOCK = 1024
#: Rows of small groups that are compared in one step.
TILE = 192


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspell: bool = False, shortest: int = LEAST_LENGTH, fewest: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the runs of letters of all whole texts, A to Z in lower case, of at least ``shortest`` characters and ``fewest``
    occurrences. With ``misspell`` a run whose crc32 with its document's id is a multiple of 97 loses one letter first."""
    # A longer run keeps its length but for the lost letter, so shorter ones need not be looked at.
    words = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))).alias("run"))
    words = words.select("id", F.translate("run", UPPER, UPPER.lower()).alias("word"))
    if misspell:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = (h % F.length("word")).cast("int")
        cut = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        words = words.select(F.when(h % 97 == 0, cut).otherwise(F.col("word")).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


def filed(vocabulary: DataFrame) -> DataFrame:
    """(side, long, half, word, n): every word under its halves, as the longer or shorter of two words of up to ``long`` characters."""
    size = F.length("word")
    keys = []
    for more in (0, 1):
        half = F.floor((size + more) / 2).cast("int")
        keys.append(F.struct(F.lit(0).alias("side"), (size + more).alias("long"), F.col("word").substr(F.lit(1), half).alias("half")))
        keys.append(F.struct(F.lit(1).alias("side"), (size + more).alias("long"), F.col("word").substr(size - half + 1, half).alias("half")))
    return vocabulary.withColumn("k", F.explode(F.array(*keys))).select("k.side", "k.long", "k.half", "word", "n")


def tiles(rows: DataFrame, block: int) -> DataFrame:
    """``filed`` rows with the tile (i, j) they go to and their block ``at``. A half of up to ``block`` words is the tile (0, 0)."""
    key = ["side", "long", "half"]
    counts = materialize(rows.groupBy(*key).count().where(F.col("count") > block).select(*key, F.ceil(F.col("count") / block).cast("int").alias("blocks")), "spelling-hot")
    n = counts.count()
    if not n:
        return rows.select("*", F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    counted = rows.join(bounded(counts, n), key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    counted = counted.withColumn("at", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    # Its own block's row and column of tiles.
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    return counted.withColumn("o", F.explode(other)).select(*key, "word", "n", "at", F.least("at", "o").alias("i"), F.greatest("at", "o").alias("j"))


def matrix(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded to ``width``: from the left, and from the right with the last one first."""
    rows = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    back = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return rows, back


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``a`` with every row of ``b``. The padding counts as equal; it only adds to
    words of equal length, and these are told apart by their own length."""
    alive = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(a.T, b.T):
        alive &= x[:, None] == y[None, :]
        if not alive.any():
            break
        length += alive
    return length


def near(words: list[bytes], long: np.ndarray, side: np.ndarray, group: np.ndarray, half: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs one edit apart, of ``rows`` with ``columns``, inside groups of equal tile and ``long``; ``half`` tells the two blocks of a tile
    apart and is -1 where they are the same one. A pair that shares both halves counts on the first side only."""
    width = max(map(len, words)) + 1
    ahead, back = matrix(words, width)
    size = np.array([len(w) for w in words], np.int16)
    prefix = common(ahead[rows], ahead[columns])
    suffix = common(back[rows], back[columns])
    most, least = np.maximum(size[rows][:, None], size[columns][None, :]), np.minimum(size[rows][:, None], size[columns][None, :])
    hit = (group[rows][:, None] == group[columns][None, :]) & (most == long[rows][:, None]) & (most - least <= 1)
    hit &= (half[rows][:, None] != half[columns][None, :]) | (half[rows] < 0)[:, None]
    hit &= prefix.astype(np.int16) + suffix >= most - 1
    hit &= (side[rows][:, None] == 0) | (prefix < most // 2)
    x, y = np.nonzero(hit)
    x, y = rows[x], columns[y]
    apart = x != y
    return x[apart], y[apart]


_BEST = "word string, n long, near_n long, near string, n_near long"


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles, sorted by tile -> for every word of a tile that has near words there, their number and the best of them."""
    for b in whole_tiles(batches):
        names = ["side", "long", "half", "i", "j", "at", "word", "n"]
        side, long, half, i, j, at, word, n = (b.column(names.index(c)) for c in names)
        words = [w.encode("latin-1") for w in word.to_pylist()]
        side, long, i, j, at, n = (x.to_numpy(zero_copy_only=False) for x in (side, long, i, j, at, n))
        same = half.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        change = np.zeros(len(words), bool)
        for c in (side, long, same, i, j):
            change[1:] |= c[1:] != c[:-1]
        group = np.cumsum(change)
        first = np.append(np.flatnonzero(np.concatenate([[True], change[1:]])), len(words))
        half_at = np.where(i == j, -1, at)
        xs, ys, g = [], [], 0
        while g < len(first) - 1:
            lo = first[g]
            end = max(g + 1, int(np.searchsorted(first, lo + TILE, "right")) - 1)
            hi, two = first[end], end == g + 1 and i[lo] != j[lo]
            g = end
            rows = columns = np.arange(hi - lo)
            if two:
                rows, columns = rows[at[lo:hi] == i[lo]], rows[at[lo:hi] == j[lo]]
            if len(rows) and len(columns) and hi - lo > 1:
                x, y = near(words[lo:hi], long[lo:hi], side[lo:hi], group[lo:hi], half_at[lo:hi], rows, columns)
                if two:
                    x, y = np.concatenate([x, y]), np.concatenate([y, x])
                xs.append(x + lo)
                ys.append(y + lo)
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
        # Of each word's near words the most frequent, of equal ones the first in order of code points, as Latin-1 has it.
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(np.array(words), kind="stable")] = np.arange(len(words))
        order = np.lexsort((rank[y], -n[y], x))
        x, y = x[order], y[order]
        head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
        count = np.diff(np.append(head, len(x)))
        own, best = pa.array(x[head]), pa.array(y[head])
        yield pa.RecordBatch.from_arrays([word.take(own), pa.array(n).take(own), pa.array(n).take(best), word.take(best), pa.array(count, pa.int64())], names=["word", "n", "near_n", "near", "n_near"])


def whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut between tiles only."""
    held: list[pa.RecordBatch] = []
    keys = ["side", "long", "half", "i", "j"]
    of = lambda b, r: tuple(b.column(k)[r].as_py() for k in keys)
    for b in batches:
        if not b.num_rows:
            continue
        last, cut = of(b, b.num_rows - 1), b.num_rows - 1
        if of(b, 0) == last:
            cut = 0
        while cut and of(b, cut - 1) == last:
            cut -= 1
        if held and (cut or of(held[-1], held[-1].num_rows - 1) != last):
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = []
        elif cut:
            yield b.slice(0, cut)
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, near, near_n) for the words of ``vocabulary(word, n)`` that have words one edit apart: their number, and the most
    frequent of them (of equal ones the first in order of code points)."""
    placed = tiles(filed(vocabulary), block)
    order = ["side", "long", "half", "i", "j"]
    dealt = placed.repartition(*order).sortWithinPartitions(*order).select(*order, "at", "word", "n")
    found = dealt.mapInArrow(searched, _BEST)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return found.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n", "n_near", F.col("b.word").alias("near"), (-F.col("b.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` -> (word, root): the last word that the forms lead to. Each step doubles the way that all words have gone; a
    form is at least twice as frequent as its word, so ways are short and have an end."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def spelling_groups(vocabulary: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``vocabulary(word, n)``, whose words are distinct and of letters up to U+00FF.

    A word's form is the most frequent word one edit apart, if it is at least ``times`` as frequent as the word (2 or more); else
    it is null. The root is where forms lead to, the word itself where it has none. Defined cases: words of any length of at least
    one; null words have no near words and are their own (null) root; an empty table gives no rows.
    """
    if times < 2:
        raise ValueError("times must be 2 or more: forms could lead in circles")
    words = materialize(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    found = near_words(words.where("word is not null"), block)
    fits: Column = F.col("near_n") >= times * F.col("n")
    formed = materialize(found.select("word", "n_near", F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")), "spelling-forms")
    led = roots(formed.where("form is not null").select("word", "form"))
    out = words.join(formed, "word", "left").join(led, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(table(spark, sf_dir, "documents"), misspell=True))


#: Near words by their texts with one letter left out.
ORACLE_SQL = rf"""
WITH RECURSIVE {SQL_CRC32_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{5,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
distinct_runs AS (SELECT doc_id, w, count(*) AS k, hex(encode(CAST(doc_id AS VARCHAR) || ':' || w)) AS x FROM runs GROUP BY 1, 2),
hashed AS (SELECT w, k, {SQL_CRC32} AS h FROM distinct_runs, tab),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY 1 HAVING sum(k) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM words, range(1, 100) r(i) WHERE i <= length(word)),
near AS (SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.d = b.word UNION SELECT b.word, a.word FROM less a JOIN words b ON a.d = b.word),
best AS (SELECT x, count(*) AS n_near, first(y ORDER BY n DESC, encode(y)) AS y, max(n) AS top FROM near JOIN words ON word = y GROUP BY x),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN y END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n FROM words LEFT JOIN best ON x = word),
ways AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL UNION ALL SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NOT NULL),
ends AS (SELECT ways.word, ways.at AS root FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NULL)
SELECT forms.word, form, coalesce(root, forms.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms LEFT JOIN ends ON ends.word = forms.word
"""

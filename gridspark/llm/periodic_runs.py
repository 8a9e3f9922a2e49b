"""Periodic runs of words, found with a dictionary of basic factors.

For each power of two L the dictionary names the factor of L words at every position; a name of length 2L is the pair of
two names of length L, so equal names mean equal words. Only factors that occur again in their text are kept, for a
longer factor can't occur again where a shorter one doesn't.

A run of period q with L <= q < 2L starts with a factor of L words that occurs again q words on. Occurrences at most L/2
apart form an arithmetic progression, whose step is the factor's own period; between two progressions there is more than
L/2, so of each one only the next three are within 2L. Every distance between two of them proposes a period once. Equal
proposals that overlap are one stretch; the dictionary then extends it to both sides, from the longest factors to
single words, and of stretches with the same ends that with the smallest period is the run. The shortest length that
proposes is 4 (periods 1 to 7), since runs have 12 words at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import SQL_CRC32, SQL_CRC32_TABLE, bound_batches, table
from gridspark.llm.packing import steps

#: Words of the shortest run; shorter ones are no runs.
LEAST = 12
#: Words of the shortest factors that propose periods.
BASE = 4


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and where each text's words begin (and the last ones end)."""
    large = pa.large_string()
    # White space behind each text: no word goes on in the next one.
    texts = pc.binary_join_element_wise(texts.cast(large).fill_null(""), pa.scalar("", large), pa.scalar("\n", large))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[: int(offsets[-1])] if len(texts) else np.zeros(0, np.uint8)
    body = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(body.astype(np.int8), prepend=0)
    begins = np.flatnonzero(edge == 1)
    ends = np.cumsum(np.flatnonzero(edge == -1) - begins)
    cuts = np.concatenate([[0], ends]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(raw[body])])
    return words, np.searchsorted(begins, offsets)


def _sorted(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``at`` in order of (a, b, at), and the number of each one's (a, b)."""
    if not len(at):
        return at, np.zeros(0, np.int64)
    wide = [int(x.max()).bit_length() for x in (a, b, at)]
    if sum(wide) < 64:
        key = np.sort((a.astype(np.int64) << (wide[1] + wide[2])) | (b.astype(np.int64) << wide[2]) | at)
        at, pair = key & ((1 << wide[2]) - 1), key >> wide[2]
        new = pair[1:] != pair[:-1]
    else:
        order = np.lexsort((at, b, a))
        a, b, at = a[order], b[order], at[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return at, np.concatenate([[0], np.cumsum(new)])


class Names:
    """The names of one length: of the positions whose factor occurs again, in order of (name, position)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, n: int):
        at, name = _sorted(a, b, at)
        again = np.bincount(name)[name] > 1 if len(name) else np.zeros(0, bool)
        self.at, self.name = at[again], name[again]
        self.dense = len(self.at) > n // 8
        if self.dense:
            self.of = np.full(n, -1, np.int32)
            self.of[self.at] = self.name
        else:
            order = np.argsort(self.at)
            self.where, self.of = self.at[order], self.name[order]

    def __call__(self, at: np.ndarray) -> np.ndarray:
        """Names of positions; -1 where the factor occurs once, is cut off by the text's end, or the position is none."""
        out = np.full(len(at), -1, np.int64)
        if self.dense:
            some = (at >= 0) & (at < len(self.of))
            out[some] = self.of[at[some]]
        elif len(self.where):
            i = np.minimum(np.searchsorted(self.where, at), len(self.where) - 1)
            out = np.where(self.where[i] == at, self.of[i], -1)
        return out

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        left = self(x)
        return (left >= 0) & (left == self(y))


def dictionary(code: np.ndarray, first: np.ndarray) -> list[Names]:
    """Names of 1, 2, 4, ... words up to the length at which no factor occurs again in its text."""
    n, text = len(code), np.repeat(np.arange(len(first) - 1), np.diff(first))
    levels, at = [Names(text, code, np.arange(n), n)], None
    while len(levels[-1].at):
        last, long = levels[-1], 1 << (len(levels) - 1)
        at, a = last.at, last.name
        some = at + long < n
        at, a = at[some], a[some]
        b = last(at + long)
        some = (b >= 0) & (text[at] == text[np.minimum(at + long, n - 1)])
        levels.append(Names(a[some], b[some], at[some], n))
    return levels[:-1]


def proposals(names: Names, long: int) -> tuple[np.ndarray, np.ndarray]:
    """(s, q): factors of ``long`` words at s and at s + q are equal; q is in [long, 2 long), at the base length from 1 on."""
    low = 1 if long == BASE else long
    at, name = names.at, names.name
    gap = np.diff(at)
    same = (name[1:] == name[:-1]) & (gap <= long // 2)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    last = np.append(first[1:], len(at)) - 1
    more, of = last - first, name[first]
    step = np.where(more > 0, gap[np.minimum(first, len(gap) - 1)], 0)
    inside = np.flatnonzero((more > 0) & (step >= low))
    starts, periods = [at[first[inside]]], [step[inside]]
    for j in (1, 2, 3):
        c = np.flatnonzero(of[j:] == of[:-j])
        base = at[first[c + j]] - at[last[c]]
        c, base = c[base < 2 * long], base[base < 2 * long]
        d = np.maximum(np.maximum(step[c], step[c + j]), 1)
        t0 = np.maximum(-((base - low) // d), 0)
        t1 = np.minimum(more[c] + more[c + j], (2 * long - 1 - base) // d)
        n = np.maximum(t1 - t0 + 1, 0)
        k = np.repeat(np.arange(len(c)), n)
        t = t0[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        starts.append(at[last[c]][k] - np.minimum(t, more[c][k]) * d[k])
        periods.append(base[k] + t * d[k])
    return np.concatenate(starts), np.concatenate(periods)


def stretches(s: np.ndarray, q: np.ndarray, long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, q): proposals of one period whose factors meet, as one; words begin to end equal those q further on."""
    order = np.lexsort((s, q))
    s, q = s[order], q[order]
    apart = (q[1:] != q[:-1]) | (s[1:] - s[:-1] > long)
    first = np.flatnonzero(np.concatenate([[True], apart]))
    return s[first], s[np.append(first[1:], len(s)) - 1] + long, q[first]


def runs(code: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, period) of all runs, by begin and period. ``code`` are the words as numbers, ``first`` where each text begins;
    positions count over all texts."""
    if least < LEAST:
        raise ValueError(f"runs have {LEAST} words at least")
    levels = dictionary(code, first)
    found = []
    for k in range(BASE.bit_length() - 1, len(levels)):
        s, q = proposals(levels[k], 1 << k)
        if len(s):
            found.append(stretches(s, q, 1 << k))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    begin, end, q = (np.concatenate(x) for x in zip(*found))
    for k in range(len(levels) - 1, -1, -1):
        end = end + (levels[k].agree(end, end + q) << k)
        begin = begin - (levels[k].agree(begin - (1 << k), begin - (1 << k) + q) << k)
    end = end + q
    some = end - begin >= np.maximum(least, 2 * q)
    begin, end, q = begin[some], end[some], q[some]
    order = np.lexsort((q, end, begin))
    begin, end, q = begin[order], end[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, q = begin[new], end[new], q[new]
    order = np.lexsort((q, begin))
    return begin[order], end[order], q[order]


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def searched(texts: pa.Array, least: int = LEAST) -> tuple[pa.Array, pa.Array]:
    """Of each text its runs, and its words without the repeats that runs make, joined by one space."""
    words, first = words_of(texts)
    n = len(words)
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begin, end, q = runs(code, first, least)
    text = np.searchsorted(first, begin, "right") - 1
    cuts = pa.array(np.searchsorted(begin, first), pa.int32())
    parts = [pa.array(x, pa.int64()) for x in (begin - first[text], end - begin, q)]
    listed = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    # Numbers of runs that cover a word behind their first period.
    over = np.bincount(begin + q, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1]
    kept = np.flatnonzero(np.cumsum(over)[:n] == 0)
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, first), pa.int64()), words.take(pa.array(kept)))
    return listed, pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.string())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(id, runs, text) for every row of ``docs``: the runs by start and period, and the collapsed text.

    A run is a stretch of words with smallest period q and ``least`` and 2 q words at least, that no word beside it continues.
    Its words behind the first q are left out of the collapsed text; kept words are joined by one space. Each text is
    searched whole; a text is never more than one row's work, and nothing is shuffled.

    Defined cases: null and empty texts and those of white space alone have no runs and an empty text; repeated rows and null
    ids give a row each; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in steps(whole, 1)):
            found, text = searched(b.column(1), least)
            yield pa.RecordBatch.from_arrays([b.column(0), found.cast(_RUN), text], names=["id", "runs", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, runs array<struct<start:long,length:long,period:long>>, text string")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of documents where those of whose crc32 ends in 0 go over into a repetition, so that there are known runs."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    period = F.expr("slice(w, cast(a + 1 as int), cast(p as int))")
    times = F.expr("cast((n - a) div p + 1 as int)")
    made = F.expr("slice(w, 1, cast(a as int))"), F.flatten(F.array_repeat(period, times))
    text = F.array_join(F.slice(F.concat(*made), 1, F.col("n").cast("int")), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeated(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.p")).alias("exponent_milli"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


#: Every period of every text: equal words of a text by distance, in stretches.
ORACLE_SQL = rf"""
WITH {SQL_CRC32_TABLE},
hashed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {SQL_CRC32} AS h
  FROM (SELECT doc_id, text, hex(encode(CAST(doc_id AS VARCHAR))) AS x FROM documents), tab),
shaped AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM shaped),
words AS (SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word FROM (SELECT *, unnest(range(n)) AS i FROM placed WHERE n > 0)),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs),
found AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM islands GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (SELECT doc_id, s, n, min(q) AS q FROM found GROUP BY 1, 2, 3),
listed AS (SELECT doc_id, count(*) AS n_runs, first(s ORDER BY n DESC, s, q) AS s, first(n ORDER BY n DESC, s, q) AS n, first(q ORDER BY n DESC, s, q) AS q, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(n AS BIGINT) AS length, CAST(q AS BIGINT) AS period, CAST(1000 * n // q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed ON listed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

"""Line dedup: exact repeats and lines within one word edit of an earlier line go; the earliest stays.

Only DataFrame functions are used. A line is a text's part between newlines, trimmed of spaces; its words are split
at single spaces. Lines are ordered by (doc_id, null last; hash of the text; line number).

Near lines, of two words or more, are found by a deletion-neighbourhood join. The keys of a line are itself and itself
without each of its words; two lines are within one edit (a word inserted, deleted or replaced) only if such keys are
equal. A key is the XOR of hashes of (word, position), so all keys of a line come from running XORs. Members of one key
are not paired with each other: all lines that replace the same word are within one edit of each other, so the
earliest line of each key is aggregated, and every other member is verified against it. That is why the bound is one
edit for every length: with more, the members of a key needn't be near each other and would have to be paired. Lines
get ids in their order, so the earliest is the least id.

Before that, lines that cannot have a partner are ruled out exactly: of two lines within one edit either the first
or the last half is the same, so only lines that share a half with another distinct line emit their variants, and
only those of the other half.

Texts are split once into a table of places (40 bytes a line and its half keys), from which all joins are made; then
only texts that have candidate lines or lose lines are split again. No side is broadcast by hint: all joins shuffle, at
every size alike, and AQE may split their hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.llm.common import LAST_ID, materialize, release, table, unused

MIN_WORDS = 1
NEAR_WORDS = 2


def _row(doc: Column, text: Column) -> Column:
    """With the id, this names a row; rows that agree in both are told apart at the end."""
    return F.xxhash64(text, doc)


def _named(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """The id (null last), the row's name and the text (null as empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    return doc, _row(doc, text), text


def _size(line: str) -> Column:
    """Number of words."""
    return F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(" "), F.lit(""))) + 1


def _halves() -> list[Column]:
    """Keys of the halves of a line against one of as many words and against one of a word less: two first halves, two
    last ones. A half's key has the number of words of the (shorter) line; null for lines of a single word."""
    n = F.col("n")
    half, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    part = lambda count: F.call_function("substring_index", F.col("line"), F.lit(" "), count)
    keys = [("first", n, part(half)), ("first", n - 1, part(less)), ("last", n, part(half - n)), ("last", n - 1, part(-half))]
    return [F.when((n >= NEAR_WORDS) & (size >= NEAR_WORDS), F.xxhash64(F.lit(side), size, words)) for side, size, words in keys]


def _places(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, row, pos, h1, h2, k0 to k3): every line of at least ``min_words`` words by two hashes, and the keys of its
    halves. Each row's line 0 is there in any case, without hashes if it doesn't count."""
    doc, row, text = _named(docs, id_col, text_col)
    rows = docs.select(doc.alias("id"), row.alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "raw"))
    rows = rows.select("id", "row", "pos", F.trim("raw").alias("line"))
    rows = rows.withColumn("n", _size("line"))
    counts = (F.col("n") >= min_words) & (F.col("line") != "")
    rows = rows.where(counts | (F.col("pos") == 0))
    hashes = {"h1": F.when(counts, F.xxhash64("line")), "h2": F.when(counts, F.xxhash64(F.lit("2"), "line"))}
    return rows.select("id", "row", "pos", *(h.alias(c) for c, h in hashes.items()), *(k.alias(f"k{i}") for i, k in enumerate(_halves())))


def _candidates(places: DataFrame, firsts: DataFrame) -> DataFrame:
    """(cid, h1, h2, id, row, pos, by_first, by_last): the distinct lines that share a half with another one, by their
    earliest place; cid is in the order of the lines."""
    halves = firsts.where("k0 is not null").select("h1", F.explode(F.array(*(F.struct(F.lit(i >= 2).alias("last"), F.col(f"k{i}").alias("k")) for i in range(4)))).alias("s")).select("h1", "s.last", "s.k").where("k is not null")
    shared = halves.groupBy("k").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("k")
    maybe = halves.join(shared, "k", "left_semi").groupBy("h1").agg(F.max(F.when(~F.col("last"), 1).otherwise(0)).alias("by_first"), F.max(F.when(F.col("last"), 1).otherwise(0)).alias("by_last"))
    some = firsts.select("h1", "h2", "id").join(maybe, "h1")
    at = places.select("h1", "h2", "id", "row", "pos").join(some, ["h1", "h2", "id"])
    first = at.groupBy("h1", "h2", "id", "by_first", "by_last").agg(F.min(F.struct("row", "pos")).alias("at")).select("h1", "h2", "id", "at.row", "at.pos", "by_first", "by_last")
    # Ranges are in order, and so are the rows of each.
    return materialize(first.repartitionByRange("id", "row", "pos").sortWithinPartitions("id", "row", "pos").withColumn("cid", F.monotonically_increasing_id()), "line-candidates")


def _near(docs: DataFrame, ranked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, id): the candidates that have an earlier line within one word edit."""
    doc, row, text = _named(docs, id_col, text_col)
    wanted = ranked.groupBy("id", "row").agg(F.collect_list(F.struct("pos", "cid", "by_first", "by_last")).alias("wanted"))
    rows = docs.select(doc.alias("id"), row.alias("row"), text.alias("text")).join(wanted, ["id", "row"])
    # The text is split once, as the lambda's argument.
    taken = F.transform(F.array(F.split("text", "\n")), lambda p: F.transform("wanted", lambda w: F.struct(w["cid"].alias("cid"), w["by_first"].alias("by_first"), w["by_last"].alias("by_last"), F.trim(F.get(p, w["pos"])).alias("line"))))
    found = rows.select(F.inline(F.get(taken, 0)))
    lines = found.groupBy("cid", "by_first", "by_last").agg(F.min("line").alias("line"))
    lines = materialize(lines.withColumn("w", F.split("line", " ")).drop("line"), "line-words")

    # A line's rows stay where the line is, so the running XORs move nothing.
    words = lines.repartition("cid").select("cid", "by_first", "by_last", F.size("w").alias("n"), F.posexplode("w").alias("i", "word"))
    words = words.withColumn("x", F.xxhash64("word", "i")).withColumn("y", F.xxhash64("word", F.col("i") - 1)).drop("word")
    line = W.partitionBy("cid")
    upto = line.orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = words.select("cid", "by_first", "by_last", "n", "i", "x", *(F.expr(f"bit_xor({c})").over(upto).alias(f"p{c}") for c in "xy"), *(F.expr(f"bit_xor({c})").over(line).alias(f"t{c}") for c in "xy"))
    # With an equal first half the edit is in the last one, and the other way round.
    reach = "(by_first = 1 and i >= floor((n - 1) / 2)) or (by_last = 1 and i <= ceil(n / 2) - 1)"
    cuts = run.where(reach).select("cid", "i", F.expr("xxhash64(px ^ x ^ ty ^ py, n - 1)").alias("v"))
    whole = run.where("i = 0").select("cid", F.lit(-1).alias("i"), F.expr("xxhash64(tx, n)").alias("v"))
    keys = materialize(cuts.unionByName(whole), "line-variants")
    cuts, whole = keys.where("i >= 0"), keys.where("i < 0")
    # A replaced word: equal variants without the same place. All of a group are such to each other, so each is held
    # against the earliest alone. A word more or less: a variant equals a whole line.
    alike = cuts.groupBy("v", "i").agg(F.min("cid").alias("e"), F.max("cid").alias("z")).where("e < z").select("v", "i", "e")
    replaced = cuts.join(alike, ["v", "i"]).where("e < cid").select("cid", "i", "e")
    moved = cuts.join(whole.select("v", F.col("cid").alias("o")), "v").where("cid <> o").select(F.greatest("cid", "o").alias("cid"), "i", F.least("cid", "o").alias("e"))
    pairs = replaced.unionByName(moved).distinct()
    # Verify the edit distance on the words themselves.
    pairs = pairs.join(lines.select("cid", "w"), "cid").join(lines.select(F.col("cid").alias("e"), F.col("w").alias("u")), "e")
    within = F.expr(
        "case when size(w) = size(u) then size(filter(zip_with(w, u, (a, b) -> a <=> b), e -> not e)) <= 1"
        " when size(w) = size(u) + 1 then concat(slice(w, 1, i), slice(w, i + 2, size(w))) = u"
        " when size(u) = size(w) + 1 then concat(slice(u, 1, i), slice(u, i + 2, size(u))) = w else false end"
    )
    near = materialize(ranked.join(pairs.where(within).select("cid").distinct(), "cid").select("h1", "h2", "id"), "line-near")
    release(lines, keys, ranked)
    return near


def _dropped(docs: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, pos) of the lines that go."""
    counted = places.where("h1 is not null")
    firsts = counted.groupBy("h1", "h2").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("again"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(4)))
    firsts = materialize(firsts, "line-firsts")
    near = _near(docs, _candidates(counted, firsts), id_col, text_col)
    verdict = firsts.where("again").select("h1", "h2", "id", F.lit(False).alias("near")).unionByName(near.withColumn("near", F.lit(True)))
    verdict = materialize(verdict.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("near").alias("near")), "line-verdicts")
    hits = counted.select("h1", "h2", "id", "row", "pos").join(verdict, ["h1", "h2"])
    hits = materialize(hits.select("h1", "h2", "id", "row", "pos", F.expr("near or id > first").alias("sure")), "line-hits")
    release(firsts, verdict)
    # Of several places under the smallest id the first stays.
    ties = hits.where("not sure")
    stays = ties.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("stays")).where("n > 1").drop("n")
    later = ties.join(stays, ["h1", "h2"]).where("struct(row, pos) > stays")
    return hits.where("sure").select("id", "row", "pos").unionByName(later.select("id", "row", "pos"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and ``lines_total``, ``lines_dropped`` beside its columns
    (names that are taken get underscores before them).

    A line that isn't blank and has at least ``min_words`` words goes if an equal line is earlier; one of at least two
    words also if a line of at least two words within one word edit is earlier, kept or not. All rows stay, texts may
    become empty. Defined cases: a null text stays null and has no lines; null ids come last; of rows that agree in id
    and text one is the first and the others lose all their lines; an empty table gives an empty result.
    """
    names = docs.columns
    own_id, own_row, own_drop, own_place, own_first = unused(names, "id", "row", "drop", "place", "first")
    total, cut = "lines_total", "lines_dropped"
    while {total, cut} & {n.lower() for n in names}:
        total, cut = "_" + total, "_" + cut
    places = materialize(_places(docs, id_col, text_col, min_words), "line-places")
    doc, row, text = _named(docs, id_col, text_col)
    named = docs.withColumns({own_id: doc, own_row: row})
    # Rows that agree in id and text, of which there are none in a clean table.
    equal = materialize(places.where("pos = 0").groupBy("id", "row").count().where("count > 1").select(F.col("id").alias(own_id), F.col("row").alias(own_row)), "line-equal-rows")
    n_equal = equal.count()

    gone = _dropped(docs, places, id_col, text_col).groupBy(F.col("id").alias(own_id), F.col("row").alias(own_row)).agg(F.collect_set("pos").alias(own_drop))
    gone = materialize(gone, "line-drops")
    release(places)

    def shown(rows: DataFrame, clean: Column, dropped: Column) -> DataFrame:
        n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
        return rows.select(*(clean.alias(c) if c == text_col else F.col(c) for c in names), F.when(F.col(text_col).isNull(), 0).otherwise(n).alias(total), dropped.alias(cut))

    def without_drops(rows: DataFrame) -> DataFrame:
        joined = rows.join(gone, [own_id, own_row], "left")
        # The text is split once, as the lambda's argument.
        kept = F.transform(F.array(F.split(text, "\n")), lambda p: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col(own_drop)), lambda i: F.get(p, i)), "\n"))
        return shown(joined, F.when(F.col(own_drop).isNull(), F.col(text_col)).otherwise(F.get(kept, 0)), F.coalesce(F.size(own_drop), F.lit(0)))

    if not n_equal:
        return without_drops(named)
    copies = materialize(named.join(equal, [own_id, own_row], "left_semi").withColumn(own_place, F.monotonically_increasing_id()), "line-copies")
    leads = copies.groupBy(own_id, own_row).agg(F.min(own_place).alias(own_first))
    copies = copies.join(leads, [own_id, own_row])
    stays = F.filter(F.split(text, "\n"), lambda x: (F.trim(x) == "") | (F.size(F.split(F.trim(x), " ")) < min_words))
    n_stays = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text, "\n")) - F.size(stays))
    others = shown(copies.where(F.col(own_place) > F.col(own_first)), F.when(F.col(text_col).isNotNull(), F.array_join(stays, "\n")), n_stays)
    singles = named.join(equal, [own_id, own_row], "left_anti")
    return without_drops(singles).unionByName(without_drops(copies.where(F.col(own_place) == F.col(own_first)).drop(own_place, own_first))).unionByName(others)


def query(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("lines_total").cast("long"), F.col("lines_dropped").cast("long"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


ORACLE_SQL = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p, text IS NULL AS none FROM documents),
places AS (SELECT doc_id, unnest(range(len(p))) AS pos, unnest(p) AS raw FROM parts),
lines AS (SELECT doc_id, pos, trim(raw) AS line, string_split(trim(raw), ' ') AS w FROM places),
long_lines AS (SELECT doc_id, pos, line, w, len(w) AS n, doc_id * 1000000 + pos AS ord FROM lines WHERE len(w) >= {MIN_WORDS} AND line <> ''),
firsts AS (SELECT line, any_value(w) AS w, any_value(n) AS n, min(ord) AS ord FROM long_lines GROUP BY line),
places_cut AS (SELECT line, w, n, ord, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= {NEAR_WORDS}),
cut AS (SELECT line, n, ord, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v FROM places_cut),
near AS (
  SELECT c.line FROM cut c JOIN (SELECT v, i, n, min(ord) AS low FROM cut GROUP BY v, i, n) g ON c.v = g.v AND c.i = g.i AND c.n = g.n WHERE g.low < c.ord
  UNION SELECT c.line FROM cut c JOIN firsts f ON f.line = c.v AND f.n >= {NEAR_WORDS} WHERE f.ord < c.ord
  UNION SELECT f.line FROM cut c JOIN firsts f ON f.line = c.v AND f.n >= {NEAR_WORDS} WHERE c.ord < f.ord),
gone AS (
  SELECT l.doc_id, l.pos FROM long_lines l JOIN firsts f ON l.line = f.line LEFT JOIN near x ON x.line = l.line
  WHERE l.ord > f.ord OR x.line IS NOT NULL),
kept AS (SELECT p.doc_id, string_agg(p.raw, chr(10) ORDER BY p.pos) AS text FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos WHERE g.pos IS NULL GROUP BY p.doc_id),
cuts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT a.doc_id, CAST(CASE WHEN a.none THEN 0 ELSE len(a.p) END AS BIGINT) AS lines_total, CAST(coalesce(c.n, 0) AS BIGINT) AS lines_dropped, md5(coalesce(k.text, '')) AS text_md5
FROM parts a LEFT JOIN cuts c ON c.doc_id = a.doc_id LEFT JOIN kept k ON k.doc_id = a.doc_id
"""

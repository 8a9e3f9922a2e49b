"""URL filter: fixed rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that the rules decide (or from given labels). Features: lengths, depth, digit ratio,
entropy, parameter count, host shape, and block rates among all URLs that the rules decide: of the host's last labels, and of
the path's first segment and first characters, which also tell hosts apart that no rule knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import bounded, materialize, table

#: (verdict, host, path): fixed values of the query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TRAIN_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path up to ``?``, ``#`` or
    the end. Both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits; of equally long ones the first listed."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        hit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(hit, h + p).otherwise(rule), F.when(hit, kind).otherwise(verdict)
    return rule, verdict


FEATURES = ["url_len", "host_len", "path_len", "depth", "digit_ratio", "host_digits", "entropy", "params", "labels", "hyphens", "query_len", "secure", "fragment"]
#: Key column and feature: block rates of what URLs share.
RATES = {"__suffix": "suffix_rate", "__domain": "domain_rate", "__segment": "segment_rate", "__start": "start_rate"}
FEATURES += [*RATES.values(), "host_known"]
#: Characters of a path's start.
START = 5


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features to rows with ``__url``, ``host``, ``path``; a null url counts as empty."""
    u = F.coalesce(F.col("__url"), F.lit(""))
    size = F.greatest(F.length(u), F.lit(1))
    count = lambda c, pattern: F.length(F.regexp_replace(c, f"[^{pattern}]", "")).cast("double")
    chars = F.array_distinct(F.split(u, ""))
    share = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / size
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    parts = F.split("host", r"\.")
    return urls.withColumns(
        {
            "url_len": F.length(u).cast("double"),
            "host_len": F.length("host").cast("double"),
            "path_len": F.length("path").cast("double"),
            "depth": count(F.col("path"), "/"),
            "digit_ratio": count(u, "0-9") / size,
            "host_digits": count(F.col("host"), "0-9"),
            "entropy": F.coalesce(entropy, F.lit(0.0)),
            "params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
            "labels": F.size(parts).cast("double"),
            "hyphens": count(F.col("host"), "-"),
            "query_len": F.length(query).cast("double"),
            "secure": u.startswith("https").cast("double"),
            "fragment": F.contains(u, F.lit("#")).cast("double"),
            "__suffix": F.element_at(parts, -1),
            "__domain": F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), "."),
            "__segment": F.regexp_extract("path", "^/([^/]*)", 1),
            "__start": F.substring("path", 1, START),
        }
    )


FOLDS = 4


def fold_of() -> Column:
    return F.pmod(F.xxhash64("__url", F.lit("fold")), F.lit(FOLDS)).cast("int")


def block_rates(known: DataFrame) -> tuple[float, list[tuple[str, str, DataFrame, int]]]:
    """The block rate of all labelled URLs, and smoothed ones by each key of ``RATES``: of all folds (place 0), and without each fold."""
    known = known.select(*RATES, "label", fold_of().alias("fold"))
    base = known.agg((F.sum("label") + 1) / (F.count("*") + 2)).first()[0]
    tables = []
    for key, name in RATES.items():
        without = lambda f: (F.col("fold") != f) if f >= 0 else F.lit(True)
        smooth = lambda f: (F.coalesce(F.sum(F.when(without(f), F.col("label"))), F.lit(0.0)) + 10 * base) / (F.count(F.when(without(f), 1)) + 10)
        rates = materialize(known.groupBy(key).agg(F.array(*(smooth(f) for f in range(-1, FOLDS))).alias(name)), "url-rates")
        tables.append((key, name, rates, rates.count()))
    return base, tables


def with_rates(rows: DataFrame, base: float, tables: list[tuple[str, str, DataFrame, int]], place: Column | None = None) -> DataFrame:
    """Adds the smoothed block rates; what no labelled URL has gets the base rate. ``place`` chooses the fold that is
    left out: rows of the fit are described by the labels of other folds, never by their own."""
    for key, name, rates, n in tables:
        rows = rows.join(bounded(rates, n), key, "left").withColumn(name, F.coalesce(F.get(name, F.lit(0) if place is None else place), F.lit(base)))
    return rows.withColumn("host_known", (F.col("domain_rate") != F.lit(base)).cast("double"))


def unknown_hosts(rows: DataFrame, base: float) -> DataFrame:
    """Rows of the fit as they would be if no labelled URL had their host: so the trees learn what else tells."""
    return rows.withColumns({"suffix_rate": F.lit(base), "domain_rate": F.lit(base), "host_known": F.lit(0.0)})


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS, trees: int = 12, depth: int = 4) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row; score is the trees' probability to block.

    About ``train_rows`` of the URLs that rules decide are drawn by hash to fit the trees, each with its host and once more
    without. If the rules decide none,
    or all alike, there is nothing to learn and other URLs get that verdict (``allow`` without any). Null urls have
    empty host and path; repeated rows and null ids give rows; an empty table gives an empty result.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("__verdict", verdict)
    known = rows.where("rule is not null")
    counts = {r[0]: r[1] for r in known.groupBy("__verdict").count().collect()}
    if len(counts) < 2:
        only = next(iter(counts), "allow")
        return rows.select("page_id", "host", "path", "rule", F.coalesce("__verdict", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("score"))
    rate = min(1.0, train_rows / sum(counts.values()))
    known = lexical(known.withColumn("label", (F.col("__verdict") == "block").cast("double")))
    # The rates are of all URLs that rules decide; only the rows of the fit are drawn.
    rates = block_rates(known)
    train = materialize(known.where(F.pmod(F.xxhash64("page_id", "__url"), F.lit(1_000_000)) < rate * 1_000_000), "url-train")
    gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
    known_hosts = with_rates(train, *rates, fold_of() + 1)
    both = known_hosts.unionByName(unknown_hosts(known_hosts, rates[0]))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=5, labelCol="label").fit(gather.transform(both).select("features", "label"))
    scored = model.transform(gather.transform(with_rates(lexical(rows), *rates))).withColumn("score", vector_to_array("probability")[1])
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("__verdict", by_model).alias("verdict"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))

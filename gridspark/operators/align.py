"""Time: days, daily means, duplicates, common dates and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SYNOPTIC_HOURS = (0, 6, 12, 18)


def floor_day(time: Column) -> Column:
    """The UTC day (the session's time zone must be UTC); never rounds up."""
    return F.to_date(time)


def daily_mean(df: DataFrame, keys: list[str], values: list[str], time: str = "time", hours: tuple[int, ...] | None = SYNOPTIC_HOURS, dense: bool = False) -> DataFrame:
    """Mean of the samples at the given hours per day and cell; missing samples are skipped. ``dense`` adds the empty
    days of each cell between the first and the last day of the table."""
    rows = df if hours is None else df.where(F.hour(time).isin(*hours))
    out = rows.groupBy(floor_day(F.col(time)).alias("date"), *keys).agg(*(F.avg(v).alias(v) for v in values))
    return with_calendar(out, keys) if dense else out


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Every day from the first to the last."""
    return df.agg(F.min(date).alias("a"), F.max(date).alias("b")).select(F.explode(F.sequence("a", "b")).alias(date))


def with_calendar(df: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """A row for every key and day of the table's calendar: each key's days come from one two-value aggregate that is
    broadcast, and an explode."""
    ends = df.agg(F.min(date).alias("__a"), F.max(date).alias("__b"))
    spine = df.select(*keys).distinct().join(F.broadcast(ends)).select(*keys, F.explode(F.sequence("__a", "__b")).alias(date))
    return spine.join(df, [*keys, date], "left")


def first_file_per_time(df: DataFrame, time: str = "time", file: str = "source_file") -> DataFrame:
    """Of files that have the same time, only the whole slice of the first stays. The winner is picked on the small
    table of distinct (time, file)."""
    win = df.groupBy(time).agg(F.min(file).alias(file))
    return df.join(win, [time, file], "left_semi")


def common_dates(a: DataFrame, b: DataFrame, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Both tables on the dates that both have."""
    dates = a.select(date).distinct().intersect(b.select(date).distinct())
    return a.join(dates, date, "left_semi"), b.join(dates, date, "left_semi")


def day_gaps(df: DataFrame, date: str = "date") -> DataFrame:
    """(date, gap): days since the date before it, over the distinct dates (thousands of rows at most)."""
    days = df.select(date).distinct()
    return days.select(date, F.datediff(date, F.lag(date).over(W.orderBy(date))).alias("gap"))


def fill_gaps(df: DataFrame, keys: list[str], value: str, date: str = "date", method: str = "linear", max_days: int | None = None) -> DataFrame:
    """Missing values (rows with NULL, on a spine of days) from the days before and after. ``linear`` leaves both ends
    missing; ``forward`` repeats the last value. Gaps of over ``max_days`` missing days stay."""
    order = W.partitionBy(*keys).orderBy(date)
    before, after = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(0, W.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(date).alias("d"), F.col(value).alias("v")))
    rows = df.withColumn("__p", F.last(known, True).over(before)).withColumn("__n", F.first(known, True).over(after))
    return _filled(rows, value, date, method, max_days)


def _filled(rows: DataFrame, value: str, date: str, method: str, max_days: int | None) -> DataFrame:
    """``value`` between the known ones before and after, which ``__p`` and ``__n`` hold with their days."""
    wide = F.datediff("__n.d", "__p.d")
    if method == "linear":
        part = F.datediff(date, "__p.d") / F.nullif(wide, F.lit(0))
        made = F.col("__p.v") + (F.col("__n.v") - F.col("__p.v")) * part
        size = wide - 1
    elif method == "forward":
        made, size = F.col("__p.v"), F.datediff(date, "__p.d")
    else:
        raise ValueError("method must be linear or forward")
    fits = F.lit(True) if max_days is None else size <= max_days
    return rows.withColumn(value, F.coalesce(value, F.when(fits, made))).drop("__p", "__n")


def fill_gaps_by_month(df: DataFrame, keys: list[str], value: str, date: str = "date", method: str = "linear", max_days: int | None = None) -> DataFrame:
    """The contract of ``fill_gaps`` for decades of days: no window over the rows is longer than a month.

    Each cell's month gives its first and last known value; a scan over these summaries, a row a month, carries the last
    one before each month and the first one behind it; the rows of a month are then filled with those at its ends. Rows are dealt
    once, by cell and month, which the summary's aggregation and the filling both use.
    """
    month = "__month"
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(date).alias("d"), F.col(value).alias("v")))
    rows = df.withColumn(month, F.trunc(date, "month")).repartition(*keys, month)
    ends = rows.groupBy(*keys, month).agg(F.min(known).alias("first"), F.max(known).alias("last"))
    order = W.partitionBy(*keys).orderBy(month)
    carried = ends.select(*keys, month, F.last("last", True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("__b"), F.first("first", True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("__a"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, month]]
    both = rows.alias("r").join(carried.alias("c"), same, "left").select("r.*", "c.__b", "c.__a")
    inside = W.partitionBy(*keys, month).orderBy(date)
    before, after = inside.rowsBetween(W.unboundedPreceding, 0), inside.rowsBetween(0, W.unboundedFollowing)
    ended = both.withColumn("__p", F.coalesce(F.last(known, True).over(before), "__b")).withColumn("__n", F.coalesce(F.first(known, True).over(after), "__a"))
    return _filled(ended, value, date, method, max_days).drop("__b", "__a", month)

"""Merging sources into one surface table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["date", "lat_idx", "lon_idx"]


def merge_sources(sources: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """Inner join on the keys; of a variable that several sources have, the first source's stays."""
    seen: set[str] = set(keys)
    parts = []
    for s in sources:
        own = [c for c in s.columns if c not in seen]
        seen |= set(own)
        parts.append(s.select(*keys, *own))
    return reduce(lambda a, b: a.join(b, keys), parts)


def prefer_source(first: DataFrame, other: DataFrame, days: int, date: str = "date") -> DataFrame:
    """``first`` if it covers at least ``days`` dates, else ``other``: one decision for the whole period, made by a
    one-row table that is broadcast to both."""
    covers = first.agg((F.countDistinct(date) >= days).alias("__first"))
    a = first.join(F.broadcast(covers.where("__first")), how="cross").drop("__first")
    b = other.join(F.broadcast(covers.where("not __first")), how="cross").drop("__first")
    return a.unionByName(b)

"""Groupings whose tasks hold a bounded number of rows, however large the table and however few the session's partitions."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import saved

#: Rows of a partition on average.
EACH = 250_000


def dealt(df: DataFrame, rows: int, by: list[str], each: int = EACH) -> DataFrame:
    """`df`, of some `rows` rows, by hash of `by` in a partition for each `each` rows, so that groups by `by` and more need no other shuffle."""
    return df.repartition(max(1, ceil(rows / each)), *by)


def distinct_counts(df: DataFrame, by: list[str], ids: dict[str, str], sums: dict[str, Column] | None = None, each: int = EACH) -> DataFrame:
    """by, the sums, and for each name how many different values its column of `ids` has; nulls aren't counted.

    The rows are written down once. Each column is told apart by itself, with one narrow row for each of the table's, by
    hash of group and value: a large group lies in many tasks, and tasks grow in number with the table, not in size.
    """
    sums = sums or {}
    known, told = {n: f"_s_{n}" for n in sums}, {n: f"_i_{n}" for n in ids}
    rows = saved(df.select(*by, *[F.col(c).alias(told[n]) for n, c in ids.items()], *[c.alias(known[n]) for n, c in sums.items()]), "distinct")
    size = rows.count()
    parts = []
    for i, (name, c) in enumerate(told.items()):
        here = {n: s for n, s in known.items() if not i}  # the first column takes the sums along
        once = dealt(rows.select(*by, c, *here.values()), size, [*by, c], each).groupBy(*by, c).agg(*[F.sum(s).alias(s) for s in here.values()], F.lit(True).alias("_one"))
        found = once.groupBy(*by).agg(F.count(c).alias(name), *[F.sum(s).alias(n) for n, s in here.items()])
        parts.append(found if not i else found.select(*by, name))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    if len(parts) == 1:
        return whole.select(*by, *sums, *ids)
    return whole.groupBy(*by).agg(*[F.max(n).alias(n) for n in (*sums, *ids)])

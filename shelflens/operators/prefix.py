"""Running sums and places of values in groups of any size: no task sorts more than its share of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path


def same(a: list[str], b: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True)], F.lit(True))


def saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(df: DataFrame, by: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """`df` with _place (from 1) and _count of its row's group, and of each column of `sums` _before_x (the sum of the rows before) and _all_x.

    The rows are dealt out by ranges of group and order, so a large group lies in several parts; sums within a part
    follow those of the parts before it, of which there is a row a part. `order` must tell all rows of a group apart.
    """
    ranged = saved(df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_part", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy(*by, "_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"), F.sum("_n").over(group).alias("_count"),
        *[x for c in sums for x in (F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_skip_{c}"), F.sum(f"_s_{c}").over(group).alias(f"_all_{c}"))],
    )
    inside = Window.partitionBy(*by, "_part").orderBy(*order)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.select("*", F.row_number().over(inside).alias("_i"), *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_r_{c}") for c in sums])
    found = rows.join(offsets, same(by, [f"_by_{c}" for c in by]) & (F.col("_part") == F.col("_p")))
    return found.select(*df.columns, (F.col("_i") + F.col("_skip")).alias("_place"), "_count", *[x for c in sums for x in ((F.col(f"_r_{c}") + F.col(f"_skip_{c}")).alias(f"_before_{c}"), F.col(f"_all_{c}"))])


def values_at(df: DataFrame, by: list[str], value: str, places: dict[str, Column], bins: int = 1024, small: int = 10_000) -> DataFrame:
    """by and, for each name, the value at a 0-based place of the group's sorted values, nulls first; `places` are expressions of _n, the rows of the group.

    Selection by narrowing: while a range that holds a wanted place has over `small` values, its values are counted in
    `bins` equal steps and the step with the place, from its least to its greatest value, is the next range. The least
    and the greatest never share a step, so each round narrows; a range of one value is an answer. Small ranges are
    sorted. Values are numbers and not NaN. A place outside of the group gives null. The values are written down once,
    and each round reads them without a shuffle of them.
    """
    df = saved(df.select(*by, value), "values")
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"), F.count(value).alias("_inside"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("long").alias("place")) for n, c in places.items()]))
    wanted = counts.withColumn("_want", asked).select(*by, F.col("_want.name").alias("_name"), (F.col("_want.place") - F.col("_n") + F.col("_inside")).alias("_at"), "_low", "_high", "_inside")
    wanted = saved(wanted.where("_at >= 0 and _at < _inside"), "places")
    ranges = [f"_by_{c}" for c in by]

    def within(rows: DataFrame) -> DataFrame:
        """The values of `df` in each of the ranges."""
        asked = rows.select(*[F.col(c).alias(r) for c, r in zip(by, ranges, strict=True)], "_low", "_high").distinct()
        return df.select(*by, F.col(value).alias("_v")).join(asked, same(by, ranges)).where(F.col("_v").between(F.col("_low"), F.col("_high"))).drop(*ranges)

    large = (F.col("_inside") > small) & (F.col("_low") < F.col("_high"))
    answers = []
    while not (open_ := wanted.where(large)).isEmpty():
        answers.append(wanted.where(~large))
        # halves, so that the width of the widest range is a number
        step = F.least(F.floor((F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2) * bins), F.lit(bins - 1))
        hist = within(open_).groupBy(*by, "_low", "_high", F.when(F.col("_v") == F.col("_high"), bins - 1).otherwise(step).alias("_bin")).agg(F.count("*").alias("_c"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        ahead = Window.partitionBy(*by, "_low", "_high").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # `bins` rows at most
        hist = hist.withColumn("_skip", F.coalesce(F.sum("_c").over(ahead), F.lit(0)))
        at = hist.select(*[F.col(c).alias(r) for c, r in zip(by, ranges, strict=True)], F.col("_low").alias("_l"), F.col("_high").alias("_h"), "_c", "_a", "_b", "_skip")
        narrowed = open_.join(at, same([*by, "_low", "_high"], [*ranges, "_l", "_h"])).where("_at >= _skip and _at < _skip + _c")
        wanted = saved(narrowed.select(*by, "_name", (F.col("_at") - F.col("_skip")).alias("_at"), F.col("_a").alias("_low"), F.col("_b").alias("_high"), F.col("_c").alias("_inside")), "places")
    found = reduce(DataFrame.unionByName, [*answers, wanted])
    one = found.where("_low = _high").select(*by, "_name", F.col("_low").alias("_v"))
    several = found.where("_low < _high")
    order = Window.partitionBy(*by, "_low", "_high").orderBy("_v")  # `small` rows at most
    ranked = within(several).withColumn("_i", F.row_number().over(order) - 1)
    ranked = ranked.select(*[F.col(c).alias(r) for c, r in zip(by, ranges, strict=True)], F.col("_low").alias("_l"), F.col("_high").alias("_h"), "_v", "_i")
    rest = several.join(ranked, same([*by, "_low", "_high", "_at"], [*ranges, "_l", "_h", "_i"])).select(*by, "_name", "_v")
    whole = one.unionByName(rest).unionByName(counts.select(*by, F.lit("").alias("_name"), F.lit(None).cast(dict(df.dtypes)[value]).alias("_v")))  # groups without an answer stay
    return whole.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, F.col("_v"))).alias(n) for n in places])


def exact_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, median: the middle value, or the mean of both middle ones; nulls are left out."""
    rows = df.where(F.col(value).isNotNull())
    return values_at(rows, by, value, {"_a": F.floor((F.col("_n") - 1) / 2), "_b": F.floor(F.col("_n") / 2)}).select(*by, (F.col("_a") / 2 + F.col("_b") / 2).alias("median"))

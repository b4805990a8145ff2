"""Rankings, shares and scalings within groups; every ranking has a tie-break of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running, values_at


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def minmax(value: Column, by: list[str]) -> Column:
    """Scaled to 0..1 within a group; 0 where the range is 0 or the value is missing."""
    w = Window.partitionBy(*by)
    return F.coalesce((value - F.min(value).over(w)) / F.nullif(F.max(value).over(w) - F.min(value).over(w), F.lit(0.0)), F.lit(0.0))


def share(value: Column, by: list[str]) -> Column:
    return value / F.nullif(F.sum(value).over(Window.partitionBy(*by)), F.lit(0.0))


def pareto_counts(df: DataFrame, by: list[str], item: str, value: str, parts: dict[str, float]) -> DataFrame:
    """How many of a group's items, largest first, reach each part of its sum, the one that crosses it included; and all_items."""
    marked = running(df.select(*by, item, F.col(value).alias("_value")), by, [F.col("_value").desc(), F.col(item)], ["_value"])
    return marked.groupBy(*by).agg(*[F.count_if(F.col("_before__value") < F.lit(p) * F.col("_all__value")).alias(n) for n, p in parts.items()], F.count("*").alias("all_items"))


def pareto_count(df: DataFrame, by: list[str], item: str, value: str, part: float) -> DataFrame:
    return pareto_counts(df, by, item, value, {"items": part})


def dense_rank_desc(df: DataFrame, value: str, rank: str = "rank") -> DataFrame:
    """0 for the largest value of the whole table. The distinct values are ranked, not the rows."""
    levels = running(df.select(value).distinct(), [], [F.col(value).desc()], [])
    return df.join(levels.select(value, (F.col("_place") - 1).cast("int").alias(rank)), value)


def positional_quantile(df: DataFrame, by: list[str], value: str, tenths: list[int]) -> DataFrame:
    """The values at the 0-based positions floor(n * k / 10) of a group's sorted values, without interpolation."""
    return values_at(df, by, value, {f"q{k}": F.floor(F.col("_n") * k / 10) for k in tenths})


def minmax_of_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the columns scaled to 0..1 over the whole table, as minmax does; their ends are one row."""
    ends = df.agg(*[x for c in columns for x in (F.min(c).alias(f"_low_{c}"), F.max(c).alias(f"_high_{c}"))])
    scaled = {c: F.coalesce((F.col(c) - F.col(f"_low_{c}")) / F.nullif(F.col(f"_high_{c}") - F.col(f"_low_{c}"), F.lit(0.0)), F.lit(0.0)) for c in columns}
    return df.join(F.broadcast(ends)).select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])

"""Sums and distinct counts over a tree of categories, from facts that are grouped once by leaf."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import saved


def _dense(sums: DataFrame, levels: tuple[str, ...], by: list[str], least: int, buckets: int) -> set[int]:
    """The levels above the deepest whose nodes hold `least` rows of `sums` (_n) or more on average for each of `buckets` bitmaps."""
    at = range(1, len(levels))
    deep = lambda level: F.col("_depth") >= level
    nodes = [F.count_distinct(F.when(deep(level), F.struct(*levels[:level], *by))).alias(f"nodes{level}") for level in at]
    held = [F.coalesce(F.sum(F.when(deep(level), F.col("_n"))), F.lit(0)).alias(f"ids{level}") for level in at]
    if not nodes:
        return set()
    row = sums.agg(*nodes, *held).first()
    return {level for level in at if row[f"ids{level}"] >= least * buckets * max(row[f"nodes{level}"], 1)}


def roll_up(facts: DataFrame, dim: DataFrame, extra: dict[str, Column], id_: str, measures: dict[str, tuple[str, Column]], distinct: dict[str, Column | None], key: str = "category", levels: tuple[str, ...] = ("level1", "level2", "level3"), sketch: bool = False, least: int = 512) -> DataFrame:
    """level_no, node, path, the columns of `extra`, each measure and each distinct count, of every node above a fact.

    `measures`: name -> (sum, min or max; expression); `distinct`: name -> a condition of which the facts' `id_` are
    counted once each, or null for all. A node has one path and a key one place in the tree.

    Facts are grouped once, by key, `extra` and id. Only that goes up the tree: the sums of a key as one row a level,
    and the ids as bitmaps, which take 4 KB for each 32,768 ids of a node, however many facts or leaves hold them. A
    node's bitmaps are the union of those below it. Levels whose nodes have fewer than `least` ids for a bitmap on
    average, where bitmaps would be mostly empty, and the deepest level count their ids as they are. Ids are whole numbers. With `sketch` they may be anything and nodes hold HyperLogLog sketches, whose counts are within
    some 1.6 % (twice that at times).
    """
    by = list(extra)
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    once = facts.select(key, id_, *[c.alias(n) for n, c in extra.items()], *[c.alias(f"_m_{n}") for n, (_, c) in measures.items()], *[c.alias(f"_d_{n}") for n, c in distinct.items() if c is not None])
    flags = {n: F.max(F.lit(True) if c is None else F.coalesce(F.col(f"_d_{n}"), F.lit(False))).alias(n) for n, c in distinct.items()}
    grouped = once.groupBy(key, *by, id_).agg(*[fold[kind](f"_m_{n}").alias(n) for n, (kind, _) in measures.items()], *flags.values())
    grouped = saved(grouped, "roll-up")
    depth = reduce(lambda below, i: F.when(F.col(levels[i]).isNull(), F.lit(i)).otherwise(below), range(len(levels) - 1, -1, -1), F.lit(len(levels)))
    rows = grouped.join(dim.select(key, *levels).distinct().withColumn("_depth", depth), key)

    none = {**{n: F.lit(None).cast(t) for n, t in grouped.dtypes if n in measures}, **{n: F.lit(None).cast("long") for n in distinct}}

    def told(df: DataFrame, level: int, found: list[str]) -> DataFrame:
        named = [F.lit(level).alias("level_no"), F.col(levels[level - 1]).alias("node"), F.concat_ws(">", *levels[:level]).alias("path")]
        return df.select(*named, *by, *[F.col(n) if n in found else c.alias(n) for n, c in none.items()])

    parts, names = [], list(distinct)
    sums = saved(rows.groupBy(*levels, "_depth", *by).agg(*[fold[kind](n).alias(n) for n, (kind, _) in measures.items()], F.count("*").alias("_n")), "roll-up-sums")
    parts += [told(sums.where(F.col("_depth") >= level), level, list(measures)) for level in range(1, len(levels) + 1)]
    if sketch:
        start = lambda n: F.hll_sketch_agg(F.when(F.col(n), F.col(id_)))
        merge, size, bucket = F.hll_union_agg, F.hll_sketch_estimate, F.lit(0).cast("long")
        dense = set(range(1, len(levels)))
    else:
        start = lambda n: F.bitmap_construct_agg(F.when(F.col(n), F.bitmap_bit_position(F.col(id_))))
        merge, size, bucket = F.bitmap_or_agg, F.bitmap_count, F.bitmap_bucket_number(F.col(id_))
        dense = _dense(sums, levels, by, least, max(grouped.select(bucket.alias("_b")).distinct().count(), 1))
    below = None
    for level in range(len(levels), 0, -1):
        here = [*levels[:level], *by]
        if level not in dense:
            deep = rows.where(F.col("_depth") >= level).groupBy(*here).agg(*[F.count_distinct(F.when(F.col(n), F.col(id_))).alias(n) for n in names])
            parts.append(told(deep, level, names))
            below = None
            continue
        own = rows.where(F.col("_depth") >= level if below is None else F.col("_depth") == level)
        own = own.withColumn("_bucket", bucket).groupBy(*here, "_bucket").agg(*[start(n).alias(n) for n in names])
        below = own if below is None else own.unionByName(below.select(*own.columns)).groupBy(*here, "_bucket").agg(*[merge(n).alias(n) for n in names])
        parts.append(told(below.groupBy(*here).agg(*[F.sum(size(n)).alias(n) for n in names]), level, names))
    whole = reduce(DataFrame.unionByName, parts).groupBy("level_no", "node", "path", *by)
    return whole.agg(*[fold[kind](n).alias(n) for n, (kind, _) in measures.items()], *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names])

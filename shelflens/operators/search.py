"""Search ranking, search words and competitor matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import characters, words
from .nearest import best_set_matches
from .rank import minmax, top_k


def goods_metrics(goods: DataFrame, orders: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """goods, category, channel, units7, sales7, units30, sales30, pv, uv."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    recent = lambda n, c: F.sum(F.when(age.between(0, n - 1), F.col(c)).otherwise(0.0))
    sold = orders.groupBy("goods").agg(recent(7, "qty").alias("units7"), recent(7, "amount").alias("sales7"), recent(30, "qty").alias("units30"), recent(30, "amount").alias("sales30"))
    seen = events.where("behavior = 1000").groupBy("goods").agg(F.count("*").alias("pv"), F.count_distinct("member").alias("uv"))
    return goods.select("goods", "category", "level1", "channel").join(sold, "goods", "left").join(seen, "goods", "left").fillna(0, ["units7", "sales7", "units30", "sales30", "pv", "uv"])


#: Points of each metric.
GOODS_WEIGHTS = {"units30": 15.0, "sales30": 15.0, "units7": 7.5, "sales7": 7.5, "pv": 5.0, "uv": 15.0}


def goods_search_score(metrics: DataFrame, weights: dict[str, float] | None = None, by: tuple[str, ...] = ("level1", "channel")) -> DataFrame:
    """goods and score: each metric scaled within its group, times its points; without a channel in `by` over all channels."""
    total: Column = F.lit(0.0)
    for c, w in (weights or GOODS_WEIGHTS).items():
        total = total + w * minmax(F.col(c).cast("double"), list(by))
    return metrics.select("goods", "category", "level1", "channel", total.alias("score"))


def category_ranking(scores: DataFrame, k: int = 30) -> DataFrame:
    """level1, category, score, rank by the summed scores of the category's best `k` goods."""
    best = top_k(scores, ["level1", "category"], [F.round("score", 9).desc(), F.col("goods")], k, "_rank")
    found = best.groupBy("level1", "category").agg(F.sum("score").alias("score"))
    return top_k(found, ["level1"], [F.round("score", 6).desc(), F.col("category")], 1 << 30)


def brand_scores(metrics: DataFrame, goods: DataFrame, k: int = 1 << 30) -> DataFrame:
    """level1, brand, score, rank: goods (30), 7-day (40) and 30-day sales (30), each scaled within the level."""
    rows = metrics.join(goods.select("goods", "brand"), "goods").groupBy("level1", "brand").agg(F.count("*").cast("double").alias("n"), F.sum("sales7").alias("s7"), F.sum("sales30").alias("s30"))
    by = ["level1"]
    scored = rows.select("level1", "brand", (30 * minmax(F.col("n"), by) + 40 * minmax(F.col("s7"), by) + 30 * minmax(F.col("s30"), by)).alias("score"))
    return top_k(scored, ["level1"], [F.round("score", 6).desc(), F.col("brand")], k)


def search_terms(texts: DataFrame, category: str) -> DataFrame:
    """category, term, n of every word of at least two letters."""
    rows = texts.select(F.col(category).alias("category"), F.explode(words(F.col("text"))).alias("term")).where(F.length("term") >= 2)
    return rows.groupBy("category", "term").agg(F.count("*").alias("n"))


def hot_words(terms: DataFrame, k: int = 50) -> DataFrame:
    return terms.groupBy("term").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "term").limit(k)


def category_terms(terms: DataFrame, k: int = 20) -> DataFrame:
    return top_k(terms, ["category"], [F.col("n").desc(), F.col("term")], k)


def similar_terms(terms: DataFrame, categories: int = 3, per_category: int = 20, k: int = 10) -> DataFrame:
    """term, other, distance, rank: of the leading words of a term's leading categories those nearest by edits, not equal.

    The terms asked for are the leading words as well, so no list grows with the table.
    """
    lead = category_terms(terms, per_category)
    own = top_k(lead.select("term", "category", "n"), ["term"], [F.col("n").desc(), F.col("category")], categories, "_rank").select("term", "category")
    pairs = own.join(lead.select("category", F.col("term").alias("other")), "category").select("term", "other").distinct()
    found = pairs.withColumn("distance", F.levenshtein("term", "other")).where("distance > 0")
    return top_k(found, ["term"], [F.col("distance"), F.col("other")], k)


def match_categories(own: DataFrame, other: DataFrame, name: str = "name") -> DataFrame:
    """own, other, score: for each own name the other one whose characters agree best."""
    named = lambda df: df.select(F.col(name).alias("id")).distinct().withColumn("characters", characters(F.col("id")))
    return best_set_matches(named(own), named(other), "characters")


def brand_gap(own: DataFrame, other: DataFrame, by: str, brand: str = "brand", least: int = 2) -> DataFrame:
    """Brands that others have in a category and the own list lacks, where there are at least `least`."""
    clean = F.lower(F.trim(brand)).alias("b")
    missing = other.select(by, clean).distinct().join(own.select(by, clean).distinct(), [by, "b"], "left_anti")
    return missing.groupBy(by).agg(F.count("*").alias("missing"), F.expr("listagg(b, '#') WITHIN GROUP (ORDER BY b)").alias("brands")).where(F.col("missing") >= least)


def competitor_price_bins(own: DataFrame, other: DataFrame, by: str, bins: int = 10) -> DataFrame:
    """by, bin, items, comments: the competitor's items within equal bins of the own price range."""
    edges = own.groupBy(by).agg(F.min("price").alias("low"), F.max("price").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    at = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("price") - F.col("low")) / width), F.lit(bins - 1))).cast("int")
    rows = other.join(edges, by).where(F.col("price").between(F.col("low"), F.col("high")))
    return rows.groupBy(by, at.alias("bin")).agg(F.count("*").alias("items"), F.sum("comments").alias("comments"))


def item_match_features(own: DataFrame, other: DataFrame, by: str, k: int = 50) -> DataFrame:
    """goods, item, shared_words, shared_characters: own goods and the competitor's most commented items of the same brand."""
    items = top_k(other, [by], [F.col("comments").desc(), F.col("goods")], k).select(by, "brand", F.col("goods").alias("item"), F.col("name").alias("item_name"))
    rows = own.select(by, "brand", "goods", "name").join(items, [by, "brand"])
    return rows.select("goods", "item", F.size(F.array_intersect(words(F.col("name")), words(F.col("item_name")))).alias("shared_words"), F.size(F.array_intersect(characters(F.col("name")), characters(F.col("item_name")))).alias("shared_characters"))


#: Points of the review metrics: how many, how good, and the share of good ones.
REVIEW_WEIGHTS = {"reviews": 5.0, "review_score": 5.0, "review_ratio": 5.0}


def reviewed_search_score(metrics: DataFrame, weights: dict[str, float] | None = None, by: tuple[str, ...] = ("level1", "channel")) -> DataFrame:
    """goods_search_score with review metrics as well."""
    return goods_search_score(metrics, weights or GOODS_WEIGHTS | REVIEW_WEIGHTS, by)


#: Points of each metric by the length of its window: what is listed over 30 days, then over 7. Fixed values.
WINDOW_WEIGHTS = {
    "units30": 15.0, "sales30": 15.0, "pv30": 5.0, "uv30": 15.0, "reviews30": 5.0, "review_score30": 5.0, "review_ratio30": 5.0,
    "units7": 7.5, "sales7": 7.5, "pv7": 2.5, "uv7": 7.5, "reviews7": 2.5, "review_score7": 2.5, "review_ratio7": 5.0,
}
#: The same of the variant with conversion. Fixed values.
CONVERSION_WINDOW_WEIGHTS = {
    "sales30": 20.0, "pv30": 4.0, "uv30": 14.0, "reviews30": 4.0, "review_score30": 10.0, "conversion": 15.0, "fill_rate": 2.0,
    "sales7": 15.0, "pv7": 2.0, "uv7": 6.0, "reviews7": 2.0, "review_score7": 10.0,
}


def window_visits(events: DataFrame, as_of: str, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """goods, and pv and uv over each number of days up to `as_of`."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("ts"))
    views = events.where((F.col("behavior") == 1000) & age.between(0, max(days) - 1)).groupBy("goods", "member").agg(*[F.count_if(age < n).alias(f"v{n}") for n in days])
    return views.groupBy("goods").agg(*[x for n in days for x in (F.sum(f"v{n}").alias(f"pv{n}"), F.count_if(F.col(f"v{n}") > 0).alias(f"uv{n}"))])


def window_score(metrics: DataFrame, weights: dict[str, float], by: tuple[str, ...] = ("level1", "channel")) -> DataFrame:
    """goods, score: each metric of `weights` scaled within its group, times its points; a missing metric is 0."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in weights]
    total = sum((w * minmax(F.col(c), list(by)) for c, w in weights.items()), F.lit(0.0))
    return metrics.select("goods", *by, *values).select("goods", total.alias("score"))


def to_channels(scores: DataFrame, channels: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """goods, channel, score: scores summed over channels, once for each channel."""
    return scores.groupBy("goods").agg(F.sum("score").alias("score")).select("goods", F.explode(F.array(*map(F.lit, channels))).alias("channel"), "score")


def channel_ranking(scores: DataFrame, k: int = 30) -> DataFrame:
    """channel, level1, category, score, rank by the summed scores of the category's best `k` goods in the channel."""
    best = top_k(scores, ["channel", "level1", "category"], [F.round("score", 9).desc(), F.col("goods")], k, "_rank")
    found = best.groupBy("channel", "level1", "category").agg(F.sum("score").alias("score"))
    return top_k(found, ["channel", "level1"], [F.round("score", 6).desc(), F.col("category")], 1 << 30)


def back_categories(scores: DataFrame, search_category: str = "level1", k: int = 30) -> DataFrame:
    """search category, items: the goods' own categories of its best `k` goods, the most frequent first, delimited."""
    best = top_k(scores, [search_category], [F.round("score", 9).desc(), F.col("goods")], k, "_rank")
    n = best.groupBy(search_category, "category").agg(F.count("*").alias("n"))
    return n.groupBy(search_category).agg(F.expr("listagg(category, '#') WITHIN GROUP (ORDER BY n DESC, category)").alias("items"))


def _to_hundred(rows: DataFrame) -> DataFrame:
    """`rows` with `raw` as `score`, the greatest one 100; 0 if that is 0."""
    most = rows.agg(F.max("raw").alias("_most"))  # one row
    return rows.join(F.broadcast(most)).withColumn("score", F.when(F.col("_most") > 0, 100 * F.col("raw") / F.col("_most")).otherwise(0.0)).drop("raw", "_most")


def _path_score(rows: DataFrame, path: list[str], by: list[str]) -> DataFrame:
    found = rows.groupBy(*path, *by).agg(F.count("*").cast("double").alias("n"), F.sum("sales7").alias("s7"), F.sum("sales30").alias("s30"))
    return found.withColumn("raw", 30 * minmax(F.col("n"), path) + 40 * minmax(F.col("s7"), path) + 30 * minmax(F.col("s30"), path))


def brand_level_scores(metrics: DataFrame, goods: DataFrame, levels: tuple[str, ...] = ("level1", "level2")) -> DataFrame:
    """brand, score: goods (30), 7-day (40) and 30-day sales (30) scaled within each level path, summed over levels, the best one 100."""
    rows = metrics.select("goods", "sales7", "sales30").join(goods.select("goods", "brand", *levels), "goods")
    parts = [_path_score(rows, list(levels[: i + 1]), ["brand"]).select("brand", "raw") for i in range(len(levels))]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return _to_hundred(total.groupBy("brand").agg(F.sum("raw").alias("raw")))


def child_scores(metrics: DataFrame, goods: DataFrame, parent: str = "level1", child: str = "level2") -> DataFrame:
    """parent, child, score: the same of the categories below a parent, the best of all 100."""
    rows = metrics.select("goods", "sales7", "sales30").join(goods.select("goods", parent, child), "goods")
    return _to_hundred(_path_score(rows, [parent], [child]).select(parent, child, "raw"))


def term_categories(terms: DataFrame) -> DataFrame:
    """term, items: the categories in which it is searched, most often first, delimited."""
    return terms.groupBy("term").agg(F.expr("listagg(category, '#') WITHIN GROUP (ORDER BY n DESC, category)").alias("items"))


def named_brand_matches(own: DataFrame, other: DataFrame, by: str, k: int = 50) -> DataFrame:
    """goods, item, shared_words, shared_characters: the competitor's `k` most commented items of a category whose name holds the own brand."""
    items = top_k(other, [by], [F.col("comments").desc(), F.col("goods")], k).select(by, F.col("goods").alias("item"), F.lower("name").alias("item_name"))
    rows = own.select(by, F.lower("brand").alias("brand"), "goods", "name").join(items, by).where(F.contains("item_name", "brand"))
    return rows.select("goods", "item", F.size(F.array_intersect(words(F.col("name")), words(F.col("item_name")))).alias("shared_words"), F.size(F.array_intersect(characters(F.col("name")), characters(F.col("item_name")))).alias("shared_characters"))

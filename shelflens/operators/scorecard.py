"""Scores of category nodes and the analyses of leaf categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .category import explode_levels
from .rank import minmax

NODE = ["level_no", "node"]
OPERATION_METRICS = ("in_stock_rate", "fill_rate", "price_changes", "shelf_changes", "steadiness")


def score_weights(components: DataFrame, details: DataFrame) -> DataFrame:
    """component, sub, weight: a component's weight times that of each of its parts."""
    parts = details.withColumnRenamed("weight", "_part")
    return parts.join(components, "component").select("component", "sub", (F.col("weight") * F.col("_part")).alias("weight"))


def deviation(ratios: DataFrame, by: list[str], value: str, least: int = 5) -> DataFrame:
    """Population deviation in groups with at least `least` values; groups without any spread are left out."""
    found = ratios.groupBy(*by).agg(F.count(value).alias("_n"), F.stddev_pop(value).alias("deviation"))
    return found.where((F.col("_n") >= least) & (F.col("deviation") > 1e-9)).drop("_n")


def operation(goods: DataFrame, fills: DataFrame, price_changes: DataFrame, shelf_changes: DataFrame, ratios: DataFrame, dim: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """level_no, node and its five operation metrics.

    In-stock rate of goods on sale; mean fill rate in the latest snapshot of `fills` (goods, snapshot, fill_rate); changes
    (goods, changed_at) of price and of shelf within `days`; and the steadiness of `ratios` (level_no, node, ratio), 1 for
    the least deviation of the level and 0 for the largest. What is missing counts as 0.
    """
    latest = fills.join(F.broadcast(fills.agg(F.max("snapshot").alias("snapshot"))), "snapshot").groupBy("goods").agg(F.avg("fill_rate").alias("fill"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("changed_at"))
    changes = lambda df, name: df.where(age.between(0, days - 1)).groupBy("goods").agg(F.count("*").alias(name))
    rows = goods.join(latest, "goods", "left").join(changes(price_changes, "_p"), "goods", "left").join(changes(shelf_changes, "_s"), "goods", "left")
    on_sale = F.col("sale_status") == 4
    found = explode_levels(rows, dim).groupBy(*NODE).agg(
        F.coalesce(F.count_if(on_sale & (F.col("stock") == 1)) / F.nullif(F.count_if(on_sale), F.lit(0)), F.lit(0.0)).alias("in_stock_rate"), F.coalesce(F.avg("fill"), F.lit(0.0)).alias("fill_rate"),
        F.coalesce(F.sum("_p"), F.lit(0)).alias("price_changes"), F.coalesce(F.sum("_s"), F.lit(0)).alias("shelf_changes"),
    )
    spread = deviation(ratios, NODE, "ratio")
    w = Window.partitionBy("level_no")
    low, high = F.min("deviation").over(w), F.max("deviation").over(w)
    steady = spread.select(*NODE, (1 - F.coalesce((F.col("deviation") - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))).alias("steadiness"))
    return found.join(steady, NODE, "left").fillna(0.0, ["steadiness"])


def operation_score(metrics: DataFrame, weights: dict[str, float]) -> DataFrame:
    """level_no, node, score: each metric scaled within its level, times its weight."""
    total: Column = F.lit(0.0)
    for c in OPERATION_METRICS:
        total = total + weights[c] * minmax(F.col(c).cast("double"), ["level_no"])
    return metrics.select(*NODE, total.alias("score"))


def popularity_score(popularity: DataFrame, weights: dict[str, float], month: str) -> DataFrame:
    """level_no, node, score of one month's views, viewers and buyers, as scaled by category_popularity."""
    total = sum((w * F.col(f"{c}_norm") for c, w in weights.items()), F.lit(0.0))
    return popularity.where(F.col("month") == month).select(*NODE, total.alias("score"))


def concentration_points(x: Column) -> Column:
    return F.when(x.between(0.2, 0.4), 1.0).when((x > 0.4) & (x <= 0.8), 0.5).otherwise(0.2)


def sell_through_points(x: Column) -> Column:
    return F.when((x > 0.4) & (x < 0.6), 1.0).when(x.between(0.2, 0.8), 0.5).otherwise(0.2)


def scored_month(month: Column, as_of: str, months: int = 4) -> Column:
    """Whether product_line_score takes a month (yyyy-MM)."""
    return month > F.date_format(F.add_months(F.lit(as_of).cast("date"), -months), "yyyy-MM")


def product_line_score(monthly: DataFrame, correlations: DataFrame, weights: dict[str, float], as_of: str, months: int = 4) -> DataFrame:
    """level_no, node, score from the mean concentration (`ratio80`) and sell-through of the months after `months` ago,
    in steps, and from the correlation of price and units."""
    means = monthly.where(scored_month(F.col("month"), as_of, months)).groupBy(*NODE).agg(F.avg("ratio80").alias("_c"), F.avg("sell_through").alias("_s"))
    rows = means.join(correlations.select(*NODE, "correlation"), NODE, "left").fillna(0.0, ["correlation"])
    total = weights["concentration"] * concentration_points(F.round("_c", 9)) + weights["sell_through"] * sell_through_points(F.round("_s", 9)) + weights["correlation"] * F.col("correlation")
    return rows.select(*NODE, total.alias("score"))


def price_correlation(distribution: DataFrame) -> DataFrame:
    """level_no, node, correlation of goods and units over the bins of a price distribution; 0 if none or negative."""
    a, b = F.col("goods_count").cast("double"), F.col("units")
    found = distribution.groupBy(*NODE).agg(F.round(F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)), 9).alias("c"))
    return found.select(*NODE, F.when(F.col("c").between(0, 1), F.col("c")).otherwise(0.0).alias("correlation"))


def overall_score(nodes: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """level_no, node, the named sub-scores (missing: 0), their sum, and its dense rank within the level by whole points."""
    rows = nodes
    for name, scores in parts.items():
        rows = rows.join(scores.select(*NODE, F.col("score").alias(name)), NODE, "left").fillna(0.0, [name])
    rows = rows.withColumn("total", sum((F.col(n) for n in parts), F.lit(0.0))).withColumn("points", F.floor(F.round("total", 6)))
    ranks = rows.select("level_no", "points").distinct().withColumn("rank", F.dense_rank().over(Window.partitionBy("level_no").orderBy(F.col("points").desc())))
    return rows.join(ranks, ["level_no", "points"])


def promotion_coverage(promotions: DataFrame, coupons: DataFrame, goods: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node: goods under a promotion or coupon, and all such entries, over goods on sale; both also scaled over all nodes."""
    entries = promotions.select("goods").unionByName(coupons.select("goods")).groupBy("goods").agg(F.count("*").alias("_n"))
    rows = explode_levels(goods.where("sale_status = 4").join(entries, "goods", "left"), dim)
    found = rows.groupBy(*NODE).agg(F.count_distinct("goods").alias("on_sale"), F.count_distinct(F.when(F.col("_n").isNotNull(), F.col("goods"))).alias("_d"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_t"))
    rates = found.select(*NODE, "on_sale", (F.col("_d") / F.col("on_sale")).alias("coverage"), (F.col("_t") / F.col("on_sale")).alias("entries_per_goods"))
    span = rates.agg(*[f(c).alias(f"{n}_{c}") for c in ("coverage", "entries_per_goods") for n, f in (("low", F.min), ("high", F.max))])  # one row
    norm = lambda c: F.coalesce((F.col(c) - F.col(f"low_{c}")) / F.nullif(F.col(f"high_{c}") - F.col(f"low_{c}"), F.lit(0.0)), F.lit(0.0)).alias(f"{c}_norm")
    return rates.join(F.broadcast(span)).select(*rates.columns, norm("coverage"), norm("entries_per_goods"))


def _age(as_of: str, ts: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(ts))


def traffic_stages(events: DataFrame, as_of: str, stage: int = 10) -> DataFrame:
    """category: views of three stages (stage 1 the latest), of all three, and viewers."""
    age = _age(as_of, "ts")
    rows = events.where((F.col("behavior") == 1000) & age.between(0, 3 * stage - 1))
    return rows.groupBy("category").agg(*[F.count_if(F.floor(age / stage) == i).alias(f"pv{i + 1}") for i in range(3)], F.count("*").alias("pv"), F.count_distinct("member").alias("uv"))


def traffic_top(events: DataFrame, item: str, as_of: str, days: int = 30, k: int = 10) -> DataFrame:
    """category, item, pv, uv and both ranks, of items among the first `k` by either."""
    rows = events.where((F.col("behavior") == 1000) & _age(as_of, "ts").between(0, days - 1))
    found = rows.groupBy("category", F.col(item).alias("item")).agg(F.count("*").alias("pv"), F.count_distinct("member").alias("uv"))
    return _two_ranks(found, "pv", "uv", k)


def _two_ranks(df: DataFrame, a: str, b: str, k: int) -> DataFrame:
    w = Window.partitionBy("category")
    ranked = [F.row_number().over(w.orderBy(F.round(c, 4).desc(), "item")).alias(f"{c}_rank") for c in (a, b)]
    return df.select("*", *ranked).where((F.col(f"{a}_rank") <= k) | (F.col(f"{b}_rank") <= k))


def _third(price: Column, by: str) -> Column:
    """1, 2 or 3: the third of a group's price range that holds the price."""
    w = Window.partitionBy(by)
    low, width = F.min(price).over(w), (F.max(price).over(w) - F.min(price).over(w)) / 3
    return F.when(price < low + width, 1).when(price < low + 2 * width, 2).otherwise(3)


def band_viewers(events: DataFrame, goods: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """category, band, viewers: who viewed goods of each third of the category's price range."""
    bands = goods.select("category", "goods", _third(F.col("price"), "category").alias("band"))
    rows = events.where((F.col("behavior") == 1000) & _age(as_of, "ts").between(0, days - 1)).select("goods", "member")
    return rows.join(bands, "goods").groupBy("category", "band").agg(F.count_distinct("member").alias("viewers"))


def sales_status(orders: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """category: sales, units, members and brands of the last days, and the shares of sales and units by price third."""
    rows = orders.where(_age(as_of, "sale_time").between(0, days - 1)).withColumn("_band", _third(F.col("price"), "category"))
    part = lambda c, i: (F.sum(F.when(F.col("_band") == i, F.col(c)).otherwise(0.0)) / F.sum(c)).alias(f"{c}_share{i}")
    return rows.groupBy("category").agg(
        F.sum("amount").alias("sales"), F.sum("qty").alias("units"), F.count_distinct("member").alias("members"), F.count_distinct("brand").alias("brands"),
        *[part(c, i) for c in ("amount", "qty") for i in (1, 2, 3)],
    )


def sales_top(orders: DataFrame, item: str, as_of: str, days: int = 30, k: int = 10) -> DataFrame:
    """category, item, sales, units and both ranks, of items among the first `k` by either."""
    rows = orders.where(_age(as_of, "sale_time").between(0, days - 1))
    found = rows.groupBy("category", F.col(item).alias("item")).agg(F.sum("amount").alias("sales"), F.sum("qty").alias("units"))
    return _two_ranks(found, "sales", "units", k)


def category_summary_v2(goods: DataFrame, node: str = "level2", parent: str = "level1") -> DataFrame:
    """node, parent: goods, brands and products and their shares of the parent's."""
    counts = [F.count_distinct(c).alias(n) for c, n in (("goods", "goods_count"), ("brand", "brands"), ("product", "products"))]
    names = ("goods_count", "brands", "products")
    above = goods.groupBy(parent).agg(*counts).withColumnsRenamed({n: f"_{n}" for n in names})
    rows = goods.groupBy(parent, node).agg(*counts).join(above, parent)
    return rows.select(parent, node, *names, *[(F.col(n) / F.col(f"_{n}")).alias(f"{n}_share") for n in names])


def price_zones(goods: DataFrame, by: str = "level1", zones: int = 10) -> DataFrame:
    """by, zone, goods_count, brands within equal zones of the price range; the highest price is in the last zone."""
    w = Window.partitionBy(by)
    low, width = F.min("price").over(w), (F.max("price").over(w) - F.min("price").over(w)) / zones
    zone = F.when(width == 0, 0).otherwise(F.least(F.floor(F.round((F.col("price") - low) / width, 9)), F.lit(zones - 1))).cast("int")
    return goods.select(by, "goods", "brand", zone.alias("zone")).groupBy(by, "zone").agg(F.count_distinct("goods").alias("goods_count"), F.count_distinct("brand").alias("brands"))

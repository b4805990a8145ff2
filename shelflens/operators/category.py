"""Category tree and scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dealing import dealt
from .prefix import running, saved, values_at
from .rank import minmax, minmax_of_all, pareto_counts, share, top_k
from .rollup import roll_up

LEVELS = ("level1", "level2", "level3")


def level_tree(dim: DataFrame, key: str = "category", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """key, level_no, node, path, parent: a row for every level above a key that isn't null, with the path down to it and the node above."""
    tree = dim.select(key, F.posexplode(F.array(*levels)).alias("i", "node"), *levels).where("node IS NOT NULL")
    path = F.concat_ws(">", *[F.when(F.col("i") >= i, F.col(c)) for i, c in enumerate(levels)])
    parent = F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.array(*levels)), F.col("i") + 1)
    return tree.select(key, (F.col("i") + 1).alias("level_no"), "node", path.alias("path"), parent.alias("parent"))


def explode_levels(facts: DataFrame, dim: DataFrame, key: str = "category", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Each fact once for every level above it that isn't null: node, level_no, and the path down to the node."""
    return facts.drop(*levels).join(level_tree(dim, key, levels).drop("parent"), key)


def ancestor_leaves(dim: DataFrame, key: str = "category", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """node, n, leaves: the keys below each node, itself included if it is one, delimited."""
    rows = level_tree(dim, key, levels).select("node", key).distinct()
    return rows.groupBy("node").agg(F.count("*").alias("n"), F.expr(f"listagg({key}, '#') WITHIN GROUP (ORDER BY {key})").alias("leaves"))


def parent_child(dim: DataFrame) -> DataFrame:
    """parent, children: the categories below each level-2 node, delimited, itself left out."""
    rows = dim.where("category <> level2").select(F.col("level2").alias("parent"), "category").distinct()
    return rows.groupBy("parent").agg(F.count("*").alias("n"), F.expr("listagg(category, '#') WITHIN GROUP (ORDER BY category)").alias("children"))


def nearest_ancestor(dim: DataFrame) -> DataFrame:
    """category, ancestor: the deepest level that differs from it."""
    above = [F.when(F.col(c) != F.col("category"), F.col(c)) for c in ("level3", "level2")]
    return dim.select("category", F.coalesce(*above, "level1").alias("ancestor")).distinct()


def category_basic(goods: DataFrame, dim: DataFrame) -> DataFrame:
    counted = lambda c: ("sum", F.coalesce(c.cast("long"), F.lit(0)))
    measures = {"off_shelf": counted(F.col("sale_status") == 0), "out_of_stock": counted((F.col("stock") == 0) & (F.col("sale_status") == 4)), "min_price": ("min", F.col("price")), "max_price": ("max", F.col("price"))}
    nodes = roll_up(goods, dim, {}, "goods", measures, {"goods_count": None})
    brands = explode_levels(goods.select("category", "brand").distinct(), dim).groupBy(F.col("level_no").alias("_l"), F.col("path").alias("_p")).agg(F.count_distinct("brand").alias("brands"))
    return nodes.join(brands, (F.col("level_no") == F.col("_l")) & (F.col("path") == F.col("_p"))).select("level_no", "node", "path", "goods_count", "off_shelf", "out_of_stock", "brands", "min_price", "max_price")


def category_brand(goods: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node, brand: goods, those off the shelf and out of stock, and prices' ends; goods are told apart in partitions that follow their number."""
    key = ["level_no", "node", "brand"]
    rows = explode_levels(goods.select("category", "brand", "goods", "sale_status", "stock", "price"), dim)
    once = dealt(rows, len(LEVELS) * goods.count(), [*key, "goods"]).groupBy(*key, "goods").agg(
        F.count_if(F.col("sale_status") == 0).alias("off_shelf"), F.count_if((F.col("stock") == 0) & (F.col("sale_status") == 4)).alias("out_of_stock"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )
    return once.groupBy(*key).agg(F.count("goods").alias("goods_count"), F.sum("off_shelf").alias("off_shelf"), F.sum("out_of_stock").alias("out_of_stock"), F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"))


def _month(ts: str = "sale_time") -> Column:
    return F.date_format(ts, "yyyy-MM").alias("month")


def category_monthly_sales(orders: DataFrame, dim: DataFrame) -> DataFrame:
    return roll_up(orders, dim, {"month": _month()}, "goods", {"sales": ("sum", F.col("amount")), "units": ("sum", F.col("qty"))}, {"goods_sold": None}).drop("path")


def category_monthly_units(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node, month, units: those of category_monthly_sales, without its counts of goods."""
    leaf = orders.groupBy("category", _month()).agg(F.sum("qty").alias("units"))
    return explode_levels(leaf, dim).groupBy("level_no", "node", "month").agg(F.sum("units").alias("units"))


def category_sell_through(orders: DataFrame, goods: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node, month: goods sold, and goods that make 50 % and 80 % of sales, over goods on sale; 0 without sales."""
    leaf = saved(orders.groupBy("category", _month(), "goods").agg(F.sum("amount").alias("amount")), "sell-through")
    sold = explode_levels(leaf, dim).groupBy("level_no", "node", "month", "goods").agg(F.sum("amount").alias("amount"))
    key = ["level_no", "node", "month"]
    counts = pareto_counts(sold, key, "goods", "amount", {"n50": 0.5, "n80": 0.8}).withColumnRenamed("all_items", "sold")
    valid = explode_levels(goods.where("sale_status = 4"), dim).groupBy("level_no", "node").agg(F.count_distinct("goods").alias("valid"))
    months = leaf.select("month").distinct()
    grid = valid.join(F.broadcast(months))  # a row for each month
    ratio = lambda c: F.coalesce(F.col(c) / F.col("valid"), F.lit(0.0))
    return grid.join(counts, key, "left").select(*key, ratio("sold").alias("sell_through"), ratio("n50").alias("ratio50"), ratio("n80").alias("ratio80"))


def category_hotcakes(orders: DataFrame, dim: DataFrame, k: int = 20) -> DataFrame:
    leaf = orders.groupBy("category", _month(), "goods").agg(F.sum("qty").alias("units"))
    sold = explode_levels(leaf, dim).groupBy("level_no", "node", "month", "goods").agg(F.sum("units").alias("units"))
    return top_k(sold, ["level_no", "node", "month"], [F.col("units").desc(), F.col("goods")], k)


def category_popularity(events: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node, month: views, viewers, buyers, their shares of the level's month and those scaled to 0..1."""
    viewed, bought = (F.col("behavior") == code for code in (1000, 4000))
    found = roll_up(events, dim, {"month": _month("ts")}, "member", {"pv": ("sum", F.coalesce(viewed.cast("long"), F.lit(0)))}, {"uv": viewed, "buyers": bought}).drop("path")
    by = ["level_no", "month"]
    for c in ("pv", "uv", "buyers"):
        found = found.withColumn(f"{c}_share", F.coalesce(share(F.col(c).cast("double"), by), F.lit(0.0)))
    for c in ("pv", "uv", "buyers"):
        found = found.withColumn(f"{c}_norm", minmax(F.col(f"{c}_share"), by))
    return found


def stock_sales_ratio(orders: DataFrame, goods: DataFrame, dim: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """level_no, node, stock, units, ratio: goods in stock over units a day, to two places; 0 without sales."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    units = explode_levels(orders.where(age.between(0, days - 1)), dim).groupBy("level_no", "node").agg(F.sum("qty").alias("units"))
    stock = explode_levels(goods, dim).groupBy("level_no", "node").agg(F.sum("stock").alias("stock"))
    ratio = F.coalesce(F.round(F.col("stock") / (F.col("units") / days), 2), F.lit(0.0))
    return stock.join(units, ["level_no", "node"], "left").select("level_no", "node", "stock", F.coalesce("units", F.lit(0.0)).alias("units"), ratio.alias("ratio"))


def sales_score(orders: DataFrame, goods: DataFrame, dim: DataFrame, as_of: str, weights: tuple[float, float, float] = (0.4, 0.3, 0.3)) -> DataFrame:
    """level_no, node, score: 90-day sales (scaled within a level), sales per goods and growth on the half year (scaled over all)."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    recent = lambda n: F.sum(F.when(age.between(0, n - 1), F.col("amount")).otherwise(0.0))
    leaf = orders.groupBy("category").agg(recent(90).alias("s90"), recent(180).alias("s180"))  # lines add up before the levels are laid out
    sold = explode_levels(leaf, dim).groupBy("level_no", "node").agg(F.sum("s90").alias("s90"), F.sum("s180").alias("s180"))
    count = explode_levels(goods, dim).groupBy("level_no", "node").agg(F.count_distinct("goods").alias("n"))
    rows = count.join(sold, ["level_no", "node"], "left").fillna(0.0, ["s90", "s180"])
    half = F.col("s180") / 6
    rows = rows.withColumn("per_goods", F.col("s90") / F.col("n")).withColumn("growth", F.coalesce((F.col("s90") / 3 - half) / F.nullif(half, F.lit(0.0)), F.lit(0.0)))
    a, b, c = weights
    rows = minmax_of_all(rows.select("level_no", "node", "s90", "per_goods", "growth"), ["per_goods", "growth"])
    return rows.select("level_no", "node", (a * minmax(F.col("s90"), ["level_no"]) + b * F.col("per_goods") + c * F.col("growth")).alias("score"))


def price_distribution(goods: DataFrame, orders: DataFrame, dim: DataFrame, bins: int = 20) -> DataFrame:
    """level_no, node, bin, goods_count, units in bins of equal width; a node of one price has the single bin 0."""
    priced = explode_levels(goods, dim).select("level_no", "node", "goods", "price")
    ends = priced.groupBy("level_no", "node").agg(F.min("price").alias("_low"), ((F.max("price") - F.min("price")) / (bins - 1)).alias("_width"))
    at = F.when(F.col("_width") == 0, 0).otherwise(F.floor((F.col("price") - F.col("_low")) / F.col("_width"))).cast("int")
    binned = priced.join(ends, ["level_no", "node"]).select("level_no", "node", "goods", at.alias("bin"))
    units = orders.groupBy("goods").agg(F.sum("qty").alias("units"))
    return binned.join(units, "goods", "left").groupBy("level_no", "node", "bin").agg(F.count("*").alias("goods_count"), F.coalesce(F.sum("units"), F.lit(0.0)).alias("units"))


def category_summary_v1(goods: DataFrame) -> DataFrame:
    """category: brands, goods, products, prices with their upper-middle one, and the shares of price thirds."""
    ends = values_at(goods, ["category"], "price", {"_low": F.lit(0), "_high": F.col("_n") - 1, "median_price": F.floor(F.col("_n") / 2)})
    third = (F.col("_high") - F.col("_low")) / 3
    rows = goods.join(ends.select("category", F.col("_low").alias("_l"), third.alias("_t"), "median_price"), "category")
    cheap, dear = F.col("price") < F.col("_l") + F.col("_t"), F.col("price") >= F.col("_l") + 2 * F.col("_t")
    return rows.groupBy("category").agg(
        F.count_distinct("brand").alias("brands"), F.count_if(F.col("sale_status") == 4).alias("on_sale"), F.count_distinct("product").alias("products"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.avg("price").alias("mean_price"), F.max("median_price").alias("median_price"),
        F.avg(cheap.cast("double")).alias("low"), F.avg((~cheap & ~dear).cast("double")).alias("mid"), F.avg(dear.cast("double")).alias("high"),
    )


def sales_windows(orders: DataFrame, as_of: str) -> DataFrame:
    """category: sales, units and members of 1 and 3 months, share of members with two orders, growth 3 * m1 / m3."""
    month = lambda n: F.col("sale_time") > F.add_months(F.lit(as_of).cast("date"), -n)
    rows = orders.where(month(3) & (F.to_date("sale_time") <= F.lit(as_of).cast("date")))
    sums = rows.groupBy("category").agg(F.sum(F.when(month(1), F.col("amount")).otherwise(0.0)).alias("sales1"), F.sum("amount").alias("sales3"), F.sum(F.when(month(1), F.col("qty")).otherwise(0.0)).alias("units1"), F.sum("qty").alias("units3"))
    again = rows.groupBy("category", "member").agg(F.count_distinct("order_no").alias("n")).groupBy("category").agg(F.count("*").alias("members"), F.avg((F.col("n") >= 2).cast("double")).alias("repeat_rate"))
    return sums.join(again, "category").withColumn("growth", 3 * F.col("sales1") / F.col("sales3"))


def order_shape(orders: DataFrame) -> DataFrame:
    """category: mean days between purchases, amount and lines of an order, top-decile goods' share of sales.

    The lines are written down once; members, orders and goods are grouped in partitions that follow their number.
    """
    lines = saved(orders.select("category", "member", "order_no", "goods", "amount", F.to_date("sale_time").alias("day")), "order-shape")
    size = lines.count()
    each = lambda by, *values: dealt(lines.select("category", by, *values), size, ["category", by]).groupBy("category", by)
    dates = each("member", "day").agg(F.datediff(F.max("day"), F.min("day")).alias("span"), F.count_distinct("day").alias("n")).where("n > 1")
    cycle = dates.groupBy("category").agg((F.sum("span") / F.sum(F.col("n") - 1)).alias("days_between"))
    order = each("order_no", "amount").agg(F.sum("amount").alias("amount"), F.count("*").alias("lines")).groupBy("category").agg(F.avg("amount").alias("order_value"), F.avg("lines").alias("order_lines"))
    sold = running(each("goods", "amount").agg(F.sum("amount").alias("amount")), ["category"], [F.col("amount").desc(), F.col("goods")], [])
    top = sold.groupBy("category").agg((F.sum(F.when(F.col("_place") <= F.greatest(F.lit(1), F.floor(F.col("_count") / 10)), F.col("amount"))) / F.sum("amount")).alias("top_share"))
    return order.join(top, "category").join(cycle, "category", "left")


def brand_stock(goods: DataFrame, dim: DataFrame) -> DataFrame:
    """level_no, node, brand: goods and those in stock, counted by leaf before the levels are laid out."""
    leaf = goods.groupBy("category", "brand").agg(F.count_distinct("goods").alias("g"), F.count_distinct(F.when(F.col("stock") == 1, F.col("goods"))).alias("s"))
    return explode_levels(leaf, dim).groupBy("level_no", "node", "brand").agg(F.sum("g").alias("goods_count"), F.sum("s").alias("in_stock"))


def sibling_shares(goods: DataFrame, dim: DataFrame) -> DataFrame:
    """category, ancestor: its brands, goods on sale and products as shares of those of all categories under the same nearest ancestor."""
    sums = goods.groupBy("category").agg(F.count_distinct("brand").alias("brands"), F.count_if(F.col("sale_status") == 4).alias("on_sale"), F.count_distinct("product").alias("products"))
    rows = sums.join(nearest_ancestor(dim), "category")
    return rows.select("category", "ancestor", *[share(F.col(c).cast("double"), ["ancestor"]).alias(f"{c}_share") for c in ("brands", "on_sale", "products")])


def activity(orders: DataFrame, goods: DataFrame, as_of: str) -> DataFrame:
    """category: shares of its goods and brands that were sold in the last 30 and 90 days."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    sold = lambda n, c: F.count_distinct(F.when(age.between(0, n - 1), F.col(c)))
    active = orders.groupBy("category").agg(*[sold(n, c).alias(f"{c}{n}") for n in (30, 90) for c in ("goods", "brand")])
    every = goods.groupBy("category").agg(F.count_distinct("goods").alias("goods"), F.count_distinct("brand").alias("brands"))
    ratio = lambda c, n: F.coalesce(F.col(f"{c}{n}") / F.col({"goods": "goods", "brand": "brands"}[c]), F.lit(0.0)).alias(f"{c}_active{n}")
    return every.join(active, "category", "left").select("category", *[ratio(c, n) for n in (30, 90) for c in ("goods", "brand")])


def decile_shares(orders: DataFrame) -> DataFrame:
    """category: prices' ends, and the shares of sales of the top 10 and 20 per cent of its goods, one at least."""
    sold = orders.groupBy("category", "goods").agg(F.sum("amount").alias("amount"), F.min("price").alias("low"), F.max("price").alias("high"))
    ranked = running(sold, ["category"], [F.col("amount").desc(), F.col("goods")], [])
    top = lambda k: F.sum(F.when(F.col("_place") <= F.greatest(F.lit(1), F.floor(k * F.col("_count") / 10)), F.col("amount"))) / F.sum("amount")
    return ranked.groupBy("category").agg(F.min("low").alias("min_price"), F.max("high").alias("max_price"), top(1).alias("top10"), top(2).alias("top20"))


def best_goods(orders: DataFrame, k: int = 10) -> DataFrame:
    """category, goods, amount, rank of a category's best-selling goods."""
    return top_k(orders.groupBy("category", "goods").agg(F.sum("amount").alias("amount")), ["category"], [F.round("amount", 4).desc(), F.col("goods")], k)


def zone_activity(orders: DataFrame, goods: DataFrame, by: str, as_of: str, days: int = 90) -> DataFrame:
    """by, zone (thirds of the price range): goods, brands, sales of the last `days` and the share of goods sold in them."""
    ends = goods.groupBy(by).agg(F.min("price").alias("_low"), ((F.max("price") - F.min("price")) / 3).alias("_width"))
    zone = F.when(F.col("_width") == 0, 0).otherwise(F.least(F.floor((F.col("price") - F.col("_low")) / F.col("_width")), F.lit(2))).cast("int")
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    sold = orders.where(age.between(0, days - 1)).groupBy("goods").agg(F.sum("amount").alias("amount"))
    rows = goods.join(ends, by).select(by, "goods", "brand", zone.alias("zone")).join(sold, "goods", "left")
    return rows.groupBy(by, "zone").agg(F.count("*").alias("goods_count"), F.count_distinct("brand").alias("brands"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("sales"), F.avg(F.col("amount").isNotNull().cast("double")).alias("active"))

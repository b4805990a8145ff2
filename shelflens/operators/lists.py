"""Recommendation lists from behaviour and the goods catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running
from .rank import top_k


def joined(df: DataFrame, by: list[str], item: str, order: str, name: str = "items", sep: str = "#") -> DataFrame:
    """Ordered lists as delimited text."""
    return df.groupBy(*by).agg(F.expr(f"listagg(cast({item} AS string), '{sep}') WITHIN GROUP (ORDER BY {order})").alias(name))


def joined_parts(df: DataFrame, by: list[str], item: str, size: int = 1000, name: str = "items", sep: str = "#") -> DataFrame:
    """by, part, items: a key's distinct items in order, delimited, `size` to a numbered part, so that no text grows with the table."""
    rows = running(df.select(*by, item).distinct(), by, [F.col(item)], [])
    return joined(rows.withColumn("part", F.floor((F.col("_place") - 1) / size)), [*by, "part"], item, item, name, sep)


def viewed_not_bought(events: DataFrame) -> DataFrame:
    """member, category, goods, last_view: views on days on which the member didn't buy those goods. `nested_list` orders them."""
    key = ["member", "day", "category", "goods"]
    left = events.where("behavior = 1000").join(events.where("behavior = 4000").select(*key).distinct(), key, "left_anti")
    return left.groupBy("member", "category", "goods").agg(F.max("ts").alias("last_view"))


def purchase_history(events: DataFrame) -> DataFrame:
    """member, category, goods, bought, times of purchases."""
    return events.where("behavior = 4000").groupBy("member", "category", "goods").agg(F.max("ts").alias("bought"), F.count("*").alias("times"))


def hot_sale(orders: DataFrame, as_of: str, days: int = 30, window: int = 60, k: int = 20, recent_weight: int = 2) -> DataFrame:
    """category, store, goods, score, rank: quantity of the last `window` days, the last `days` counting more."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("sale_time"))
    weighed = F.col("qty") * F.when(age < days, recent_weight).otherwise(1)
    found = orders.where(age.between(0, window - 1)).groupBy("category", "store", "goods").agg(F.sum(weighed).alias("score"))
    return top_k(found, ["category", "store"], [F.col("score").desc(), F.col("goods")], k)


def daypart(ts: Column) -> Column:
    return F.when((F.hour(ts) >= 8) & (F.hour(ts) < 12), "forenoon").when((F.hour(ts) >= 12) & (F.hour(ts) < 18), "afternoon").otherwise("evening")


def daypart_top_categories(events: DataFrame, k: int = 20) -> DataFrame:
    found = events.where("behavior = 4000").groupBy(daypart(F.col("ts")).alias("daypart"), "category").agg(F.count("*").alias("n"))
    return top_k(found, ["daypart"], [F.col("n").desc(), F.col("category")], k)


def new_arrivals(feed: DataFrame, quota: int = 20) -> DataFrame:
    """category, brand, goods, rank: of each brand in a category its share of `quota` newest goods, at least one.

    `feed`: goods, product, brand, category, started. Of one product's goods the newest stands for it.
    """
    one = top_k(feed, ["product"], [F.col("started").desc(), F.col("goods")], 1, "_first").drop("_first")
    brand = one.groupBy("category", "brand").agg(F.count("*").alias("n_brand"))
    category = one.groupBy("category").agg(F.count("*").alias("n_category"))
    ranked = top_k(one, ["category", "brand"], [F.col("started").desc(), F.col("goods")], 1 << 30)
    allowed = F.ceil(F.lit(quota) * F.col("n_brand") / F.col("n_category"))
    return ranked.join(brand, ["category", "brand"]).join(category, "category").where(F.col("rank") <= allowed).select("category", "brand", "goods", "rank")


def category_goods(goods: DataFrame, by: list[str], k: int = 200) -> DataFrame:
    """Goods on sale and in stock of each key as a list, in the order of their ids, `k` at most."""
    sold = goods.where("sale_status = 4 AND stock = 1")
    return joined(top_k(sold, by, [F.col("goods")], k), by, "goods", "rank")


def goods_profile(goods: DataFrame, prefixes: dict[int, str] | None = None) -> DataFrame:
    """key, profile (JSON) of every goods under its channel's prefix."""
    names = prefixes or {3: "pc_", 1: "app_", 2: "h5_"}
    prefix = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return goods.select(F.concat(prefix[F.col("channel")], F.col("goods").cast("string")).alias("key"), F.to_json(F.struct("goods", "name", "brand", "category")).alias("profile"))


def cookie_map(rows: DataFrame, cookie: str, member: str, seen: str) -> DataFrame:
    """cookie -> the member seen with it last."""
    last = rows.groupBy(cookie, member).agg(F.max(seen).alias("seen"))
    return top_k(last, [cookie], [F.col("seen").desc(), F.col(member)], 1).drop("rank")


def rec_conversion(views: DataFrame, recs: DataFrame) -> DataFrame:
    """day, recommended, viewed, rate: distinct (member, day, goods) recommended, and those that were viewed as well."""
    key = ["member", "day", "goods"]
    rec, seen = recs.select(*key).distinct(), views.select(*key).distinct().withColumn("hit", F.lit(1))
    out = rec.join(seen, key, "left").groupBy("day").agg(F.count("*").alias("recommended"), F.count("hit").alias("viewed"))
    return out.withColumn("rate", F.col("viewed") / F.col("recommended"))


def recent_view_counts(events: DataFrame, k: int = 10) -> DataFrame:
    """member, goods, views, rank of the last day on which the member viewed anything."""
    views = events.where("behavior = 1000")
    last = views.groupBy("member").agg(F.max("day").alias("day"))
    found = views.join(last, ["member", "day"]).groupBy("member", "goods").agg(F.count("*").alias("views"))
    return top_k(found, ["member"], [F.col("views").desc(), F.col("goods")], k)


def member_cookies(rows: DataFrame, cookie: str, member: str, seen: str) -> DataFrame:
    """member, items: a member's cookies newest first, delimited."""
    last = rows.groupBy(member, cookie).agg(F.max(seen).alias("_seen"))
    return joined(last, [member], cookie, f"_seen DESC, {cookie}")


def channel_arrivals(feed: DataFrame, quota: int = 20) -> DataFrame:
    """channel, category, items: new arrivals of each channel's part of the feed, newest first."""
    inner = feed.withColumn("category", F.struct("channel", "category"))
    found = new_arrivals(inner, quota).join(feed.select("goods", "started"), "goods").select("category.*", "goods", "started")
    return joined(found, ["channel", "category"], "goods", "started DESC, goods")


def goods_maps(goods: DataFrame, k: int = 200) -> dict[str, DataFrame]:
    """Goods on sale and in stock: each one's category, and the lists of a shop's category, a category and a shop (`k` at most)."""
    sold = goods.where("sale_status = 4 AND stock = 1")
    return {
        "goods_category": sold.select("goods", "category"),
        "shop_category_goods": joined(sold, ["shop", "category"], "goods", "goods"),
        "category_goods": joined(sold, ["category"], "goods", "goods"),
        "shop_goods": category_goods(goods, ["shop"], k),
    }

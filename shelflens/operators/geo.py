"""Orders by district and store, and points in delivery polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dealing import distinct_counts
from .intervals import points_in_areas as points_in_polygons
from .rank import share, top_k


def diamonds(zones: DataFrame) -> DataFrame:
    """zone and ring of the square on its corner with centre (cx, cy) and half-diagonal r."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    cx, cy, r = F.col("cx"), F.col("cy"), F.col("r")
    return zones.select("zone", F.array(corner(cx - r, cy), corner(cx, cy - r), corner(cx + r, cy), corner(cx, cy + r)).alias("ring"))


def order_metrics(orders: DataFrame, by: list[Column | str]) -> DataFrame:
    """Sales, units, orders and members with their ratios."""
    rows = orders.groupBy(*by).agg(F.sum("amount").alias("sales"), F.sum("qty").alias("units"), F.count_distinct("order_no").alias("orders"), F.count_distinct("member").alias("members"))
    s = F.col("sales")
    return rows.withColumn("unit_price", s / F.col("units")).withColumn("per_order", s / F.col("orders")).withColumn("orders_per_member", F.col("orders") / F.col("members")).withColumn("per_member", s / F.col("members"))


def store_profile(orders: DataFrame, item: str, k: int = 100) -> DataFrame:
    """store, item, lines, share, rank of the store's most frequent items."""
    rows = orders.groupBy("store", F.col(item).alias("item")).agg(F.count("*").alias("lines"))
    return top_k(rows.withColumn("share", share(F.col("lines").cast("double"), ["store"])), ["store"], [F.col("lines").desc(), F.col("item")], k)


def store_deviation(orders: DataFrame, by: str, least: int = 10) -> DataFrame:
    """by, stores, deviation: root of the mean squared distance of the stores' sales from their mean, of items with enough members."""
    enough = orders.groupBy(by).agg(F.count_distinct("member").alias("n")).where(F.col("n") >= least).select(by)
    sold = orders.join(enough, by).groupBy(by, "store").agg(F.sum("amount").alias("x"))
    mean = F.avg("x").over(Window.partitionBy(by))
    return sold.withColumn("d", F.pow(mean - F.col("x"), 2)).groupBy(by).agg(F.count("store").alias("stores"), F.sqrt(F.sum("d") / F.count("store")).alias("deviation"))  # a row a store


def category_features(orders: DataFrame) -> DataFrame:
    """level1: its mean share over stores of sales, units and orders."""
    rows = distinct_counts(orders, ["store", "level1"], {"orders": "order_no"}, {"sales": F.col("amount"), "units": F.col("qty")}).withColumn("orders", F.col("orders").cast("double"))
    for c in ("sales", "units", "orders"):
        rows = rows.withColumn(f"{c}_share", share(F.col(c), ["store"]))
    return rows.groupBy("level1").agg(*[F.avg(f"{c}_share").alias(f"{c}_share") for c in ("sales", "units", "orders")])


def store_category_matrix(orders: DataFrame, categories: list[str]) -> DataFrame:
    """A row for each store, a column for each category's share of its sales; 0 where it sells none."""
    rows = orders.groupBy("store", "level1").agg(F.sum("amount").alias("x")).withColumn("s", share(F.col("x"), ["store"]))
    return rows.groupBy("store").pivot("level1", categories).agg(F.sum("s")).fillna(0.0)


def order_store_wide(orders: DataFrame, places: DataFrame, polygons: DataFrame) -> DataFrame:
    """Every order with the place of its address and each zone that holds it; addresses are compared without spaces.

    `places` has id, address, x, y. An order of an address that is unknown or outside every zone is left out.
    """
    key = F.regexp_replace("address", " ", "").alias("_key")
    zones = points_in_polygons(places.select("id", "x", "y"), polygons)
    located = places.select("id", "x", "y", key).join(zones, "id").drop("id")
    return orders.select("*", key).join(located, "_key").drop("_key")


SCOPE = "STRUCT<scopeVOList: ARRAY<STRUCT<lngLatList: ARRAY<ARRAY<DOUBLE>>>>>"


def parse_scopes(stores: DataFrame, scope: str = "scope") -> DataFrame:
    """zone, ring of every polygon of each store's scope in JSON; a scope that can't be read has none."""
    polygons = stores.select("zone", F.explode(F.from_json(scope, SCOPE)["scopeVOList"]["lngLatList"]).alias("_p"))
    ring = F.transform("_p", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return polygons.where("_p IS NOT NULL").select("zone", ring.alias("ring"))


def store_shares(orders: DataFrame, item: str, k: int = 100) -> DataFrame:
    """store, item, sales, share of the store's sales, rank by sales."""
    rows = orders.groupBy("store", F.col(item).alias("item")).agg(F.sum("amount").alias("sales"))
    return top_k(rows.withColumn("share", share(F.col("sales"), ["store"])), ["store"], [F.round("sales", 4).desc(), F.col("item")], k)


def store_summary(orders: DataFrame, cuts: DataFrame) -> DataFrame:
    """store: members, orders, sales, and the shares of lines below, between and above its categories' price cuts (category, low, high)."""
    rows = orders.join(cuts, "category")
    tier = lambda c: F.avg(c.cast("double"))
    price = F.col("price")
    return rows.groupBy("store").agg(
        F.count_distinct("member").alias("members"), F.count_distinct("order_no").alias("orders"), F.sum("amount").alias("sales"),
        tier(price < F.col("low")).alias("cheap"), tier((price >= F.col("low")) & (price < F.col("high"))).alias("middle"), tier(price >= F.col("high")).alias("dear"),
    )


def six_shares(orders: DataFrame) -> DataFrame:
    """level1: its mean share over stores of sales, units, orders, members, goods and lines."""
    what = ("sales", "units", "orders", "members", "goods", "lines")
    rows = distinct_counts(orders, ["store", "level1"], {"orders": "order_no", "members": "member", "goods": "goods"}, {"sales": F.col("amount"), "units": F.col("qty"), "lines": F.lit(1)})
    shares = rows.select("level1", *[share(F.col(n).cast("double"), ["store"]).alias(n) for n in what])
    return shares.groupBy("level1").agg(*[F.avg(n).alias(f"{n}_share") for n in what])


def store_matrix(orders: DataFrame, categories: list[str], value: Column) -> DataFrame:
    """A row for each store, a column for each category's share of `value` (an aggregate); 0 where it has none."""
    rows = orders.groupBy("store", "level1").agg(value.cast("double").alias("x")).withColumn("s", share(F.col("x"), ["store"]))
    return rows.groupBy("store").pivot("level1", categories).agg(F.sum("s")).fillna(0.0)

"""The operators on the test tables, by name. Doubles are rounded to six places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.text import jaccard, normalize_nulls
from .operators import category as C
from .operators import cooccurrence as R
from .operators import geo, lists, models, profile, rank, search
from .operators import scorecard as S
from .operators.dealing import distinct_counts
from .operators.prefix import saved
from .plans.views import view
from .sources import tables
from .sources.scratch import scratch_path
from .streaming import events as stream

Query = Callable[[SparkSession, str], DataFrame]
EVENTS_AS_OF, ORDERS_AS_OF = "2024-01-31", "2001-08-01"


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _on(f: Callable[..., DataFrame], *views: str) -> Query:
    return lambda spark, sf_dir: rounded(f(*[view(spark, sf_dir, v) for v in views]))


def _ratings(events: DataFrame) -> DataFrame:
    return R.implicit_ratings(events, EVENTS_AS_OF)


def _metrics(goods: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    return search.goods_metrics(goods, orders, events, ORDERS_AS_OF)


def _feed(goods: DataFrame) -> DataFrame:
    return goods.select("goods", "product", "brand", F.col("level1").alias("category"), (F.col("goods") * 7 % 1000).alias("started"))


def _own(goods: DataFrame) -> DataFrame:
    return goods.where("goods % 2 = 0")


def _other(goods: DataFrame) -> DataFrame:
    return goods.where("goods % 2 = 1")


def _conversion(events: DataFrame) -> DataFrame:
    """Clicked goods stand for recommended ones."""
    return lists.rec_conversion(events.where("behavior = 1000"), events.where("behavior = 2000")).withColumn("day", F.col("day").cast("string"))


def _latest_price(orders: DataFrame) -> DataFrame:
    w = Window.partitionBy("goods").orderBy(F.col("sale_time").desc(), F.col("order_no").desc(), F.col("line").desc())
    return orders.withColumn("n", F.row_number().over(w)).where("n = 1").select("goods", "sale_time", "price")


def _weighted(orders: DataFrame) -> DataFrame:
    """Lines of a level, and their shares of brands, stand for the weights of components and parts."""
    conf = orders.groupBy(F.col("level1").alias("component")).agg((F.count("*") / 1000).alias("weight"))
    details = orders.groupBy(F.col("level1").alias("component"), F.col("brand").alias("sub")).agg((F.sum("qty") / 100).alias("weight"))
    return S.score_weights(conf, details)


def _running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.drain(stream.running_count(stream.file_source(spark, sf_dir, "events"), "event_type"), scratch_path(spark, "stream"))


def _sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = stream.sliding_count(stream.file_source(spark, sf_dir, "events"), "ts", "event_type", "2 hours", "1 hour")
    return stream.drain(counted, scratch_path(spark, "stream")).select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "count")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = spark.sql("SELECT explode(array('the', 'and', 'of')) AS word")
    return stream.drain(stream.word_count(stream.file_source(spark, sf_dir, "conversations"), stop, "text"), scratch_path(spark, "stream"))


def _upserted(goods: DataFrame) -> DataFrame:
    new = goods.where("goods % 10 = 0").select("goods", (F.col("price") * 2).alias("price"), "brand")
    return tables.upsert(goods.select("goods", "price", "brand"), new, ["goods"])


def _updated(goods: DataFrame) -> DataFrame:
    return tables.update_columns(goods.select("goods", "price", "brand"), goods.where("goods % 10 = 0").select("goods", (F.col("price") * 2).alias("price")), ["goods"], ["price"])


#: Points of the four parts of a node's score, 25 each.
OPERATION = {"in_stock_rate": 7.5, "fill_rate": 5.0, "price_changes": 5.0, "shelf_changes": 2.5, "steadiness": 5.0}
POPULARITY = {"pv": 7.5, "uv": 7.5, "buyers": 10.0}
PRODUCT = {"concentration": 10.0, "sell_through": 10.0, "correlation": 5.0}
LEVEL1 = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _operation(goods: DataFrame, orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders stand for price changes, large ones for changes of shelf, monthly units for ratios."""
    fill = lambda n, snapshot: goods.select("goods", F.lit(snapshot).alias("snapshot"), (F.col("comments") / n).alias("fill_rate"))
    changes = orders.select("goods", "qty", F.col("sale_time").alias("changed_at"))
    ratios = C.category_monthly_units(orders, dim).select("level_no", "node", F.col("units").alias("ratio"))
    return S.operation(goods, fill(100, 1).unionByName(fill(50, 2)), changes, changes.where("qty >= 25"), ratios, dim, ORDERS_AS_OF)


def _product_line(goods: DataFrame, orders: DataFrame, dim: DataFrame) -> DataFrame:
    """A month's figures come from its own orders, so those of months that the score leaves out aren't worked out first."""
    scored = orders.where(S.scored_month(F.date_format("sale_time", "yyyy-MM"), ORDERS_AS_OF))
    monthly = rounded(C.category_sell_through(scored, goods, dim))
    return S.product_line_score(monthly, S.price_correlation(C.price_distribution(goods, orders, dim)), PRODUCT, ORDERS_AS_OF)


def _overall(goods: DataFrame, orders: DataFrame, events: DataFrame, dim: DataFrame) -> DataFrame:
    """The columns of the order lines that the parts read, and the tree, are written down once; the joins below them run once."""
    orders = saved(orders.select("category", "goods", "amount", "qty", "sale_time"), "overall-orders")
    dim = saved(dim, "overall-tree")
    parts = {
        "sales": rounded(C.sales_score(orders, goods, dim, ORDERS_AS_OF)).withColumn("score", 25 * F.col("score")),
        "product": rounded(_product_line(goods, orders, dim)),
        "popularity": rounded(S.popularity_score(C.category_popularity(events, dim), POPULARITY, "2024-01")),
        "operation": rounded(S.operation_score(_operation(goods, orders, dim), OPERATION)),
    }
    return S.overall_score(C.explode_levels(goods, dim).select("level_no", "node").distinct(), parts)


def _attributes(goods: DataFrame) -> DataFrame:
    terms = F.concat(F.split("name", " "), F.array(F.concat(F.lit("size:"), F.col("comments").cast("string")), F.concat(F.lit("brand:"), F.col("brand"))))
    attrs = goods.select("level1", "goods", F.explode(terms).alias("term"))
    return models.attribute_similarity(attrs, models.price_levels(goods, "level1"), "level1")


def _itemsets(events: DataFrame) -> DataFrame:
    baskets = events.where("behavior = 4000").groupBy("member", "level1", "week").agg(F.collect_set("goods").alias("items")).select("items")
    return models.frequent_itemsets(baskets).select(F.array_join(F.col("items").cast("array<string>"), "#").alias("items"), "freq")


def _clusters(orders: DataFrame) -> DataFrame:
    columns = ["sales", "units", "orders", "members", "per_order"]
    return models.kmeans_categories(geo.order_metrics(orders, ["level2"]).select("level2", *columns), columns)[0]


def _with_conversion(goods: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    reviews = goods.select("goods", F.col("comments").alias("reviews"), (F.col("goods") % 5 + 1).alias("review_score"), (F.col("comments") / 50).alias("fill_rate"))
    return models.search_score_with_conversion(_metrics(goods, orders, events).join(reviews, "goods"))


def _labelled(events: DataFrame) -> DataFrame:
    """Purchases; odd and even members stand for the two labels."""
    return events.where("behavior = 4000").withColumn("label", F.col("member") % 2)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read_tagged(spark, [f"{sf_dir}/{t}.parquet" for t in ("nation", "supplier", "orders")])
    return rows.groupBy("ordinal").agg(F.count("*").alias("n"))


#: A location message for each event, every tenth one broken off, in SQL that Spark and DuckDB both read.
MESSAGE = """concat('{"createDate":"', cast(ts AS date), '","memberId":"', user_id, '","memberLantitude":"', event_id % 90, '","memberLongitude":"', event_id % 180, '","method":"get","methodType":"', event_type, CASE WHEN event_id % 10 = 0 THEN '' ELSE '"}' END)"""


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = stream.file_source(spark, sf_dir, "events").selectExpr(f"{MESSAGE} AS value")
    return stream.drain(stream.location_log(messages), scratch_path(spark, "stream"), "append", stream.with_log_keys).drop("value")


def _last_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = stream.file_source(spark, sf_dir, "events").where("event_type = 'view'").selectExpr("concat('c', user_id) AS cookie", "cast(get_json_object(props, '$.k') AS bigint) AS goods", "ts")
    cookies = view(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS cookie", "c_custkey AS member")
    return stream.drain(stream.last_views(views, cookies), scratch_path(spark, "stream"))


QUERIES: dict[str, Query] = {
    # relational parts
    "p4_missing_values": _on(lambda c: c.select("c_custkey", normalize_nulls(F.when(F.col("c_custkey") % 3 == 0, "NULL").when(F.col("c_custkey") % 3 == 1, "").otherwise(F.col("c_mktsegment"))).alias("segment")).dropna(subset=["segment"]), "customer"),
    "j3_left_join_default": _on(lambda c, o: c.select("c_custkey").join(o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")), "c_custkey", "left").fillna(0, ["n"]), "customer", "orders"),
    "j10_anti_join": _on(lambda c, o: c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey"), "customer", "orders"),
    "j11_semi_join": _on(lambda p, e: p.join(e.select("goods"), p["p_partkey"] == e["goods"], "left_semi").select("p_partkey"), "part", "v_events"),
    "a3_count_distinct": _on(lambda o: distinct_counts(o, ["store"], {"members": "member", "goods": "goods", "orders": "order_no"}), "v_orders"),
    "a9_median": _on(lambda o: o.groupBy("brand").agg(F.median("price").alias("median_price")), "v_orders"),
    "a10_positional_quantiles": _on(lambda g: rank.positional_quantile(g, ["level1"], "price", [2, 4, 6, 8]), "v_goods"),
    "a11_deviation": _on(lambda o: o.groupBy("goods").agg(F.count("*").alias("n"), F.stddev_pop("price").alias("deviation")).where("n >= 5 AND deviation > 1e-9"), "v_orders"),
    "a14_correlation": _on(lambda o: o.groupBy("level1").agg(F.corr("price", "qty").alias("c")).select("level1", F.when(F.col("c").between(0, 1), F.col("c")).otherwise(0.0).alias("correlation")), "v_orders"),
    "a15_listed": _on(lambda g: lists.joined(g, ["brand"], "goods", "goods"), "v_goods"),
    "w1_top_k": _on(lambda o: rank.top_k(o.groupBy("store", "goods").agg(F.sum("amount").alias("sales")), ["store"], [F.round("sales", 4).desc(), F.col("goods")], 5), "v_orders"),
    "w4_dense_rank": _on(lambda g: rank.dense_rank_desc(g.groupBy("level2").agg(F.count("*").alias("n")), "n"), "v_goods"),
    "w5_pareto": _on(lambda o: rank.pareto_count(o.groupBy("level1", "goods").agg(F.sum("qty").alias("units")), ["level1"], "goods", "units", 0.8), "v_orders"),
    "w9_share": _on(lambda o: o.groupBy("region", "district").agg(F.sum("amount").alias("sales")).withColumn("share", rank.share(F.col("sales"), ["region"])), "v_orders"),
    "w12_latest": _on(_latest_price, "v_orders"),
    "w13_minmax": _on(lambda g: g.select("goods", rank.minmax(F.col("price"), ["level2"]).alias("scaled")), "v_goods"),
    "u2_fused_scores": _on(lambda e, o: e.groupBy("goods").agg(F.count("*").cast("double").alias("score")).unionByName(o.groupBy("goods").agg(F.sum("qty").alias("score"))).groupBy("goods").agg(F.sum("score").alias("score")), "v_events", "v_orders"),
    "u4_except": _on(lambda c, o: c.select(F.col("c_custkey").alias("id")).subtract(o.select(F.col("o_custkey").alias("id"))), "customer", "orders"),
    "f1_jaccard": _on(lambda p: p.select("p_partkey", jaccard(F.col("p_name"), F.concat_ws(" ", "p_type", "p_brand")).alias("score")), "part"),
    "s15_upsert": _on(_upserted, "v_goods"),
    "s16_update_columns": _on(_updated, "v_goods"),
    "s18_delete_keys": _on(lambda g: tables.delete_keys(g.select("goods", "brand"), g.where("sale_status = 0"), ["goods"]), "v_goods"),
    # category tree
    "g1_explode_levels": _on(lambda g, d: C.explode_levels(g, d).groupBy("level_no", "node", "path").agg(F.count("*").alias("n")), "v_goods", "v_category_dim"),
    "g2_parent_child": _on(C.parent_child, "v_category_dim"),
    "g3_nearest_ancestor": _on(C.nearest_ancestor, "v_category_dim"),
    # recommendation lists
    "r1_also_viewed": _on(R.also_viewed, "v_events"),
    "r2_view_then_buy": _on(R.view_then_buy, "v_events"),
    "r3_also_bought": _on(R.also_bought, "v_events"),
    "r4_category_also_bought": _on(R.category_also_bought, "v_events"),
    "r5_viewed_not_bought": _on(lists.viewed_not_bought, "v_events"),
    "r6_purchase_history": _on(lists.purchase_history, "v_events"),
    "r7_hot_sale": _on(lambda o: lists.hot_sale(o, ORDERS_AS_OF), "v_orders"),
    "r8_daypart_top": _on(lists.daypart_top_categories, "v_events"),
    "r9_new_arrivals": _on(lambda g: lists.new_arrivals(_feed(g)), "v_goods"),
    "r10_category_goods": _on(lambda g: lists.category_goods(g, ["shop", "level1"]), "v_goods"),
    "r12_cookie_map": _on(lambda e: lists.cookie_map(e, "shop", "member", "ts"), "v_events"),
    "r13_rec_conversion": _on(_conversion, "v_events"),
    "r14_recent_views": _on(lists.recent_view_counts, "v_events"),
    # preferences
    "e1_category_preference": _on(lambda e: profile.category_preference(e, EVENTS_AS_OF), "v_events"),
    "e2_goods_preference": _on(lambda e: profile.goods_preference(e, EVENTS_AS_OF), "v_events"),
    "e3_buying_cycle": _on(profile.buying_cycle, "v_events"),
    "e4_interest_degree": _on(profile.interest_degree, "v_events"),
    "e5_price_tiers": _on(profile.price_tier_preference, "v_events", "v_goods"),
    "e8_view_sequences": _on(profile.view_sequences, "v_events"),
    # ratings
    "m1_implicit_ratings": _on(_ratings, "v_events"),
    "m2_item_cf": _on(lambda e: R.item_cf(_ratings(e)), "v_events"),
    "m3_user_cf": _on(lambda e: R.user_cf(_ratings(e)), "v_events"),
    "m6_llr": _on(lambda e: R.llr_item_similarity(_ratings(e)), "v_events"),
    # category scorecard
    "c1_basic": _on(C.category_basic, "v_goods", "v_category_dim"),
    "c2_brand": _on(C.category_brand, "v_goods", "v_category_dim"),
    "c3_monthly_sales": _on(C.category_monthly_sales, "v_orders", "v_category_dim"),
    "c4_sell_through": _on(C.category_sell_through, "v_orders", "v_goods", "v_category_dim"),
    "c5_hotcakes": _on(C.category_hotcakes, "v_orders", "v_category_dim"),
    "c6_popularity": _on(C.category_popularity, "v_events", "v_category_dim"),
    "c7_stock_sales": _on(lambda o, g, d: C.stock_sales_ratio(o, g, d, ORDERS_AS_OF), "v_orders", "v_goods", "v_category_dim"),
    "c11_sales_score": _on(lambda o, g, d: C.sales_score(o, g, d, ORDERS_AS_OF), "v_orders", "v_goods", "v_category_dim"),
    "c13_price_distribution": _on(C.price_distribution, "v_goods", "v_orders", "v_category_dim"),
    "c17_summary": _on(C.category_summary_v1, "v_goods"),
    "c21_sales_windows": _on(lambda o: C.sales_windows(o, ORDERS_AS_OF), "v_orders"),
    "c22_order_shape": _on(C.order_shape, "v_orders"),
    # search and competitors
    "q1_goods_score": _on(lambda g, o, e: search.goods_search_score(_metrics(g, o, e)).drop("category", "level1", "channel"), "v_goods", "v_orders", "v_events"),
    "q3_goods_score_all_channels": _on(lambda g, o, e: search.goods_search_score(_metrics(g, o, e), by=("level1",)).select("goods", "score"), "v_goods", "v_orders", "v_events"),
    "q4_category_ranking": _on(lambda g, o, e: search.category_ranking(search.goods_search_score(_metrics(g, o, e))), "v_goods", "v_orders", "v_events"),
    "q5_brand_scores": _on(lambda g, o, e: search.brand_scores(_metrics(g, o, e), g), "v_goods", "v_orders", "v_events"),
    "q6_hot_words": _on(lambda c: search.hot_words(search.search_terms(c, "role")), "conversations"),
    "q6_category_terms": _on(lambda c: search.category_terms(search.search_terms(c, "role")), "conversations"),
    "q7_similar_terms": _on(lambda c: search.similar_terms(search.search_terms(c, "role")), "conversations"),
    "k1_category_match": _on(lambda g: search.match_categories(_own(g), _other(g), "level2"), "v_goods"),
    "k2_brand_gap": _on(lambda g: search.brand_gap(_own(g), _other(g), "category", least=1), "v_goods"),
    "k3_price_bins": _on(lambda g: search.competitor_price_bins(_own(g), _other(g), "level1"), "v_goods"),
    "k4_item_match": _on(lambda g: search.item_match_features(_own(g), _other(g), "level1"), "v_goods"),
    # geography
    "geo1_points_in_polygons": _on(lambda p, z: geo.points_in_polygons(p, geo.diamonds(z)), "v_points", "v_diamonds"),
    "geo3_district_month": _on(lambda o: geo.order_metrics(o, ["district", F.date_format("sale_time", "yyyy-MM").alias("month")]), "v_orders"),
    "geo3_district_category": _on(lambda o: geo.order_metrics(o, ["district", "level1"]), "v_orders"),
    "geo4_store_goods": _on(lambda o: geo.order_metrics(o, ["store", "goods"]), "v_orders"),
    "geo5_store_profile": _on(lambda o: geo.store_profile(o, "brand"), "v_orders"),
    "geo6_store_deviation": _on(lambda o: geo.store_deviation(o, "brand"), "v_orders"),
    "geo7_category_features": _on(geo.category_features, "v_orders"),
    # streams
    "t4_running_count": _running,
    "t5_sliding_count": _sliding,
    "t7_word_count": _words,
    "t8_location_log": _locations,
    "t10_last_views": _last_views,
    # scores of category nodes
    "c8_operation": _on(_operation, "v_goods", "v_orders", "v_category_dim"),
    "c9_operation_score": _on(lambda g, o, d: S.operation_score(_operation(g, o, d), OPERATION), "v_goods", "v_orders", "v_category_dim"),
    "c10_popularity_score": _on(lambda e, d: S.popularity_score(C.category_popularity(e, d), POPULARITY, "2024-01"), "v_events", "v_category_dim"),
    "c12_product_line_score": _on(_product_line, "v_goods", "v_orders", "v_category_dim"),
    "c14_overall_score": _on(_overall, "v_goods", "v_orders", "v_events", "v_category_dim"),
    "c15_promotion_coverage": _on(lambda g, e, o, d: S.promotion_coverage(e.where("behavior = 2000"), o.where("qty >= 45"), g, d), "v_goods", "v_events", "v_orders", "v_category_dim"),
    "c16_score_weights": _on(_weighted, "v_orders"),
    "c18_traffic_stages": _on(lambda e: S.traffic_stages(e, EVENTS_AS_OF), "v_events"),
    "c18_top_goods": _on(lambda e: S.traffic_top(e, "goods", EVENTS_AS_OF), "v_events"),
    "c18_top_brands": _on(lambda e: S.traffic_top(e.withColumn("category", F.col("level1")), "brand", EVENTS_AS_OF), "v_events"),
    "c18_band_viewers": _on(lambda e, g: S.band_viewers(e, g.withColumn("category", F.col("level1")), EVENTS_AS_OF), "v_events", "v_goods"),
    "c19_sales_status": _on(lambda o: S.sales_status(o, ORDERS_AS_OF), "v_orders"),
    "c19_top_goods": _on(lambda o: S.sales_top(o.withColumn("category", F.col("level1")), "goods", ORDERS_AS_OF), "v_orders"),
    "c20_summary": _on(S.category_summary_v2, "v_goods"),
    "c20_price_zones": _on(S.price_zones, "v_goods"),
    # models, profiles and wide tables
    "m4_als": _on(lambda e: models.als_lists(_ratings(e)), "v_events"),
    "m5_behavior_ratings": _on(lambda e: models.behavior_ratings(e, EVENTS_AS_OF).withColumn("rating", F.round("rating", 9)), "v_events"),
    "m5_behavior_als": _on(lambda e: models.behavior_als(e, EVENTS_AS_OF)[0], "v_events"),
    "m7_kmeans": _on(_clusters, "v_orders"),
    "m8_attribute_similarity": _on(_attributes, "v_goods"),
    "r11_goods_profile": _on(lists.goods_profile, "v_goods"),
    "r15_frequent_itemsets": _on(_itemsets, "v_events"),
    "e6_profile_json": _on(models.user_profile_json, "v_events"),
    "e7_gender_features": _on(lambda e: models.gender_features(_labelled(e), "label"), "v_events"),
    "e7_train_binary": _on(lambda e: models.train_binary(_labelled(e), "label"), "v_events"),
    "q2_goods_score_conversion": _on(_with_conversion, "v_goods", "v_orders", "v_events"),
    "geo2_order_store": _on(lambda o, p, z: geo.order_store_wide(o, p, geo.diamonds(z)), "v_addressed", "v_places", "v_diamonds"),
    "geo8_store_matrix": _on(lambda o: geo.store_category_matrix(o, LEVEL1), "v_orders"),
    "s5_read_tagged": _tagged,
}

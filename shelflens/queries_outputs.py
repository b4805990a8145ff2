"""Queries of sources, sinks, keyed outputs, wider scorecards and streams, each with its SQL for DuckDB (null where SQL has none)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import cleaned, dated, hash_bucket, normalize_nulls, random_part, url_decoded
from .operators import category as C
from .operators import cooccurrence, geo, lists, outputs, profile, rank, search
from .oracles import _LEVELS, _METRICS, ORACLES as BASE, _minmax, _score
from .plans.views import view, with_views
from .queries import EVENTS_AS_OF, LEVEL1, ORDERS_AS_OF, QUERIES as FIRST, _feed, _metrics, _other, _own, _on, _ratings, rounded
from .sources import tables
from .sources.scratch import scratch_path
from .streaming import events as stream

Query = Callable[[SparkSession, str], DataFrame]
_O = f"DATE '{ORDERS_AS_OF}'"
_AGE = f"date_diff('day', CAST(sale_time AS date), {_O})"
FIVE = ("l1", "l2", "l3", "l4", "l5")
#: A dimension with five levels, in SQL that both engines read; deep levels are missing for large sizes.
_FIVE_DIM = """SELECT DISTINCT p_type AS l1, concat(p_type, '/', p_brand) AS l2, CASE WHEN p_size <= 40 THEN concat(p_type, '/', p_brand, '/', p_size) END AS l3,
    CASE WHEN p_size <= 25 THEN concat(p_type, '/', p_brand, '/', p_size, '/', p_partkey % 3) END AS l4, CASE WHEN p_size <= 10 THEN concat(p_type, '/', p_brand, '/', p_size, '/', p_partkey % 3, '/', p_partkey % 2) END AS l5,
    p_partkey AS category FROM {part}"""


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in names})


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.run_named(spark, "orders", {"since": "2001-01-01"}, orders=view(spark, sf_dir, "v_orders")))


def _partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day, written, the last days written again without clicks, and scanned from a day on."""
    events, path = view(spark, sf_dir, "v_events").select("event_id", "behavior", F.col("day").cast("string").alias("dt")), scratch_path(spark, "partitions")
    tables.write_partition(events, path, "dt")
    tables.write_partition(events.where("dt >= '2024-01-20' AND behavior <> 2000"), path, "dt")
    return tables.scan(spark.read.schema("event_id long, behavior int, dt string").parquet(path), "dt", "2024-01-15").groupBy("dt", "behavior").agg(F.count("*").alias("n"))


def _delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delimited")
    rows = view(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    tables.write_text(rows.coalesce(1), path)  # one small file
    return tables.read_delimited(spark, path, rows.schema)


def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    view(spark, sf_dir, "events").select("event_id", "event_type", F.round("value", 4).alias("value")).write.json(path)
    return tables.read_json(spark, path, "event_id long, event_type string, value double")


def _full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, goods = scratch_path(spark, "full"), view(spark, sf_dir, "v_goods").select("goods", "brand", "sale_status")
    tables.write_full(goods, path)
    tables.write_full(goods.where("sale_status = 4"), path)
    return spark.read.schema(goods.schema).parquet(path)


def _wide_rows(goods: DataFrame) -> DataFrame:
    rows = goods.select(F.concat_ws("_", "shop", "brand", F.when(F.col("goods") % 4 > 0, F.col("goods"))).alias("key"), "price")
    return tables.read_wide_rows(rows, "key", ["shop", "brand", "goods"])


def _cells(orders: DataFrame) -> DataFrame:
    wide = orders.groupBy("goods").agg(F.map_from_arrays(F.array(F.lit("sales"), F.lit("units")), F.array(F.sum("amount"), F.sum("qty"))).alias("cells"))
    return tables.explode_cells(wide, "goods", "cells")


def _expiring(events: DataFrame) -> DataFrame:
    last = events.groupBy("member").agg(F.max("ts").alias("ts"), F.count("*").alias("n"))
    kept = tables.with_expiry(last.where("n % 2 = 0"), "2024-01-31 00:00:00", 3600).unionByName(tables.with_expiry(last.where("n % 2 = 1"), "2024-01-30 00:00:00", 3600))
    return tables.alive(kept, "2024-01-31 00:30:00").select("member", "n")


def _prefixed(goods: DataFrame) -> DataFrame:
    names = {3: "pc_", 1: "app_", 2: "h5_"}
    key = tables.prefixed(F.col("channel"), F.col("goods"), names).alias("key")
    return tables.delete_keys(goods.select(key, "brand"), goods.where("sale_status = 0").select(key), ["key"])


def _invalid(customer: DataFrame) -> DataFrame:
    segment = normalize_nulls(F.when(F.col("c_custkey") % 3 == 0, "NULL").otherwise(F.col("c_mktsegment")))
    rows = customer.select("c_nationkey", segment.alias("segment"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return tables.count_invalid(rows, ["c_nationkey"], ["segment", "balance"])


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, seen = tables.counted(view(spark, sf_dir, "v_orders"), F.col("status") != "F")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["processed"], seen.get["invalid"])], "processed long, invalid long")


def _merged(orders: DataFrame) -> DataFrame:
    by_year = lambda lo, hi: orders.where((F.year("sale_time") >= lo) & (F.year("sale_time") <= hi)).groupBy("level1", "brand").agg(F.count("*").alias("n")).groupBy("level1").agg(F.map_from_entries(F.collect_list(F.struct("brand", "n"))).alias("m"))
    return tables.merge_maps(by_year(1995, 1998), by_year(1998, 2001).withColumn("m", F.map_filter("m", lambda k, v: v % 2 == 0)), "level1", "m").select("level1", F.explode("m").alias("brand", "n"))


def _bands(goods: DataFrame) -> DataFrame:
    edges = goods.groupBy("level1").agg(F.min("price").alias("a"), F.max("price").alias("b"))
    bands = edges.select("level1", F.posexplode(F.sequence(F.lit(0), F.lit(2))).alias("i", "band"), "a", "b")
    step = (F.col("b") - F.col("a")) / 3
    bands = bands.select("level1", "band", (F.col("a") + F.col("band") * step).alias("low"), (F.col("a") + (F.col("band") + 1) * step).alias("high"))
    return tables.band_join(goods.select("level1", "goods", "price"), bands, "level1", "price").groupBy("level1", "band").agg(F.count("*").alias("n"))


def _five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.level_tree(_sql(spark, sf_dir, _FIVE_DIM, "part"), "category", FIVE).groupBy("level_no", "node", "path", "parent").agg(F.count("*").alias("n"))


def _scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = F.transform(F.col("ring"), lambda p: F.array(p["x"], p["y"]))
    scope = F.to_json(F.struct(F.array(F.struct(corners.alias("lngLatList"))).alias("scopeVOList")))
    stores = geo.diamonds(view(spark, sf_dir, "v_diamonds")).select("zone", scope.alias("scope"))
    return geo.points_in_polygons(view(spark, sf_dir, "v_points"), geo.parse_scopes(stores))


def _weights(events: DataFrame) -> DataFrame:
    return events.groupBy("member").agg(*[F.sum(profile.weight_of(v)).alias(v) for v in profile.BEHAVIOUR_WEIGHTS])


def _reviewed(goods: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    reviews = goods.select("goods", F.col("comments").alias("reviews"), (F.col("goods") % 5 + 1).alias("review_score"), (F.col("comments") / 50).alias("review_ratio"))
    return search.reviewed_search_score(_metrics(goods, orders, events).join(reviews, "goods"))


def _arrivals(goods: DataFrame) -> DataFrame:
    return lists.channel_arrivals(_feed(goods).join(goods.select("goods", "channel"), "goods"))


def _goods_map(name: str) -> Query:
    return _on(lambda g: lists.goods_maps(g, 50)[name], "v_goods")


def _store_summary(goods: DataFrame, orders: DataFrame) -> DataFrame:
    cuts = rank.positional_quantile(goods, ["category"], "price", [4, 8]).select("category", F.col("q4").alias("low"), F.col("q8").alias("high"))
    return geo.store_summary(orders, cuts)


def _vectors(events: DataFrame) -> DataFrame:
    """Members' viewed goods as sentences; the vector of each goods, its first part shown."""
    seen = events.where("behavior = 1000").groupBy("member").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "goods"))), lambda x: x["goods"].cast("string")).alias("items"))
    from pyspark.ml.functions import vector_to_array

    from .operators import models

    return models.word_vectors(seen, "items").getVectors().select("word", F.size(vector_to_array("vector")).alias("parts"))


#: A view or recommendation message for each event, some broken off or of an unknown kind.
_MESSAGE = """concat('{"goodsId":"', event_id % 50, '","cookieId":"c', user_id, '","memberId":"', user_id, '","eventDate":', 1000 * event_id, ',"channel":"', CASE WHEN event_id % 2 = 0 THEN 'PC' ELSE 'APP' END, '","actType":"', CASE event_type WHEN 'view' THEN 'hotsale' WHEN 'click' THEN 'pcgl' ELSE 'other' END, '","recResult":{"goodsList":[{"sid":"', event_id % 7, '"},{"sid":"', event_id % 5, '"}]}', CASE WHEN event_id % 10 = 0 THEN '' ELSE '}' END)"""


def _streamed(job: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        routed = stream.route_events(stream.file_source(spark, sf_dir, "events").selectExpr(f"{_MESSAGE} AS value"))
        return stream.drain(job(spark, sf_dir, routed), scratch_path(spark, "stream"), "append")

    return run


def _views(spark: SparkSession, sf_dir: str, routed: DataFrame) -> DataFrame:
    cookies = view(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS cookie", "concat('m', c_custkey) AS member").where("member <> 'm7'")
    return stream.handle_views(routed, cookies).withColumn("ts", F.unix_seconds("ts"))


def _top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stream.running_count(stream.file_source(spark, sf_dir, "events"), "user_id")
    return stream.drain(counts, scratch_path(spark, "stream"), "complete", lambda batch: stream.top_counts(batch, "user_id"))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.drain(stream.batch_count(stream.file_source(spark, sf_dir, "events")), scratch_path(spark, "stream"))


def _dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = spark.sql("SELECT explode(array('the', 'and', 'of', 'de')) AS word")
    return stream.drain(stream.kept_and_dropped(stream.file_source(spark, sf_dir, "conversations"), stop, "text"), scratch_path(spark, "stream"))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = stream.session_count(stream.file_source(spark, sf_dir, "events"), "ts", "user_id", "3 hours")
    return stream.drain(counted, scratch_path(spark, "stream")).select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "count")


_HASH = "CAST(concat('0x', substr(md5({}), 1, 8)) AS bigint)"
_DRAW = "substr(md5(concat('5-', goods)), 1, 8)"
_HISTORY = "SELECT member, string_agg(concat(category, ':', items), '#' ORDER BY seen DESC, category) AS items FROM (SELECT member, category, max(seen) AS seen, string_agg(CAST(goods AS varchar), ',' ORDER BY seen DESC, goods) AS items FROM ({}) x GROUP BY 1, 2) y GROUP BY 1"
_LISTED = "SELECT {0}, string_agg(CAST(goods AS varchar), '#' ORDER BY goods) AS items FROM {{v_goods}} WHERE sale_status = 4 AND stock = 1 GROUP BY ALL"
_CUTS = "c AS (SELECT category, max(CASE WHEN i = floor(n * 4 / 10) THEN price END) AS low, max(CASE WHEN i = floor(n * 8 / 10) THEN price END) AS high FROM (SELECT category, price, row_number() OVER (PARTITION BY category ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY category) AS n FROM {v_goods}) x GROUP BY 1)"
_SCORES = f"{_METRICS}, s AS (SELECT goods, level1, category, channel, {_score('level1, channel')} AS score FROM m)"
_BRAND = f"{_METRICS}, g AS (SELECT goods, brand, level1, level2, sales7, sales30 FROM m JOIN (SELECT goods, level2 FROM {{v_goods}}) l USING (goods))"


def _path(table: str, key: str, by: str) -> str:
    return f"(SELECT {by}, 30 * {_minmax('n', key)} + 40 * {_minmax('s7', key)} + 30 * {_minmax('s30', key)} AS raw FROM (SELECT {key}, {by}, count(*) AS n, sum(sales7) AS s7, sum(sales30) AS s30 FROM {table} GROUP BY ALL) x)"


def _matrix(value: str) -> str:
    return f"WITH s AS (SELECT store, level1, {value} AS a FROM {{v_orders}} GROUP BY 1, 2), h AS (SELECT store, level1, a / sum(a) OVER (PARTITION BY store) AS s FROM s) SELECT store, " + ", ".join(f"round(coalesce(sum(CASE WHEN level1 = '{c}' THEN s END), 0), 6) AS {c}" for c in LEVEL1) + " FROM h GROUP BY 1"


def _deviation(by: str) -> str:
    return f"WITH e AS (SELECT {by} FROM {{v_orders}} GROUP BY 1 HAVING count(DISTINCT member) >= 10), s AS (SELECT {by}, store, sum(amount) AS x FROM {{v_orders}} WHERE {by} IN (SELECT {by} FROM e) GROUP BY 1, 2) SELECT {by}, count(*) AS stores, round(stddev_pop(x), 6) AS deviation FROM s GROUP BY 1"


_SHARES = ("sales", "units", "orders", "members", "goods", "lines")
_ALL: dict[str, tuple[Query, str | None]] = {
    # sources and sinks
    "s1_named_query": (_named, "SELECT member, goods, round(qty, 6) AS qty, round(amount, 6) AS amount FROM {v_orders} WHERE sale_time >= TIMESTAMP '2001-01-01'"),
    "s2_s13_partitions": (_partitions, "SELECT CAST(day AS varchar) AS dt, behavior, count(*) AS n FROM {v_events} WHERE day >= DATE '2024-01-15' AND (day < DATE '2024-01-20' OR behavior <> 2000) GROUP BY 1, 2"),
    "s4_s12_delimited": (_delimited, "SELECT s_suppkey, s_name, s_acctbal FROM {supplier}"),
    "s7_wide_rows": (_on(_wide_rows, "v_goods"), "SELECT CAST(shop AS varchar) AS shop, brand, CAST(goods AS varchar) AS goods, round(price, 6) AS price FROM {v_goods} WHERE goods % 4 > 0"),
    "s8_cells": (_on(_cells, "v_orders"), "SELECT goods, 'sales' AS qualifier, round(sum(amount), 6) AS value FROM {v_orders} GROUP BY 1 UNION ALL SELECT goods, 'units', round(sum(qty), 6) FROM {v_orders} GROUP BY 1"),
    "s9_json_lines": (_json_lines, "SELECT event_id, event_type, round(value, 4) AS value FROM {events}"),
    "s17_full_refresh": (_full_refresh, "SELECT goods, brand, sale_status FROM {v_goods} WHERE sale_status = 4"),
    "s18_delete_prefixed": (_on(_prefixed, "v_goods"), "SELECT concat(CASE channel WHEN 3 THEN 'pc_' WHEN 1 THEN 'app_' ELSE 'h5_' END, goods) AS key, brand FROM {v_goods} WHERE sale_status <> 0"),
    "x4_expiry": (_on(_expiring, "v_events"), "SELECT member, count(*) AS n FROM {v_events} GROUP BY 1 HAVING count(*) % 2 = 0"),
    # relational parts
    "s3_drop_nulls": (_on(lambda c: tables.scan(c.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance")), "c_custkey", 10, "drop"), "customer"), "SELECT c_custkey, round(c_acctbal, 6) AS balance FROM {customer} WHERE c_custkey >= 10 AND c_acctbal > 0"),
    "p10_valid_ids": (_on(lambda c: tables.valid_ids(c.select("c_custkey", F.col("c_custkey").cast("string").alias("id")), "id", 3, 200, 1 << 31, F.col("c_custkey")).select("c_custkey"), "customer"), "SELECT c_custkey FROM {customer} WHERE length(CAST(c_custkey AS varchar)) = 3 AND c_custkey BETWEEN 200 AND 2147483648"),
    "p11_sample": (_on(lambda g: tables.sample_rows(g.select("goods", "brand"), "goods", 0.25, 5), "v_goods"), f"SELECT goods, brand FROM {{v_goods}} WHERE {_DRAW} < '40000000'"),
    "p11_take_sample": (_on(lambda g: tables.take_sample(g.select("goods", "brand"), "goods", 100, 5), "v_goods"), f"SELECT goods, brand FROM {{v_goods}} ORDER BY {_DRAW}, goods LIMIT 100"),
    "p12_invalid_rows": (_on(_invalid, "customer"), "SELECT c_nationkey, count(*) AS rows, count(*) FILTER (WHERE c_custkey % 3 = 0 OR c_acctbal <= 0) AS invalid FROM {customer} GROUP BY 1"),
    "a16_map_merge": (_on(_merged, "v_orders"), "WITH a AS (SELECT level1, brand, count(*) AS n FROM {v_orders} WHERE year(sale_time) BETWEEN 1995 AND 1998 GROUP BY 1, 2), b AS (SELECT level1, brand, count(*) AS n FROM {v_orders} WHERE year(sale_time) BETWEEN 1998 AND 2001 GROUP BY 1, 2 HAVING count(*) % 2 = 0) SELECT level1, brand, coalesce(b.n, a.n) AS n FROM a FULL JOIN b USING (level1, brand)"),
    "a19_counters": (_counted, "SELECT count(*) AS processed, count(*) FILTER (WHERE status <> 'F') AS invalid FROM {v_orders}"),
    "j9_band_join": (_on(_bands, "v_goods"), "WITH e AS (SELECT level1, min(price) AS a, max(price) AS b FROM {v_goods} GROUP BY 1), k AS (SELECT level1, CAST(band AS int) AS band, a + band * ((b - a) / 3) AS low, a + (band + 1) * ((b - a) / 3) AS high FROM e, (SELECT unnest([0, 1, 2]) AS band) i) SELECT level1, band, count(*) AS n FROM {v_goods} JOIN k USING (level1) WHERE price >= low AND price < high GROUP BY 1, 2"),
    "j10_unsold_goods": (_on(lambda g, o: g.select("goods", "brand").join(o.where("qty >= 49 AND sale_time >= '1999-01-01'").select("goods"), "goods", "left_anti"), "v_goods", "v_orders"), "SELECT goods, brand FROM {v_goods} WHERE goods NOT IN (SELECT goods FROM {v_orders} WHERE qty >= 49 AND sale_time >= TIMESTAMP '1999-01-01')"),
    "u3_distinct_union": (_on(lambda e, o: e.where("behavior = 1000").select("goods", "brand").union(o.where("qty >= 49").select("goods", "brand")).distinct(), "v_events", "v_orders"), "SELECT goods, brand FROM {v_events} WHERE behavior = 1000 UNION SELECT goods, brand FROM {v_orders} WHERE qty >= 49"),
    "u4_unviewed_goods": (_on(lambda g, e: g.select("goods").subtract(e.where("behavior = 1000").select("goods")), "v_goods", "v_events"), "SELECT goods FROM {v_goods} EXCEPT SELECT goods FROM {v_events} WHERE behavior = 1000"),
    "f4_dated": (_on(lambda o: o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("t")).where(dated(F.col("t"))), "orders"), "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS t FROM {orders} WHERE o_orderkey % 3 = 2"),
    "f5_cleaned": (_on(lambda c: c.select("c_custkey", cleaned(F.col("c_name")).alias("name")), "customer"), "SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g') AS name FROM {customer}"),
    "f7_url_decoded": (_on(lambda p: p.select("p_partkey", url_decoded(F.replace("p_name", F.lit(" "), F.when(F.col("p_partkey") % 5 == 0, "%zz").otherwise("%20"))).alias("name")), "part"), "SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 OR instr(p_name, ' ') = 0 THEN p_name END AS name FROM {part}"),
    "f18_hash_bucket": (_on(lambda p: p.groupBy(hash_bucket(F.col("p_name"), 64).alias("bucket")).agg(F.count("*").alias("n")), "part"), f"SELECT CAST({_HASH.format('p_name')} % 64 AS int) AS bucket, count(*) AS n FROM {{part}} GROUP BY 1"),
    "f22_random_part": (_on(lambda p: p.groupBy(random_part(F.col("p_partkey"), 8, 7).alias("part")).agg(F.count("*").alias("n")), "part"), f"SELECT CAST({_HASH.format("concat('7-', p_partkey)")} % 8 AS int) AS part, count(*) AS n FROM {{part}} GROUP BY 1"),
    # category tree
    "g1_five_levels": (_five, "WITH d AS (" + _FIVE_DIM + "), t AS (" + " UNION ALL ".join(f"SELECT category, CAST({i + 1} AS int) AS level_no, {c} AS node, concat_ws('>', {', '.join(FIVE[: i + 1])}) AS path, {FIVE[i - 1] if i else 'NULL'} AS parent FROM d WHERE {c} IS NOT NULL" for i, c in enumerate(FIVE)) + ") SELECT level_no, node, path, parent, count(*) AS n FROM t GROUP BY ALL"),
    "g5_ancestor_leaves": (_on(C.ancestor_leaves, "v_category_dim"), f"SELECT node, count(*) AS n, string_agg(category, '#' ORDER BY category) AS leaves FROM (SELECT DISTINCT node, category FROM {_LEVELS} t) x GROUP BY 1"),
    "c2_brand_stock": (_on(C.brand_stock, "v_goods", "v_category_dim"), f"SELECT level_no, node, brand, count(DISTINCT goods) AS goods_count, count(DISTINCT CASE WHEN stock = 1 THEN goods END) AS in_stock FROM {{v_goods}} JOIN {_LEVELS} t USING (category) GROUP BY ALL"),
    "c17_sibling_shares": (_on(C.sibling_shares, "v_goods", "v_category_dim"), "WITH s AS (SELECT category, count(DISTINCT brand) AS a, count(*) FILTER (WHERE sale_status = 4) AS b, count(DISTINCT product) AS c FROM {v_goods} GROUP BY 1), n AS (SELECT DISTINCT category, CASE WHEN level2 <> category THEN level2 ELSE level1 END AS ancestor FROM {v_category_dim}) SELECT category, ancestor, round(a / sum(a) OVER w, 6) AS brands_share, round(b / nullif(sum(b) OVER w, 0), 6) AS on_sale_share, round(c / sum(c) OVER w, 6) AS products_share FROM s JOIN n USING (category) WINDOW w AS (PARTITION BY ancestor)"),
    "c21_activity": (_on(lambda o, g: C.activity(o, g, ORDERS_AS_OF), "v_orders", "v_goods"), "WITH a AS (SELECT category, " + ", ".join(f"count(DISTINCT CASE WHEN {_AGE} BETWEEN 0 AND {n - 1} THEN {c} END) AS {c}{n}" for n in (30, 90) for c in ("goods", "brand")) + " FROM {v_orders} GROUP BY 1), e AS (SELECT category, count(DISTINCT goods) AS goods, count(DISTINCT brand) AS brand FROM {v_goods} GROUP BY 1) SELECT category, " + ", ".join(f"round(coalesce({c}{n} / {c}, 0), 6) AS {c}_active{n}" for n in (30, 90) for c in ("goods", "brand")) + " FROM e LEFT JOIN a USING (category)"),
    "c22_decile_shares": (_on(C.decile_shares, "v_orders"), "WITH s AS (SELECT category, goods, sum(amount) AS x, min(price) AS lo, max(price) AS hi FROM {v_orders} GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY x DESC, goods) AS i, count(*) OVER (PARTITION BY category) AS n FROM s) SELECT category, round(min(lo), 6) AS min_price, round(max(hi), 6) AS max_price, round(sum(CASE WHEN i <= greatest(1, floor(n / 10)) THEN x END) / sum(x), 6) AS top10, round(sum(CASE WHEN i <= greatest(1, floor(2 * n / 10)) THEN x END) / sum(x), 6) AS top20 FROM r GROUP BY 1"),
    "c22_best_goods": (_on(C.best_goods, "v_orders"), "WITH s AS (SELECT category, goods, sum(amount) AS x FROM {v_orders} GROUP BY 1, 2) SELECT category, goods, round(x, 6) AS amount, row_number() OVER (PARTITION BY category ORDER BY round(x, 4) DESC, goods) AS rank FROM s QUALIFY rank <= 10"),
    "c22_zone_activity": (_on(lambda o, g: C.zone_activity(o, g, "category", ORDERS_AS_OF), "v_orders", "v_goods"), f"WITH s AS (SELECT goods, sum(amount) AS x FROM {{v_orders}} WHERE {_AGE} BETWEEN 0 AND 89 GROUP BY 1), w AS (SELECT category, goods, brand, price, min(price) OVER (PARTITION BY category) AS lo, (max(price) OVER (PARTITION BY category) - min(price) OVER (PARTITION BY category)) / 3 AS step FROM {{v_goods}}), z AS (SELECT category, goods, brand, CAST(CASE WHEN step = 0 THEN 0 ELSE least(floor((price - lo) / step), 2) END AS int) AS zone FROM w) SELECT category, zone, count(*) AS goods_count, count(DISTINCT brand) AS brands, round(coalesce(sum(x), 0), 6) AS sales, round(avg(CASE WHEN x IS NULL THEN 0.0 ELSE 1 END), 6) AS active FROM z LEFT JOIN s USING (goods) GROUP BY 1, 2"),
    # lists and keyed outputs
    "a15_all_listed": (_on(lambda g: lists.joined(g, ["brand"], "goods", "goods"), "v_goods"), "SELECT brand, string_agg(CAST(goods AS varchar), '#' ORDER BY goods) AS items FROM {v_goods} GROUP BY 1"),
    "r5_unbought_list": (_on(lambda e: outputs.nested_list(lists.viewed_not_bought(e), ["member"], "category", "goods", "last_view"), "v_events"), _HISTORY.format("SELECT member, category, goods, max(ts) AS seen FROM {v_events} e WHERE behavior = 1000 AND NOT EXISTS (SELECT 1 FROM {v_events} b WHERE b.behavior = 4000 AND b.member = e.member AND b.day = e.day AND b.goods = e.goods) GROUP BY 1, 2, 3")),
    "r6_purchase_list": (_on(lambda e: outputs.nested_list(lists.purchase_history(e), ["member"], "category", "goods", "bought"), "v_events"), _HISTORY.format("SELECT member, category, goods, max(ts) AS seen FROM {v_events} WHERE behavior = 4000 GROUP BY 1, 2, 3")),
    "r9_channel_arrivals": (_on(_arrivals, "v_goods"), "WITH f AS (SELECT goods, product, brand, level1 AS category, channel, goods * 7 % 1000 AS started FROM {v_goods}), o AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY product ORDER BY started DESC, goods) = 1), r AS (SELECT *, row_number() OVER (PARTITION BY channel, category, brand ORDER BY started DESC, goods) AS i, count(*) OVER (PARTITION BY channel, category, brand) AS nb, count(*) OVER (PARTITION BY channel, category) AS nc FROM o) SELECT channel, category, string_agg(CAST(goods AS varchar), '#' ORDER BY started DESC, goods) AS items FROM r WHERE i <= ceil(20 * nb / nc) GROUP BY 1, 2"),
    "r10_goods_category": (_goods_map("goods_category"), "SELECT goods, category FROM {v_goods} WHERE sale_status = 4 AND stock = 1"),
    "r10_shop_category_goods": (_goods_map("shop_category_goods"), _LISTED.format("shop, category").replace("{{", "{").replace("}}", "}")),
    "r10_category_goods_all": (_goods_map("category_goods"), _LISTED.format("category").replace("{{", "{").replace("}}", "}")),
    "r10_shop_goods": (_goods_map("shop_goods"), "SELECT shop, string_agg(CAST(goods AS varchar), '#' ORDER BY goods) AS items FROM (SELECT shop, goods FROM {v_goods} WHERE sale_status = 4 AND stock = 1 QUALIFY row_number() OVER (PARTITION BY shop ORDER BY goods) <= 50) x GROUP BY 1"),
    "r12_member_cookies": (_on(lambda e: lists.member_cookies(e, "shop", "member", "ts"), "v_events"), "SELECT member, string_agg(CAST(shop AS varchar), '#' ORDER BY seen DESC, shop) AS items FROM (SELECT member, shop, max(ts) AS seen FROM {v_events} GROUP BY 1, 2) x GROUP BY 1"),
    "x1_scored_list": (_on(lambda o: outputs.scored_list(o.groupBy("store", "level1").agg(F.sum("qty").alias("units")), ["store"], "level1", "units"), "v_orders"), "SELECT store, string_agg(concat(level1, ':', printf('%.4f', u)), '#' ORDER BY u DESC, level1) AS items FROM (SELECT store, level1, round(sum(qty), 4) AS u FROM {v_orders} GROUP BY 1, 2) x GROUP BY 1"),
    "x2_key_values": (_on(lambda e: outputs.key_values(lists.member_cookies(e, "shop", "member", "ts"), "rcmd_member_shop_", F.col("member"), F.col("items")), "v_events"), "SELECT concat('rcmd_member_shop_', member) AS key, string_agg(CAST(shop AS varchar), '#' ORDER BY seen DESC, shop) AS value FROM (SELECT member, shop, max(ts) AS seen FROM {v_events} GROUP BY 1, 2) x GROUP BY 1"),
    "x3_key_hashes": (_on(lambda o: outputs.key_hashes(o.groupBy("store", "level1").agg(F.count("*").alias("n")), "rcmd_store_", "store", "level1", "n").select("key", F.explode("fields").alias("field", "value")), "v_orders"), "SELECT concat('rcmd_store_', store) AS key, level1 AS field, CAST(count(*) AS varchar) AS value FROM {v_orders} GROUP BY store, level1"),
    # preferences and models
    "f21_behaviour_weights": (_on(_weights, "v_events"), "SELECT member, " + ", ".join(f"round(sum(CASE behavior {' '.join(f'WHEN {k} THEN {w}' for k, w in ws.items())} END), 6) AS {v}" for v, ws in profile.BEHAVIOUR_WEIGHTS.items()) + " FROM {v_events} GROUP BY 1"),
    "e4_brand_interest": (_on(lambda e: profile.faded_interest(e, ["category", "brand"], EVENTS_AS_OF), "v_events"), "WITH s AS (SELECT member, category, brand, sum(CASE behavior WHEN 1000 THEN 1.0 WHEN 2000 THEN 3 WHEN 3000 THEN 0 ELSE 5 END) AS w, count(*) AS n FROM {v_events} GROUP BY 1, 2, 3), t AS (SELECT *, max(n) OVER (PARTITION BY category, brand) AS most FROM s) SELECT member, category, brand, round(w, 6) AS weight, round(CASE WHEN w <= 0 THEN NULL WHEN most = 1 THEN 1.0 ELSE ln(w) / ln(most) END, 6) AS doi FROM t"),
    "e4_faded_interest": (_on(lambda e: profile.faded_interest(e, ["level1"], EVENTS_AS_OF, 30.0, "guess"), "v_events"), "WITH s AS (SELECT member, level1, sum(CASE behavior WHEN 1000 THEN 1.0 WHEN 2000 THEN 2 WHEN 3000 THEN -1.5 ELSE 3 END * pow(0.5, date_diff('day', day, DATE '2024-01-31') / 30.0)) AS w, count(*) AS n FROM {v_events} GROUP BY 1, 2), t AS (SELECT *, max(n) OVER (PARTITION BY level1) AS most FROM s) SELECT member, level1, round(w, 6) AS weight, round(CASE WHEN round(w, 9) <= 0 THEN NULL WHEN most = 1 THEN 1.0 ELSE ln(w) / ln(most) END, 6) AS doi FROM t"),
    "e8_word_vectors": (_on(_vectors, "v_events"), "SELECT CAST(goods AS varchar) AS word, CAST(16 AS int) AS parts FROM {v_events} WHERE behavior = 1000 GROUP BY goods HAVING count(*) >= 2"),
    "m6_llr_lists": (_on(lambda e: cooccurrence.llr_lists(_ratings(e)), "v_events"), None),
    # search
    "q1_reviewed_score": (_on(lambda g, o, e: _reviewed(g, o, e).select("goods", "score"), "v_goods", "v_orders", "v_events"), f"WITH {_METRICS}, r AS (SELECT m.*, comments AS reviews, goods % 5 + 1 AS review_score, comments / 50 AS review_ratio FROM m JOIN (SELECT goods, comments FROM {{v_goods}}) g USING (goods)) SELECT goods, round({_score('level1, channel')} + " + " + ".join(f"5 * {_minmax(c, 'level1, channel')}" for c in ("reviews", "review_score", "review_ratio")) + ", 6) AS score FROM r"),
    "q3_channel_scores": (_on(lambda g, o, e: search.to_channels(search.goods_search_score(_metrics(g, o, e), by=("level1",))), "v_goods", "v_orders", "v_events"), f"WITH {_METRICS} SELECT goods, CAST(c.channel AS int) AS channel, round({_score('level1')}, 6) AS score FROM m, (SELECT unnest([1, 2, 3]) AS channel) c"),
    "q4_channel_ranking": (_on(lambda g, o, e: search.channel_ranking(search.goods_search_score(_metrics(g, o, e))), "v_goods", "v_orders", "v_events"), f"WITH {_SCORES}, b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY channel, level1, category ORDER BY round(score, 9) DESC, goods) <= 30), c AS (SELECT channel, level1, category, sum(score) AS score FROM b GROUP BY 1, 2, 3) SELECT channel, level1, category, round(score, 6) AS score, row_number() OVER (PARTITION BY channel, level1 ORDER BY round(score, 6) DESC, category) AS rank FROM c"),
    "q4_back_categories": (_on(lambda g, o, e: search.back_categories(search.goods_search_score(_metrics(g, o, e))), "v_goods", "v_orders", "v_events"), f"WITH {_SCORES}, b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY level1 ORDER BY round(score, 9) DESC, goods) <= 30), n AS (SELECT level1, category, count(*) AS n FROM b GROUP BY 1, 2) SELECT level1, string_agg(category, '#' ORDER BY n DESC, category) AS items FROM n GROUP BY 1"),
    "q5_brand_level_scores": (_on(lambda g, o, e: search.brand_level_scores(_metrics(g, o, e), g), "v_goods", "v_orders", "v_events"), f"WITH {_BRAND}, t AS (SELECT brand, sum(raw) AS raw FROM (SELECT * FROM {_path('g', 'level1', 'brand')} UNION ALL SELECT * FROM {_path('g', 'level1, level2', 'brand')}) y GROUP BY 1) SELECT brand, round(coalesce(100 * raw / nullif(max(raw) OVER (), 0), 0), 6) AS score FROM t"),
    "q5_child_scores": (_on(lambda g, o, e: search.child_scores(_metrics(g, o, e), g), "v_goods", "v_orders", "v_events"), f"WITH {_BRAND}, t AS (SELECT level1, level2, 30 * {_minmax('n', 'level1')} + 40 * {_minmax('s7', 'level1')} + 30 * {_minmax('s30', 'level1')} AS raw FROM (SELECT level1, level2, count(*) AS n, sum(sales7) AS s7, sum(sales30) AS s30 FROM g GROUP BY 1, 2) x) SELECT level1, level2, round(coalesce(100 * raw / nullif(max(raw) OVER (), 0), 0), 6) AS score FROM t"),
    "q6_term_categories": (_on(lambda c: search.term_categories(search.search_terms(c, "role")), "conversations"), None),
    "k4_named_brand": (_on(lambda g: search.named_brand_matches(_own(g).withColumn("brand", F.element_at(F.split("name", " "), 1)), _other(g), "level1"), "v_goods"), None),  # SQL below
    # stores
    "f15_scopes": (_scopes, "SELECT id, zone FROM {v_points}, {v_diamonds} WHERE abs(x - cx) + abs(y - cy) <= r"),
    "geo5_brand_sales": (_on(lambda o: geo.store_shares(o, "brand"), "v_orders"), "WITH s AS (SELECT store, brand AS item, sum(amount) AS x FROM {v_orders} GROUP BY 1, 2) SELECT store, item, round(x, 6) AS sales, round(x / sum(x) OVER (PARTITION BY store), 6) AS share, row_number() OVER (PARTITION BY store ORDER BY round(x, 4) DESC, item) AS rank FROM s QUALIFY rank <= 100"),
    "geo5_store_summary": (_on(_store_summary, "v_goods", "v_orders"), f"WITH {_CUTS} SELECT store, count(DISTINCT member) AS members, count(DISTINCT order_no) AS orders, round(sum(amount), 6) AS sales, round(avg(CASE WHEN price < low THEN 1.0 ELSE 0 END), 6) AS cheap, round(avg(CASE WHEN price >= low AND price < high THEN 1.0 ELSE 0 END), 6) AS middle, round(avg(CASE WHEN price >= high THEN 1.0 ELSE 0 END), 6) AS dear FROM {{v_orders}} JOIN c USING (category) GROUP BY 1"),
    "geo6_goods_deviation": (_on(lambda o: geo.store_deviation(o, "goods"), "v_orders"), _deviation("goods")),
    "geo6_category_deviation": (_on(lambda o: geo.store_deviation(o, "category"), "v_orders"), _deviation("category")),
    "geo7_six_shares": (_on(geo.six_shares, "v_orders"), "WITH s AS (SELECT store, level1, sum(amount) AS sales, sum(qty) AS units, count(DISTINCT order_no) AS orders, count(DISTINCT member) AS members, count(DISTINCT goods) AS goods, count(*) AS lines FROM {v_orders} GROUP BY 1, 2), h AS (SELECT level1, " + ", ".join(f"{c} / sum({c}) OVER (PARTITION BY store) AS {c}" for c in _SHARES) + " FROM s) SELECT level1, " + ", ".join(f"round(avg({c}), 6) AS {c}_share" for c in _SHARES) + " FROM h GROUP BY 1"),
    "geo8_units_matrix": (_on(lambda o: geo.store_matrix(o, LEVEL1, F.sum("qty")), "v_orders"), _matrix("sum(qty)")),
    "geo8_orders_matrix": (_on(lambda o: geo.store_matrix(o, LEVEL1, F.count_distinct("order_no")), "v_orders"), _matrix("count(DISTINCT order_no)")),
    # streams
    "t1_routes": (lambda spark, sf_dir: _streamed(lambda s, d, r: r.select("route"))(spark, sf_dir).groupBy("route").agg(F.count("*").alias("n")), "SELECT CASE WHEN event_id % 10 = 0 THEN 'error' WHEN event_type = 'view' THEN 'view' WHEN event_type = 'click' THEN 'rec' ELSE 'error' END AS route, count(*) AS n FROM {events} GROUP BY 1"),
    "t2_views": (_streamed(_views), "SELECT CASE WHEN event_id % 2 = 0 THEN concat('m', user_id) ELSE concat(user_id) END AS member, concat(event_id % 50) AS goods, CASE WHEN event_id % 2 = 0 THEN 'PC' ELSE 'APP' END AS channel, event_id AS ts FROM {events} WHERE event_type = 'view' AND event_id % 10 <> 0 AND (event_id % 2 = 1 OR (user_id <> 7 AND user_id IN (SELECT c_custkey FROM {customer})))"),
    "t3_recs": (_streamed(lambda s, d, r: stream.explode_recs(r).withColumn("ts", F.unix_seconds("ts"))), "SELECT concat(user_id) AS memberId, event_id AS ts, concat(event_id % 7) AS goods FROM {events} WHERE event_type = 'click' AND event_id % 10 <> 0 UNION ALL SELECT concat(user_id), event_id, concat(event_id % 5) FROM {events} WHERE event_type = 'click' AND event_id % 10 <> 0"),
    "t4_top_users": (_top_users, "SELECT user_id, count(*) AS count FROM {events} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "t6_batch_count": (_batch, "SELECT count(*) AS count FROM {events}"),
    "t7_dropped_words": (_dropped, None),
    "t11_sessions": (_sessions, "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS new FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM g) SELECT user_id, min(ts) AS start, count(*) AS count FROM s GROUP BY user_id, i"),
}

QUERIES: dict[str, Query] = FIRST | {name: query for name, (query, _) in _ALL.items()}
ORACLES: dict[str, str] = BASE | {name: with_views(sql) for name, (_, sql) in _ALL.items() if sql}
_W = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
#: These hold patterns with braces, so they are written out without names in braces.
ORACLES |= {
    "k4_named_brand": r"WITH g AS (SELECT p_type AS level1, p_partkey AS goods, lower(p_name) AS name, p_size AS comments FROM part), i AS (SELECT level1, goods AS item, name AS item_name FROM g WHERE goods % 2 = 1 QUALIFY row_number() OVER (PARTITION BY level1 ORDER BY comments DESC, goods) <= 50), r AS (SELECT goods, item, name AS a, item_name AS b FROM g JOIN i USING (level1) WHERE goods % 2 = 0 AND contains(item_name, split_part(name, ' ', 1))) SELECT goods, item, CAST(len(list_intersect(list_filter(string_split_regex(a, '[^\p{L}\p{N}]+'), lambda w: w <> ''), list_filter(string_split_regex(b, '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS int) AS shared_words, CAST(len(list_intersect(list_distinct(list_filter(string_split(a, ''), lambda w: w <> '')), list_distinct(list_filter(string_split(b, ''), lambda w: w <> '')))) AS int) AS shared_characters FROM r",
    "q6_term_categories": f"WITH terms AS (SELECT role AS category, term, count(*) AS n FROM (SELECT role, unnest({_W}) AS term FROM conversations) x WHERE length(term) >= 2 GROUP BY ALL) SELECT term, string_agg(category, '#' ORDER BY n DESC, category) AS items FROM terms GROUP BY 1",
    "t7_dropped_words": f"SELECT word IN ('the', 'and', 'of', 'de') AS dropped, count(*) AS count FROM (SELECT unnest({_W}) AS word FROM conversations) x GROUP BY 1",
}

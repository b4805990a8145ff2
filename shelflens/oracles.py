"""The queries' SQL for DuckDB. Names in braces are views or tables."""

from __future__ import annotations

from .plans.views import with_views

_E, _O = "DATE '2024-01-31'", "DATE '2001-08-01'"
_LEVELS = "(SELECT category, 1 AS level_no, level1 AS node, level1 AS path FROM {v_category_dim} UNION SELECT category, 2, level2, concat(level1, '>', level2) FROM {v_category_dim} UNION SELECT category, 3, level3, concat(level1, '>', level2, '>', level3) FROM {v_category_dim} WHERE level3 IS NOT NULL)"
_MONTH = "strftime(sale_time, '%Y-%m')"
_AGE = f"date_diff('day', CAST(sale_time AS date), {_O})"


def _minmax(x: str, by: str) -> str:
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"coalesce(({x} - min({x}) {over}) / nullif(max({x}) {over} - min({x}) {over}, 0), 0)"


def _similar(code: int, item: str, extra: str = "") -> str:
    return f"""s AS (SELECT DISTINCT member, level1, week, goods{extra} FROM {{v_events}} WHERE behavior = {code}),
        n AS (SELECT {item}, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.{item} AS a, b.{item} AS b, count(*) AS pairs FROM s a JOIN s b USING (member, level1, week) WHERE a.{item} <> b.{item} GROUP BY 1, 2),
        t AS (SELECT a, b, pairs / n AS score FROM p JOIN n ON n.{item} = b)"""


_RATINGS = f"""
    v AS (SELECT member, goods, category, day, count(*) AS n FROM {{v_events}} WHERE behavior = 1000 GROUP BY ALL),
    pv AS (SELECT goods, day, count(*) AS pv FROM {{v_events}} WHERE behavior = 1000 GROUP BY ALL),
    raw AS (SELECT member, category, goods, sum(n / pv * pow(0.75, date_diff('day', day, {_E}))) AS rating FROM v JOIN pv USING (goods, day) GROUP BY ALL HAVING sum(n / pv * pow(0.75, date_diff('day', day, {_E}))) > 1e-4),
    ratings AS (SELECT member, goods, rating FROM raw QUALIFY row_number() OVER (PARTITION BY member, category ORDER BY round(rating, 9) DESC, goods) <= 30)"""


def _cosine(key: str, item: str, k: int, least: float) -> str:
    return f"""
    norm AS (SELECT {item}, sqrt(sum(rating * rating)) AS norm FROM ratings GROUP BY 1),
    w AS (SELECT {key}, {item}, rating / norm AS w FROM ratings JOIN norm USING ({item})),
    near AS (SELECT a.{item} AS a, b.{item} AS b, sum(a.w * b.w) AS score FROM w a JOIN w b USING ({key}) WHERE a.{item} <> b.{item} GROUP BY 1, 2 HAVING sum(a.w * b.w) > {least}
             QUALIFY row_number() OVER (PARTITION BY a.{item} ORDER BY round(sum(a.w * b.w), 9) DESC, b.{item}) <= {k})"""


def _pref(item: str, floor: float) -> str:
    return f"""
    v AS (SELECT member, {item}, day, count(*) AS n FROM {{v_events}} WHERE behavior = 1000 GROUP BY ALL),
    pv AS (SELECT {item}, day, count(*) AS pv FROM {{v_events}} WHERE behavior = 1000 GROUP BY ALL),
    viewed AS (SELECT member, {item}, sum(n / pv * pow(0.75, date_diff('day', day, {_E}))) AS score FROM v JOIN pv USING ({item}, day) GROUP BY ALL HAVING sum(n / pv * pow(0.75, date_diff('day', day, {_E}))) > {floor})"""


_CYCLE = """
    days AS (SELECT DISTINCT member, category, day FROM {v_events} WHERE behavior = 4000),
    gaps AS (SELECT category, date_diff('day', lag(day) OVER (PARTITION BY member, category ORDER BY day), day) AS gap FROM days),
    cycle AS (SELECT category, median(gap) AS cycle, count(*) AS observations FROM gaps WHERE gap IS NOT NULL GROUP BY 1)"""

_METRICS = f"""
    sold AS (SELECT goods, sum(CASE WHEN {_AGE} BETWEEN 0 AND 6 THEN qty ELSE 0 END) AS units7, sum(CASE WHEN {_AGE} BETWEEN 0 AND 6 THEN amount ELSE 0 END) AS sales7,
                    sum(CASE WHEN {_AGE} BETWEEN 0 AND 29 THEN qty ELSE 0 END) AS units30, sum(CASE WHEN {_AGE} BETWEEN 0 AND 29 THEN amount ELSE 0 END) AS sales30 FROM {{v_orders}} GROUP BY 1),
    seen AS (SELECT goods, count(*) AS pv, count(DISTINCT member) AS uv FROM {{v_events}} WHERE behavior = 1000 GROUP BY 1),
    m AS (SELECT goods, category, level1, channel, brand, coalesce(units7, 0) AS units7, coalesce(sales7, 0) AS sales7, coalesce(units30, 0) AS units30, coalesce(sales30, 0) AS sales30,
                 coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv FROM {{v_goods}} LEFT JOIN sold USING (goods) LEFT JOIN seen USING (goods))"""


def _score(by: str) -> str:
    return " + ".join(f"{w} * {_minmax(c, by)}" for c, w in {"units30": 15.0, "sales30": 15.0, "units7": 7.5, "sales7": 7.5, "pv": 5.0, "uv": 15.0}.items())


_CHARS = "list_distinct(list_filter(string_split(lower({0}), ''), lambda x: x <> ''))"
_JACCARD = lambda a, b: f"len(list_intersect({_CHARS.format(a)}, {_CHARS.format(b)})) / len(list_distinct(list_concat({_CHARS.format(a)}, {_CHARS.format(b)})))"
_ORDER_METRICS = "round(sum(amount), 6) AS sales, round(sum(qty), 6) AS units, count(DISTINCT order_no) AS orders, count(DISTINCT member) AS members, round(sum(amount) / sum(qty), 6) AS unit_price, round(sum(amount) / count(DISTINCT order_no), 6) AS per_order, round(count(DISTINCT order_no) / count(DISTINCT member), 6) AS orders_per_member, round(sum(amount) / count(DISTINCT member), 6) AS per_member"
_PARETO = lambda p: f"count(*) FILTER (WHERE before < {p} * total)"

_DAY = f"date_diff('day', CAST(ts AS date), {_E})"
_OPERATION = f"""t AS {_LEVELS}, p AS (SELECT goods, count(*) AS n, count(*) FILTER (WHERE qty >= 25) AS k FROM {{v_orders}} WHERE {_AGE} BETWEEN 0 AND 89 GROUP BY 1),
    units AS (SELECT level_no, node, {_MONTH} AS month, sum(qty) AS r FROM {{v_orders}} JOIN t USING (category) GROUP BY ALL),
    spread AS (SELECT level_no, node, stddev_pop(r) AS d FROM units GROUP BY ALL HAVING count(*) >= 5 AND stddev_pop(r) > 1e-9), steady AS (SELECT level_no, node, 1 - {_minmax('d', 'level_no')} AS steadiness FROM spread),
    f AS (SELECT level_no, node, coalesce(count(*) FILTER (WHERE sale_status = 4 AND stock = 1) / nullif(count(*) FILTER (WHERE sale_status = 4), 0), 0) AS in_stock_rate, avg(comments / 50) AS fill_rate,
                 CAST(coalesce(sum(n), 0) AS bigint) AS price_changes, CAST(coalesce(sum(k), 0) AS bigint) AS shelf_changes FROM {{v_goods}} LEFT JOIN p USING (goods) JOIN t USING (category) GROUP BY ALL),
    operation AS (SELECT f.*, coalesce(steadiness, 0) AS steadiness FROM f LEFT JOIN steady USING (level_no, node))"""
_SCORES = {"in_stock_rate": 7.5, "fill_rate": 5.0, "price_changes": 5.0, "shelf_changes": 2.5, "steadiness": 5.0}


def _two_ranks(source: str, by: str, item: str, where: str, a: tuple[str, str], b: tuple[str, str]) -> str:
    rank = lambda c: f"row_number() OVER (PARTITION BY category ORDER BY round({c}, 4) DESC, item)"
    return f"""WITH s AS (SELECT {by} AS category, {item} AS item, {a[1]} AS {a[0]}, {b[1]} AS {b[0]} FROM {source} WHERE {where} GROUP BY 1, 2), r AS (SELECT *, {rank(a[0])} AS {a[0]}_rank, {rank(b[0])} AS {b[0]}_rank FROM s)
        SELECT category, item, round({a[0]}, 6) AS {a[0]}, round({b[0]}, 6) AS {b[0]}, {a[0]}_rank, {b[0]}_rank FROM r WHERE {a[0]}_rank <= 10 OR {b[0]}_rank <= 10"""


_SQL = {
    "p4_missing_values": "SELECT c_custkey, c_mktsegment AS segment FROM {customer} WHERE c_custkey % 3 = 2",
    "j3_left_join_default": "SELECT c_custkey, coalesce(n, 0) AS n FROM {customer} LEFT JOIN (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1) o ON c_custkey = o_custkey",
    "j10_anti_join": "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey)",
    "j11_semi_join": "SELECT p_partkey FROM {part} WHERE p_partkey IN (SELECT goods FROM {v_events})",
    "a3_count_distinct": "SELECT store, count(DISTINCT member) AS members, count(DISTINCT goods) AS goods, count(DISTINCT order_no) AS orders FROM {v_orders} GROUP BY 1",
    "a9_median": "SELECT brand, round(median(price), 6) AS median_price FROM {v_orders} GROUP BY 1",
    "a10_positional_quantiles": "WITH r AS (SELECT level1, price, row_number() OVER (PARTITION BY level1 ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY level1) AS n FROM {v_goods}) SELECT level1, " + ", ".join(f"round(max(CASE WHEN i = floor(n * {k} / 10) THEN price END), 6) AS q{k}" for k in (2, 4, 6, 8)) + " FROM r GROUP BY 1",
    "a11_deviation": "SELECT goods, count(*) AS n, round(stddev_pop(price), 6) AS deviation FROM {v_orders} GROUP BY 1 HAVING count(*) >= 5 AND stddev_pop(price) > 1e-9",
    "a14_correlation": "SELECT level1, round(CASE WHEN corr(price, qty) BETWEEN 0 AND 1 THEN corr(price, qty) ELSE 0 END, 6) AS correlation FROM {v_orders} GROUP BY 1",
    "a15_listed": "SELECT brand, string_agg(CAST(goods AS varchar), '#' ORDER BY goods) AS items FROM {v_goods} GROUP BY 1",
    "w1_top_k": "WITH s AS (SELECT store, goods, sum(amount) AS sales FROM {v_orders} GROUP BY ALL) SELECT store, goods, round(sales, 6) AS sales, row_number() OVER (PARTITION BY store ORDER BY round(sales, 4) DESC, goods) AS rank FROM s QUALIFY rank <= 5",
    "w4_dense_rank": "SELECT level2, count(*) AS n, dense_rank() OVER (ORDER BY count(*) DESC) - 1 AS rank FROM {v_goods} GROUP BY 1",
    "w5_pareto": f"WITH s AS (SELECT level1, goods, sum(qty) AS units FROM {{v_orders}} GROUP BY ALL), r AS (SELECT level1, coalesce(sum(units) OVER (PARTITION BY level1 ORDER BY units DESC, goods ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(units) OVER (PARTITION BY level1) AS total FROM s) SELECT level1, {_PARETO(0.8)} AS items, count(*) AS all_items FROM r GROUP BY 1",
    "w9_share": "SELECT region, district, round(sum(amount), 6) AS sales, round(sum(amount) / sum(sum(amount)) OVER (PARTITION BY region), 6) AS share FROM {v_orders} GROUP BY 1, 2",
    "w12_latest": "SELECT goods, sale_time, round(price, 6) AS price FROM {v_orders} QUALIFY row_number() OVER (PARTITION BY goods ORDER BY sale_time DESC, order_no DESC, line DESC) = 1",
    "w13_minmax": f"SELECT goods, round({_minmax('price', 'level2')}, 6) AS scaled FROM {{v_goods}}",
    "u2_fused_scores": "SELECT goods, round(sum(score), 6) AS score FROM (SELECT goods, count(*) AS score FROM {v_events} GROUP BY 1 UNION ALL SELECT goods, sum(qty) FROM {v_orders} GROUP BY 1) x GROUP BY 1",
    "u4_except": "SELECT c_custkey AS id FROM {customer} EXCEPT SELECT o_custkey FROM {orders}",
    "f1_jaccard": f"SELECT p_partkey, round({_JACCARD('p_name', "concat_ws(' ', p_type, p_brand)")}, 6) AS score FROM {{part}}",
    "s15_upsert": "SELECT goods, round(CASE WHEN goods % 10 = 0 THEN price * 2 ELSE price END, 6) AS price, brand FROM {v_goods}",
    "s16_update_columns": "SELECT goods, round(CASE WHEN goods % 10 = 0 THEN price * 2 ELSE price END, 6) AS price, brand FROM {v_goods}",
    "s18_delete_keys": "SELECT goods, brand FROM {v_goods} WHERE sale_status <> 0",
    "g1_explode_levels": f"SELECT level_no, node, path, count(*) AS n FROM {{v_goods}} JOIN {_LEVELS} t USING (category) GROUP BY ALL",
    "g2_parent_child": "WITH d AS (SELECT DISTINCT level2 AS parent, category FROM {v_category_dim} WHERE category <> level2) SELECT parent, count(*) AS n, string_agg(category, '#' ORDER BY category) AS children FROM d GROUP BY 1",
    "g3_nearest_ancestor": "SELECT DISTINCT category, CASE WHEN level2 <> category THEN level2 ELSE level1 END AS ancestor FROM {v_category_dim}",
    "r1_also_viewed": f"WITH {_similar(1000, 'goods')} SELECT a AS goods, b AS other, round(score, 6) AS score, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank FROM t QUALIFY rank <= 20",
    "r2_view_then_buy": "WITH v AS (SELECT DISTINCT member, level1, week, goods FROM {v_events} WHERE behavior = 1000), b AS (SELECT DISTINCT member, level1, week, goods FROM {v_events} WHERE behavior = 4000), p AS (SELECT v.goods, b.goods AS other, count(*) AS score FROM v JOIN b USING (member, level1, week) WHERE v.goods <> b.goods GROUP BY 1, 2) SELECT goods, other, score, row_number() OVER (PARTITION BY goods ORDER BY score DESC, other) AS rank FROM p QUALIFY rank <= 20",
    "r3_also_bought": f"WITH {_similar(4000, 'goods')} SELECT a AS goods, b AS other, round(score, 6) AS score FROM t",
    "r4_category_also_bought": f"WITH {_similar(4000, 'level2', ', level2')} SELECT a AS category, b AS other, round(score, 6) AS score FROM t",
    "r5_viewed_not_bought": "SELECT member, category, goods, max(ts) AS last_view FROM {v_events} e WHERE behavior = 1000 AND NOT EXISTS (SELECT 1 FROM {v_events} b WHERE b.behavior = 4000 AND b.member = e.member AND b.day = e.day AND b.goods = e.goods) GROUP BY 1, 2, 3",
    "r6_purchase_history": "SELECT member, category, goods, max(ts) AS bought, count(*) AS times FROM {v_events} WHERE behavior = 4000 GROUP BY 1, 2, 3",
    "r7_hot_sale": f"WITH s AS (SELECT category, store, goods, sum(qty * CASE WHEN {_AGE} < 30 THEN 2 ELSE 1 END) AS score FROM {{v_orders}} WHERE {_AGE} BETWEEN 0 AND 59 GROUP BY ALL) SELECT category, store, goods, score, row_number() OVER (PARTITION BY category, store ORDER BY score DESC, goods) AS rank FROM s QUALIFY rank <= 20",
    "r8_daypart_top": "WITH s AS (SELECT CASE WHEN hour(ts) BETWEEN 8 AND 11 THEN 'forenoon' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon' ELSE 'evening' END AS daypart, category, count(*) AS n FROM {v_events} WHERE behavior = 4000 GROUP BY ALL) SELECT daypart, category, n, row_number() OVER (PARTITION BY daypart ORDER BY n DESC, category) AS rank FROM s QUALIFY rank <= 20",
    "r9_new_arrivals": "WITH f AS (SELECT goods, product, brand, level1 AS category, goods * 7 % 1000 AS started FROM {v_goods} QUALIFY row_number() OVER (PARTITION BY product ORDER BY goods * 7 % 1000 DESC, goods) = 1), r AS (SELECT *, row_number() OVER (PARTITION BY category, brand ORDER BY started DESC, goods) AS rank, count(*) OVER (PARTITION BY category, brand) AS nb, count(*) OVER (PARTITION BY category) AS nc FROM f) SELECT category, brand, goods, rank FROM r WHERE rank <= ceil(20 * nb / nc)",
    "r10_category_goods": "WITH r AS (SELECT shop, level1, goods, row_number() OVER (PARTITION BY shop, level1 ORDER BY goods) AS rank FROM {v_goods} WHERE sale_status = 4 AND stock = 1) SELECT shop, level1, string_agg(CAST(goods AS varchar), '#' ORDER BY rank) AS items FROM r WHERE rank <= 200 GROUP BY 1, 2",
    "r12_cookie_map": "WITH s AS (SELECT shop, member, max(ts) AS seen FROM {v_events} GROUP BY 1, 2) SELECT shop, member, seen FROM s QUALIFY row_number() OVER (PARTITION BY shop ORDER BY seen DESC, member) = 1",
    "r13_rec_conversion": "WITH c AS (SELECT DISTINCT member, day, goods FROM {v_events} WHERE behavior = 2000), v AS (SELECT DISTINCT member, day, goods, 1 AS hit FROM {v_events} WHERE behavior = 1000) SELECT CAST(day AS varchar) AS day, count(*) AS recommended, count(hit) AS viewed, round(count(hit) / count(*), 6) AS rate FROM c LEFT JOIN v USING (member, day, goods) GROUP BY 1",
    "r14_recent_views": "WITH v AS (SELECT member, day, goods, max(day) OVER (PARTITION BY member) AS last FROM {v_events} WHERE behavior = 1000), s AS (SELECT member, goods, count(*) AS views FROM v WHERE day = last GROUP BY 1, 2) SELECT member, goods, views, row_number() OVER (PARTITION BY member ORDER BY views DESC, goods) AS rank FROM s QUALIFY rank <= 10",
    "e1_category_preference": f"WITH {_pref('category', 1e-5)}, {_CYCLE}, last AS (SELECT member, category, date_diff('day', max(day), {_E}) AS since FROM {{v_events}} WHERE behavior = 4000 GROUP BY 1, 2), bought AS (SELECT member, category, CASE WHEN cycle IS NULL THEN 2.0 ELSE 2 / (1 + exp(abs(cycle - since))) END AS score FROM last LEFT JOIN cycle USING (category)) SELECT member, category, round(sum(score), 6) AS score FROM (SELECT * FROM viewed UNION ALL SELECT * FROM bought) x GROUP BY 1, 2",
    "e2_goods_preference": f"WITH {_pref('goods', 1e-6)}, bought AS (SELECT member, goods, sum(2 * pow(0.9, date_diff('day', day, {_E}))) AS score FROM {{v_events}} WHERE behavior = 4000 GROUP BY 1, 2), s AS (SELECT member, goods, sum(score) AS score FROM (SELECT * FROM viewed UNION ALL SELECT * FROM bought) x GROUP BY 1, 2), c AS (SELECT DISTINCT goods, category FROM {{v_events}}) SELECT goods, member, round(score, 6) AS score, category, row_number() OVER (PARTITION BY member, category ORDER BY round(score, 9) DESC, goods) AS rank FROM s JOIN c USING (goods) QUALIFY rank <= 5",
    "e3_buying_cycle": f"WITH {_CYCLE} SELECT category, round(cycle, 6) AS cycle, observations FROM cycle",
    "e4_interest_degree": "WITH s AS (SELECT member, category AS item, sum(CASE behavior WHEN 1000 THEN 1 WHEN 2000 THEN 2 WHEN 3000 THEN -1 ELSE 4 END) AS w FROM {v_events} GROUP BY 1, 2), t AS (SELECT *, max(w) OVER (PARTITION BY item) AS most FROM s) SELECT member, item, round(CASE WHEN w <= 0 THEN NULL WHEN most = 1 THEN 1.0 ELSE ln(w) / ln(most) END, 6) AS doi FROM t",
    "e5_price_tiers": "WITH r AS (SELECT category, price, row_number() OVER (PARTITION BY category ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY category) AS n FROM {v_goods}), q AS (SELECT category, max(CASE WHEN i = floor(n * 4 / 10) THEN price END) AS q4, max(CASE WHEN i = floor(n * 8 / 10) THEN price END) AS q8 FROM r GROUP BY 1), s AS (SELECT DISTINCT member, category, goods, price FROM {v_events} WHERE behavior = 1000) SELECT member, category, round(avg(CASE WHEN price < q4 THEN 1.0 ELSE 0 END), 6) AS low, round(avg(CASE WHEN price >= q4 AND price < q8 THEN 1.0 ELSE 0 END), 6) AS mid, round(avg(CASE WHEN price >= q8 THEN 1.0 ELSE 0 END), 6) AS high FROM s JOIN q USING (category) GROUP BY 1, 2",
    "e8_view_sequences": "SELECT member, count(*) AS n, string_agg(CAST(goods AS varchar), ' ' ORDER BY ts, event_id) AS sequence FROM {v_events} WHERE behavior = 1000 GROUP BY 1 HAVING count(*) >= 4",
    "m1_implicit_ratings": f"WITH {_RATINGS} SELECT member, goods, round(rating, 6) AS rating FROM ratings",
    "m2_item_cf": f"WITH {_RATINGS}, {_cosine('member', 'goods', 10, 1e-6)}, r AS (SELECT member, b AS item, max(rating * score) AS score FROM ratings JOIN near ON goods = a GROUP BY 1, 2) SELECT member, item, round(score, 6) AS score, row_number() OVER (PARTITION BY member ORDER BY round(score, 9) DESC, item) AS rank FROM r QUALIFY rank <= 60",
    "m3_user_cf": f"WITH {_RATINGS}, {_cosine('goods', 'member', 50, 1e-5)}, r AS (SELECT near.a AS member, goods AS item, sum(score * rating) AS score FROM near JOIN ratings ON ratings.member = near.b GROUP BY 1, 2) SELECT member, item, round(score, 6) AS score, row_number() OVER (PARTITION BY member ORDER BY round(score, 9) DESC, item) AS rank FROM r QUALIFY rank <= 80",
    "m6_llr": f"""WITH {_RATINGS}, n AS (SELECT goods, count(*) AS n FROM ratings GROUP BY 1), u AS (SELECT count(DISTINCT member) AS users FROM ratings),
        p AS (SELECT a.goods AS a, b.goods AS b, count(*) AS k11 FROM ratings a JOIN ratings b USING (member) WHERE a.goods <> b.goods GROUP BY 1, 2),
        k AS (SELECT a, b, k11, na.n - k11 AS k12, nb.n - k11 AS k21, users - na.n - nb.n + k11 AS k22 FROM p JOIN n na ON na.goods = a JOIN n nb ON nb.goods = b, u),
        x AS (SELECT a, b, """ + ", ".join(f"CASE WHEN {e} > 0 THEN ({e}) * ln({e}) ELSE 0 END AS {n}" for n, e in {"x11": "k11", "x12": "k12", "x21": "k21", "x22": "k22", "r1": "(k11 + k12)", "r2": "(k21 + k22)", "c1": "(k11 + k21)", "c2": "(k12 + k22)", "t": "(k11 + k12 + k21 + k22)"}.items()) + """ FROM k),
        s AS (SELECT a, b, greatest(0, 2 * ((t - r1 - r2) + (t - c1 - c2) - (t - x11 - x12 - x21 - x22))) AS score FROM x)
        SELECT a AS goods, b AS other, round(score, 6) AS score, row_number() OVER (PARTITION BY a ORDER BY round(score, 6) DESC, b) AS rank FROM s QUALIFY rank <= 50""",
    "c1_basic": f"SELECT level_no, node, path, count(DISTINCT goods) AS goods_count, count(*) FILTER (WHERE sale_status = 0) AS off_shelf, count(*) FILTER (WHERE stock = 0 AND sale_status = 4) AS out_of_stock, count(DISTINCT brand) AS brands, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price FROM {{v_goods}} JOIN {_LEVELS} t USING (category) GROUP BY ALL",
    "c2_brand": f"SELECT level_no, node, brand, count(DISTINCT goods) AS goods_count, count(*) FILTER (WHERE sale_status = 0) AS off_shelf, count(*) FILTER (WHERE stock = 0 AND sale_status = 4) AS out_of_stock, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price FROM {{v_goods}} JOIN {_LEVELS} t USING (category) GROUP BY ALL",
    "c3_monthly_sales": f"SELECT level_no, node, {_MONTH} AS month, round(sum(amount), 6) AS sales, round(sum(qty), 6) AS units, count(DISTINCT goods) AS goods_sold FROM {{v_orders}} JOIN {_LEVELS} t USING (category) GROUP BY ALL",
    "c4_sell_through": f"""WITH t AS {_LEVELS}, s AS (SELECT level_no, node, {_MONTH} AS month, goods, sum(amount) AS x FROM {{v_orders}} JOIN t USING (category) GROUP BY ALL),
        r AS (SELECT level_no, node, month, coalesce(sum(x) OVER (w ORDER BY x DESC, goods ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(x) OVER w AS total FROM s WINDOW w AS (PARTITION BY level_no, node, month)),
        c AS (SELECT level_no, node, month, count(*) AS sold, {_PARETO(0.5)} AS n50, {_PARETO(0.8)} AS n80 FROM r GROUP BY ALL),
        v AS (SELECT level_no, node, count(DISTINCT goods) AS valid FROM {{v_goods}} JOIN t USING (category) WHERE sale_status = 4 GROUP BY ALL), m AS (SELECT DISTINCT {_MONTH} AS month FROM {{v_orders}})
        SELECT level_no, node, month, round(coalesce(sold / valid, 0), 6) AS sell_through, round(coalesce(n50 / valid, 0), 6) AS ratio50, round(coalesce(n80 / valid, 0), 6) AS ratio80 FROM v CROSS JOIN m LEFT JOIN c USING (level_no, node, month)""",
    "c5_hotcakes": f"WITH s AS (SELECT level_no, node, {_MONTH} AS month, goods, sum(qty) AS units FROM {{v_orders}} JOIN {_LEVELS} t USING (category) GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY level_no, node, month ORDER BY units DESC, goods) AS rank FROM s QUALIFY rank <= 20",
    "c6_popularity": f"""WITH s AS (SELECT level_no, node, strftime(ts, '%Y-%m') AS month, count(*) FILTER (WHERE behavior = 1000) AS pv, count(DISTINCT CASE WHEN behavior = 1000 THEN member END) AS uv, count(DISTINCT CASE WHEN behavior = 4000 THEN member END) AS buyers FROM {{v_events}} JOIN {_LEVELS} t USING (category) GROUP BY ALL),
        h AS (SELECT *, """ + ", ".join(f"coalesce({c} / nullif(sum({c}) OVER (PARTITION BY level_no, month), 0), 0) AS {c}_share" for c in ("pv", "uv", "buyers")) + " FROM s) SELECT level_no, node, month, pv, uv, buyers, " + ", ".join(f"round({c}_share, 6) AS {c}_share, round({_minmax(f'{c}_share', 'level_no, month')}, 6) AS {c}_norm" for c in ("pv", "uv", "buyers")) + " FROM h",
    "c7_stock_sales": f"WITH t AS {_LEVELS}, u AS (SELECT level_no, node, sum(qty) AS units FROM {{v_orders}} JOIN t USING (category) WHERE {_AGE} BETWEEN 0 AND 29 GROUP BY ALL), k AS (SELECT level_no, node, sum(stock) AS stock FROM {{v_goods}} JOIN t USING (category) GROUP BY ALL) SELECT level_no, node, CAST(stock AS bigint) AS stock, coalesce(units, 0) AS units, coalesce(round(stock / (units / 30), 2), 0) AS ratio FROM k LEFT JOIN u USING (level_no, node)",
    "c11_sales_score": f"""WITH t AS {_LEVELS}, s AS (SELECT level_no, node, sum(CASE WHEN {_AGE} BETWEEN 0 AND 89 THEN amount ELSE 0 END) AS s90, sum(CASE WHEN {_AGE} BETWEEN 0 AND 179 THEN amount ELSE 0 END) AS s180 FROM {{v_orders}} JOIN t USING (category) GROUP BY ALL),
        c AS (SELECT level_no, node, count(DISTINCT goods) AS n FROM {{v_goods}} JOIN t USING (category) GROUP BY ALL),
        r AS (SELECT level_no, node, coalesce(s90, 0) AS s90, coalesce(s90, 0) / n AS per_goods, coalesce((s90 / 3 - s180 / 6) / nullif(s180 / 6, 0), 0) AS growth FROM c LEFT JOIN s USING (level_no, node))
        SELECT level_no, node, round(0.4 * {_minmax('s90', 'level_no')} + 0.3 * {_minmax('per_goods', '')} + 0.3 * {_minmax('growth', '')}, 6) AS score FROM r""",
    "c13_price_distribution": f"""WITH p AS (SELECT level_no, node, goods, price, min(price) OVER w AS low, (max(price) OVER w - min(price) OVER w) / 19 AS width FROM {{v_goods}} JOIN {_LEVELS} t USING (category) WINDOW w AS (PARTITION BY level_no, node)), u AS (SELECT goods, sum(qty) AS units FROM {{v_orders}} GROUP BY 1)
        SELECT level_no, node, CAST(CASE WHEN width = 0 THEN 0 ELSE floor((price - low) / width) END AS int) AS bin, count(*) AS goods_count, coalesce(sum(units), 0) AS units FROM p LEFT JOIN u USING (goods) GROUP BY ALL""",
    "c17_summary": """WITH r AS (SELECT *, min(price) OVER w + (max(price) OVER w - min(price) OVER w) / 3 AS a, min(price) OVER w + 2 * ((max(price) OVER w - min(price) OVER w) / 3) AS b, row_number() OVER (PARTITION BY category ORDER BY price, goods) - 1 AS i, count(*) OVER w AS n FROM {v_goods} WINDOW w AS (PARTITION BY category))
        SELECT category, count(DISTINCT brand) AS brands, count(*) FILTER (WHERE sale_status = 4) AS on_sale, count(DISTINCT product) AS products, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price, round(avg(price), 6) AS mean_price, round(max(CASE WHEN i = floor(n / 2) THEN price END), 6) AS median_price,
        round(avg(CASE WHEN price < a THEN 1.0 ELSE 0 END), 6) AS low, round(avg(CASE WHEN price >= a AND price < b THEN 1.0 ELSE 0 END), 6) AS mid, round(avg(CASE WHEN price >= b THEN 1.0 ELSE 0 END), 6) AS high FROM r GROUP BY 1""",
    "c21_sales_windows": f"""WITH r AS (SELECT *, sale_time > DATE '2001-07-01' AS m1 FROM {{v_orders}} WHERE sale_time > DATE '2001-05-01' AND CAST(sale_time AS date) <= {_O}), s AS (SELECT category, sum(CASE WHEN m1 THEN amount ELSE 0 END) AS sales1, sum(amount) AS sales3, sum(CASE WHEN m1 THEN qty ELSE 0 END) AS units1, sum(qty) AS units3 FROM r GROUP BY 1),
        a AS (SELECT category, count(*) AS members, avg(CASE WHEN n >= 2 THEN 1.0 ELSE 0 END) AS repeat_rate FROM (SELECT category, member, count(DISTINCT order_no) AS n FROM r GROUP BY 1, 2) x GROUP BY 1)
        SELECT category, round(sales1, 6) AS sales1, round(sales3, 6) AS sales3, units1, units3, members, round(repeat_rate, 6) AS repeat_rate, round(3 * sales1 / sales3, 6) AS growth FROM s JOIN a USING (category)""",
    "c22_order_shape": """WITH d AS (SELECT category, date_diff('day', CAST(min(sale_time) AS date), CAST(max(sale_time) AS date)) AS span, count(DISTINCT CAST(sale_time AS date)) AS n FROM {v_orders} GROUP BY category, member), c AS (SELECT category, sum(span) / sum(n - 1) AS days_between FROM d WHERE n > 1 GROUP BY 1),
        o AS (SELECT category, avg(x) AS order_value, avg(k) AS order_lines FROM (SELECT category, order_no, sum(amount) AS x, count(*) AS k FROM {v_orders} GROUP BY 1, 2) y GROUP BY 1),
        s AS (SELECT category, x, row_number() OVER (PARTITION BY category ORDER BY x DESC, goods) AS i, count(*) OVER (PARTITION BY category) AS n FROM (SELECT category, goods, sum(amount) AS x FROM {v_orders} GROUP BY 1, 2) z), t AS (SELECT category, sum(CASE WHEN i <= greatest(1, floor(n / 10)) THEN x END) / sum(x) AS top_share FROM s GROUP BY 1)
        SELECT category, round(order_value, 6) AS order_value, round(order_lines, 6) AS order_lines, round(top_share, 6) AS top_share, round(days_between, 6) AS days_between FROM o JOIN t USING (category) LEFT JOIN c USING (category)""",
    "q1_goods_score": f"WITH {_METRICS} SELECT goods, round({_score('level1, channel')}, 6) AS score FROM m",
    "q3_goods_score_all_channels": f"WITH {_METRICS} SELECT goods, round({_score('level1')}, 6) AS score FROM m",
    "q4_category_ranking": f"WITH {_METRICS}, s AS (SELECT goods, level1, category, {_score('level1, channel')} AS score FROM m), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY level1, category ORDER BY round(score, 9) DESC, goods) <= 30), c AS (SELECT level1, category, sum(score) AS score FROM b GROUP BY 1, 2) SELECT level1, category, round(score, 6) AS score, row_number() OVER (PARTITION BY level1 ORDER BY round(score, 6) DESC, category) AS rank FROM c",
    "q5_brand_scores": f"WITH {_METRICS}, b AS (SELECT level1, brand, count(*) AS n, sum(sales7) AS s7, sum(sales30) AS s30 FROM m GROUP BY 1, 2), s AS (SELECT level1, brand, 30 * {_minmax('n', 'level1')} + 40 * {_minmax('s7', 'level1')} + 30 * {_minmax('s30', 'level1')} AS score FROM b) SELECT level1, brand, round(score, 6) AS score, row_number() OVER (PARTITION BY level1 ORDER BY round(score, 6) DESC, brand) AS rank FROM s",
    "k1_category_match": f"WITH a AS (SELECT DISTINCT level2 AS own FROM {{v_goods}} WHERE goods % 2 = 0), b AS (SELECT DISTINCT level2 AS other FROM {{v_goods}} WHERE goods % 2 = 1), s AS (SELECT own, other, {_JACCARD('own', 'other')} AS score FROM a, b) SELECT own, other, round(score, 6) AS score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY own ORDER BY round(score, 9) DESC, other) = 1",
    "k2_brand_gap": "WITH m AS (SELECT DISTINCT category, lower(trim(brand)) AS b FROM {v_goods} WHERE goods % 2 = 1 EXCEPT SELECT DISTINCT category, lower(trim(brand)) FROM {v_goods} WHERE goods % 2 = 0) SELECT category, count(*) AS missing, string_agg(b, '#' ORDER BY b) AS brands FROM m GROUP BY 1",
    "k3_price_bins": "WITH e AS (SELECT level1, min(price) AS low, max(price) AS high FROM {v_goods} WHERE goods % 2 = 0 GROUP BY 1) SELECT level1, CAST(CASE WHEN high = low THEN 0 ELSE least(floor((price - low) / ((high - low) / 10)), 9) END AS int) AS bin, count(*) AS items, CAST(sum(comments) AS bigint) AS comments FROM {v_goods} JOIN e USING (level1) WHERE goods % 2 = 1 AND price BETWEEN low AND high GROUP BY 1, 2",
    "geo1_points_in_polygons": "SELECT id, zone FROM {v_points}, {v_diamonds} WHERE abs(x - cx) + abs(y - cy) <= r",
    "geo3_district_month": f"SELECT district, {_MONTH} AS month, {_ORDER_METRICS} FROM {{v_orders}} GROUP BY 1, 2",
    "geo3_district_category": f"SELECT district, level1, {_ORDER_METRICS} FROM {{v_orders}} GROUP BY 1, 2",
    "geo4_store_goods": f"SELECT store, goods, {_ORDER_METRICS} FROM {{v_orders}} GROUP BY 1, 2",
    "geo5_store_profile": "WITH s AS (SELECT store, brand AS item, count(*) AS lines FROM {v_orders} GROUP BY 1, 2) SELECT store, item, lines, round(lines / sum(lines) OVER (PARTITION BY store), 6) AS share, row_number() OVER (PARTITION BY store ORDER BY lines DESC, item) AS rank FROM s QUALIFY rank <= 100",
    "geo6_store_deviation": "WITH e AS (SELECT brand FROM {v_orders} GROUP BY 1 HAVING count(DISTINCT member) >= 10), s AS (SELECT brand, store, sum(amount) AS x FROM {v_orders} WHERE brand IN (SELECT brand FROM e) GROUP BY 1, 2) SELECT brand, count(*) AS stores, round(stddev_pop(x), 6) AS deviation FROM s GROUP BY 1",
    "geo7_category_features": "WITH s AS (SELECT store, level1, sum(amount) AS a, sum(qty) AS b, count(DISTINCT order_no) AS c FROM {v_orders} GROUP BY 1, 2), h AS (SELECT level1, a / sum(a) OVER w AS a, b / sum(b) OVER w AS b, c / sum(c) OVER w AS c FROM s WINDOW w AS (PARTITION BY store)) SELECT level1, round(avg(a), 6) AS sales_share, round(avg(b), 6) AS units_share, round(avg(c), 6) AS orders_share FROM h GROUP BY 1",
    "t4_running_count": "SELECT event_type, count(*) AS count FROM {events} GROUP BY 1",
    "t5_sliding_count": "SELECT s AS start, s + INTERVAL 2 HOUR AS \"end\", event_type, count(*) AS count FROM (SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s FROM {events}) x GROUP BY 1, 2, 3",
}

_SQL |= {
    "c8_operation": f"WITH {_OPERATION} SELECT level_no, node, round(in_stock_rate, 6) AS in_stock_rate, round(fill_rate, 6) AS fill_rate, price_changes, shelf_changes, round(steadiness, 6) AS steadiness FROM operation",
    "c9_operation_score": f"WITH {_OPERATION} SELECT level_no, node, round(" + " + ".join(f"{w} * {_minmax(c, 'level_no')}" for c, w in _SCORES.items()) + ", 6) AS score FROM operation",
    "c10_popularity_score": f"""WITH s AS (SELECT level_no, node, count(*) FILTER (WHERE behavior = 1000) AS pv, count(DISTINCT CASE WHEN behavior = 1000 THEN member END) AS uv, count(DISTINCT CASE WHEN behavior = 4000 THEN member END) AS buyers FROM {{v_events}} JOIN {_LEVELS} t USING (category) WHERE strftime(ts, '%Y-%m') = '2024-01' GROUP BY ALL)
        SELECT level_no, node, round(7.5 * {_minmax('pv', 'level_no')} + 7.5 * {_minmax('uv', 'level_no')} + 10 * {_minmax('buyers', 'level_no')}, 6) AS score FROM s""",
    "c12_product_line_score": f"""WITH monthly AS ({_SQL['c4_sell_through']}), bins AS ({_SQL['c13_price_distribution']}), m AS (SELECT level_no, node, round(avg(ratio80), 9) AS c, round(avg(sell_through), 9) AS s FROM monthly WHERE month > '2001-04' GROUP BY ALL),
        k AS (SELECT level_no, node, CASE WHEN round(corr(goods_count, units), 9) BETWEEN 0 AND 1 THEN round(corr(goods_count, units), 9) ELSE 0 END AS k FROM bins GROUP BY ALL)
        SELECT level_no, node, round(10 * CASE WHEN c BETWEEN 0.2 AND 0.4 THEN 1 WHEN c > 0.4 AND c <= 0.8 THEN 0.5 ELSE 0.2 END + 10 * CASE WHEN s > 0.4 AND s < 0.6 THEN 1 WHEN s BETWEEN 0.2 AND 0.8 THEN 0.5 ELSE 0.2 END + 5 * coalesce(k, 0), 6) AS score FROM m LEFT JOIN k USING (level_no, node)""",
    "c15_promotion_coverage": f"""WITH e AS (SELECT goods, count(*) AS n FROM (SELECT goods FROM {{v_events}} WHERE behavior = 2000 UNION ALL SELECT goods FROM {{v_orders}} WHERE qty >= 45) x GROUP BY 1),
        r AS (SELECT level_no, node, count(DISTINCT goods) AS on_sale, count(DISTINCT CASE WHEN n IS NOT NULL THEN goods END) / count(DISTINCT goods) AS a, coalesce(sum(n), 0) / count(DISTINCT goods) AS b FROM {{v_goods}} LEFT JOIN e USING (goods) JOIN {_LEVELS} t USING (category) WHERE sale_status = 4 GROUP BY ALL)
        SELECT level_no, node, on_sale, round(a, 6) AS coverage, round(b, 6) AS entries_per_goods, round({_minmax('a', '')}, 6) AS coverage_norm, round({_minmax('b', '')}, 6) AS entries_per_goods_norm FROM r""",
    "c16_score_weights": "WITH c AS (SELECT level1 AS component, count(*) / 1000 AS w FROM {v_orders} GROUP BY 1) SELECT level1 AS component, brand AS sub, round(w * (sum(qty) / 100), 6) AS weight FROM {v_orders} JOIN c ON component = level1 GROUP BY 1, 2, w",
    "c18_traffic_stages": f"SELECT category, " + ", ".join(f"count(*) FILTER (WHERE {_DAY} BETWEEN {i * 10} AND {i * 10 + 9}) AS pv{i + 1}" for i in range(3)) + f", count(*) AS pv, count(DISTINCT member) AS uv FROM {{v_events}} WHERE behavior = 1000 AND {_DAY} BETWEEN 0 AND 29 GROUP BY 1",
    "c18_top_goods": _two_ranks("{v_events}", "category", "goods", f"behavior = 1000 AND {_DAY} BETWEEN 0 AND 29", ("pv", "count(*)"), ("uv", "count(DISTINCT member)")),
    "c18_top_brands": _two_ranks("{v_events}", "level1", "brand", f"behavior = 1000 AND {_DAY} BETWEEN 0 AND 29", ("pv", "count(*)"), ("uv", "count(DISTINCT member)")),
    "c18_band_viewers": f"""WITH r AS (SELECT level1, goods, price, min(price) OVER w AS low, (max(price) OVER w - min(price) OVER w) / 3 AS width FROM {{v_goods}} WINDOW w AS (PARTITION BY level1)), b AS (SELECT level1, goods, CASE WHEN price < low + width THEN 1 WHEN price < low + 2 * width THEN 2 ELSE 3 END AS band FROM r)
        SELECT b.level1 AS category, band, count(DISTINCT member) AS viewers FROM {{v_events}} JOIN b USING (goods) WHERE behavior = 1000 AND {_DAY} BETWEEN 0 AND 29 GROUP BY 1, 2""",
    "c19_sales_status": f"""WITH r AS (SELECT *, min(price) OVER w AS low, (max(price) OVER w - min(price) OVER w) / 3 AS width FROM {{v_orders}} WHERE {_AGE} BETWEEN 0 AND 29 WINDOW w AS (PARTITION BY category)), b AS (SELECT *, CASE WHEN price < low + width THEN 1 WHEN price < low + 2 * width THEN 2 ELSE 3 END AS band FROM r)
        SELECT category, round(sum(amount), 6) AS sales, round(sum(qty), 6) AS units, count(DISTINCT member) AS members, count(DISTINCT brand) AS brands, """ + ", ".join(f"round(sum(CASE WHEN band = {i} THEN {c} ELSE 0 END) / sum({c}), 6) AS {c}_share{i}" for c in ("amount", "qty") for i in (1, 2, 3)) + " FROM b GROUP BY 1",
    "c19_top_goods": _two_ranks("{v_orders}", "level1", "goods", f"{_AGE} BETWEEN 0 AND 29", ("sales", "sum(amount)"), ("units", "sum(qty)")),
    "c20_summary": "WITH p AS (SELECT level1, count(DISTINCT goods) AS g, count(DISTINCT brand) AS b, count(DISTINCT product) AS p FROM {v_goods} GROUP BY 1), n AS (SELECT level1, level2, count(DISTINCT goods) AS goods_count, count(DISTINCT brand) AS brands, count(DISTINCT product) AS products FROM {v_goods} GROUP BY 1, 2) SELECT level1, level2, goods_count, brands, products, round(goods_count / g, 6) AS goods_count_share, round(brands / b, 6) AS brands_share, round(products / p, 6) AS products_share FROM n JOIN p USING (level1)",
    "c20_price_zones": "WITH r AS (SELECT level1, goods, brand, price, min(price) OVER w AS low, (max(price) OVER w - min(price) OVER w) / 10 AS width FROM {v_goods} WINDOW w AS (PARTITION BY level1)) SELECT level1, CAST(CASE WHEN width = 0 THEN 0 ELSE least(floor(round((price - low) / width, 9)), 9) END AS int) AS zone, count(DISTINCT goods) AS goods_count, count(DISTINCT brand) AS brands FROM r GROUP BY 1, 2",
    "m5_behavior_ratings": f"SELECT member, goods, round(round(sum(CASE behavior WHEN 1000 THEN 1.0 WHEN 2000 THEN 2.0 WHEN 3000 THEN -1.5 ELSE 3.0 END * pow(0.95, {_DAY})), 9), 6) AS rating FROM {{v_events}} WHERE {_DAY} BETWEEN 0 AND 89 GROUP BY 1, 2",
    "m8_attribute_similarity": """WITH a AS (SELECT level1, goods, unnest(string_split(name, ' ')) AS term FROM {v_goods} UNION ALL SELECT level1, goods, concat('size:', comments) FROM {v_goods} UNION ALL SELECT level1, goods, concat('brand:', brand) FROM {v_goods}),
        prices AS (SELECT DISTINCT level1, price FROM {v_goods}), cut AS (SELECT level1, price, row_number() OVER (PARTITION BY level1 ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY level1) AS n FROM prices),
        tf AS (SELECT level1, goods, term, CAST(count(*) AS double) AS tf FROM a GROUP BY ALL UNION ALL SELECT level1, goods, 'price level', """ + " + ".join(["1.0"] + [f"CASE WHEN i >= floor(n * {k} / 5) THEN 1 ELSE 0 END" for k in (1, 2, 3, 4)]) + """ FROM {v_goods} JOIN cut USING (level1, price)),
        m AS (SELECT level1, count(*) AS m FROM {v_goods} GROUP BY 1), df AS (SELECT level1, term, count(*) AS df FROM tf GROUP BY ALL), w AS (SELECT level1, goods, term, tf * ln((m + 1) / (df + 1)) AS w FROM tf JOIN df USING (level1, term) JOIN m USING (level1) WHERE df < m),
        u AS (SELECT level1, goods, term, w / sqrt(sum(w * w) OVER (PARTITION BY level1, goods)) AS w FROM w), s AS (SELECT a.goods, b.goods AS other, sum(a.w * b.w) AS score FROM u a JOIN u b USING (level1, term) WHERE a.goods <> b.goods GROUP BY 1, 2)
        SELECT goods, other, round(score, 6) AS score, row_number() OVER (PARTITION BY goods ORDER BY round(score, 9) DESC, other) AS rank FROM s WHERE score > 0 QUALIFY rank <= 20""",
    "r11_goods_profile": "SELECT concat(CASE channel WHEN 3 THEN 'pc_' WHEN 1 THEN 'app_' ELSE 'h5_' END, goods) AS key, CAST(to_json({'goods': goods, 'name': name, 'brand': brand, 'category': category}) AS varchar) AS profile FROM {v_goods}",
    "r15_frequent_itemsets": """SELECT items, freq FROM (WITH RECURSIVE i AS (SELECT DISTINCT member, level1, week, goods FROM {v_events} WHERE behavior = 4000), s AS (SELECT member, level1, week, CAST(goods AS varchar) AS items, goods AS last, 1 AS n FROM i UNION ALL SELECT member, level1, week, concat(s.items, '#', i.goods), i.goods, n + 1 FROM s JOIN i USING (member, level1, week) WHERE i.goods > s.last)
        SELECT items, count(*) AS freq FROM s WHERE n > 1 GROUP BY 1 HAVING count(*) >= (SELECT ceil(count(*) * 1e-4) FROM (SELECT DISTINCT member, level1, week FROM i) b)) x""",
    "e6_profile_json": """WITH n AS (SELECT member, level1, count(*) AS n FROM {v_events} GROUP BY ALL), l AS (SELECT member, level1, row_number() OVER (PARTITION BY member ORDER BY n DESC, level1) AS rank FROM n QUALIFY rank <= 3), c AS (SELECT member, list(level1 ORDER BY rank) AS categories FROM l GROUP BY 1),
        r AS (SELECT member, list_sort(list(DISTINCT brand)) AS brands, min(CAST(round(price * 100) AS bigint)) AS low, max(CAST(round(price * 100) AS bigint)) AS high FROM {v_events} GROUP BY 1) SELECT member, CAST(to_json({'categories': categories, 'brands': brands, 'price': {'min': low, 'max': high}}) AS varchar) AS profile FROM c JOIN r USING (member)""",
    "e7_gender_features": "WITH n AS (SELECT member, level2, count(*) AS n FROM {v_events} WHERE behavior = 4000 GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY member) AS total FROM n) SELECT member, member % 2 AS label, level2, round(n / total, 6) AS ratio FROM r WHERE total BETWEEN 4 AND 19",
    "q2_goods_score_conversion": f"""WITH {_METRICS}, r AS (SELECT m.*, coalesce(round(units7 / nullif(uv, 0), 10), 0) AS conversion, comments AS reviews, goods % 5 + 1 AS review_score, comments / 50 AS fill_rate FROM m JOIN (SELECT goods, comments FROM {{v_goods}}) g USING (goods))
        SELECT goods, round(""" + " + ".join(f"{w} * {_minmax(c, 'level1, channel')}" for c, w in {"sales7": 20.0, "sales30": 15.0, "pv": 4.0, "uv": 14.0, "conversion": 15.0, "reviews": 4.0, "review_score": 10.0, "fill_rate": 2.0}.items()) + ", 6) AS score FROM r",
    "geo2_order_store": "SELECT o_orderkey AS order_no, o_custkey AS member, replace(c_name, '#', ' #') AS address, round(o_totalprice, 6) AS amount, x, y, zone FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {v_points} p ON p.id = c_custkey JOIN {v_diamonds} z ON abs(x - cx) + abs(y - cy) <= r",
    "geo8_store_matrix": "WITH s AS (SELECT store, level1, sum(amount) AS a FROM {v_orders} GROUP BY 1, 2), h AS (SELECT store, level1, a / sum(a) OVER (PARTITION BY store) AS s FROM s) SELECT store, " + ", ".join(f"round(coalesce(sum(CASE WHEN level1 = '{c}' THEN s END), 0), 6) AS {c}" for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " FROM h GROUP BY 1",
    "s5_read_tagged": "SELECT CAST(0 AS int) AS ordinal, count(*) AS n FROM {nation} UNION ALL SELECT 1, count(*) FROM {supplier} UNION ALL SELECT 2, count(*) FROM {orders}",
    "t8_location_log": "WITH e AS (SELECT concat(CAST(ts AS date)) AS createDate, concat(user_id) AS memberId, concat(event_id % 90) AS memberLantitude, concat(event_id % 180) AS memberLongitude, 'get' AS method, event_type AS methodType FROM {events} WHERE event_id % 10 <> 0) SELECT concat_ws('|', createDate, memberId, methodType, row_number() OVER (PARTITION BY createDate, memberId, methodType ORDER BY memberLantitude || '\",\"memberLongitude\":\"' || memberLongitude || '\"') - 1) AS key, * FROM e",
    "t10_last_views": "SELECT user_id AS member, CAST(json_extract_string(props, '$.k') AS bigint) AS goods, ts FROM {events} JOIN {customer} ON c_custkey = user_id WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(json_extract_string(props, '$.k') AS bigint) DESC) = 1",
}
_SQL["c14_overall_score"] = f"""WITH sales AS ({_SQL['c11_sales_score']}), product AS ({_SQL['c12_product_line_score']}), popularity AS ({_SQL['c10_popularity_score']}), operation AS ({_SQL['c9_operation_score']}), nodes AS (SELECT DISTINCT level_no, node FROM {{v_goods}} JOIN {_LEVELS} t USING (category)),
    r AS (SELECT n.level_no, n.node, coalesce(25 * a.score, 0) AS sales, coalesce(b.score, 0) AS product, coalesce(c.score, 0) AS popularity, coalesce(d.score, 0) AS operation FROM nodes n LEFT JOIN sales a USING (level_no, node) LEFT JOIN product b USING (level_no, node) LEFT JOIN popularity c USING (level_no, node) LEFT JOIN operation d USING (level_no, node)),
    s AS (SELECT *, sales + product + popularity + operation AS total, CAST(floor(round(sales + product + popularity + operation, 6)) AS bigint) AS points FROM r)
    SELECT level_no, node, round(sales, 6) AS sales, round(product, 6) AS product, round(popularity, 6) AS popularity, round(operation, 6) AS operation, round(total, 6) AS total, points, dense_rank() OVER (PARTITION BY level_no ORDER BY points DESC) AS rank FROM s"""

ORACLES = {name: with_views(sql) for name, sql in _SQL.items()}

#: These hold patterns with braces, so they are written out without names in braces.
_W = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_T = f"terms AS (SELECT role AS category, term, count(*) AS n FROM (SELECT role, unnest({_W}) AS term FROM conversations) x WHERE length(term) >= 2 GROUP BY ALL)"
ORACLES |= {
    "q6_hot_words": f"WITH {_T} SELECT term, CAST(sum(n) AS bigint) AS n FROM terms GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50",
    "q6_category_terms": f"WITH {_T} SELECT category, term, n, row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS rank FROM terms QUALIFY rank <= 20",
    "q7_similar_terms": f"WITH {_T}, lead_ AS (SELECT category, term, n FROM terms QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, term) <= 20), own AS (SELECT term, category FROM lead_ QUALIFY row_number() OVER (PARTITION BY term ORDER BY n DESC, category) <= 3), p AS (SELECT DISTINCT own.term, lead_.term AS other FROM own JOIN lead_ USING (category)), s AS (SELECT term, other, levenshtein(term, other) AS distance FROM p) SELECT term, other, distance, row_number() OVER (PARTITION BY term ORDER BY distance, other) AS rank FROM s WHERE distance > 0 QUALIFY rank <= 10",
    "k4_item_match": r"WITH g AS (SELECT p_type AS level1, p_brand AS brand, p_partkey AS goods, p_name AS name, p_size AS comments FROM part), i AS (SELECT level1, brand, goods AS item, name AS item_name FROM g WHERE goods % 2 = 1 QUALIFY row_number() OVER (PARTITION BY level1 ORDER BY comments DESC, goods) <= 50), r AS (SELECT goods, item, lower(name) AS a, lower(item_name) AS b FROM g JOIN i USING (level1, brand) WHERE goods % 2 = 0) SELECT goods, item, CAST(len(list_intersect(list_filter(string_split_regex(a, '[^\p{L}\p{N}]+'), lambda w: w <> ''), list_filter(string_split_regex(b, '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS int) AS shared_words, CAST(len(list_intersect(list_distinct(list_filter(string_split(a, ''), lambda w: w <> '')), list_distinct(list_filter(string_split(b, ''), lambda w: w <> '')))) AS int) AS shared_characters FROM r",
    "t7_word_count": f"SELECT word, count(*) AS count FROM (SELECT unnest({_W}) AS word FROM conversations) x WHERE word NOT IN ('the', 'and', 'of') GROUP BY 1",
}

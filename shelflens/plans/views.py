"""The retail data model as views on the test tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: name -> SQL; {x} is another view or a table. Only the field of the events' JSON is written differently by engine.
VIEWS = {
    "v_category_dim": """
        SELECT DISTINCT p_type AS level1, concat(p_type, '/', p_brand) AS level2,
               CASE WHEN p_size <= 25 THEN concat(p_type, '/', p_brand, '/', p_size) END AS level3,
               CASE WHEN p_size <= 25 THEN concat(p_type, '/', p_brand, '/', p_size) ELSE concat(p_type, '/', p_brand) END AS category
        FROM {part}""",
    "v_goods": """
        SELECT p_partkey AS goods, p_name AS name, p_brand AS brand, p_retailprice AS price,
               CASE WHEN p_size <= 25 THEN concat(p_type, '/', p_brand, '/', p_size) ELSE concat(p_type, '/', p_brand) END AS category,
               p_type AS level1, concat(p_type, '/', p_brand) AS level2,
               cast(floor(p_partkey / 2) AS bigint) AS product, cast(p_partkey % 10 AS int) AS shop, cast(p_partkey % 3 + 1 AS int) AS channel,
               CASE WHEN p_size % 5 = 0 THEN 0 ELSE 4 END AS sale_status, CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END AS stock, p_size AS comments
        FROM {part}""",
    "v_orders": """
        SELECT l_orderkey AS order_no, l_linenumber AS line, o_custkey AS member, l_partkey AS goods, g.category, g.level1, g.level2, g.brand,
               l_extendedprice / l_quantity AS price, l_quantity AS qty, l_extendedprice AS amount, o_orderdate AS sale_time, o_orderstatus AS status,
               l_suppkey AS store, n_name AS district, r_name AS region
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {v_goods} g ON l_partkey = g.goods
             JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        WHERE o_orderstatus <> 'P'""",
    "v_events": """
        SELECT event_id, user_id AS member, ts, cast(ts AS date) AS day, date_trunc('week', ts) AS week, g.goods, g.category, g.level1, g.level2, g.brand, g.shop, g.price,
               CASE event_type WHEN 'view' THEN 1000 WHEN 'click' THEN 2000 WHEN 'error' THEN 3000 ELSE 4000 END AS behavior
        FROM {events} JOIN {v_goods} g ON g.goods = cast({json_k} AS bigint)
        WHERE event_type IN ('view', 'click', 'error', 'purchase')""",
    "v_points": "SELECT c_custkey AS id, cast(c_custkey * 37 % 1000 AS double) AS x, cast(c_custkey * 91 % 1000 AS double) AS y FROM {customer}",
    "v_places": "SELECT c_custkey AS id, concat(c_name, ' ') AS address, cast(c_custkey * 37 % 1000 AS double) AS x, cast(c_custkey * 91 % 1000 AS double) AS y FROM {customer}",
    "v_addressed": "SELECT o_orderkey AS order_no, o_custkey AS member, replace(c_name, '#', ' #') AS address, o_totalprice AS amount FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
    "v_diamonds": "SELECT n_nationkey AS zone, cast(n_nationkey * 173 % 1000 AS double) AS cx, cast(n_nationkey * 311 % 1000 AS double) AS cy, cast(60 + n_nationkey * 5 AS double) AS r FROM {nation}",
}
_JSON_K = {"spark": "get_json_object(props, '$.k')", "duckdb": "json_extract_string(props, '$.k')"}
_NAME = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table if no view has that name."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("{json_k}", _JSON_K["spark"])
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in set(_NAME.findall(text))})


def with_views(sql: str) -> str:
    """`sql` for DuckDB, after the views that it names in braces."""
    needed: list[str] = []

    def need(text: str) -> None:
        for n in _NAME.findall(text):
            if n in VIEWS and n not in needed:
                need(VIEWS[n].replace("{json_k}", ""))
                needed.append(n)

    need(sql)
    plain = lambda text: _NAME.sub(lambda m: m[1], text.replace("{json_k}", _JSON_K["duckdb"]))
    head = ", ".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    body = plain(sql).strip()
    if not head:
        return body
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"

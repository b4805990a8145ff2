from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from shelflens.functions.text import in_polygon, jaccard, normalize_nulls
from shelflens.operators import cooccurrence, geo, lists, models, outputs, rank
from shelflens.operators import scorecard as S
from shelflens.sources import tables
from shelflens.streaming import events as stream


def test_top_k_breaks_ties_by_item(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 1.0), ("a", 3, 2.0)], "g string, i long, s double")
    assert [(r["i"], r["rank"]) for r in rank.top_k(df, ["g"], [F.col("s").desc(), F.col("i")], 2).orderBy("rank").collect()] == [(3, 1), (1, 2)]


def test_minmax_of_one_value_is_zero(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 3.0), ("b", None)], "g string, x double")
    assert [r[0] for r in df.orderBy("g", "x").select(rank.minmax(F.col("x"), ["g"])).collect()].count(0.0) == 3


def test_cosine_of_sparse_vectors(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (2, 1, 3.0), (0, 2, 2.0), (1, 2, 3.0)], "member long, goods long, rating double")
    score = {r["goods"]: r["score"] for r in cooccurrence.item_cosine(df).collect()}
    assert score[1] == pytest.approx(2 / (10 * 13) ** 0.5)


def test_missing_values(spark):
    df = spark.createDataFrame([("null",), ("NULL",), ("",), (None,), ("x",)], "c string")
    assert [r[0] for r in df.select(normalize_nulls(F.col("c"))).collect()] == [None, None, None, None, "x"]


def test_jaccard_of_characters(spark):
    assert spark.sql("SELECT 'abc' a, 'bcd' b").select(jaccard(F.col("a"), F.col("b"))).first()[0] == 0.5


def test_polygons_include_their_edges(spark):
    ring = spark.sql("SELECT 1 AS zone, array(struct(0D AS x, 0D AS y), struct(4D AS x, 0D AS y), struct(4D AS x, 4D AS y), struct(0D AS x, 4D AS y)) AS ring")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.0, 1.0), (3, 4.0, 4.0), (4, 5.0, 2.0), (5, -1.0, 0.0)], "id long, x double, y double")
    assert sorted(r["id"] for r in geo.points_in_polygons(points, ring).collect()) == [1, 2, 3]
    assert points.crossJoin(ring).where(in_polygon(F.col("x"), F.col("y"), F.col("ring"))).count() == 3


def test_viewed_not_bought_drops_that_days_purchases(spark):
    rows = [(1, "2024-01-01 08:00:00", 1000, 5), (1, "2024-01-01 09:00:00", 4000, 5), (1, "2024-01-02 08:00:00", 1000, 6)]
    df = spark.createDataFrame(rows, "member long, t string, behavior int, goods long").select("member", "behavior", "goods", F.lit("c").alias("category"), F.to_timestamp("t").alias("ts"), F.to_date("t").alias("day"))
    assert [r["goods"] for r in lists.viewed_not_bought(df).collect()] == [6]


def test_upsert_update_delete(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert sorted(map(tuple, tables.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, tables.update_columns(old, new, ["k"], ["v"]).collect())) == [(1, "a"), (2, "c")]
    assert [tuple(r) for r in tables.delete_keys(old, new, ["k"]).collect()] == [(1, "a")]


def test_routes_of_messages(spark):
    good = '{"actType": "hotsale", "goodsId": "g", "cookieId": "c", "channel": "PC", "eventDate": 1000}'
    rec = '{"actType": "pcgl", "memberId": "m", "recResult": {"goodsList": [{"sid": "1"}, {"sid": "2"}]}}'
    routed = stream.route_events(spark.createDataFrame([(good,), (rec,), ("{broken",), ('{"actType": "x"}',)], "value string"))
    assert sorted(r["route"] for r in routed.collect()) == ["error", "error", "rec", "view"]
    cookies = spark.createDataFrame([("c", "m7")], "cookie string, member string")
    assert [r["member"] for r in stream.handle_views(routed, cookies).collect()] == ["m7"]
    assert sorted(r["goods"] for r in stream.explode_recs(routed).collect()) == ["1", "2"]


def test_ids_are_gapless_and_models_reload(spark, tmp_path):
    members = spark.range(50).select(F.concat(F.lit("m"), F.col("id") % 20).alias("name"))
    index = models.save_index(models.id_index(members, "name", 7), f"{tmp_path}/index")
    assert sorted(r["index"] for r in index.collect()) == list(range(20))
    ratings = spark.range(200).select((F.col("id") % 20).alias("member"), (F.col("id") * 7 % 11).alias("goods"), (F.col("id") % 5 + 1.0).alias("rating"))
    model = models.train_als(ratings.dropDuplicates(["member", "goods"]), rank=3, iters=3)
    models.save_model(model, f"{tmp_path}/als")
    first, again = ({(r["member"], r["goods"]): r["score"] for r in models.top_goods(m, 2).collect()} for m in (model, models.load_model(f"{tmp_path}/als")))
    assert first == again and len(first) == 40


def test_steps_of_the_product_line(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.4,), (0.5,), (0.6,), (0.8,), (0.9,)], "x double")
    got = df.select(S.concentration_points(F.col("x")), S.sell_through_points(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(0.2, 0.2), (1.0, 0.5), (1.0, 0.5), (0.5, 1.0), (0.5, 0.5), (0.5, 0.5), (0.2, 0.2)]


def test_ranks_by_whole_points_and_missing_parts(spark):
    nodes = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "level_no int, node string")
    scores = spark.createDataFrame([(1, "a", 10.9), (1, "b", 10.1)], "level_no int, node string, score double")
    found = {r["node"]: (r["total"], r["rank"]) for r in S.overall_score(nodes, {"sales": scores}).collect()}
    assert found == {"a": (10.9, 1), "b": (10.1, 1), "c": (0.0, 2)}


def test_no_correlation_without_spread(spark):
    df = spark.createDataFrame([(1, "a", 3, 1.0), (1, "a", 3, 2.0), (1, "b", 1, 1.0), (1, "b", 2, 2.0), (1, "c", 1, 2.0), (1, "c", 2, 1.0)], "level_no int, node string, goods_count long, units double")
    assert {r["node"]: r["correlation"] for r in S.price_correlation(df).collect()} == {"a": 0.0, "b": 1.0, "c": 0.0}


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    def put(name, value):
        spark.createDataFrame([(value,)], "value string").write.parquet(f"{tmp_path}/in/{name}")

    message = '{"createDate": "d", "memberId": "m", "memberLantitude": "1", "memberLongitude": "2", "method": "get", "methodType": "x"}'
    source = lambda: spark.readStream.schema("value string").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    put("one", message)
    put("bad", "{")
    assert stream.drain(stream.location_log(source()), f"{tmp_path}/out", "append", stream.with_log_keys).count() == 1
    put("two", message)
    assert stream.drain(stream.location_log(source()), f"{tmp_path}/out", "append", stream.with_log_keys).count() == 2


def test_progress_counts_messages(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    query = rows.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert stream.received(query) == 5


def test_listed_goods_of_every_id(spark):
    from shelflens.queries import QUERIES

    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    items = [r["items"].split("#") for r in QUERIES["a15_listed"](spark, "/root/testdata/sf0.01").collect()]
    assert sorted(int(x) for i in items for x in i) == sorted(r[0] for r in part.select("p_partkey").collect())


def test_sinks_replace_what_they_should(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k long, d string")
    tables.write_partition(rows, str(tmp_path / "p"), "d")
    tables.write_partition(rows.where("k = 3"), str(tmp_path / "p"), "d")
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [1, 3]
    for part in (rows, rows.where("k = 2")):
        tables.write_full(part, str(tmp_path / "f"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "f")).collect()] == [(2, "b")]
    tables.write_text(rows.coalesce(1), str(tmp_path / "t"))
    assert sorted(map(tuple, tables.read_delimited(spark, str(tmp_path / "t"), rows.schema).collect())) == [(1, "a"), (2, "b"), (3, "b")]


def test_jdbc_round_trip(spark):
    rows, url = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string"), "jdbc:derby:memory:shelf;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    tables.write_jdbc(rows, url, "rows_", **driver)
    assert sorted(map(tuple, tables.read_jdbc(spark, url, "rows_", **driver).collect())) == [(1, "a"), (2, None)]


def test_an_update_to_null_sets_null(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(2, None)], "k long, v string")
    assert sorted(map(tuple, tables.update_columns(old, new, ["k"], ["v"]).collect())) == [(1, "a"), (2, None)]


def test_later_map_wins_and_missing_ones_stay(spark):
    a, b = spark.sql("SELECT 1 k, map('x', 1, 'y', 2) m UNION ALL SELECT 2, map('x', 3)"), spark.sql("SELECT 1 k, map('y', 5) m UNION ALL SELECT 3, map('z', 9)")
    assert {r["k"]: r["m"] for r in tables.merge_maps(a, b, "k", "m").collect()} == {1: {"x": 1, "y": 5}, 2: {"x": 3}, 3: {"z": 9}}


def test_expired_rows_go(spark):
    rows = tables.with_expiry(spark.range(2), "2024-01-01 00:00:00", 60)
    assert tables.alive(rows, "2024-01-01 00:00:59").count() == 2 and tables.alive(rows, "2024-01-01 00:01:00").count() == 0


def test_lists_are_newest_first(spark):
    rows = spark.createDataFrame([(1, "c", 5, 10), (1, "c", 6, 20), (1, "d", 7, 15), (1, "c", 5, 30)], "m long, c string, g long, t long")
    assert outputs.nested_list(rows, ["m"], "c", "g", "t").first()["items"] == "c:5,6#d:7"
    assert outputs.scored_list(rows.select("m", "g", (F.col("t") / 4).alias("s")).where("t < 30"), ["m"], "g", "s", 1).first()["items"] == "6:5.0#7:3.8#5:2.5"


def test_scopes_are_parsed_from_json(spark):
    rows = spark.createDataFrame([(1, '{"scopeVOList":[{"lngLatList":[[0,0],[4,0],[4,4]]},{"lngLatList":[[9,9],[8,9],[8,8]]}]}'), (2, "{broken"), (3, None)], "zone long, scope string")
    assert [(r["zone"], len(r["ring"]), r["ring"][1]["x"]) for r in geo.parse_scopes(rows).collect()] == [(1, 3, 4.0), (1, 3, 8.0)]

"""Operators for groups of any size, stream state and keyed tables: results against plain versions, and the work they leave out."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from shelflens.operators import category, cooccurrence, geo, intervals, lists, models, nearest, outputs, prefix, rollup
from shelflens.sources import tables
from shelflens.sources.keyed import KeyedTable
from shelflens.streaming import panes, progress, state


def _rows(df, *columns):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect()), key=repr)


# sums and places of large groups


@pytest.fixture(scope="module")
def skewed(spark):
    """95 % of the rows in one group, many of them with equal values."""
    return spark.range(40_000).select(F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(99).alias("g"), F.col("id").alias("item"), (F.col("id") * 7919 % 1000 / 4).alias("v"))


def test_running_sums_split_a_hot_group(spark, skewed):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = prefix.running(skewed, ["g"], [F.col("v").desc(), F.col("item")], ["v"]).cache()
        held = prefix.saved(skewed.repartitionByRange("g", F.col("v").desc(), "item").withColumn("p", F.spark_partition_id()), "t").groupBy("p").count()
        most = held.agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert most < 40_000 / 16 * 2  # no task has over twice its share of the rows
    want: dict = {}
    for g, item, v in skewed.collect():
        want.setdefault(g, []).append((-v, item))
    got = {(r["g"], r["item"]): (r["_place"], r["_count"], r["_before_v"], r["_all_v"]) for r in found.collect()}
    for g, rows in want.items():
        total, before = -sum(v for v, _ in rows), 0.0
        for i, (v, item) in enumerate(sorted(rows)):
            assert got[g, item] == pytest.approx((i + 1, len(rows), before, total))
            before -= v
    found.unpersist()


@pytest.mark.parametrize(("bins", "small"), [(1024, 10_000), (16, 50), (2, 1)])
def test_places_are_found_by_narrowing(spark, skewed, bins, small):
    rows = skewed.withColumn("v", F.when(F.col("item") % 11 == 0, None).when(F.col("item") % 13 == 0, -1e300).when(F.col("item") % 17 == 0, 1e300).otherwise(F.col("v"))).where("item < 4000")
    rows = rows.unionByName(spark.createDataFrame([(None, 1, 5.0), (50, 2, None)], "g long, item long, v double"))
    places = {"first": F.lit(0), "tenth": F.floor(F.col("_n") / 10), "half": F.floor(F.col("_n") / 2), "last": F.col("_n") - 1, "beyond": F.col("_n")}
    got = {r["g"]: tuple(r[n] for n in places) for r in prefix.values_at(rows, ["g"], "v", places, bins, small).collect()}
    groups: dict = {}
    for r in rows.collect():
        groups.setdefault(r["g"], []).append(r["v"])
    for g, values in groups.items():
        values.sort(key=lambda v: (v is not None, v))
        assert got[g] == (values[0], values[len(values) // 10], values[len(values) // 2], values[-1], None)


def test_roll_ups_count_ids_once(spark):
    rng = random.Random(2)
    dim = spark.createDataFrame([(f"k{i}", f"a{i % 2}", f"b{i % 6}" if i else None, f"c{i}" if i % 3 else None) for i in range(24)], "category string, level1 string, level2 string, level3 string")
    facts = spark.createDataFrame([(f"k{rng.randrange(24)}", rng.choice([None, -40_000, *range(60), 70_000, 1 << 40]), rng.random(), rng.randrange(2)) for _ in range(3000)], "category string, id long, x double, m int")
    args = ({"m": F.col("m")}, "id", {"total": ("sum", F.col("x")), "least": ("min", F.col("x"))}, {"ids": None, "large": F.col("x") > 0.5})
    plain = category.explode_levels(facts, dim).groupBy("level_no", "node", "path", "m").agg(F.sum("x").alias("total"), F.min("x").alias("least"), F.count_distinct("id").alias("ids"), F.count_distinct(F.when(F.col("x") > 0.5, F.col("id"))).alias("large"))
    names = ("level_no", "node", "path", "m", "total", "least", "ids", "large")
    for least in (0, 60, 10**9):  # bitmaps everywhere, in part, nowhere
        assert _rows(rollup.roll_up(facts, dim, *args, least=least), *names) == _rows(plain, *names)
    near = {r[:4]: r[6:] for r in _rows(rollup.roll_up(facts, dim, *args, sketch=True), *names)}
    assert all(abs(a - b) <= 0.05 * b + 1 for r in _rows(plain, *names) for a, b in zip(near[r[:4]], r[6:], strict=True))


# intervals and areas


def test_bands_meet_their_neighbourhood_only(spark):
    rng = random.Random(1)
    bands = [(0, i, x, x + rng.choice([0.01, 0.5, 3.0])) for i in range(10_000) for x in [rng.uniform(-1000, 1000)]]
    bands += [(0, 20_000, -500.0, 500.0), (0, 20_001, -float("inf"), -990.0), (1, 20_002, 0.0, float("inf")), (0, 20_003, 5.0, 5.0), (0, 20_004, 9.0, 2.0), (0, 20_005, None, 2.0)]
    told = spark.createDataFrame(bands, "k int, band int, low double, high double")
    rows = spark.createDataFrame([(rng.randint(0, 1), i, rng.uniform(-1010, 1010)) for i in range(2000)] + [(0, 5000, None), (None, 5001, 1.0), (1, 5002, 1e300), (0, 5003, 500.0), (0, 5004, -500.0)], "k int, r int, v double")
    found = intervals.interval_join(rows, told, ["k"], "v")
    want = rows.join(told, "k").where("v >= low and v < high")
    assert _rows(found, "k", "r", "v", "band", "low", "high") == _rows(want, "k", "r", "v", "band", "low", "high")
    laid = told.where("low < high and abs(low) < 1e9 and abs(high) < 1e9").withColumn("_level", intervals._level(F.col("high") - F.col("low"), F.greatest(F.abs("low"), F.abs("high"))))
    cells = F.size(F.sequence(intervals._cell(F.col("low"), F.col("_level")), intervals._cell(F.col("high"), F.col("_level"))))
    assert laid.agg(F.max(cells)).first()[0] <= 10 and laid.select("_level").distinct().count() <= 5


@pytest.mark.parametrize("unit", [1.0, 1 / 4096, 4096.0])
def test_areas_in_any_unit(spark, unit):
    rng = random.Random(4)
    shapes = {z: [(x + dx * s, y + dy * s) for dx, dy in ((0, 0), (8, 1), (3, 3), (9, 9), (1, 7))] for z, x, y, s in [(i, rng.uniform(0, 900), rng.uniform(0, 900), rng.choice([1, 4, 40])) for i in range(40)]}
    rings = spark.createDataFrame([(z, [(x * unit, y * unit) for x, y in ring]) for z, ring in shapes.items()] + [(99, [])], "zone int, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(i, rng.uniform(-10, 1000) * unit, rng.uniform(-10, 1000) * unit) for i in range(3000)] + [(5000, shapes[3][1][0] * unit, shapes[3][1][1] * unit), (5001, None, 1.0)], "id int, x double, y double")
    from shelflens.functions.text import in_polygon

    want = points.crossJoin(rings.where("size(ring) > 0")).where(in_polygon(F.col("x"), F.col("y"), F.col("ring")))
    assert _rows(geo.points_in_polygons(points, rings), "id", "zone") == _rows(want, "id", "zone")
    cells = intervals.polygon_cells(rings).groupBy("zone").agg(F.count("*").alias("n"), F.count_if("_whole").alias("whole"))
    assert cells.agg(F.max("n")).first()[0] <= 34 * 34 and cells.agg(F.sum("whole")).first()[0] > 0


# matches of sets, vectors and factors


def test_best_sets_are_found_among_few_candidates(spark):
    rng = random.Random(5)
    common, words = [f"the{i}" for i in range(4)], [f"w{i}" for i in range(3000)]
    others = [common + rng.sample(words, 6) for _ in range(600)]
    own = [rng.sample(x, 8) + ["new"] for x in rng.sample(others, 300)] + [["the0", "never"], ["never"], [], common]
    frame = lambda sets: spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<string>")
    a, b = frame(own), frame(others)
    pairs = a.crossJoin(b.select(F.col("id").alias("other"), F.col("tokens").alias("t"))).withColumn("score", F.size(F.array_intersect("tokens", "t")) / F.size(F.array_union("tokens", "t"))).where("score > 0")
    from shelflens.operators.rank import top_k

    want = top_k(pairs.withColumnRenamed("id", "own"), ["own"], [F.round("score", 9).desc(), F.col("other")], 1)
    assert _rows(nearest.best_set_matches(a, b, "tokens"), "own", "other", "score") == _rows(want, "own", "other", "score")
    counts = b.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    x, y = (nearest.rare_first(s, "tokens", counts) for s in (a, b))
    assert nearest.set_candidates(x, y, 0.5).count() < 0.05 * len(own) * len(others)


@pytest.fixture
def in_blocks(monkeypatch):
    """All joins on dimensions count as too large, and blocks and pieces are small."""
    for name, value in {"PLAIN_PAIRS": 0, "BLOCK": 50, "PIECE": 64, "TAKEN": 1}.items():
        monkeypatch.setattr(nearest, name, value)
    for name in ("_plain", "_pruned", "set_candidates", "cosine_candidates"):
        monkeypatch.setattr(nearest, name, lambda *args: pytest.fail("pairs are written"))


def test_best_sets_in_blocks(spark, in_blocks):
    """Common tokens alone, equal sets, ties, copies, names as ids and sets without a match: as all pairs tell."""
    from shelflens.operators.rank import top_k

    rng = random.Random(15)
    draw = lambda n, most: [rng.sample([f"w{j}" for j in range(9)], rng.randint(1, most)) for _ in range(n)]
    own, others = [*draw(230, 6), ["none"], []], [*draw(150, 7), ["w1"], ["w1"], ["other"], []]
    for kind in ("long", "string"):
        frame = lambda sets, kind=kind: spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<string>").withColumn("id", F.col("id").cast(kind))
        a, b = frame(own), frame(others)
        pairs = a.where("size(tokens) > 0").crossJoin(b.select(F.col("id").alias("other"), F.col("tokens").alias("t"))).withColumn("score", F.size(F.array_intersect("tokens", "t")) / F.size(F.array_union("tokens", "t"))).where("score > 0")
        want = top_k(pairs.withColumnRenamed("id", "own"), ["own"], [F.round("score", 9).desc(), F.col("other")], 1)
        assert _rows(nearest.best_set_matches(a, b, "tokens"), "own", "other", "score") == _rows(want, "own", "other", "score")


def test_cosine_lists_in_blocks(spark, in_blocks):
    """Vectors of few values on few dimensions, many equal and very many scores tied, some in line and some alone: as all pairs tell."""
    rng = random.Random(16)
    vectors = [[(("a", f"d{d}"), rng.choice([1.0, 2.0])) for d in rng.sample(range(7), rng.randint(1, 4))] for _ in range(220)]
    vectors += [[(("b", "x"), 1.0 + i % 2)] for i in range(9)] + [[(("c", "alone"), 2.0)]] + [[(e, 3 * w) for e, w in vectors[i]] for i in range(20)] + [vectors[0]] * 12
    rng.shuffle(vectors)
    told = [dict(v) for v in vectors]
    norm = [sum(w * w for w in v.values()) ** 0.5 for v in told]
    rows = spark.createDataFrame([(i, e, w) for i, v in enumerate(vectors) for e, w in v], "id long, dim struct<by: string, term: string>, w double")
    for k, least in ((4, 0.0), (20, 0.3)):
        want = []
        for i, a in enumerate(told):
            scores = [(sum(w * b.get(e, 0) for e, w in a.items()) / norm[i] / norm[j], j) for j, b in enumerate(told) if j != i]
            near = sorted((-round(s, 9), j) for s, j in scores if s > least)[:k]
            want += [(i, j, round(-s, 6), n + 1) for n, (s, j) in enumerate(near)]
        assert _rows(nearest.cosine_lists(rows, k, least), "id", "other", "score", "rank") == sorted(want, key=repr)


def test_cosine_lists_without_popular_dimensions(spark):
    """Every vector holds the popular dimension, which alone would pair all of them."""
    rng = random.Random(6)
    rows = [(i, d, rng.uniform(0.5, 2)) for i in range(400) for d in [*rng.sample(range(10 * (i // 8), 10 * (i // 8) + 10), 6)]] + [(i, 9999, 0.4) for i in range(400)]
    ratings = spark.createDataFrame(rows, "id long, dim long, w double")
    plain = cooccurrence.item_cosine(ratings.toDF("goods", "member", "rating"), 3, 0.0).toDF("id", "other", "score", "rank")
    assert _rows(nearest.pruned_cosine(ratings, 3), "id", "other", "score", "rank") == _rows(plain, "id", "other", "score", "rank")
    norm = ratings.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    held = ratings.groupBy("dim").agg(F.count("*").alias("_n"))
    vectors = ratings.join(norm, "id").join(held, "dim").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "dim", (F.col("w") / F.col("n")).alias("w")))), lambda e: F.struct(e["dim"].alias("dim"), e["w"].alias("w"))).alias("entries"))
    assert nearest.cosine_candidates(vectors, vectors, 0.4).count() <= 400 * 7  # of 400 * 399
    assert nearest.most_pairs(ratings) > 400 * 399 / 2


def test_products_equal_the_models_own_lists(spark):
    rng = random.Random(3)
    ratings = spark.createDataFrame([(m, g, float(rng.randint(1, 5))) for m in range(60) for g in rng.sample(range(300), 25)], "member long, goods long, rating double")
    model = models.train_als(ratings, rank=6, iters=4)
    factors = lambda df: df.select(F.col("id").cast("long").alias("id"), F.col("features").alias("factors"))
    got = nearest.top_products(factors(model.userFactors), factors(model.itemFactors), 5, 32).collect()
    want = {(r["member"], r["rank"]): r["score"] for r in models.top_goods(model, 5).collect()}
    assert {(r["id"], r["rank"]): r["score"] for r in got} == pytest.approx(want, abs=1e-4)
    assert max(r["products"] for r in got) <= 300
    long_tail = spark.range(1000).select("id", F.array((1000 / (F.col("id") + 1)).alias("a"), F.lit(0.01)).alias("factors"))
    few = nearest.top_products(spark.createDataFrame([(1, [1.0, 0.0])], "id long, factors array<double>"), long_tail, 3, 50).collect()
    assert [r["item"] for r in few] == [0, 1, 2] and few[0]["products"] == 50


# models, against held-out ratings and plain versions


def test_factors_foretell_held_out_ratings(spark):
    rng = random.Random(9)
    taste = [[rng.uniform(0, 1) for _ in range(2)] for _ in range(80)], [[rng.uniform(0, 4) for _ in range(2)] for _ in range(60)]
    rows = [(m, g, sum(a * b for a, b in zip(taste[0][m], taste[1][g], strict=True))) for m in range(80) for g in rng.sample(range(60), 30)]
    ratings = spark.createDataFrame(rows, "member long, goods long, rating double").withColumn("held", F.pmod(F.xxhash64("member", "goods"), F.lit(5)) == 0)
    model = models.train_als(ratings.where("not held"), rank=4, iters=10)
    told = model.transform(ratings.where("held").select(F.col("member").cast("int"), F.col("goods").cast("int"), "rating")).agg(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)).alias("mse"), F.variance("rating").alias("var")).first()
    assert told["mse"] < 0.1 * told["var"]


def test_clusters_cost_no_more_than_a_plain_run(spark):
    rng = random.Random(2)
    rows = [(f"c{i}", *[rng.gauss(5 * (i % 3), 1) for _ in range(3)]) for i in range(90)]
    found, cost = models.kmeans_categories(spark.createDataFrame(rows, "name string, a double, b double, c double"), ["a", "b", "c"])
    import numpy as np

    x = np.array([r[1:] for r in rows])
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    groups = {r["name"]: r["cluster"] for r in found.collect()}
    label = np.array([groups[r[0]] for r in rows])
    plain = sum(((x[label == k] - x[label == k].mean(0)) ** 2).sum() for k in range(3))
    true = sum(((x[np.arange(90) % 3 == k] - x[np.arange(90) % 3 == k].mean(0)) ** 2).sum() for k in range(3))
    assert cost == pytest.approx(plain) and cost <= 1.001 * true


def test_behaviour_model_reports_its_error(spark):
    rows = spark.range(600).select((F.col("id") % 20).alias("member"), (F.col("id") * 7 % 30).alias("goods"), F.lit(1000).alias("behavior"), F.to_timestamp(F.lit("2024-01-20")).alias("ts"))
    lists, mse = models.behavior_als(rows, "2024-01-31", rank=3, iters=5, k=4, evaluate=True)
    ratings = models.behavior_ratings(rows, "2024-01-31")
    assert 0 <= mse < ratings.agg(F.avg(F.col("rating") * F.col("rating"))).first()[0] and lists.groupBy("member").count().where("count <> 4").isEmpty()


def test_labels_of_members_kept_out_of_the_training(spark):
    rng = random.Random(4)
    rows = [(m, m % 2, f"{'ab'[m % 2 if rng.random() < 0.85 else 1 - m % 2]}{rng.randrange(5)}") for m in range(400) for _ in range(rng.randint(6, 15))]
    found = models.train_binary(spark.createDataFrame(rows, "member long, label int, level2 string"), "label").collect()
    assert 50 < len(found) < 150 and sum((r["probability"] > 0.5) == (r["label"] > 0.5) for r in found) >= 0.95 * len(found)


def test_vectors_of_goods_viewed_together_lie_near(spark):
    rng = random.Random(5)
    rows = [([str(10 * c + rng.randrange(8)) for _ in range(12)],) for c in range(4) for _ in range(150)]
    from pyspark.ml.functions import vector_to_array

    vectors = models.word_vectors(spark.createDataFrame(rows, "items array<string>"), "items").getVectors()
    found = nearest.nearest_items(vectors.select(F.col("word").cast("long").alias("id"), vector_to_array("vector").alias("factors")), 3).collect()
    assert len(found) == 96 and sum(r["id"] // 10 == r["item"] // 10 for r in found) >= 0.9 * 96


def test_lists_in_numbered_parts(spark):
    rows = spark.range(250).select((F.col("id") % 2).alias("g"), "id", (F.col("id") * 3).alias("v"))
    told = {(r["g"], r["part"]): r["items"].split("#") for r in lists.joined_parts(rows.unionByName(rows), ["g"], "id", 50).collect()}
    assert sorted(told) == [(g, p) for g in (0, 1) for p in (0, 1, 2)] and told[1, 2] == [str(x) for x in range(201, 250, 2)]
    fields = {(r["key"], r["part"]): r["fields"] for r in outputs.key_hash_parts(rows, "k_", "g", "id", "v", 100).collect()}
    assert len(fields["k_0", 0]) == 100 and fields["k_0", 1] == {str(x): str(3 * x) for x in range(200, 250, 2)}


def test_partitioned_jdbc(spark):
    url, driver = "jdbc:derby:memory:parts;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(-5, 95)] + [(None, "none")], "k long, v string")
    tables.write_jdbc(rows, url, "rows_", **driver)
    found = tables.read_jdbc_parts(spark, url, "rows_", "k", 0, 90, 4, **driver)
    assert found.rdd.getNumPartitions() == 4 and sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, rows.collect())))


# keyed tables


def _files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_keyed_tables_rewrite_what_changes(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), F.lit("x").alias("t"))
    table = KeyedTable.create(rows, str(tmp_path / "t"), ["id"], 16)
    want = {r["id"]: (r["v"], r["t"]) for r in rows.collect()}
    told = lambda: {r["id"]: (r["v"], r["t"]) for r in table.read().collect()}
    new = spark.createDataFrame([(3, 100, "y"), (2000, 5, None)], "id long, v long, t string")
    before = _files(tmp_path / "t")
    touched = table.upsert(new)
    want |= {3: (100, "y"), 2000: (5, None)}
    after = _files(tmp_path / "t")
    assert told() == want and len(touched) <= 2
    same = {p for p in before if not any(f"_bucket={b}/" in p for b in touched)}
    assert same and all(after[p] == before[p] for p in same)
    assert table.upsert(new) == [] and _files(tmp_path / "t") == after  # again: nothing is written
    assert table.upsert(rows.limit(0)) == [] and table.delete(spark.createDataFrame([(5000,)], "id long")) == []
    table.update(spark.createDataFrame([(3, None), (4, 9), (7777, 1)], "id long, v long"), ["v"])
    want |= {3: (None, "y"), 4: (9, "x")}
    assert told() == want
    table.delete(rows.select("id"))  # whole buckets go
    assert told() == {2000: (5, None)}
    table.upsert(spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 1, "n")], "id long, v long, t string"), latest="v")
    assert told() == {2000: (5, None), 1: (3, "c"), None: (1, "n")}


# streams


def test_view_state_ends_and_stays_small(spark, tmp_path):
    """Pairs seen once go after their lifetime, so that the state doesn't grow with the stream; a restart loses nothing."""
    rows = [(f"m{t % 3}", f"g{t}" if t % 2 else "same", t) for t in range(5, 6000, 5)]
    table = KeyedTable.create(spark.createDataFrame([], "member string, goods string, views long, last_ms long"), str(tmp_path / "t"), ["member", "goods"], 4)
    parts = [spark.createDataFrame([r for r in rows if low <= r[2] < low + 2000], "member string, goods string, s long").select("member", "goods", F.timestamp_seconds("s").alias("ts")) for low in range(0, 6000, 2000)]
    told = state.in_runs(parts, str(tmp_path / "in"), lambda views: state.follow(state.view_state(views, 300, "10 seconds"), table, str(tmp_path / "run")))
    top, want = max(r[2] for r in rows) - 10, {}
    for member, goods, t in rows:
        n, last = want.get((member, goods), (0, None))
        want[member, goods] = (1 if last is not None and t - last >= 300 else n + 1, t)
    want = {k: (n, 1000 * t) for k, (n, t) in want.items() if t + 300 > top}
    assert {(r["member"], r["goods"]): (r["views"], r["last_ms"]) for r in table.read().collect()} == want
    ended = [p["stateOperators"][0]["numRowsTotal"] for p in told if p["numInputRows"] == 0]
    assert len(ended) == 3 and all(n <= len(want) + 3 for n in ended)  # a third of the stream each time, never more pairs


def test_panes_make_a_row_for_each_pane_and_key(spark, tmp_path):
    rng = random.Random(7)
    rows = sorted((rng.choice("ab"), rng.randint(0, 900)) for _ in range(3000))
    spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in"))
    from shelflens.streaming import events

    found = events.drain(panes.pane_counts(stream, "ts", "k", 4, "20 seconds"), str(tmp_path / "out"), "append").cache()
    done = [(k, s) for k, s in rows if s // 4 * 4 + 4 <= max(s for _, s in rows) - 20]
    assert found.count() == len({(k, s // 4) for k, s in done}) and found.agg(F.sum("n")).first()[0] == len(done)
    got: dict = {}
    for r in panes.sliding_counts(found, "k", 60, 4).collect():
        for end in range(r["first_end"], r["last_end"] + 1, 4):
            got[r["k"], end] = r["n"]
    want: dict = {}
    for k, s in done:
        for end in range(s // 4 * 4 + 4, s // 4 * 4 + 61, 4):
            want[k, end] = want.get((k, end), 0) + 1
    assert got == want


def test_a_stopped_stream_counts_each_row_once(spark, tmp_path):
    heard = progress.Progress()
    spark.streams.addListener(heard)
    try:
        for i in range(2):
            spark.range(10 * i, 10 * i + 10).write.mode("append").parquet(str(tmp_path / "in"))
            rows = progress.observed(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), even=F.col("id") % 2 == 0)
            counts, run = progress.counted(rows.groupBy((F.col("id") % 3).alias("k")).count(), str(tmp_path / "out"))
            heard.wait(run)
    finally:
        spark.streams.removeListener(heard)
    assert {r["k"]: r["count"] for r in counts.collect()} == {0: 7, 1: 7, 2: 6}
    assert _rows(heard.rows(spark).groupBy("run", "name").agg(F.sum("value").alias("v"), F.sum("input_rows").alias("n")), "run", "name", "v", "n") == [(0, "even", 5, 10), (1, "even", 5, 10)]


def test_lines_of_a_socket(spark):
    import socket
    import threading
    import time

    from shelflens.streaming import events

    with socket.create_server(("127.0.0.1", 0)) as server:
        over = threading.Event()

        def serve():
            told, _ = server.accept()
            with told:
                told.sendall(b"the cat\nand the dog\n")
                over.wait(60)

        threading.Thread(target=serve, daemon=True).start()
        stop = spark.createDataFrame([("the",)], "word string")
        words = events.word_count(events.socket_source(spark, "127.0.0.1", server.getsockname()[1]), stop)
        query = words.writeStream.outputMode("complete").format("memory").queryName("words_of_a_socket").start()
        try:
            for _ in range(60):
                found = {r["word"]: r["count"] for r in spark.table("words_of_a_socket").collect()}
                if len(found) == 3:
                    break
                time.sleep(0.5)
        finally:
            over.set()
            query.stop()
        assert found == {"cat": 1, "and": 1, "dog": 1}


def test_latest_rows_of_a_key_whatever_the_batches(spark, tmp_path):
    rng = random.Random(8)
    times = sorted({60 + t for t in rng.sample(range(8000), 500)})
    rows = [(rng.randrange(12), f"i{rng.randrange(40)}", t) for t in times]
    want: dict = {}
    for k, item, t in rows:
        n, last, _ = want.get(k, (0, None, None))
        want[k] = (1 if last is not None and t - last >= 400 else n + 1, t, item)
    want = {k: (n, 1000 * t, item) for k, (n, t, item) in want.items() if t + 400 > times[-1] - 10}
    for cuts in ([0, 9000], [0, 700, 5000, 9000]):
        base = tmp_path / str(len(cuts))
        table = KeyedTable.create(spark.createDataFrame([], "k long, n long, last_ms long, item string"), str(base / "t"), ["k"], 4)
        parts = [spark.createDataFrame([r for r in rows if a <= r[2] < b], "k long, item string, s long").select("k", "item", F.timestamp_seconds("s").alias("ts")) for a, b in zip(cuts, cuts[1:])]
        state.in_runs(parts, str(base / "in"), lambda x, t=table, p=base: state.follow(state.latest(x, ["k"], "ts", 400, "10 seconds", "item").select(*t.schema.names, "expired"), t, str(p / "run")))
        assert {r["k"]: (r["n"], r["last_ms"], r["item"]) for r in table.read().collect()} == want


def test_state_has_an_entry_a_bucket_and_ends_at_the_watermark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 8, raising=False)
    rows = [("edge", 100), ("late", 101)] + [(None if i == 7 else f"k{i}", 155 + i % 6) for i in range(300)]
    part = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    table = KeyedTable.create(spark.createDataFrame([], "k string, n long, last_ms long"), str(tmp_path / "t"), ["k"], 4)
    told = state.in_runs([part], str(tmp_path / "in"), lambda x: state.follow(state.latest(x, ["k"], "ts", 50, "10 seconds").select(*table.schema.names, "expired"), table, str(tmp_path / "run")))
    assert {(r["k"], r["n"], r["last_ms"]) for r in table.read().collect()} == {(k, 1, 1000 * s) for k, s in rows if k != "edge"}  # its end is the watermark itself, 150 s
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 8 for p in told)


def test_a_streamed_table_is_a_file_or_a_folder(spark, tmp_path):
    from shelflens.queries_scale import QUERIES

    for at in ("file", "folder"):
        (tmp_path / at).mkdir()
    rows = spark.createDataFrame([(1, 1, "user", "The cat and a cat"), (1, 2, "assistant", "of dogs")], "conv_id long, turn long, role string, text string").coalesce(1)
    rows.write.parquet(str(tmp_path / "folder" / "conversations.parquet"))
    part = next((tmp_path / "folder" / "conversations.parquet").glob("part-*"))
    (tmp_path / "file" / "conversations.parquet").write_bytes(part.read_bytes())
    for at in ("file", "folder"):
        assert _rows(QUERIES["t7_word_count"](spark, str(tmp_path / at)), "word", "count") == [("a", 1), ("cat", 2), ("dogs", 1)]
        assert _rows(QUERIES["t7_dropped_words"](spark, str(tmp_path / at)), "dropped", "count") == [(False, 4), (True, 3)]


def test_equal_sets_are_matched_once(spark, monkeypatch):
    """Fifty copies of each set make no more candidates than one."""
    seen, plain = [], nearest.set_candidates
    monkeypatch.setattr(nearest, "set_candidates", lambda *args: seen.append(plain(*args)) or seen[-1])
    rng = random.Random(7)
    sets = [rng.sample([f"w{i}" for i in range(12)], 4) for _ in range(40)]
    frame = lambda copies: spark.createDataFrame([(i + 40 * c, x) for c in range(copies) for i, x in enumerate(sets)], "id long, tokens array<string>")
    got = {}
    for copies in (1, 50):
        seen.clear()
        got[copies] = _rows(nearest.best_set_matches(frame(copies).withColumn("tokens", F.reverse("tokens")), frame(copies), "tokens"), "own", "other", "score"), sum(x.count() for x in seen)
    assert got[50][1] == got[1][1]
    assert sorted(got[50][0]) == sorted((own + 40 * c, other, score) for own, other, score in got[1][0] for c in range(50))


def test_equal_vectors_share_a_list(spark, monkeypatch):
    """Copies of vectors cost no pairs of their own, and their lists are those of all pairs."""
    rng = random.Random(8)
    rows = [(i + 20 * c, d, w) for i in range(20) for d, w in [(d, rng.choice([1.0, 2.0])) for d in rng.sample(range(9), 4)] for c in range(1 + i % 7)]
    vectors = spark.createDataFrame(rows, "id long, dim long, w double")
    asked, most = [], nearest.most_pairs
    monkeypatch.setattr(nearest, "most_pairs", lambda rows: asked.append(rows.select("id").distinct().count()) or most(rows))
    told: dict = {}
    for i, d, w in rows:
        told.setdefault(i, {})[d] = w
    norm = {i: sum(w * w for w in v.values()) ** 0.5 for i, v in told.items()}
    want = []
    for i, a in told.items():
        near = sorted((-round(sum(w * b.get(d, 0) for d, w in a.items()) / norm[i] / norm[j], 9), j) for j, b in told.items() if j != i)
        want += [(i, j, round(-s, 6), n + 1) for n, (s, j) in enumerate([x for x in near if x[0] < 0][:5])]
    for found in (nearest.cosine_lists(vectors, 5), nearest.pruned_cosine(vectors, 5)):
        assert _rows(found, "id", "other", "score", "rank") == sorted(want, key=repr)
    assert max(asked) <= 20


def test_long_vectors_are_joined_plainly(spark, monkeypatch):
    """Few vectors of very many entries: looking each entry up among the other's is more work than joining what both have."""
    monkeypatch.setattr(nearest, "cosine_candidates", lambda *args: pytest.fail("candidates of long vectors"))
    rows = spark.range(4000).select(F.explode(F.expr("filter(sequence(0, 9), g -> (id * 31 + g * 17) % 7 < 3)")).alias("id"), F.col("id").alias("dim"), (F.col("id") % 5 + 1.0).alias("w"))
    want = cooccurrence.item_cosine(rows.toDF("goods", "member", "rating"), 3).toDF("id", "other", "score", "rank")
    assert _rows(nearest.pruned_cosine(rows, 3, 1e-6), "id", "other", "score", "rank") == _rows(want, "id", "other", "score", "rank")


def test_users_with_equal_ratings_and_neighbours(spark):
    rng = random.Random(9)
    rows = [(u + 30 * c, g, r) for u in range(30) for g, r in [(g, rng.choice([0.5, 1.0, 3.0])) for g in rng.sample(range(12), 4)] for c in range(1 + u % 5)]
    ratings = spark.createDataFrame(rows, "member long, goods long, rating double")
    near = cooccurrence.item_cosine(ratings.toDF("goods", "member", "rating"), 6, 1e-5).toDF("member", "neighbour", "sim", "rank").collect()
    mine: dict = {}
    for u, g, r in rows:
        mine.setdefault(u, {})[g] = r
    sums: dict = {}
    for n in near:
        for g, r in mine[n["neighbour"]].items():
            sums[n["member"], g] = sums.get((n["member"], g), 0.0) + n["sim"] * r
    want = []
    for u in mine:
        best = sorted((-round(s, 9), g) for (m, g), s in sums.items() if m == u)[:4]
        want += [(u, g, round(-s, 6), i + 1) for i, (s, g) in enumerate(best)]
    assert _rows(cooccurrence.user_cf(ratings, 6, 4), "member", "item", "score", "rank") == sorted(want, key=repr)


def test_prices_of_bands_are_rounded_alike(spark, tmp_path):
    """Halves of a cent, and quotients a little below them."""
    import duckdb
    from shelflens.queries_scale import ORACLES, _overlapping

    rows = [("A", x / y) for x, y in [(66187.65, 10.0), (37584.85, 38.0), (76142.51, 2.0), (17123.92, 16.0), (20889.05, 10.0), (5.0, 8.0)]]
    edges = sorted({round(p + d, 2) for _, p in rows for d in (-0.01, 0, 0.01)})
    orders = spark.createDataFrame(rows, "level1 string, price double")
    goods = spark.createDataFrame([("A", i, p, 1) for i, p in enumerate(edges)] + [("A", 100 + i, p - 1.0, 1) for i, p in enumerate(edges)], "level1 string, goods long, price double, comments int")
    sql = ORACLES["j9_overlapping_bands"]
    con = duckdb.connect()
    for name, df in (("v_orders", orders), ("v_goods", goods)):
        df.write.parquet(str(tmp_path / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    want = con.execute(sql[sql.index(", b AS (") :].replace(", b AS (", "WITH b AS (", 1)).fetchall()
    assert _rows(_overlapping(goods, orders), "band", "lines") == sorted(want, key=repr)


def test_sums_in_bands_make_no_pairs(spark):
    """Equal to the pairs' sums, with equal, empty, endless and null bands, also where nearly all bands hold nearly all rows."""
    rng = random.Random(21)
    inf = float("inf")
    ends = [None, -inf, inf, -0.0, 0.0, float("nan")]
    rows = [(rng.choice(["a", "b", None]), rng.choice(ends) if rng.random() < 0.1 else rng.randint(-30, 30) / 2, rng.choice([1, 2, -3, None])) for _ in range(300)]
    bands = [(rng.choice(["a", "b", "c", None]), i, *(rng.choice(ends) if rng.random() < 0.2 else rng.randint(-40, 40) / 2 for _ in range(2))) for i in range(400)]
    values, told = spark.createDataFrame(rows, "k string, v double, n long"), spark.createDataFrame(bands, "k string, band long, low double, high double")
    want = intervals.interval_join(values, told, ["k"], "v").groupBy("k", "band", "low", "high").agg(F.sum("n").alias("n"))
    got = intervals.interval_sums(values, told, ["k"], "v", "n")
    # where all values of a band are null its sum is 0 here
    assert got.columns == ["k", "band", "low", "high", "n"] and _rows(got, "k", "band", "n") == _rows(want.fillna(0, ["n"]), "k", "band", "n")
    hot = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    wide = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").alias("band"), (-F.col("id")).cast("double").alias("low"), (20_000.0 + F.col("id") % 3).alias("high"))
    found = intervals.interval_sums(hot, wide, ["k"], "v", "n")  # 400 million pairs
    assert found.agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (20_000, 20_000, 20_000)


def test_bands_of_a_hot_level_are_summed_without_pairs(spark):
    from shelflens.queries_scale import _overlapping

    goods = spark.range(30_000).select(F.lit("A").alias("level1"), F.col("id").alias("goods"), (F.col("id") % 100).cast("double").alias("price"), F.lit(200).alias("comments"))
    orders = spark.range(30_000).select(F.lit("A").alias("level1"), (F.col("id") / 100).alias("price"))
    assert _overlapping(goods, orders).agg(F.count("*"), F.min("lines"), F.max("lines")).first()[:] == (30_000, 30_000, 30_000)
    plan = _overlapping(goods, orders)._jdf.queryExecution().executedPlan().toString()
    assert "_cell" not in plan and "Generate explode(sequence" not in plan


def test_summed_ratios_tie_whatever_their_halves(spark, monkeypatch):
    near = spark.createDataFrame([(1, 10, 0.053364), (2, 10, 1.239186), (1, 11, 1.2926)], "goods long, other long, score double")
    monkeypatch.setattr(cooccurrence, "llr_item_similarity", lambda ratings: near)
    ratings = spark.createDataFrame([(7, 1), (7, 2)], "member long, goods long")
    assert 0.053364 + 1.239186 < 1.29255  # as doubles
    assert [(r["goods"], r["rank"]) for r in cooccurrence.llr_lists(ratings).orderBy("rank").collect()] == [(10, 1), (11, 2)]



def _counted(spark, column, kind):
    """A column as it is, and how many times rows of it have been worked out."""
    seen = spark.sparkContext.accumulator(0)

    def told(x):
        seen.add(1)
        return x

    return F.udf(told, kind).asNondeterministic()(column), seen



def test_values_at_places_read_the_rows_once(spark, skewed):
    value, seen = _counted(spark, F.col("v"), "double")
    found = prefix.values_at(skewed.limit(3000).withColumn("v", value), ["g"], "v", {"half": F.floor(F.col("_n") / 2)}, 4, 50)
    assert found.count() == 8
    assert seen.value == 3000



def test_clusters_read_their_features_once(spark):
    value, seen = _counted(spark, F.col("id").cast("double"), "double")
    found = models.kmeans_categories(spark.range(50).select("id", value.alias("x"), (F.col("id") % 3 + 0.5).alias("y")), ["x", "y"])[0]
    assert found.count() == 50 and seen.value == 50



def test_no_bitmaps_for_ids_far_apart(spark, monkeypatch):
    """A node's 600 ids lie in 600 bitmaps of 4 KB, so they are counted as they are."""
    monkeypatch.setattr(rollup.F, "bitmap_construct_agg", lambda *args: pytest.fail("bitmaps of an id each"))
    dim = spark.createDataFrame([("k", "a", "b", None)], "category string, level1 string, level2 string, level3 string")
    facts = spark.range(600).select(F.lit("k").alias("category"), (F.col("id") * 32768).alias("goods"))
    found = rollup.roll_up(facts, dim, {}, "goods", {"n": ("sum", F.lit(1))}, {"ids": None})
    assert _rows(found, "level_no", "ids", "n") == [(1, 600, 600), (2, 600, 600)]



def test_sell_through_reads_the_orders_once(spark):
    at, seen = _counted(spark, F.lit("2024-01-05"), "string")
    dim = spark.createDataFrame([("k", "a", "b", None)], "category string, level1 string, level2 string, level3 string")
    goods = spark.range(10).select(F.col("id").alias("goods"), F.lit("k").alias("category"), F.lit(4).alias("sale_status"))
    orders = spark.range(40).select((F.col("id") % 5).alias("goods"), F.lit("k").alias("category"), F.lit(1.0).alias("amount"), at.alias("sale_time"))
    assert _rows(category.category_sell_through(orders, goods, dim), "level_no", "month", "sell_through") == [(1, "2024-01", 0.5), (2, "2024-01", 0.5)]
    assert seen.value == 40


def test_store_deviation_counts_stores_once(spark):
    """Its rows are one a store already, so the stores aren't told apart again in tables of their own."""
    from shelflens.operators import geo

    orders = spark.createDataFrame([("a", s, 10 * i + s, float(s)) for i in range(6) for s in (1, 2)] + [("a", None, 99, 8.0), ("b", 1, 1, 5.0)], "brand string, store long, member long, amount double")
    found = geo.store_deviation(orders, "brand")
    assert "count(distinct store" not in found._jdf.queryExecution().analyzed().toString()
    assert [(r["brand"], r["stores"]) for r in found.collect()] == [("a", 2)]


def test_distinct_counts_deal_out_by_rows(spark):
    """Each column has its 2,000 rows in partitions of 500, though one group holds nearly all; before, the session's partitions held them once for each column."""
    from shelflens.operators import dealing

    rows = spark.range(2000).selectExpr("if(id % 50 = 0, 1L, null) AS g", "if(id % 2 = 0, id % 300, null) AS a", "if(id % 7 = 0, null, id % 11) AS b", "cast(id AS double) AS x")
    found = dealing.distinct_counts(rows, ["g"], {"a": "b", "n": "a"}, {"total": F.col("x"), "rows": F.lit(1)}, each=500)
    plain = rows.groupBy("g").agg(F.count_distinct("b").alias("a"), F.count_distinct("a").alias("n"), F.sum("x").alias("total"), F.count("*").alias("rows"))
    assert _rows(found, "g", "a", "n", "total", "rows") == _rows(plain, "g", "a", "n", "total", "rows")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and "Expand" not in plan and ", 4" in plan  # 2,000 rows, 500 each
    none = dealing.distinct_counts(rows.where("x < 0"), ["g"], {"a": "b"})
    assert none.columns == ["g", "a"] and none.count() == 0


def test_shares_over_stores_deal_out_by_rows(spark, monkeypatch):
    """Before, a store's orders were told apart in the session's partitions."""
    from shelflens.operators import dealing

    monkeypatch.setattr(dealing.distinct_counts, "__defaults__", (None, 100))
    orders = spark.range(400).selectExpr("id % 3 AS store", "if(id % 5 = 0, 'a', 'b') AS level1", "id % 70 AS order_no", "id % 9 AS member", "id % 50 AS goods", "cast(id AS double) AS amount", "2D AS qty")
    for found, size in ((geo.category_features(orders), 1), (geo.six_shares(orders), 3)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression [store#") == size and "Expand" not in plan
        share = {r["level1"]: r["orders_share"] for r in found.collect()}
        assert share == pytest.approx({"a": 0.2, "b": 0.8})


def test_brands_and_order_shapes_are_dealt_out_by_rows(spark, monkeypatch):
    """Before, goods of all levels and members, orders and goods of a category lay in the session's partitions."""
    from shelflens.operators import dealing

    monkeypatch.setattr(dealing.dealt, "__defaults__", (100,))
    dim = spark.createDataFrame([("k", "a", "b", None), ("l", "a", "c", "d")], "category string, level1 string, level2 string, level3 string")
    goods = spark.range(400).selectExpr("if(id % 4 = 0, 'k', 'l') AS category", "if(id % 3 = 0, null, id % 5) AS brand", "if(id % 7 = 0, null, id % 90) AS goods", "id % 2 * 4 AS sale_status", "id % 3 AS stock", "id * 1.5D AS price")
    found = category.category_brand(goods, dim)
    what = [F.count_distinct("goods"), F.count_if(F.col("sale_status") == 0), F.count_if((F.col("stock") == 0) & (F.col("sale_status") == 4)), F.min("price"), F.max("price")]
    plain = category.explode_levels(goods, dim).groupBy("level_no", "node", "brand").agg(*[c.alias(f"c{i}") for i, c in enumerate(what)])
    assert _rows(found, *found.columns) == _rows(plain, *plain.columns)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [level_no#" in plan(found) and ", 12" in plan(found)  # 400 rows at three levels
    orders = goods.where("goods IS NOT NULL").selectExpr("category", "goods", "goods % 6 AS member", "goods % 40 AS order_no", "price AS amount", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(price AS int)) AS sale_time")
    assert plan(category.order_shape(orders)).count("RepartitionByExpression [category#") == 2  # members and orders; goods are written down already


def test_overall_score_reads_the_orders_once(spark, monkeypatch):
    from shelflens import queries
    from shelflens.plans.views import view

    sf_dir = "/root/testdata/sf0.001"
    orders = view(spark, sf_dir, "v_orders")
    qty, seen = _counted(spark, F.col("qty"), "double")
    lines = orders.count()
    months = orders.where("date_format(sale_time, 'yyyy-MM') > '2001-04'")
    asked = []
    sell_through = queries.C.category_sell_through
    monkeypatch.setattr(queries.C, "category_sell_through", lambda o, *rest: asked.append(o) or sell_through(o, *rest))
    found = queries._overall(view(spark, sf_dir, "v_goods"), orders.withColumn("qty", qty), view(spark, sf_dir, "v_events"), view(spark, sf_dir, "v_category_dim"))
    assert found.count() > 0 and seen.value == lines
    assert asked[0].count() == months.count()

"""Item lists from items that occur together: in sessions, or with the same users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nearest import cosine_lists, equal_vectors
from .prefix import saved
from .rank import top_k


def cooccurrence(left: DataFrame, right: DataFrame, session: list[str], item: str) -> DataFrame:
    """a, b, pairs: sessions that hold a on the left and another item b on the right."""
    a = left.select(*session, F.col(item).alias("a"))
    b = right.select(*session, F.col(item).alias("b"))
    return a.join(b, session).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("pairs"))


def _both_ways(pairs: DataFrame, *values: str) -> DataFrame:
    """Rows of a, b and of b, a for those with a < b."""
    return pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), *values).select("p.a", "p.b", *values)


def cooccurrence_within(rows: DataFrame, session: list[str], item: str) -> DataFrame:
    """The same of `rows` with themselves: each two items meet once, and their count is written both ways after it is summed."""
    a, b = rows.select(*session, F.col(item).alias("a")), rows.select(*session, F.col(item).alias("b"))
    return _both_ways(a.join(b, session).where("a < b").groupBy("a", "b").agg(F.count("*").alias("pairs")), "pairs")


def _similar(rows: DataFrame, session: list[str], item: str) -> DataFrame:
    """pairs(a, b) / rows of b."""
    n = rows.groupBy(F.col(item).alias("b")).agg(F.count("*").alias("n_b"))
    return cooccurrence_within(rows, session, item).join(n, "b").select("a", "b", (F.col("pairs") / F.col("n_b")).alias("score"))


def also_viewed(events: DataFrame, k: int = 20, session: tuple[str, ...] = ("member", "level1", "week")) -> DataFrame:
    """goods, other, score, rank: what sessions with a view of `goods` also view. Each item counts once in a session."""
    rows = events.where("behavior = 1000").select(*session, "goods").distinct()
    found = _similar(rows, list(session), "goods").withColumnsRenamed({"a": "goods", "b": "other"})
    return top_k(found, ["goods"], [F.col("score").desc(), F.col("other")], k)


def view_then_buy(events: DataFrame, k: int = 20, session: tuple[str, ...] = ("member", "level1", "week")) -> DataFrame:
    """goods, other, score, rank: purchases of `other` in sessions with a view of `goods`, by their number."""
    viewed, bought = (events.where(F.col("behavior") == code).select(*session, "goods").distinct() for code in (1000, 4000))
    found = cooccurrence(viewed, bought, list(session), "goods").select(F.col("a").alias("goods"), F.col("b").alias("other"), F.col("pairs").alias("score"))
    return top_k(found, ["goods"], [F.col("score").desc(), F.col("other")], k)


def also_bought(events: DataFrame, session: tuple[str, ...] = ("member", "level1", "week")) -> DataFrame:
    """goods, other, score: the same for purchases, the list unbounded."""
    rows = events.where("behavior = 4000").select(*session, "goods").distinct()
    return _similar(rows, list(session), "goods").withColumnsRenamed({"a": "goods", "b": "other"})


def category_also_bought(events: DataFrame, session: tuple[str, ...] = ("member", "level1", "week"), category: str = "level2") -> DataFrame:
    """category, other, score: purchases by category; goods of one category in a session count each."""
    rows = events.where("behavior = 4000").select(*session, "goods", category).distinct()
    return _similar(rows, list(session), category).withColumnsRenamed({"a": "category", "b": "other"})


def implicit_ratings(events: DataFrame, as_of: str, decay: float = 0.75, least: float = 1e-4, per_category: int = 30) -> DataFrame:
    """member, goods, rating: views as a share of the goods' views that day, fading by `decay` a day; the best of a category."""
    views = events.where("behavior = 1000")
    mine = views.groupBy("member", "goods", "category", "day").agg(F.count("*").alias("n"))
    all_ = views.groupBy("goods", "day").agg(F.count("*").alias("pv"))
    faded = F.col("n") / F.col("pv") * F.pow(F.lit(decay), F.datediff(F.lit(as_of).cast("date"), "day"))
    found = mine.join(all_, ["goods", "day"]).groupBy("member", "category", "goods").agg(F.sum(faded).alias("rating")).where(F.col("rating") > least)
    return top_k(found, ["member", "category"], [F.round("rating", 9).desc(), F.col("goods")], per_category).select("member", "goods", "rating")


def item_cosine(ratings: DataFrame, k: int = 10, least: float = 1e-6) -> DataFrame:
    """goods, other, score, rank: cosine of the goods' rating columns, through the users that rated both."""
    vectors = ratings.select(F.col("goods").alias("id"), F.col("member").alias("dim"), F.col("rating").alias("w"))
    return cosine_lists(vectors, k, least).withColumnRenamed("id", "goods")


def item_cf(ratings: DataFrame, k_sim: int = 10, k_rec: int = 60) -> DataFrame:
    """member, goods, score, rank: rating times similarity of a neighbour, the best one of each, not summed."""
    near = item_cosine(ratings, k_sim).select("goods", "other", "score")
    found = ratings.join(near, "goods").groupBy("member", F.col("other").alias("item")).agg(F.max(F.col("rating") * F.col("score")).alias("score"))
    return top_k(found, ["member"], [F.round("score", 9).desc(), F.col("item")], k_rec)


def user_cf(ratings: DataFrame, k_sim: int = 50, k_rec: int = 80) -> DataFrame:
    """member, item, score, rank: what the most similar users rate, weighted by similarity and summed.

    Users with equal ratings count as one where they are neighbours, and users whose neighbours are the same get their
    list from one sum.
    """
    equal = equal_vectors(ratings.select(F.col("member").alias("id"), F.col("goods").alias("dim"), F.col("rating").alias("w")))
    flipped = ratings.select(F.col("goods").alias("member"), F.col("member").alias("goods"), "rating")
    near = item_cosine(flipped, k_sim, 1e-5).select(F.col("goods").alias("member"), F.col("other").alias("id"), F.col("score").alias("sim")).join(equal, "id")
    near = near.groupBy("member").agg(F.array_sort(F.collect_list(F.struct("first", "sim"))).alias("near"))
    near = saved(near, "neighbours")
    lists = saved(near.groupBy("near").agg(F.min("member").alias("list")), "neighbour-lists")
    mine = near.join(lists, "near").select("member", "list")
    weights = lists.select("list", F.explode("near").alias("n")).groupBy("list", F.col("n.first").alias("member")).agg(F.sum("n.sim").alias("sim"))
    found = weights.join(ratings.select("member", F.col("goods").alias("item"), "rating"), "member").groupBy("list", "item").agg(F.sum(F.col("sim") * F.col("rating")).alias("score"))
    best = top_k(found, ["list"], [F.round("score", 9).desc(), F.col("item")], k_rec)
    return mine.join(best, "list").select("member", "item", "score", "rank")


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(0.0)


def llr_item_similarity(ratings: DataFrame, k: int = 50) -> DataFrame:
    """goods, other, score, rank by the log-likelihood ratio of the 2x2 counts of users (Dunning 1993)."""
    pairs = ratings.select("member", "goods").distinct()
    n = pairs.groupBy("goods").agg(F.count("*").alias("n"))
    users = pairs.select("member").distinct().agg(F.count("*").alias("users"))
    both = cooccurrence_within(pairs, ["member"], "goods")
    rows = both.join(n.toDF("a", "n_a"), "a").join(n.toDF("b", "n_b"), "b").crossJoin(F.broadcast(users))  # a single row
    k11, k12, k21 = F.col("pairs"), F.col("n_a") - F.col("pairs"), F.col("n_b") - F.col("pairs")
    k22 = F.col("users") - F.col("n_a") - F.col("n_b") + F.col("pairs")
    entropy = lambda *x: _xlogx(sum(x[1:], x[0])) - sum((_xlogx(i) for i in x[1:]), _xlogx(x[0]))
    score = F.greatest(F.lit(0.0), 2 * (entropy(k11 + k12, k21 + k22) + entropy(k11 + k21, k12 + k22) - entropy(k11, k12, k21, k22)))
    found = rows.select(F.col("a").alias("goods"), F.col("b").alias("other"), score.alias("score"))
    return top_k(found, ["goods"], [F.round("score", 6).desc(), F.col("other")], k)


def llr_lists(ratings: DataFrame, k: int = 50) -> DataFrame:
    """member, goods, score, rank: goods that the member has not, by the summed likelihood ratios of those that it has.

    Ratios of six places are summed as decimals: one sum in a hundred is a half at the four places that are ranked, which
    a sum of doubles would round by the order of its terms.
    """
    have = ratings.select("member", "goods").distinct()
    offered = have.join(llr_item_similarity(ratings), "goods").groupBy("member", F.col("other").alias("goods")).agg(F.sum(F.round("score", 6).cast("decimal(18, 6)")).alias("score"))
    best = top_k(offered.join(have, ["member", "goods"], "left_anti"), ["member"], [F.round("score", 4).desc(), F.col("goods")], k)
    return best.withColumn("score", F.col("score").cast("double"))

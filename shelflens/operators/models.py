"""Factor models, clusters, frequent sets and attribute similarity, with Spark's own estimators where they fit."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import HashingTF, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import random_part
from .nearest import cosine_lists
from .prefix import saved
from .rank import minmax, top_k

#: Weight of each behaviour in a rating.
BEHAVIOR_WEIGHTS = {1000: 1.0, 2000: 2.0, 3000: -1.5, 4000: 3.0}


def id_index(df: DataFrame, column: str, parts: int = 200) -> DataFrame:
    """column, index: distinct values numbered from 0 without gaps. Values are dealt out by hash, so reruns agree."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_p", F.pmod(F.xxhash64(column), F.lit(parts)))
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_at"))  # `parts` rows
    numbered = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(column)) - 1)
    return numbered.join(F.broadcast(before), "_p").select(column, (F.col("_at") + F.col("_i")).cast("int").alias("index"))


def save_index(index: DataFrame, path: str) -> DataFrame:
    index.write.mode("overwrite").parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def train_als(ratings: DataFrame, rank: int = 10, iters: int = 20, reg: float = 0.01, seed: int = 7) -> ALSModel:
    als = ALS(rank=rank, maxIter=iters, regParam=reg, seed=seed, userCol="member", itemCol="goods", ratingCol="rating", coldStartStrategy="drop")
    return als.fit(ratings.select(F.col("member").cast("int"), F.col("goods").cast("int"), F.col("rating").cast("float")))


def top_goods(model: ALSModel, k: int) -> DataFrame:
    """member, goods, score, rank: the `k` goods of each member that the model rates highest."""
    rows = model.recommendForAllUsers(k).select("member", F.posexplode("recommendations").alias("i", "r"))
    return rows.select("member", "r.goods", F.col("r.rating").cast("double").alias("score"), (F.col("i") + 1).alias("rank"))


def als_lists(ratings: DataFrame, rank: int = 10, iters: int = 20, reg: float = 0.01, k: int = 60, seed: int = 7) -> DataFrame:
    """member and goods are whole numbers below 2^31; number others with id_index first."""
    return top_goods(train_als(ratings, rank, iters, reg, seed), k)


def behavior_ratings(events: DataFrame, as_of: str, days: int = 90, decay: float = 0.95) -> DataFrame:
    """member, goods, rating: each event's weight, faded by the days since."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("ts"))
    weight = F.create_map(*[F.lit(x) for pair in BEHAVIOR_WEIGHTS.items() for x in pair])[F.col("behavior")]
    return events.where(age.between(0, days - 1)).groupBy("member", "goods").agg(F.sum(weight * F.pow(F.lit(decay), age)).alias("rating"))


def behavior_als(events: DataFrame, as_of: str, rank: int = 10, iters: int = 10, reg: float = 0.01, k: int = 30, seed: int = 7, evaluate: bool = False) -> tuple[DataFrame, float | None]:
    """Lists of goods and, where asked for, the mean squared error on the ratings they were trained on."""
    ratings = behavior_ratings(events, as_of)
    model = train_als(ratings, rank, iters, reg, seed)
    if not evaluate:
        return top_goods(model, k), None
    told = model.transform(ratings.select(F.col("member").cast("int"), F.col("goods").cast("int"), "rating"))
    return top_goods(model, k), RegressionEvaluator(metricName="mse", labelCol="rating").evaluate(told)


def kmeans_categories(features: DataFrame, columns: list[str], k: int = 3, iters: int = 50, seed: int = 7) -> tuple[DataFrame, float]:
    """The rows with their cluster, and the sum of squared distances. Columns are brought to the same spread first.

    The features are written down once, since scaling, training and assigning each read them.
    """
    rows = VectorAssembler(inputCols=columns, outputCol="_raw").transform(saved(features, "features"))
    rows = StandardScaler(inputCol="_raw", outputCol="_v", withMean=True).fit(rows).transform(rows)
    model = KMeans(k=k, maxIter=iters, initSteps=10, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("_raw", "_v"), model.summary.trainingCost


def price_levels(goods: DataFrame, by: str, levels: int = 5) -> DataFrame:
    """by, goods, level: 1 and one more for each cut that the price reaches; cuts are at even shares of the distinct prices."""
    distinct = goods.select(by, "price").distinct()
    w = Window.partitionBy(by)
    at, n = F.row_number().over(w.orderBy("price")) - 1, F.count("*").over(w)
    level = sum(((at >= F.floor(n * i / levels)).cast("int") for i in range(1, levels)), F.lit(1))
    return goods.select(by, "goods", "price").join(distinct.withColumn("level", level), [by, "price"]).select(by, "goods", "level")


def attribute_similarity(attrs: DataFrame, levels: DataFrame, by: str, k: int = 20) -> DataFrame:
    """goods, other, score, rank: cosine of the tf-idf of attributes (by, goods, term) and price levels within a category.

    idf is ln((goods + 1) / (goods with the term + 1)). Terms of all goods weigh 0 and are left out of the join.
    """
    tf = attrs.groupBy(by, "goods", "term").agg(F.count("*").cast("double").alias("tf")).unionByName(levels.select(by, "goods", F.lit("price level").alias("term"), F.col("level").cast("double").alias("tf")))
    m = levels.groupBy(by).agg(F.count_distinct("goods").alias("_m"))
    df = tf.groupBy(by, "term").agg(F.count("*").alias("_df")).join(m, by).where("_df < _m")
    weight = F.col("tf") * F.log((F.col("_m") + 1) / (F.col("_df") + 1))
    rows = tf.join(df, [by, "term"]).select(by, "goods", "term", weight.alias("w"))
    dims = rows.select(F.col("goods").alias("id"), F.struct(by, "term").alias("dim"), "w")
    return cosine_lists(dims, k).withColumnRenamed("id", "goods")


def frequent_itemsets(baskets: DataFrame, support: float = 1e-4) -> DataFrame:
    """items (sorted), freq of every set of two or more items; baskets have a column `items` without repeats."""
    model = FPGrowth(itemsCol="items", minSupport=support).fit(baskets)
    return model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("items"), "freq")


def gender_features(events: DataFrame, label: str, least: int = 4, most: int = 19) -> DataFrame:
    """member, label, level2, ratio: how a member's events spread over level-2 categories, of members with few to some events."""
    n = F.sum("_n").over(Window.partitionBy("member", label))
    rows = events.groupBy("member", label, "level2").agg(F.count("*").alias("_n")).withColumn("_all", n)
    return rows.where(F.col("_all").between(least, most)).select("member", F.col(label).alias("label"), "level2", (F.col("_n") / F.col("_all")).alias("ratio"))


def train_binary(events: DataFrame, label: str, least: int = 4, most: int = 19, dim: int = 1 << 12, iters: int = 50, reg: float = 0.01, held: int = 4) -> DataFrame:
    """member, label, probability of label 1, by logistic regression on the shares that gender_features gives, hashed to `dim` places.

    One member in `held`, by a hash, is kept out of the training, and those are the ones returned.
    """
    counted = events.groupBy("member", F.col(label).cast("double").alias("label")).agg(F.count("*").alias("_n")).where(F.col("_n").between(least, most))
    lists = events.select("member", "level2").join(counted.select("member", "label"), "member").groupBy("member", "label").agg(F.collect_list("level2").alias("terms"))  # `most` terms at the most
    stages = [HashingTF(inputCol="terms", outputCol="_tf", numFeatures=dim), Normalizer(inputCol="_tf", outputCol="features", p=1.0), LogisticRegression(maxIter=iters, regParam=reg)]
    kept_out = random_part(F.col("member"), held, 0) == 0
    return Pipeline(stages=stages).fit(lists.where(~kept_out)).transform(lists.where(kept_out)).select("member", "label", vector_to_array("probability")[1].alias("probability"))


def user_profile_json(events: DataFrame, k: int = 3) -> DataFrame:
    """member, profile: a JSON document of the member's leading level-1 categories, brands in order, and price range in cents."""
    lead = top_k(events.groupBy("member", "level1").agg(F.count("*").alias("n")), ["member"], [F.col("n").desc(), F.col("level1")], k)
    cats = lead.groupBy("member").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "level1"))), lambda x: x["level1"]).alias("categories"))
    cents = F.round(F.col("price") * 100).cast("long")
    rest = events.groupBy("member").agg(F.array_sort(F.collect_set("brand")).alias("brands"), F.struct(F.min(cents).alias("min"), F.max(cents).alias("max")).alias("price"))
    return cats.join(rest, "member").select("member", F.to_json(F.struct("categories", "brands", "price")).alias("profile"))


def search_score_with_conversion(metrics: DataFrame, weights: dict[str, float] | None = None, by: tuple[str, ...] = ("level1", "channel")) -> DataFrame:
    """goods, score: like goods_search_score, with conversion (units over viewers, 0 without any) and other weights."""
    rows = metrics.withColumn("conversion", F.coalesce(F.round(F.col("units7") / F.nullif(F.col("uv"), F.lit(0)), 10), F.lit(0.0)))
    total = sum((w * minmax(F.col(c).cast("double"), list(by)) for c, w in (weights or CONVERSION_WEIGHTS).items()), F.lit(0.0))
    return rows.select("goods", total.alias("score"))


#: Points of each metric of the variant with conversion.
CONVERSION_WEIGHTS = {"sales7": 20.0, "sales30": 15.0, "pv": 4.0, "uv": 14.0, "conversion": 15.0, "reviews": 4.0, "review_score": 10.0, "fill_rate": 2.0}


def word_vectors(sequences: DataFrame, items: str, size: int = 16, seed: int = 1):
    """A Word2Vec model of item sequences (an array of texts): vectors of the items, and those nearest to one."""
    from pyspark.ml.feature import Word2Vec

    return Word2Vec(vectorSize=size, minCount=2, seed=seed, numPartitions=4, inputCol=items, outputCol="vector").fit(sequences)

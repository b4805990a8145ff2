"""User preferences, buying cycles and price tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import positional_quantile, top_k


def buying_cycle(events: DataFrame) -> DataFrame:
    """category, cycle, observations: median days between a member's consecutive purchase days."""
    days = events.where("behavior = 4000").select("member", "category", "day").distinct()
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("member", "category").orderBy("day")))
    return days.withColumn("gap", gap).where("gap IS NOT NULL").groupBy("category").agg(F.median("gap").alias("cycle"), F.count("*").alias("observations"))


def _views(events: DataFrame, item: str, as_of: str, decay: float, floor: float) -> DataFrame:
    views = events.where("behavior = 1000")
    pv = views.groupBy(item, "day").agg(F.count("*").alias("pv"))
    mine = views.groupBy("member", item, "day").agg(F.count("*").alias("n")).join(pv, [item, "day"])
    faded = F.col("n") / F.col("pv") * F.pow(F.lit(decay), F.datediff(F.lit(as_of).cast("date"), "day"))
    return mine.groupBy("member", item).agg(F.sum(faded).alias("score")).where(F.col("score") > floor)


def category_preference(events: DataFrame, as_of: str, decay: float = 0.75, floor: float = 1e-5) -> DataFrame:
    """member, category, score: fading shares of the category's views, plus how near the next purchase is.

    The purchase term is 2 / (1 + exp(|cycle - days since the last purchase|)), or 2 where the category has no cycle.
    """
    viewed = _views(events, "category", as_of, decay, floor)
    last = events.where("behavior = 4000").groupBy("member", "category").agg(F.datediff(F.lit(as_of).cast("date"), F.max("day")).alias("since"))
    near = F.when(F.col("cycle").isNull(), 2.0).otherwise(2 / (1 + F.exp(F.abs(F.col("cycle") - F.col("since")))))
    bought = last.join(buying_cycle(events), "category", "left").select("member", "category", near.alias("score"))
    return viewed.unionByName(bought).groupBy("member", "category").agg(F.sum("score").alias("score"))


def goods_preference(events: DataFrame, as_of: str, k: int = 5) -> DataFrame:
    """member, category, goods, score, rank: the same by goods, purchases counting 2 * 0.9 ** days."""
    viewed = _views(events, "goods", as_of, 0.75, 1e-6)
    bought = events.where("behavior = 4000").groupBy("member", "goods").agg(F.sum(2 * F.pow(F.lit(0.9), F.datediff(F.lit(as_of).cast("date"), "day"))).alias("score"))
    both = viewed.unionByName(bought).groupBy("member", "goods").agg(F.sum("score").alias("score"))
    named = both.join(events.select("goods", "category").distinct(), "goods")
    return top_k(named, ["member", "category"], [F.round("score", 9).desc(), F.col("goods")], k)


def interest_degree(events: DataFrame, by: str = "category") -> DataFrame:
    """member, item, doi: log of the member's weight over log of the largest one of that item; 1 where that is 1."""
    weight = F.when(F.col("behavior") == 1000, 1.0).when(F.col("behavior") == 2000, 2.0).when(F.col("behavior") == 3000, -1.0).otherwise(4.0)
    mine = events.groupBy("member", F.col(by).alias("item")).agg(F.sum(weight).alias("w"))
    most = F.max("w").over(Window.partitionBy("item"))
    doi = F.when(F.col("w") <= 0, None).when(most == 1, 1.0).otherwise(F.log("w") / F.log(most))
    return mine.withColumn("doi", doi).select("member", "item", "doi")


def price_tier_preference(events: DataFrame, goods: DataFrame) -> DataFrame:
    """member, category, low, mid, high: shares of viewed goods below, between and above the cuts at 40 % and 80 %."""
    cuts = positional_quantile(goods, ["category"], "price", [4, 8])
    seen = events.where("behavior = 1000").select("member", "category", "goods", "price").distinct().join(cuts, "category")
    return seen.groupBy("member", "category").agg(
        F.avg((F.col("price") < F.col("q4")).cast("double")).alias("low"),
        F.avg(((F.col("price") >= F.col("q4")) & (F.col("price") < F.col("q8"))).cast("double")).alias("mid"),
        F.avg((F.col("price") >= F.col("q8")).cast("double")).alias("high"),
    )


def view_sequences(events: DataFrame, least: int = 4) -> DataFrame:
    """member, n, sequence: viewed goods in order, space-joined, of members with at least `least` views."""
    rows = events.where("behavior = 1000").groupBy("member")
    return rows.agg(F.count("*").alias("n"), F.expr("listagg(cast(goods AS string), ' ') WITHIN GROUP (ORDER BY ts, event_id)").alias("sequence")).where(F.col("n") >= least)


def skip_pairs(events: DataFrame, reach: int = 5) -> DataFrame:
    """item, context, n: how often two goods are viewed by a member at most `reach` views apart, each as the other's context: what word vectors learn from."""
    order = Window.partitionBy("member").orderBy("ts", "event_id")
    ahead = [F.lead("goods", d).over(order).alias(f"_{d}") for d in range(1, reach + 1)]
    rows = events.where("behavior = 1000").select("goods", *ahead).select("goods", F.explode(F.array(*[f"_{d}" for d in range(1, reach + 1)])).alias("other")).where("other IS NOT NULL")
    both = F.explode(F.array(F.struct(F.col("goods").alias("item"), F.col("other").alias("context")), F.struct(F.col("other").alias("item"), F.col("goods").alias("context"))))
    return rows.groupBy("goods", "other").agg(F.count("*").alias("_n")).select(both.alias("p"), "_n").groupBy("p.item", "p.context").agg(F.sum("_n").alias("n"))


#: Weights of views, clicks, removals and purchases, as the several jobs take them.
BEHAVIOUR_WEIGHTS = {
    "persona": {1000: 1.0, 2000: 3.0, 3000: -2.0, 4000: 5.0},
    "goods": {1000: 1.0, 2000: 3.0, 3000: 0.0, 4000: 5.0},
    "guess": {1000: 1.0, 2000: 2.0, 3000: -1.5, 4000: 3.0},
    "ratings": {1000: 1.0, 2000: 2.0, 3000: -1.5, 4000: 3.0},
}


def weight_of(variant: str) -> Column:
    """The weight of a row's `behavior`; null for an unknown one."""
    return F.create_map(*[F.lit(x) for pair in BEHAVIOUR_WEIGHTS[variant].items() for x in pair])[F.col("behavior")]


def faded_interest(events: DataFrame, by: list[str], as_of: str, half_life: float | None = None, variant: str = "goods") -> DataFrame:
    """member, by..., weight, doi: log of a member's (fading) weight over log of the most rows a member has of that item; 1 where that is 1.

    A weight that isn't positive has none. With `half_life` a day's weight halves in so many days.
    """
    age = F.datediff(F.lit(as_of).cast("date"), "day")
    weight = weight_of(variant) * (F.pow(F.lit(0.5), age / half_life) if half_life else F.lit(1.0))
    mine = events.groupBy("member", *by).agg(F.sum(weight).alias("weight"), F.count("*").alias("n"))
    most = F.max("n").over(Window.partitionBy(*by))
    doi = F.when(F.round("weight", 9) <= 0, None).when(most == 1, 1.0).otherwise(F.log("weight") / F.log(most.cast("double")))
    return mine.select("member", *by, "weight", doi.alias("doi"))

"""Mixing sources to target weights by entropy balancing.

Of all rates that give each source its target of words, with no document above `most` times, the ones of least
relative entropy are exp(lambda * size / mean size), cut at `most`, with one multiplier for each source. Newton steps
on the convex dual find the multipliers from a histogram of sizes. The rates are rounded to whole copies along the
order of sizes, large documents first: what their rounding leaves over or short of the target, the rates of the others
make up. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, tucked, word_count

BITS = 20
ONE = 1 << BITS  #: fixed point of the rates, so that sums don't depend on their order
LARGE = 200  #: a document is large whose words, so many times, are more than its source's target
STARTS = 64  #: places tried for the run of a source's large documents to start from
WEIGHTS = (5, 2, 1)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """sid, source, source_size, target of every source of `sizes` (source, size).

    Sources by code point, null last, take the weights in turn and share all words by weight. A target stops at `most`
    times its source's size; sorted by the ratio of that limit to the weight the limited sources come first, so running
    sums find the common level at once. The windows run over a row for each source.
    """
    all_ = Window.partitionBy()
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = found.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    found = found.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1)).withColumn("cap", F.lit(most) * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("level", (F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    found = found.withColumn("capped", F.col("cap") < F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(all_)
    return found.select("sid", "source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), level * F.col("weight"))).alias("target"))


def _rate(lam: Column, size: Column, mean: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(lam * size / mean))


def multipliers(hist: DataFrame, sources: DataFrame, most: int = 3, steps: int = 16) -> DataFrame:
    """sid, lam of every source with words. `hist`: sid, size, n, with sizes above 0.

    Newton on the logarithm of the words taken, which is convex below the cut; a step that leaves the bracket halves
    it instead. Sources whose target is all that the cut allows get a large multiplier.
    """
    lam = sources.where("source_size > 0").select("sid", "target", (F.col("source_size") / F.col("docs")).alias("mean"), F.lit(0.0).alias("lam"), F.lit(-1000.0).alias("lo"), F.lit(1000.0).alias("hi"))
    for i in range(steps):
        words = F.col("n") * F.col("size") * F.col("r")
        got = (
            hist.join(lam, "sid")
            .withColumn("r", _rate(F.col("lam"), F.col("size"), F.col("mean"), most))
            .groupBy("sid")
            .agg(F.sum(words).alias("f"), F.sum(F.when(F.col("r") < most, words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"), *[F.first(c).alias(c) for c in ("target", "mean", "lam", "lo", "hi")])
        )
        got = got.withColumn("lo", F.when(F.col("f") <= F.col("target"), F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("f") > F.col("target"), F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("f") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
        step = F.when(F.abs(F.col("f") - F.col("target")) <= F.col("target") * 1e-12, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        lam = got.select("sid", "target", "mean", step.alias("lam"), "lo", "hi")
        if i % 4 == 3:
            lam = save(lam, "mix-multipliers")
    return lam.select("sid", "mean", F.round("lam", 9).alias("lam"))


def _solved(most: int) -> Column:
    """The rate in fixed point, from size, lam, mean, target and source_size."""
    rate = F.when(F.col("target") >= F.col("source_size") * float(most), F.lit(float(most))).otherwise(_rate(F.col("lam"), F.col("size"), F.col("mean"), most))
    return F.round(rate * ONE).cast("long")


def _whole(run: Column) -> Column:
    return F.shiftright(run, BITS)


def settled(hist: DataFrame, plan: DataFrame, most: int = 3) -> DataFrame:
    """sid, start, down, up of every source with words. `hist`: sid, size, n, with sizes above 0; `plan`: sid, source_size, target, lam, mean.

    Copies of large documents are known from the histogram, as documents of one size have one rate and their run goes
    by size. Of STARTS starts the one is taken with which their words come nearest to what their rates say. The rates
    of all others are then multiplied by `down`, or brought nearer to `most` by the share `up`, so that the source's
    words are its target again. A source has at most LARGE * source_size / target large documents.
    """
    cells = hist.join(plan, "sid").withColumn("r", _solved(most)).withColumn("words", F.col("n") * F.col("size"))
    cells = cells.select("sid", "target", "size", "n", "words", "r", (F.col("size") * LARGE > F.col("target")).alias("large"))
    run = cells.where("large").withColumn("run", F.sum(F.col("n") * F.col("r")).over(Window.partitionBy("sid").orderBy("size")))
    run = run.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ONE - 1).cast("long"), F.lit(ONE // STARTS).cast("long"))))
    end = F.col("start") + F.col("run")
    tried = run.groupBy("sid", "start").agg(
        F.sum(F.col("size") * (_whole(end) - _whole(end - F.col("n") * F.col("r")))).alias("taken"), F.sum(_whole(F.col("words") * F.col("r"))).alias("due")
    )
    best = tried.groupBy("sid").agg(F.min(F.struct(F.abs(F.col("taken") - F.col("due")).alias("off"), "start", "taken")).alias("best"))
    others = cells.groupBy("sid").agg(
        F.first("target").alias("target"),
        *[F.sum(F.when(F.col("large"), 0).otherwise(_whole(F.col("words") * x))).alias(c) for c, x in (("due", F.col("r")), ("room", most * ONE - F.col("r")))],
    )
    left = F.col("target") - F.coalesce("best.taken", F.lit(0)) - F.col("due")

    def share(x: Column, of: Column) -> Column:
        return F.least(F.greatest(x / F.greatest(of, F.lit(1)), F.lit(0.0)), F.lit(1.0))

    return others.join(best, "sid", "left").select(
        "sid", F.coalesce("best.start", F.lit(0)).alias("start"), (1 - share(-left, F.col("due"))).alias("down"), share(left, F.col("room")).alias("up")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, rows_per_group: int = 100_000) -> DataFrame:
    """size, source_size, target and copies of every row of `docs`, before all its columns, which are named c0, c1, ... in their order.

    Null texts have no words; documents without words are no part of any sum and keep one copy. Null is a source like
    any other. A source of which all sizes are 0 has the target 0. Repeated rows are documents of their own. Hot sources
    are split into groups of alike sizes, and by hash, before any window orders their rows; the large documents of a
    source, few by their definition, are split by size alone.
    """
    inner, at, _ = tucked(docs)
    sized = inner.select("*", F.col(at["source"]).alias("_source"), F.col(at["doc_id"]).alias("_doc_id"), word_count(F.col(at["text"])).alias("size"), F.xxhash64(at["doc_id"], at["text"]).alias("_tie"))
    hist = save(sized.groupBy(F.col("_source").alias("source"), "size").agg(F.count("*").alias("n")), "mix-sizes")
    rows = hist.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    salts = max(16, rows // rows_per_group)
    weighed = hist.select("source", (F.col("size") * F.col("n")).alias("size"))
    named = hist.groupBy("source").agg(F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"))
    sources = targets(weighed, weights, most).withColumnRenamed("source", "_s").join(named, F.col("_s").eqNullSafe(named["source"])).drop("source")
    sources = save(sources, "mix-sources")
    by_id = hist.where("size > 0").join(sources.select("_s", "sid"), F.col("source").eqNullSafe(F.col("_s"))).select("sid", "size", "n")
    by_id = save(by_id, "mix-histogram")
    solved = save(sources.join(multipliers(by_id, sources, most), "sid", "left"), "mix-solved")
    plan = save(solved.join(settled(by_id, solved.select("sid", "source_size", "target", "lam", "mean"), most), "sid", "left"), "mix-plan")

    def rated(df: DataFrame) -> DataFrame:
        large = F.col("size") * LARGE > F.col("target")
        near = F.when(F.col("down") < 1, F.round(F.col("_solved") * F.col("down"))).otherwise(F.col("_solved") + F.round((most * ONE - F.col("_solved")) * F.col("up")))
        return (
            df.join(plan, F.col("_source").eqNullSafe(F.col("_s")))
            .withColumn("_solved", _solved(most))
            .withColumn("_rate", F.when(F.col("size") <= 0, F.lit(ONE)).when(large, F.col("_solved")).otherwise(near.cast("long")))
            .withColumn("_class", F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double")) * 4).cast("int"))
            .withColumn("_salt", F.when(large, F.lit(-1)).otherwise(F.pmod(F.col("_tie"), F.lit(salts))))
        )

    groups = ["sid", "_class", "_salt"]
    sums = rated(sized.where("size > 0").select("_source", "size", "_tie")).groupBy(*groups).agg(F.sum("_rate").alias("_sum"), F.first("start").alias("_first"))
    sums = save(sums, "mix-groups")
    large = F.col("_salt") < 0
    start = F.when(large, F.col("_first")).otherwise(F.pmod(F.xxhash64(F.lit("start"), "sid"), F.lit(ONE)))
    offsets = save(sums.select(*groups, (start + F.sum("_sum").over(Window.partitionBy("sid", large).orderBy("_class", "_salt")) - F.col("_sum")).alias("_before")), "mix-offsets")
    run = F.col("_before") + F.sum("_rate").over(Window.partitionBy(*groups).orderBy("size", "_tie", "_doc_id").rowsBetween(Window.unboundedPreceding, 0))
    whole = rated(sized).join(offsets, groups, "left").withColumn("_run", run)
    copies = (_whole(F.col("_run")) - _whole(F.col("_run") - F.col("_rate"))).cast("int")
    return whole.select("size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(1).alias("copies"), *inner.columns)


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with the columns of `docs`.

    A null source is a source; rows without words are kept once; equal rows are mixed each for itself. Texts of any
    length count by all their words. An empty table stays empty.
    """
    taken = mix(docs).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*tucked(docs)[2])


def op9_entropy_mix(docs: DataFrame) -> DataFrame:
    """doc_id, its size and its source's, the source's target and the words that the mix takes of each document."""
    return mix(docs.select("doc_id", "source", "text")).select(F.col("c0").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

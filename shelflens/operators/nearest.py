"""Best matches of sets, vectors and factors that leave out pairs which can't be among them."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running, saved
from .rank import top_k

EPS = 1e-9
#: Pairs beyond which joins on common dimensions give way to sums over blocks, whose lists are the same.
PLAIN_PAIRS = 200_000_000
#: Vectors of a block that are asked for at once, and of a piece that they meet at once, at most; entries that all blocks take, about.
BLOCK, PIECE, TAKEN = 16_384, 65_536, 30_000_000


class _Lists:
    """The `k` best others of each vector of a block, as far as pieces have been met. Entries are sorted by vector."""

    def __init__(self, n: np.ndarray, dim: np.ndarray, w: np.ndarray, k: int, least: float, sets: bool):
        order = np.lexsort((dim, n))
        self.dim, self.w, self.k, self.sets = dim[order], w[order], k, sets
        self.n, first = np.unique(n[order], return_index=True)
        self.starts = np.append(first, len(n)).tolist()
        none = (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.found, self.floor = [none] * len(self.n), [least] * len(self.n)

    def meet(self, n: np.ndarray, dim: np.ndarray, w: np.ndarray, many: np.ndarray, apart: bool) -> None:
        """Takes a piece, its entries sorted by dimension; `apart`: a vector isn't its own neighbour."""
        names, at = np.unique(n, return_inverse=True)
        dims, first = np.unique(dim, return_index=True)
        ends = np.append(first[1:], len(dim))
        place = np.minimum(np.searchsorted(dims, self.dim), len(dims) - 1)
        known = dims[place] == self.dim
        a, b = np.where(known, first[place], 0).tolist(), np.where(known, ends[place], 0).tolist()
        own = np.minimum(np.searchsorted(names, self.n), len(names) - 1)
        own = np.where((names[own] == self.n) & apart, own, -1).tolist()
        told = np.zeros(len(names), np.int64)
        told[at] = many
        counts = np.int16 if len(self.dim) < 1 << 15 or np.diff(self.starts).max() < 1 << 15 else np.int32
        sums, size = np.zeros(len(names), counts if self.sets else np.float64), np.zeros(len(names))
        if self.sets:
            size[at] = w
        weights = self.w.tolist()
        for i in range(len(self.n)):
            for j in range(self.starts[i], self.starts[i + 1]):
                if a[j] < b[j]:
                    if self.sets:
                        sums[at[a[j] : b[j]]] += 1
                    else:
                        sums[at[a[j] : b[j]]] += weights[j] * w[a[j] : b[j]]
            if own[i] >= 0:
                sums[own[i]] = 0
            if not self.sets:
                # the k best of a short list tell what all others have to reach
                short = min(((b[j] - a[j], a[j]) for j in range(self.starts[i], self.starts[i + 1]) if b[j] - a[j] > self.k), default=(0, 0))
                if short[0]:
                    some = sums[at[short[1] : short[1] + short[0]]]
                    self._reach(i, np.partition(some, len(some) - self.k)[len(some) - self.k])
                near = np.flatnonzero(sums > self.floor[i])
                if len(near):
                    self._keep(i, sums[near], names[near], told[near])
            else:
                mine, most = weights[self.starts[i]], int(sums.max())
                score = lambda x, m=mine: sums[x] / (m + size[x] - sums[x])
                if most >= max(ceil(self.floor[i] * mine - EPS), 1):
                    near = np.flatnonzero(sums == most)  # these tell what the others have to reach
                    self._keep(i, score(near), names[near], told[near])
                    common = max(ceil(self.floor[i] * mine - EPS), 1)
                    if common < most:
                        near = np.flatnonzero((sums >= common) & (sums < most))
                        self._keep(i, score(near), names[near], told[near])
            sums.fill(0)

    def _reach(self, i: int, score: float) -> None:
        """From now on scores have to be as much in nine places."""
        self.floor[i] = max(self.floor[i], (np.floor(score * 1e9 + 0.5) - 0.5) / 1e9 - 1e-15)

    def _keep(self, i: int, scores: np.ndarray, names: np.ndarray, many: np.ndarray) -> None:
        """By scores of nine places, ties by the least name; of those only as many as stand for `k` + 1 vectors."""
        good = scores > self.floor[i]
        s, o, m = (np.concatenate((x, y[good])) for x, y in zip(self.found[i], (scores, names, many), strict=True))
        if len(s) > self.k:
            near = s >= np.partition(s, len(s) - self.k)[len(s) - self.k] - 2 * EPS
            s, o, m = s[near], o[near], m[near]
        places = np.floor(s * 1e9 + 0.5)
        best = np.lexsort((o, -places))[: self.k]
        s, o, m, places = s[best], o[best], m[best], places[best]
        full = np.flatnonzero(np.cumsum(m) > self.k)
        last = full[0] if len(full) else self.k - 1
        if last < len(s):
            kept = places >= places[last]
            self._reach(i, places[last] / 1e9)
            s, o, m = s[kept], o[kept], m[kept]
        self.found[i] = (s, o, m)

    def told(self) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(x[0]) for x in self.found)])
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([x[c] for x in self.found]))) for c in (1, 0)]
        return pa.RecordBatch.from_arrays([pa.array(self.n, pa.int64()), *lists], ["n", "others", "scores"])


def _meet(k: int, least: float, sets: bool, apart: bool):
    """Over rows sorted by _q, _c and dim: the lists of each block _q, whose own entries have the _c -1, from its pieces _c."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, kept = None, []
        for batch in batches:
            told = [batch[c].to_numpy() for c in ("_q", "_c", "n", "dim", "w", "many")]
            if not len(told[0]):
                continue
            edges = np.flatnonzero((np.diff(told[0]) != 0) | (np.diff(told[1]) != 0)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(told[0])], strict=True):
                here = (int(told[0][i]), int(told[1][i]))
                if kept and here != key:
                    yield *key, *(np.concatenate(x) for x in zip(*kept, strict=True))
                    kept = []
                key = here
                kept.append([x[i:j] for x in told[2:]])
        if kept:
            yield *key, *(np.concatenate(x) for x in zip(*kept, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None
        for _, piece, n, dim, w, many in whole(batches):
            if piece < 0:
                if lists:
                    yield lists.told()
                lists = _Lists(n, dim, w, k, least, sets)
            else:
                lists.meet(n, dim, w, many, apart)
        if lists:
            yield lists.told()

    return run


def _blocked(own: DataFrame, other: DataFrame, k: int, least: float, sets: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """id, other, score: for each vector of `own` (id, dim, w) the `k` best of `other` by product above `least`; ties of nine places by the least other.

    With `sets` dims are members, w is a set's size and the score is the Jaccard similarity. With `counts` (id, many) a
    vector of `other` stands for as many equal ones, and lists end where those kept stand for over `k`. Without `sets`
    `own` is `other`, and a vector isn't its own neighbour.

    Vectors are dealt out in blocks, in the order of their least dimension. A block takes the entries of its dimensions, a
    piece of the vectors at a time, adds the products up in arrays and keeps its lists alone: every pair that has a
    dimension in common is worked out, none is written. A task holds a block's lists and a piece's entries.
    """
    dims = saved(other.select("dim").distinct().withColumn("_dim", F.monotonically_increasing_id()), "dims")

    def placed(df: DataFrame) -> DataFrame:
        """_spot: places in the order of the least dimension; n: numbers in the order of the ids."""
        first = running(df.groupBy("id").agg(F.min("dim").alias("_least")), [], [F.col("_least"), F.col("id")], []).select("id", (F.col("_place") - 1).alias("_spot"))
        if dict(df.dtypes)["id"] in ("int", "bigint"):
            return saved(first.withColumn("n", F.col("id").cast("long")), "places")
        return saved(running(first, [], [F.col("id")], []).select("id", "_spot", F.col("_place").alias("n")), "places")

    theirs = placed(other)
    ours = placed(own) if sets else theirs
    entries = saved(other.join(dims, "dim").join(theirs, "id").join(counts if counts is not None else theirs.select("id", F.lit(1).alias("many")), "id").select("n", F.floor(F.col("_spot") / PIECE).cast("int").alias("_c"), F.col("_dim").alias("dim"), F.col("w").cast("double").alias("w"), F.col("many").cast("long").alias("many")), "entries")
    asked, taken = ours.count(), max(entries.count(), 1)
    blocks = max(ceil(asked / BLOCK), min(48, max(8, TAKEN // taken), asked), 1)
    each = ceil(asked / blocks)
    queries = own.join(dims, "dim").join(ours, "id").select(F.floor(F.col("_spot") / each).cast("int").alias("_q"), "n", F.col("_dim").alias("dim"), F.col("w").cast("double").alias("w"))
    queries = saved(queries, "queries")
    met = queries.select("_q", "dim").distinct().join(entries, "dim").select("_q", "_c", "n", "dim", "w", "many")
    rows = met.unionByName(queries.select("_q", F.lit(-1).alias("_c"), "n", "dim", "w", F.lit(1).cast("long").alias("many")))
    rows = rows.repartitionById(blocks, F.col("_q")).sortWithinPartitions("_q", "_c", "dim", "n")
    found = rows.mapInArrow(_meet(k, least, sets, not sets), "n long, others array<long>, scores array<double>")
    flat = found.select("n", F.explode(F.arrays_zip("others", "scores")).alias("_x")).select("n", F.col("_x.others").alias("_o"), F.col("_x.scores").alias("score"))
    if {dict(df.dtypes)["id"] for df in (own, other)} <= {"int", "bigint"}:
        return flat.select(F.col("n").cast(dict(own.dtypes)["id"]).alias("id"), F.col("_o").cast(dict(other.dtypes)["id"]).alias("other"), "score")
    named = theirs.select(F.col("id").alias("other"), F.col("n").alias("_o"))
    return flat.join(ours.select("id", "n"), "n").join(named, "_o").select("id", "other", "score")


def rare_first(sets: DataFrame, tokens: str, counts: DataFrame) -> DataFrame:
    """id, set of `sets` (id, tokens), its tokens ordered by how many sets of `counts` (token, n) hold them, the rarest first."""
    rows = sets.select("id", F.explode(F.array_distinct(tokens)).alias("token")).join(counts, "token", "left")
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))), lambda x: x["token"]).alias("set"))


def _size_class(n: Column) -> Column:
    """The least size of a set's class: sizes up to 16 by themselves, larger ones by fifths of a power of 2."""
    return F.when(n <= 16, n).otherwise(F.ceil(F.pow(F.lit(2.0), F.floor(F.log2(n) * 5) / 5))).cast("int")


def set_candidates(own: DataFrame, other: DataFrame, least: float) -> DataFrame:
    """own, other, a, b: pairs of sets that may have a Jaccard similarity of `least` or more.

    Sets of m and n tokens that do have least / (1 + least) * (m + n) = c tokens in common, so one of the first m - c + 1
    of the one is among the first n - c + 1 of the other, and they differ little in size. A pair is taken at the first
    token that both have there.
    """
    sizes = other.select(_size_class(F.size("set")).alias("_theirs")).distinct()
    kinds = own.select(_size_class(F.size("set")).alias("_ours")).distinct().crossJoin(sizes)  # some 5 for each doubling of the sizes
    common = F.greatest(F.ceil(least / (1 + least) * (F.col("_ours") + F.col("_theirs")) - EPS), F.lit(1)).cast("int")
    kinds = F.broadcast(kinds.withColumn("_c", common))

    def heads(df: DataFrame, kind: str, name: str, told: str) -> DataFrame:
        rows = df.select(F.col("id").alias(name), F.col("set").alias(told), _size_class(F.size("set")).alias(kind)).join(kinds, kind)
        rows = rows.withColumn(f"_{told}", F.slice(told, 1, F.greatest(F.size(told) - F.col("_c") + 1, F.lit(0))))
        return rows.drop("_c").withColumn("token", F.explode(f"_{told}"))

    parts = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x, y = heads(own, "_ours", "own", "a").repartition(parts, "own"), heads(other, "_theirs", "other", "b")
    near = (F.size("b") >= least * F.size("a") - EPS) & (F.size("a") >= least * F.size("b") - EPS)
    pairs = x.join(y, ["_ours", "_theirs", "token"]).where(near)
    return pairs.where(F.get(F.array_intersect("_a", "_b"), F.lit(0)) == F.col("token")).select("own", "other", "a", "b")


def best_set_matches(own: DataFrame, other: DataFrame, tokens: str, steps: tuple[float, ...] = (0.9, 0.75, 0.6, 0.45, 0.3, 0.15)) -> DataFrame:
    """own, other, score: for each own set (id, tokens) the other one of greatest Jaccard similarity above 0; ties by the least other id.

    Equal sets are matched once, under the least id that has them, so copies cost a row each; a set that stands on both
    sides is found by a join. For the others the similarity asked for falls step by step, and only own sets without a
    match at one step go on to the next, so common tokens are joined for those sets alone that have nothing rarer in
    common with any. Where tokens are so common that they make over PLAIN_PAIRS pairs, all pairs are worked out in blocks.
    """
    counts = saved(other.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("n")), "tokens")
    sets = saved(rare_first(own, tokens, counts), "sets")
    x, y = (saved(s.groupBy("set").agg(F.min("id").alias("id")), "distinct-sets") for s in (sets, rare_first(other, tokens, counts)))
    named = sets.join(x.withColumnRenamed("id", "_first"), "set").select("id", "_first")
    found = saved(x.join(y.withColumnRenamed("id", "other"), "set").select(F.col("id").alias("own"), "other", F.lit(1.0).alias("score")), "matches")
    x = saved(x.join(found.select(F.col("own").alias("id")), "id", "left_anti"), "other-sets")
    told = lambda df: df.select("id", F.explode("set").alias("dim"), F.size("set").alias("w"))
    if _meetings(told(x), told(y)) > PLAIN_PAIRS:
        met = _blocked(told(x), told(y), 1, EPS, True)
        return _for_equal(named, found.unionByName(met.withColumnRenamed("id", "own")))
    for least in (*steps, 0.0):
        score = F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
        pairs = set_candidates(x, y, max(least, EPS)).select("own", "other", score.alias("score")).where(F.col("score") >= max(least - EPS, EPS))
        best = saved(top_k(pairs, ["own"], [F.round("score", 9).desc(), F.col("other")], 1).drop("rank"), "matches")
        found = found.unionByName(best)
        x = x.join(best.select(F.col("own").alias("id")), "id", "left_anti")
    return _for_equal(named, found)


def _for_equal(named: DataFrame, found: DataFrame) -> DataFrame:
    return named.join(found.withColumnRenamed("own", "_first"), "_first").select(F.col("id").alias("own"), "other", "score")


def _heads(vectors: DataFrame, least: float) -> DataFrame:
    """id, dim: the leading entries of unit vectors (id, entries by dimension, the rarest first) without which less than `least` of their length is left."""
    rows = vectors.select("id", F.posexplode("entries").alias("_i", "e"))
    if least <= EPS:
        return rows.select("id", F.col("e.dim").alias("dim"))
    rest = Window.partitionBy("id").orderBy(F.col("_i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    left = F.sum(F.col("e.w") * F.col("e.w")).over(rest)
    return rows.select("id", F.col("e.dim").alias("dim"), left.alias("_left")).where(F.col("_left") >= (least - EPS) * (least - EPS)).select("id", "dim")


def cosine_candidates(own: DataFrame, other: DataFrame, least: float) -> DataFrame:
    """id, other: pairs of unit vectors whose product may reach `least`: they share a dimension among the leading entries of both."""
    return _heads(own, least).join(_heads(other, least).withColumnRenamed("id", "other"), "dim").where("id <> other").select("id", "other").distinct()


def equal_vectors(rows: DataFrame) -> DataFrame:
    """id, first: for each vector of `rows` (id, dim, w) the least id of those equal to it, its own included."""
    vectors = saved(rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dim", "w"))).alias("_entries")), "vectors")
    firsts = vectors.groupBy("_entries").agg(F.min("id").alias("first"))
    return saved(vectors.join(firsts, "_entries").select("id", "first"), "equal-vectors")


def _for_each(found: DataFrame, equal: DataFrame, k: int) -> DataFrame:
    """id, other, score, rank of every vector of `equal` (id, first), from the `k` nearest (id, other, score) of each first one.

    Equal vectors are nearest of all, at 1. Of those that are equal only the first k + 1 can be in a list, so a list of
    k + 1 is made for each of the different vectors, and each vector takes it without itself.
    """
    ranked = top_k(equal, ["first"], [F.col("id")], k + 1, "_place").select(F.col("first").alias("_other"), F.col("id").alias("other"))
    several = equal.groupBy("first").count().where("count > 1").select(F.col("first").alias("id"), F.col("first").alias("_other"), F.lit(1.0).alias("score"))
    near = found.select("id", F.col("other").alias("_other"), "score").unionByName(several).join(ranked, "_other")
    best = top_k(near, ["id"], [F.round("score", 9).desc(), F.col("other")], k + 1)
    lists = saved(best.groupBy(F.col("id").alias("first")).agg(F.array_sort(F.collect_list(F.struct("rank", "other", "score"))).alias("_list")), "lists")
    own = equal.join(lists, "first").select("id", F.slice(F.filter("_list", lambda x: x["other"] != F.col("id")), 1, k).alias("_list"))
    return own.select("id", F.posexplode("_list").alias("_i", "x")).select("id", "x.other", "x.score", (F.col("_i") + 1).alias("rank"))


def _unit(rows: DataFrame) -> DataFrame:
    norms = rows.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return rows.join(norms, "id").select("id", "dim", (F.col("w") / F.col("_norm")).alias("w"))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    return top_k(pairs, ["id"], [F.round("score", 9).desc(), F.col("other")], k)


def _joined(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """id, other, score of all pairs of unit vectors (id, dim, w) above `least`, through the dimensions of both."""
    pairs = a.join(b.withColumnsRenamed({"id": "other", "w": "_w"}), "dim").where("id <> other")
    return pairs.groupBy("id", "other").agg(F.sum(F.col("w") * F.col("_w")).alias("score")).where(F.col("score") > least)


def _plain(unit: DataFrame, k: int, least: float) -> DataFrame:
    """Each pair is worked out once and written both ways."""
    pairs = unit.join(unit.withColumnsRenamed({"id": "other", "w": "_w"}), "dim").where("id < other").groupBy("id", "other").agg(F.sum(F.col("w") * F.col("_w")).alias("score")).where(F.col("score") > least)
    ways = F.explode(F.array(F.struct("id", "other"), F.struct(F.col("other").alias("id"), F.col("id").alias("other"))))
    return _best(pairs.select(ways.alias("_p"), "score").select("_p.id", "_p.other", "score"), k)


def _meetings(a: DataFrame, b: DataFrame) -> float:
    """How many rows a join of `a` and `b` on dim makes."""
    n = lambda df, c: df.groupBy("dim").agg(F.count("*").cast("double").alias(c))
    return n(a, "_a").join(n(b, "_b"), "dim").agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0.0))).first()[0]


def _pruned(unit: DataFrame, k: int, least: float, steps: tuple[float, ...]) -> DataFrame:
    held = unit.groupBy("dim").agg(F.count("*").alias("_n"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("_n", "dim", "w"))), lambda e: F.struct(e["dim"].alias("dim"), e["w"].alias("w")))
    vectors = saved(unit.join(held, "dim").groupBy("id").agg(entries.alias("entries")), "vectors")
    length = vectors.agg(F.coalesce(F.avg(F.size("entries")), F.lit(0.0))).first()[0]
    open_, found = vectors, None
    for t in (*[s for s in steps if s > least], least):
        # a score of a candidate looks each entry up among the other's; a plain join meets only what both have
        laid = open_.select("id", F.explode("entries").alias("_e")).select("id", "_e.dim", "_e.w")
        if _meetings(laid, unit) <= _meetings(_heads(open_, t), _heads(vectors, t)) * (1 + length * length / 64):
            rest = saved(_best(_joined(laid, unit, least), k), "neighbours")
            return rest if found is None else found.unionByName(rest)
        pairs = cosine_candidates(open_, vectors, t)
        both = pairs.join(vectors.withColumnRenamed("entries", "a"), "id").join(vectors.select(F.col("id").alias("other"), F.map_from_entries("entries").alias("b")), "other")
        score = F.aggregate("a", F.lit(0.0), lambda acc, e: acc + e["w"] * F.coalesce(F.element_at("b", e["dim"]), F.lit(0.0)))
        near = both.select("id", "other", score.alias("score")).where(F.col("score") >= t - EPS if t > least else F.col("score") > t)
        best = saved(_best(near, k), "neighbours")
        if t > least:
            whole = best.where(F.col("rank") == k).select("id")
            open_, best = open_.join(whole, "id", "left_anti"), best.join(whole, "id", "left_semi")
        found = best if found is None else found.unionByName(best)
    return found


def pruned_cosine(rows: DataFrame, k: int, least: float = 0.0, steps: tuple[float, ...] = (0.8, 0.6, 0.4, 0.2)) -> DataFrame:
    """id, other, score, rank: the `k` vectors of greatest cosine above `least` for each vector of `rows` (id, dim, w); ties by the least other.

    Dimensions are ordered by how many vectors hold them. Of a pair whose product is t or more both have a common
    dimension before the rest of either is shorter than t; so common dimensions, which come last, are joined only for
    vectors whose `k` neighbours weren't found at a greater t. Each step goes on with the vectors that have fewer, and
    joins what is left plainly once that takes less work. Equal vectors are one in all this.
    """
    equal, unit = _different(rows)
    return _for_each(_pruned(unit, k, least, steps).select("id", "other", "score"), equal, k)


def _different(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """equal_vectors of the rows, and the different vectors at length 1."""
    equal = equal_vectors(rows)
    return equal, saved(_unit(rows.join(equal.where("id = first").select("id"), "id", "left_semi")), "unit")


def cosine_lists(rows: DataFrame, k: int, least: float = 0.0, plain: int | None = None) -> DataFrame:
    """The same lists, through a plain self-join of the different vectors where that makes at most `plain` (PLAIN_PAIRS) pairs, in blocks where it makes more."""
    equal, unit = _different(rows)
    if most_pairs(unit) <= (PLAIN_PAIRS if plain is None else plain):
        found = _plain(unit, k, least)
    else:
        found = _blocked(unit, unit, k, least, counts=equal.groupBy(F.col("first").alias("id")).agg(F.count("*").alias("many")))
    return _for_each(found.select("id", "other", "score"), equal, k)


PRODUCTS = "id long, factors array<double>, items array<long>, scores array<double>, products long"


def _score(block: list[tuple[int, list[float]]], k: int):
    ids = np.array([b[0] for b in block], np.int64)
    matrix = np.array([b[1] for b in block], np.float64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            items, scores = [], []
            for factors, had, got in zip(df["factors"], df["items"], df["scores"], strict=True):
                s, i = np.concatenate((np.asarray(got, np.float64), matrix @ np.asarray(factors))), np.concatenate((np.asarray(had, np.int64), ids))
                if len(s) > k:
                    near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                    s, i = s[near], i[near]
                best = np.lexsort((i, -s))[:k]
                items.append(i[best])
                scores.append(s[best])
            yield df.assign(items=items, scores=scores, products=df["products"] + len(ids))

    return run


def top_products(users: DataFrame, items: DataFrame, k: int, block: int = 1 << 16) -> DataFrame:
    """id, item, score, rank, products: for each user (id, factors) the `k` items (id, factors) of greatest inner product, ties by the least item.

    Items are taken in blocks, the longest vectors first. A product is at most the lengths' product, so a user whose
    kth best exceeds what the next block's longest item could reach is done; `products` is how many were worked out.
    A block of `block` items at a time goes through the driver to the tasks.
    """
    length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))
    plain = lambda df: df.select("id", F.col("factors").cast("array<double>").alias("factors"))
    ranked = running(plain(items).withColumn("_norm", length(F.col("factors"))), [], [F.col("_norm").desc(), F.col("id")], [])
    ranked = saved(ranked.withColumn("_block", F.floor((F.col("_place") - 1) / block)), "blocks")
    longest = {r["_block"]: r["n"] for r in ranked.groupBy("_block").agg(F.max("_norm").alias("n")).collect()}
    empty = lambda t: F.array().cast(t)
    open_ = plain(users).select("id", "factors", empty("array<long>").alias("items"), empty("array<double>").alias("scores"), F.lit(0).cast("long").alias("products"))
    found = open_.where("false")
    for b in sorted(longest):
        rows = [(r["id"], r["factors"]) for r in ranked.where(F.col("_block") == b).collect()]
        open_ = saved(open_.mapInPandas(_score(rows, k), PRODUCTS), "products")
        reach = length(F.col("factors")) * longest.get(b + 1, 0.0) * (1 + EPS)
        # beyond the last block nothing is left
        done = (F.size("scores") == k) & (F.element_at("scores", -1) > reach) if b + 1 in longest else F.lit(True)
        found, open_ = found.unionByName(open_.where(done)), open_.where(~done)
        if b + 1 in longest and open_.isEmpty():
            break
    told = found.select("id", "products", F.posexplode(F.arrays_zip("items", "scores")).alias("_i", "x"))
    return told.select("id", F.col("x.items").alias("item"), F.col("x.scores").alias("score"), (F.col("_i") + 1).alias("rank"), "products")


def nearest_items(vectors: DataFrame, k: int, block: int = 1 << 16) -> DataFrame:
    """id, item, score, rank: the `k` other vectors (id, factors) of greatest cosine for each; vectors of length 0 take no part."""
    plain = vectors.select("id", F.col("factors").cast("array<double>").alias("factors")).withColumn("_l", F.sqrt(F.aggregate("factors", F.lit(0.0), lambda acc, x: acc + x * x)))
    unit = saved(plain.where("_l > 0").select("id", F.transform("factors", lambda x: x / F.col("_l")).alias("factors")), "unit")
    found = top_products(unit, unit, k + 1, block).where("id <> item").select("id", "item", "score")  # itself is among the first, or others are as near
    return top_k(found, ["id"], [F.col("score").desc(), F.col("item")], k)


def most_pairs(rows: DataFrame, dim: str = "dim") -> int:
    """How many pairs a plain self-join of `rows` on a dimension would make."""
    n = F.col("n").cast("double")
    return int(rows.groupBy(dim).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))).first()[0])

"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree is a sorted array of long hash strings, a bit for the side of each of its random hyperplanes. A query
descends in every tree to the entries with the longest common prefix and then all trees ascend together, a bit at a
time, until the matches reach the number asked for; these are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save


@dataclass(frozen=True)
class Params:
    trees: int = 48
    bits: int = 32
    #: Matches to reach, as a share of a shard's rows, counted in each tree. Vectors without structure, such as the test
    #: tables', need this many for a recall above 0.9; for clustered ones a tenth does.
    share: float = 0.7
    rows: int = 20_000  #: of a shard of the index
    queries: int = 2_000  #: compared with a shard at a time
    seed: int = 3


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, size)


def hash_strings(x: np.ndarray, p: Params) -> np.ndarray:
    """Trees x rows: the bits of the sides, the first one highest."""
    planes = np.random.default_rng([p.seed, x.shape[1]]).standard_normal((p.trees, x.shape[1], p.bits))
    weight = 1 << np.arange(p.bits - 1, -1, -1, dtype=np.int64)
    return np.stack([(x @ plane > 0) @ weight for plane in planes])


class Forest:
    def __init__(self, x: np.ndarray, p: Params):
        self.p, codes = p, hash_strings(x, p)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=1)

    def candidates(self, queries: np.ndarray, need: int) -> Iterator[np.ndarray]:
        """Rows found for each query; all of them if even the roots hold fewer than `need`."""
        p, codes = self.p, hash_strings(queries, self.p)
        n = len(queries)
        low, high = np.zeros((p.trees, n), np.int64), np.zeros((p.trees, n), np.int64)
        open_ = np.arange(n)
        for depth in range(p.bits, -1, -1):  # synchronous ascent
            rest = p.bits - depth
            for t in range(p.trees):
                first = (codes[t, open_] >> rest) << rest
                low[t, open_] = np.searchsorted(self.codes[t], first)
                high[t, open_] = np.searchsorted(self.codes[t], first + (1 << rest))
            open_ = open_[(high[:, open_] - low[:, open_]).sum(0) < need]
            if not len(open_):
                break
        for i in range(n):
            found = np.zeros(self.order.shape[1], bool)
            for t in range(p.trees):
                found[self.order[t, low[t, i] : high[t, i]]] = True
            yield np.flatnonzero(found)


def cosine(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, each row summed in the same way."""
    return (rows * query).sum(1) / (np.sqrt((rows * rows).sum(1)) * math.sqrt((query * query).sum()))


class Shard:
    """The vectors of a shard and their forest."""

    def __init__(self, rows: pa.Table, size: int, p: Params):
        ids = rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.size, self.p = ids[order], _matrix(rows["embedding"].combine_chunks(), size)[order], size, p
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.forest = Forest(self.x / self.norm[:, None], p)

    def nearest(self, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
        ids, x, norm, p, out = self.ids, self.x, self.norm, self.p, []
        need = min(len(x) * p.trees, max(4 * k, math.ceil(p.share * len(x))))
        q = _matrix(asked["embedding"], self.size)
        q_norm = q / np.sqrt((q * q).sum(1))[:, None]
        for query, unit, me, row, times, found in zip(q, q_norm, *(asked[c].to_pylist() for c in ("vec_id", "row", "times")), self.forest.candidates(q_norm, need), strict=True):
            found = found[ids[found] != me]
            if len(found) < k:  # few rows, or many copies of the query
                found = np.flatnonzero(ids != me)
            near = (x[found] @ unit) / norm[found]
            if len(near) > k:
                found = found[near >= np.partition(near, -k)[-k] - 1e-9]
            exact = cosine(x[found], query)
            for i in np.lexsort((ids[found], -exact))[:k]:
                out.append((me, row, times, int(ids[found[i]]), float(exact[i])))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["query_id", "row", "times", "vec_id", "score"])


def _search(k: int, p: Params):
    """Over rows sorted by shard and size, the index's vectors before the queries: a forest is built once and the queries stream past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in batches:
            marks = np.stack([batch[c].to_numpy() for c in ("shard", "size", "kind")])
            edges = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if key != (now := (int(marks[0, a]), int(marks[1, a]))):
                    key, held, shard = now, [], None
                if marks[2, a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if shard is None and held:
                    shard, held = Shard(pa.Table.from_batches(held), key[1], p), []
                for at in range(a, b if shard else a, p.queries):
                    yield shard.nearest(batch.slice(at, min(p.queries, b - at)), k)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine found for each row of `queries`, ties to the smaller vec_id.

    Both tables hold vec_id and embedding. Rows with a null vec_id, or a vector that is null, zero or holds null or
    non-finite components, take no part; vectors are compared with those of their length. A repeated row stands in the
    result once for each time. An empty table gives an empty result. The index lies in shards of some `rows` vectors,
    each with one forest; every query is sent to every shard and streams past its forest, so a task holds a shard and a
    few queries. Repeated queries are searched once.
    """

    def clean(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("size", F.size("embedding"))

    index = clean(vectors)
    asked = clean(queries).groupBy("vec_id", "embedding", "size").agg(F.count("*").alias("times")).withColumn("row", F.xxhash64("vec_id", "embedding"))
    shards = max(1, math.ceil(index.count() / p.rows))
    columns = ["shard", "size", "kind", "vec_id", "embedding", "row", "times"]
    none = F.lit(None).cast("long")
    placed = index.select(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int").alias("shard"), "size", F.lit(0).alias("kind"), "vec_id", "embedding", none.alias("row"), none.alias("times"))
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "size", F.lit(1).alias("kind"), "vec_id", "embedding", "row", "times")
    dealt = placed.unionByName(sent).select(*columns).repartition("shard", "size").sortWithinPartitions("shard", "size", "kind")
    found = dealt.mapInArrow(_search(k, p), "query_id long, row long, times long, vec_id long, score double")
    order = Window.partitionBy("query_id", "row").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("query_id", "rank", "vec_id", "score")


def op8_prefix_forest(embeddings: DataFrame) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50. Nulls, odd vectors, ties and repeated rows are as in `nearest`; other columns are not read."""
    return save(nearest(embeddings, embeddings.where("vec_id % 50 = 0")), "neighbours")

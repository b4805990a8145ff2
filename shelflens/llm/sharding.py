"""Sharding by a two-pass external shuffle.

Pass one scatters rows over buckets by a seeded hash, enough buckets that each fits in a worker's memory. Pass two
puts each bucket in a fixed order, shuffles it by Fisher-Yates under its own seed and writes it. The buckets one after
the other are the shuffled table; it is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, scratch_path, tucked


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    order = list(range(n))
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def row_size(text: Column) -> Column:
    """UTF-8 bytes (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _place(pos: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a position: the first `rows % shards` shards have one row more."""
    base, more = divmod(rows, shards)
    cut = more * (base + 1)
    size = F.when(pos < cut, F.lit(base + 1)).otherwise(F.lit(max(base, 1)))
    past = F.when(pos < cut, pos).otherwise(pos - cut)
    shard = F.floor(past / size)  # positions stay far below 2^53
    return (shard + F.when(pos < cut, 0).otherwise(more)).cast("int"), (past - shard * size).cast("long")


def _shuffled(seed: int, fields: list[str]):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_order", "ascending"), ("_tie", "ascending")])
        order = fisher_yates(rows.num_rows, np.random.default_rng([seed, rows["_bucket"][0].as_py()]))
        return rows.take(pa.array(order)).append_column("_index", pa.array(np.arange(len(order)), pa.int64())).select([*fields, "_index"])

    return run


def external_shuffle(docs: DataFrame, path: str, shards: int = 24, seed: int = 0, bucket_bytes: int = 4 << 20) -> DataFrame:
    """Writes every row of `docs`, all columns kept, as Parquet files under `path`/_shard=n and returns them read back.

    `_shard` and `_slot` (gapless from 0) are added, with one more underscore where `docs` has such a column. The order
    depends on the rows and the seed alone. Rows are told apart by doc_id and text; rows equal in both lie in one bucket
    and may change places, which shows only in other columns. Null doc_ids and texts are values like others. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    stats = docs.agg(F.count("*").alias("n"), F.sum(row_size(F.col("text"))).alias("bytes")).first()
    buckets = max(1, math.ceil((stats["bytes"] or 0) / bucket_bytes))
    inner, at, back = tucked(docs)
    order = F.xxhash64(F.lit(seed), at["doc_id"], at["text"])
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), order), F.lit(buckets)).cast("int")
    scattered = inner.select("*", order.alias("_order"), F.xxhash64(F.lit(seed + 2), at["doc_id"], at["text"]).alias("_tie"), bucket.alias("_bucket"))
    counts = save(inner.groupBy(bucket.alias("_bucket")).count(), "shard-counts")
    offsets = counts.select("_bucket", (F.sum("count").over(Window.orderBy("_bucket")) - F.col("count")).alias("_before"))  # a row a bucket
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)
    mixed = scattered.groupBy("_bucket").applyInArrow(_shuffled(seed, [*inner.columns, "_bucket"]), f"{ddl}, _bucket int, _index long")
    shard, slot = _place(F.col("_before") + F.col("_index"), stats["n"], shards)
    shard_name, slot_name = (next(n for n in (f"{'_' * i}{name}" for i in range(1, len(back) + 3)) if n not in at) for name in ("shard", "slot"))
    placed = mixed.join(offsets, "_bucket").select(*back, shard.alias(shard_name), slot.alias(slot_name))
    placed.write.option("compression", "zstd").partitionBy(shard_name).parquet(path)
    if not stats["n"]:
        return placed
    return spark.read.schema(placed.schema).parquet(path).select(*placed.columns)


def op2_external_shuffle(docs: DataFrame, shards: int = 24) -> DataFrame:
    """What the shard files hold of each document."""
    out = external_shuffle(docs.select("doc_id", "text"), scratch_path(docs.sparkSession, "shards"), shards)
    return out.select(
        "doc_id",
        row_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

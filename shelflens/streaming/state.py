"""Streams with a state of their own for each key, and tables that follow a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.keyed import KeyedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 256  #: entries of the state, whatever the number of keys


class Latest(StatefulProcessor):
    """How often a key was seen, when last and with what, forgotten `lifetime` milliseconds after that.

    A key that comes back after its lifetime starts anew, whether or not the watermark has reached its end before, so
    the counts don't depend on how the stream is cut into batches. The keys of a bucket are one entry of the state with
    one timer, that of the first to end: a batch asks for it once and folds its rows in as columns.
    """

    def __init__(self, keys: list[str], lifetime: int):
        self.keys, self.lifetime = keys, lifetime

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", ", ".join([f"{k} array<string>" for k in self.keys] + ["n array<long>, last_ms array<long>, item array<string>"]))

    def _held(self) -> pd.DataFrame:
        told = self.seen.get() if self.seen.exists() else [[]] * (len(self.keys) + 3)
        held = pd.DataFrame({c: pd.Series(list(x), dtype=object) for c, x in zip([*self.keys, "n", "last_ms", "item"], told, strict=True)})
        return held.astype({"n": "int64", "last_ms": "int64"})

    def _hold(self, before: pd.DataFrame, now: pd.DataFrame) -> None:
        ends = lambda rows: int(rows["last_ms"].min()) + self.lifetime - 1  # noqa: E731  a timer goes off once the watermark is past it
        if len(before):
            self.handle.deleteTimer(ends(before))
        if len(now):
            self.handle.registerTimer(ends(now))
            self.seen.update(tuple(now[c].tolist() for c in [*self.keys, "n", "last_ms", "item"]))
        else:
            self.seen.clear()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, came = self._held(), pd.concat(list(rows), ignore_index=True)
        both = pd.concat([held[self.keys], came[self.keys]], ignore_index=True)
        code = both.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        old, mine, size = code[: len(held)], code[len(held) :], int(code.max()) + 1
        n, last, never = np.zeros(size, np.int64), np.zeros(size, np.int64), np.ones(size, bool)
        n[old], last[old], never[old] = held["n"].to_numpy(), held["last_ms"].to_numpy(), False
        item = np.full(size, None, object)
        item[old] = held["item"].to_numpy()
        order = np.lexsort((pd.factorize(came["item"], sort=True)[0], came["ms"].to_numpy(np.int64), mine))  # a null comes first
        mine, ms, told = mine[order], came["ms"].to_numpy(np.int64)[order], came["item"].to_numpy(object)[order]
        first, final = np.diff(mine, prepend=-1) != 0, np.diff(mine, append=size) != 0
        ahead = np.where(first, last[mine], np.maximum(np.roll(ms, 1), last[mine]))  # when the key was seen before
        anew = np.where(first & never[mine], True, ms - np.where(never[mine] & ~first, np.roll(ms, 1), ahead) >= self.lifetime)
        place = np.arange(len(mine))
        start = np.maximum.accumulate(np.where(first | anew, place, 0))[final]
        changed = mine[final]
        n[changed] = place[final] - start + 1 + np.where(anew[start], 0, n[changed])
        newer = changed[(ms[final] >= last[changed]) | never[changed]]
        at = np.zeros(size, np.int64)
        at[changed] = place[final]
        last[newer], item[newer] = ms[at[newer]], told[at[newer]]
        keys = both.loc[~pd.Series(code).duplicated().to_numpy()].reset_index(drop=True)  # in the order of their codes
        now = keys.assign(n=n, last_ms=last, item=item)
        self._hold(held, now)
        yield now.iloc[changed].assign(expired=False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        over = (held["last_ms"] + self.lifetime <= timerValues.getCurrentWatermarkInMs()).to_numpy()
        self._hold(held[:0], held[~over])
        yield held[over].assign(n=0, last_ms=0, item=None, expired=True)

    def close(self) -> None:
        pass


def latest(rows: DataFrame, keys: list[str], ts: str, lifetime_seconds: int, late: str = "1 minute", item: str | None = None) -> DataFrame:
    """keys, n, last_ms, item, expired of each key that a batch of `rows` changes; `item` is a column's value in the last row, the greatest of several.

    Rows no newer than the watermark are dropped. The state holds the keys last seen less than a lifetime before the
    watermark, a few numbers each; a key that has very many rows is held once.
    """
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    kinds = dict(timed.dtypes)
    inner = [f"k{i}" for i in range(len(keys))]  # as text, which holds a null and any number
    told = timed.select(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("bucket"), *[F.col(k).cast("string").alias(c) for k, c in zip(keys, inner, strict=True)], "_ts", F.unix_millis("_ts").alias("ms"), (F.col(item).cast("string") if item else F.lit(None).cast("string")).alias("item"))
    schema = ", ".join([f"{c} string" for c in inner] + ["n long, last_ms long, item string, expired boolean"])
    found = told.groupBy("bucket").transformWithStateInPandas(Latest(inner, 1000 * lifetime_seconds), schema, "Update", "EventTime")
    return found.select(*[F.col(c).cast(kinds[k]).alias(k) for k, c in zip(keys, inner, strict=True)], "n", "last_ms", "item", "expired")


def view_state(views: DataFrame, lifetime_seconds: int, late: str = "1 minute") -> DataFrame:
    """member, goods, views, last_ms, expired of each pair that a batch of views (member, goods, ts) changes: the map of a member's goods, an entry a pair."""
    return latest(views, ["member", "goods"], "ts", lifetime_seconds, late).select("member", "goods", F.col("n").alias("views"), "last_ms", "expired")


def view_records(routed: DataFrame, cookies: DataFrame) -> DataFrame:
    """key (channel_member_date), record: the message of each view whose member is known: on the web by its cookie."""
    rows = routed.where("route = 'view'").join(cookies.select(F.col("cookie").alias("cookieId"), F.col("member").alias("_known")), "cookieId", "left")
    channel = F.lower("channel")
    member = F.when(channel == "pc", F.col("_known")).otherwise(F.col("memberId"))
    known = channel.isin("pc", "app", "h5") & (member != "") & (F.lower(member) != "null")
    return rows.where(known).select(F.concat_ws("_", channel, member, F.col("eventDate").cast("string")).alias("key"), F.col("value").alias("record"))


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def follow(changes: DataFrame, table: KeyedTable, checkpoint: str, expired: str = "expired") -> list[dict]:
    """Runs a stream over what is there now and keeps `table` at what its changes come to: rows are put in, those with `expired` taken out.

    Each batch is written down before it changes the table, since it is read several times, and takes the place of
    itself when it is run again after a failure: its changes are by key, so twice is once. Returns the progress of the batches.
    """
    spark = changes.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        path = f"{checkpoint}/batches/{batch_id}"
        batch.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        # a pair may end and begin anew in one batch; what it is after it counts
        live = rows.where(~F.col(expired))
        table.delete(rows.where(expired).join(live, table.keys, "left_anti"))
        table.upsert(live.select(*table.schema.names))

    with _rocksdb(spark):
        query = changes.writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/checkpoint").foreachBatch(apply).trigger(availableNow=True).start()
        query.awaitTermination()
    return query.recentProgress


def in_runs(parts: list[DataFrame], path: str, job: Callable[[DataFrame], list[dict]]) -> list[dict]:
    """Puts one part after the other under `path` and lets a job read each as a stream that goes on from the one before."""
    progress = []
    for part in parts:
        part.write.mode("append").parquet(path)
        progress += job(part.sparkSession.readStream.schema(part.schema).parquet(path))
    return progress

"""Sliding windows from panes: an event counts once in its pane, and windows are running sums over panes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import top_k


def pane_counts(stream: DataFrame, ts: str, key: str, slide: int = 4, late: str = "10 minutes") -> DataFrame:
    """key, pane (its start, in seconds), n of every pane that has ended before the watermark: a row for each pane and key with events."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", f"{slide} seconds").alias("w"), key).agg(F.count("*").alias("n")).select(key, F.unix_seconds("w.start").alias("pane"), "n")


def sliding_counts(panes: DataFrame, key: str, size: int = 3600, slide: int = 4) -> DataFrame:
    """key, first_end, last_end, n: events of the windows of `size` seconds that end every `slide` seconds from first_end to last_end.

    A pane is added to the first window that holds it and taken off behind the last one, so a pane makes two changes,
    where laying events out over windows makes size / slide rows of each. A key has as many changes as there are panes
    in time, however many events it has.
    """
    change = lambda at, n: panes.select(key, (F.col("pane") + at).alias("first_end"), n.alias("change"))
    changes = change(slide, F.col("n")).unionByName(change(size + slide, -F.col("n"))).groupBy(key, "first_end").agg(F.sum("change").alias("change"))
    w = Window.partitionBy(key).orderBy("first_end")
    rows = changes.withColumn("n", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("last_end", F.lead("first_end").over(w) - slide)
    return rows.where("n > 0").select(key, "first_end", "last_end", "n")


def busiest(windows: DataFrame, key: str, k: int) -> DataFrame:
    """key, first_end, n, rank of a key's `k` fullest windows; of windows in a row that hold the same events the first."""
    return top_k(windows, [key], [F.col("n").desc(), F.col("first_end")], k).select(key, "first_end", "n", "rank")

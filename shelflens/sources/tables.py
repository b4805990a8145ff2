"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import hash_number

#: Named queries with named parameters; {x} is a DataFrame handed in.
TEMPLATES = {
    "browser": "SELECT member, goods, day FROM {events} WHERE behavior = 1000 AND day >= :since",
    "orders": "SELECT member, goods, qty, amount FROM {orders} WHERE sale_time >= :since",
}


def run_named(spark: SparkSession, name: str, args: dict, **frames: DataFrame) -> DataFrame:
    return spark.sql(TEMPLATES[name], args=args, **frames)


def scan(df: DataFrame, column: str, since: str, on_null: str = "keep") -> DataFrame:
    rows = df.where(F.col(column) >= F.lit(since))
    return rows.dropna(how="any") if on_null == "drop" else rows


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = "\t") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep)


def read_tagged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files of several paths in one scan, each row with the place of its path in the list as `ordinal`."""
    rows = spark.read.option("mergeSchema", "true").parquet(*paths)
    file = F.col("_metadata.file_path")
    tag = F.coalesce(*[F.when(F.endswith(file, F.lit(p)) | F.contains(file, F.lit(p.rstrip("/") + "/")), i) for i, p in enumerate(paths)])
    return rows.withColumn("ordinal", tag)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.json(path, schema=schema)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_jdbc_parts(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """The same over `parts` connections, each with a range of a whole-number column; rows outside of low and high are in the first and last, nulls in the first."""
    return read_jdbc(spark, url, table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def read_wide_rows(df: DataFrame, key: str, parts: list[str], sep: str = "_") -> DataFrame:
    """Key parts as columns; keys with another number of parts are left out."""
    cut = F.split(key, sep)
    return df.where(F.size(cut) == len(parts)).select(*[cut[i].alias(p) for i, p in enumerate(parts)], *[c for c in df.columns if c != key])


def explode_cells(df: DataFrame, key: str, cells: str) -> DataFrame:
    return df.select(key, F.explode(cells).alias("qualifier", "value"))


def write_partition(df: DataFrame, path: str, column: str) -> None:
    """Replaces only the partitions that `df` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(updates, keys, "left_anti").unionByName(updates)


def update_columns(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """An update to null sets null."""
    new = updates.select(*keys, F.struct(*columns).alias("_new"))
    return target.join(new, keys, "left").select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def delete_keys(store: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    return store.join(feed.select(*keys).distinct(), keys, "left_anti")


def with_expiry(df: DataFrame, now: str, seconds: int) -> DataFrame:
    return df.withColumn("expires_at", F.lit(now).cast("timestamp") + F.make_interval(secs=F.lit(seconds)))


def alive(df: DataFrame, now: str) -> DataFrame:
    return df.where(F.col("expires_at") > F.lit(now).cast("timestamp")).drop("expires_at")


def write_text(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited lines; a file for each partition, so coalesce a small result first if it is to be one file."""
    df.write.mode("overwrite").csv(path, sep=sep)


def write_full(df: DataFrame, path: str) -> None:
    """Replaces all that stood there."""
    df.write.mode("overwrite").parquet(path)


def prefixed(channel: Column, key: Column, prefixes: dict) -> Column:
    """A key under its channel's prefix."""
    names = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    return F.concat(names[channel], key.cast("string"))


def valid_ids(df: DataFrame, column: str, length: int, low: int, high: int, number: Column) -> DataFrame:
    """Rows whose id has the given length and whose number lies in a range."""
    return df.where((F.length(column) == length) & number.between(low, high))


def _draw(key: str, seed: int) -> Column:
    return hash_number(F.concat_ws("-", F.lit(seed), F.col(key)))


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    return df.where(_draw(key, seed) < int(fraction * (1 << 32)))


def take_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(_draw(key, seed), key).limit(n)


def count_invalid(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, rows, invalid: rows with a null in any of the columns."""
    missing = F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(missing).alias("invalid"))


def counted(df: DataFrame, invalid: Column) -> tuple[DataFrame, Observation]:
    """`df` as it was, and what an action on it counts on the way: processed and invalid rows."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("processed"), F.count_if(invalid).alias("invalid")), seen


def merge_maps(earlier: DataFrame, later: DataFrame, key: str, column: str) -> DataFrame:
    """The maps of both tables by key; of a map key in both the later value wins."""
    rows = earlier.select(key, F.col(column).alias("_a")).join(later.select(key, F.col(column).alias("_b")), key, "full")
    both = F.map_zip_with("_a", "_b", lambda k, x, y: F.coalesce(y, x))
    return rows.select(key, F.when(F.col("_a").isNull(), F.col("_b")).when(F.col("_b").isNull(), F.col("_a")).otherwise(both).alias(column))


def band_join(rows: DataFrame, bands: DataFrame, key: str, value: str) -> DataFrame:
    """Each row with the bands (key, low, high) of its key that hold its value, the upper end left out."""
    from ..operators.intervals import interval_join

    return interval_join(rows, bands, [key], value)

"""A table laid out by a hash of its key. A change rewrites only the buckets that it alters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from .scratch import scratch_path

BUCKET, LIVE = "_bucket", "_live"


class KeyedTable:
    """Parquet files under `path`, in a folder for each of `buckets` hash buckets of `keys`.

    Every bucket holds a row that marks it, so that one whose last row goes is overwritten too. The list of altered
    buckets, `buckets` numbers at most, is all that comes to the driver. Buckets are replaced one after the other when
    the job commits: after a failure in between the same change, made again, alters the rest. Null keys are a key.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> KeyedTable:
        """Writes the rows, whose keys must differ, in place of whatever was there."""
        self = cls(rows.sparkSession, path, rows.schema, keys, buckets)
        empty = self.spark.range(buckets).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields], F.lit(False).alias(LIVE), F.col("id").cast("int").alias(BUCKET))
        self._write(self._placed(rows).unionByName(empty), path, "static")
        return self

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.select(*self.schema.names, F.lit(True).alias(LIVE), bucket.alias(BUCKET))

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(path)

    def _files(self, path: str) -> DataFrame:
        fields = [StructField(f.name, f.dataType) for f in self.schema.fields]
        return self.spark.read.schema(StructType([*fields, StructField(LIVE, BooleanType()), StructField(BUCKET, IntegerType())])).parquet(path)

    def read(self) -> DataFrame:
        return self._files(self.path).where(LIVE).select(*self.schema.names)

    def _on(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in self.keys])

    def _numbers(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(BUCKET).distinct().collect()]

    def _replace(self, changed: DataFrame, gone: DataFrame) -> list[int]:
        """Puts `changed` (placed rows) in place of the rows with the keys of `gone` in the buckets of both."""
        touched = self._numbers(changed.select(BUCKET).union(gone.select(BUCKET)))
        if touched:
            old = self._files(self.path).where(F.col(BUCKET).isin(touched))
            kept = old.where(~F.col(LIVE)).unionByName(old.where(LIVE).join(gone, self._on(old, gone), "left_anti"))
            staged = scratch_path(self.spark, "keyed")
            self._write(kept.unionByName(changed), staged, "static")
            self._write(self._files(staged), self.path, "dynamic")
        return sorted(touched)

    def _saved(self, rows: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "keyed-changes")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def upsert(self, updates: DataFrame, latest: str | None = None) -> list[int]:
        """Adds rows and replaces those of the same key; the altered buckets. Of updates with one key the greatest `latest` counts.

        Rows that stand there already alter nothing, so the same upsert again writes nothing.
        """
        if latest:
            order = Window.partitionBy(*self.keys).orderBy(F.col(latest).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in self.schema.names if c not in (*self.keys, latest)])
            updates = updates.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
        new = self._saved(self._placed(updates))
        old = self._files(self.path).where(F.col(LIVE) & F.col(BUCKET).isin(self._numbers(new)))
        same = reduce(Column.__and__, [new[c].eqNullSafe(old[c]) for c in self.schema.names])
        changed = self._saved(new.join(old, self._on(new, old) & same, "left_anti"))
        return self._replace(changed, changed)

    def update(self, updates: DataFrame, columns: list[str]) -> list[int]:
        """Sets `columns` of the rows whose keys `updates` has; other keys are left out."""
        new = updates.select(*[F.col(k).alias(f"_{k}") for k in self.keys], *[F.col(c).alias(f"_new_{c}") for c in columns])
        old = self.read()
        on = reduce(Column.__and__, [old[k].eqNullSafe(new[f"_{k}"]) for k in self.keys])
        return self.upsert(old.join(new, on).select(*[new[f"_new_{c}"].alias(c) if c in columns else old[c] for c in self.schema.names]))

    def delete(self, keys: DataFrame) -> list[int]:
        """Removes the rows whose keys `keys` has; the altered buckets."""
        asked = keys.select(*self.keys).distinct().withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        old = self._files(self.path).where(LIVE)
        gone = self._saved(old.join(asked, self._on(old, asked), "left_semi"))
        return self._replace(gone.where("false"), gone)

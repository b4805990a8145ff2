"""Results as the texts and keyed tables that services read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running


def nested_list(df: DataFrame, by: list[str], group: str, item: str, newest: str, name: str = "items") -> DataFrame:
    """`group:item,item#group:item`: a key's items, newest first within a group, and groups by their newest item."""
    last = df.groupBy(*by, group, item).agg(F.max(newest).alias("_seen"))
    listed = last.groupBy(*by, group).agg(F.max("_seen").alias("_last"), F.expr(f"listagg(cast({item} AS string), ',') WITHIN GROUP (ORDER BY _seen DESC, {item})").alias("_items"))
    text = listed.withColumn("_text", F.concat_ws(":", F.col(group).cast("string"), "_items"))
    return text.groupBy(*by).agg(F.expr(f"listagg(_text, '#') WITHIN GROUP (ORDER BY _last DESC, {group})").alias(name))


def scored_list(df: DataFrame, by: list[str], item: str, score: str, digits: int = 4, name: str = "items") -> DataFrame:
    """`item:score#item:score`, best first."""
    text = df.withColumn("_text", F.concat_ws(":", F.col(item).cast("string"), F.format_string(f"%.{digits}f", F.round(score, digits))))
    return text.groupBy(*by).agg(F.expr(f"listagg(_text, '#') WITHIN GROUP (ORDER BY round({score}, {digits}) DESC, {item})").alias(name))


def key_values(df: DataFrame, prefix: str, key: Column, value: Column) -> DataFrame:
    return df.select(F.concat(F.lit(prefix), key.cast("string")).alias("key"), value.alias("value"))


def key_hashes(df: DataFrame, prefix: str, key: str, field: str, value: str) -> DataFrame:
    """key, fields: a map of texts for each key."""
    pair = F.struct(F.col(field).cast("string").alias("k"), F.col(value).cast("string").alias("v"))
    return df.groupBy(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("key")).agg(F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("fields"))


def key_hash_parts(df: DataFrame, prefix: str, key: str, field: str, value: str, size: int = 1000) -> DataFrame:
    """key, part, fields: key_hashes with at most `size` of a key's fields, which are distinct, to a numbered part."""
    rows = running(df.select(key, field, value), [key], [F.col(field)], []).withColumn("part", F.floor((F.col("_place") - 1) / size))
    pair = F.struct(F.col(field).cast("string").alias("k"), F.col(value).cast("string").alias("v"))
    return rows.groupBy(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("key"), "part").agg(F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("fields"))

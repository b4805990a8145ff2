"""Text and geometry expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_nulls(c: Column) -> Column:
    """Null, 'null' in any case and empty text all mean missing."""
    return F.when(F.lower(F.trim(c)).isin("null", ""), None).otherwise(c)


def characters(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), ""), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Of the sets of characters."""
    x, y = characters(a), characters(b)
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring of (x, y) corners or on its edge, by the parity of edges crossed to the right."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))
    cross = lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])
    within = lambda e: x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"])) & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"]))
    on_edge = F.exists(edges, lambda e: (cross(e) == 0) & within(e))
    crossed = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & ((cross(e) > 0) == (e["b"]["y"] > e["a"]["y"])))
    return on_edge | (F.size(crossed) % 2 == 1)


def dated(c: Column) -> Column:
    """Whether a text holds a date and a time: they are parted by a blank and can be read."""
    return (F.instr(c, " ") >= 1) & F.try_to_timestamp(c).isNotNull()


def cleaned(c: Column, keep: str = "A-Za-z0-9\\u4e00-\\u9fff") -> Column:
    """Without any sign outside a character class; by default Latin letters, digits and CJK signs stay."""
    return F.regexp_replace(c, f"[^{keep}]", "")


def url_decoded(c: Column) -> Column:
    """Null where the text isn't a valid encoding."""
    return F.try_url_decode(c)


def hash_number(c: Column) -> Column:
    """A number of a text from 0 on, below 2**32, the same at each run, for any partitioning and in other engines."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def hash_bucket(c: Column, buckets: int = 1 << 16) -> Column:
    return (hash_number(c) % buckets).cast("int")


def random_part(key: Column, parts: int, seed: int) -> Column:
    """A number from 0 to `parts` - 1, as by chance but for the key and the seed."""
    return hash_bucket(F.concat_ws("-", F.lit(seed), key.cast("string")), parts)

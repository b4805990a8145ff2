"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: runs of anything but ASCII white space. `bytes.split()` cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that the cluster shares; a local one where the session names none (tests)."""
    global _own_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        _own_dir = _own_dir or tempfile.mkdtemp(prefix="spark-")
        base = f"file://{_own_dir}"
    return f"{base}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, label: str) -> DataFrame:
    """`df` written as a table in the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of a row's id and text: rows of one id but other texts, or without an id, are told apart. A null differs from any value."""
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat(told[0], F.lit(" "), told[1])))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that long texts don't pile up in a worker."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def total_of(df: DataFrame, value: Column) -> int:
    return int(df.agg(F.coalesce(F.sum(value), F.lit(0)).alias("n")).first()["n"])


class Memo(dict):
    """word -> value, worked out once while the word stays here; emptied when it holds `limit` words."""

    def __init__(self, value, limit: int = 300_000):
        super().__init__()
        self.value, self.limit = value, limit

    def __missing__(self, word: bytes):
        if len(self) >= self.limit:
            self.clear()
        out = self[word] = self.value(word)
        return out


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


#: Stripped from both ends of a word before it counts as a token.
PUNCTUATION = b".,;:!?\"'()[]{}"


def token_bucket(buckets: int):
    """The bucket of a word's lower-case form without punctuation at its ends."""

    def bucket(word: bytes) -> int:
        token = word.decode("utf-8", "replace").lower().encode().strip(PUNCTUATION)
        return xxhash.xxh64_intdigest(token, 11) % buckets

    return bucket


def filter_of(values: DataFrame, bits: int) -> np.ndarray:
    """A bit filter over the top bits of the long column `value`: packed bytes, 2**bits bits whatever the number of rows.

    At most 2**bits / 64 numbers come to the driver.
    """
    place = F.shiftrightunsigned("value", 64 - bits)
    words = values.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for batch in words.toArrow().to_batches():
        out[batch["word"].to_numpy()] = batch["bits"].to_numpy()
    return out.view(np.uint8)


def passes(packed: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Which of the unsigned hashes the filter lets pass."""
    place = (values >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def filter_bits(expected: int, most: int = 29) -> int:
    """Bits of a filter with some 32 places for each expected value, within fixed bounds (64 MB at most)."""
    return min(most, max(20, (32 * max(expected, 1)).bit_length()))


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    return h * np.uint64(0xD6E8FEB86659FD93)


_PART = 1 << 23


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value in every window of `width`; values are told apart by their top 40 bits."""
    n = len(values)
    if n > _PART + width:  # positions have 24 bits: longer runs go in parts, each window in the one that it begins in
        parts = [sliding_argmin(values[a : a + _PART + width - 1], width) + a for a in range(0, n - width + 1, _PART)]
        return np.concatenate(parts)
    key = (values & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
    pad = -n % width
    grid = np.concatenate((key, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    m = n - width + 1
    return (np.minimum(ahead[:m], behind[width - 1 : width - 1 + m]) & np.uint64(0xFFFFFF)).astype(np.int64)


def tucked(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """`df` with columns c0, c1, ... that clash with no name, those names by the old ones, and the columns that give these back."""
    inner = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*inner), dict(zip(df.columns, inner, strict=True)), [F.col(c).alias(n) for c, n in zip(inner, df.columns, strict=True)]


def pieces(batches: Iterable[pa.RecordBatch], size: int = 1 << 20, rows: int = 400, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with the bytes of their text, cut so that a piece holds some `size` bytes or a single row."""
    for batch in slices(batches, rows):
        texts, start, held = text_bytes(batch[column]), 0, 0
        for i, text in enumerate(texts):
            if held and held + len(text) > size:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += len(text)
        yield batch.slice(start), texts[start:]

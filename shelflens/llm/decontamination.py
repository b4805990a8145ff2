"""Benchmark decontamination by spaced-seed hashing.

Masks ignore chosen token positions. Under each mask every window of a benchmark item and of a document has a hash; a
hash in common is a hit, and the overlap around it is followed along its diagonal, substitutions allowed. A bit filter
of fixed size over the benchmark's hashes, broadcast, lets nearly all windows of the documents go at once; those it
passes are joined with the benchmark's hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashes, Memo, pieces, PUNCTUATION, row_key, save, tucked

FILTER_BITS = 1 << 26  #: 8 MB, whatever the benchmark's size
_ODD = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Params:
    #: 1: the token counts, 0: it is ignored. Five tokens each, up to nine apart.
    masks: tuple[str, ...] = ("11111", "1101011", "10110101", "110000111", "101010101")
    least: int = 10  #: tokens of an overlap that counts, or the whole of a shorter item that has a mask's length
    identity: float = 0.75  #: share of equal tokens in it
    drop: int = 4  #: no overlap crosses substitutions in a row that take more points than this, 1.5 each


def token_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word.decode("utf-8", "replace").lower().encode().strip(PUNCTUATION), 3)


def mask_hashes(tokens: np.ndarray, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows under all masks, and where the windows start."""
    found, at = [], []
    for m, mask in enumerate(masks):
        n = len(tokens) - len(mask) + 1
        if n > 0:
            h = np.full(n, _ODD[m + 32], np.uint64)
            for k, j in enumerate(i for i, c in enumerate(mask) if c == "1"):
                h = (h ^ (tokens[j : j + n] * _ODD[k])) * _ODD[k + 16]
            found.append(h ^ (h >> np.uint64(29)))
            at.append(np.arange(n))
    return (np.concatenate(found), np.concatenate(at)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.uint64(FILTER_BITS - 1)
    return (h & top).astype(np.int64), ((h >> np.uint64(32)) & top).astype(np.int64)


def _items(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(token_hash)
        for batch, texts in pieces(batches):
            out: list[list] = [[], [], [], []]
            for item, text in zip(batch["item_id"].to_pylist(), texts, strict=True):
                tokens = hashes(text.split(), memo)
                h, at = mask_hashes(tokens, p.masks)
                if len(h):
                    h, first = np.unique(h, return_index=True)
                    for x, v in zip(out, (item, tokens.tobytes(), h.view(np.int64), at[first]), strict=True):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.list_(pa.int64()))], ["item_id", "tokens", "hash", "at"])

    return run


def _filter(hash_table: DataFrame) -> np.ndarray:
    """The bit filter. At most FILTER_BITS / 64 numbers come to the driver."""
    h = F.col("hash")
    places = F.explode(F.array(h.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(FILTER_BITS - 1))))
    words = hash_table.select(places.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for batch in words.toArrow().to_batches():
        out[batch["word"].to_numpy()] = batch["bits"].to_numpy()
    return out.view(np.uint8)


def _set(packed: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _regions(p: Params, packed, reach: int):
    """Of each document the stretches around the windows that pass the filter, with those windows' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, bits = Memo(token_hash), np.frombuffer(packed.value, np.uint8)
        for batch, texts in pieces(batches):
            rows: list[tuple] = []
            for doc, row, text in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), texts, strict=True):
                tokens = hashes(text.split(), memo)
                h, at = mask_hashes(tokens, p.masks)
                a, b = _bits(h)
                hit = np.flatnonzero(_set(bits, a))
                hit = hit[_set(bits, b[hit])]
                if not len(hit):
                    continue
                hit = hit[np.argsort(at[hit], kind="stable")]
                where = at[hit]
                for part in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(where) > 2 * reach) + 1):
                    start, end = max(int(where[part[0]]) - reach, 0), int(where[part[-1]]) + reach + 16
                    rows.append((doc, row, start, tokens[start:end].tobytes(), h[hit[part]].view(np.int64), where[part] - start))
            types = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["doc_id", "row", "start", "region", "hash", "at"])

    return run


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, p: Params) -> tuple[int, int, int]:
    """Longest stretch along a diagonal (document position less item position) from one equal token to another of which `identity` are equal: its start in the document, tokens, equal ones.

    Whatever lies beside a stretch doesn't count against it, so more of an item never makes its overlap shorter.
    """
    first, last = max(diagonal, 0), min(diagonal + len(item), len(doc))
    at = np.flatnonzero(doc[first:last] == item[first - diagonal : last - diagonal])
    out = (0, 0, 0)
    for part in np.split(at, np.flatnonzero(1.5 * (np.diff(at) - 1) > p.drop) + 1):
        if not len(part):
            continue
        before = np.arange(len(part)) - p.identity * part  # equal tokens before each, less those needed
        after = before + 1 - p.identity
        # The first place from which enough are equal up to each; the least so far falls, so it can be searched.
        begin = np.searchsorted(-np.minimum.accumulate(before), -after - 1e-9)
        size = part - part[begin] + 1
        i = int(size.argmax())
        if size[i] > out[1]:
            out = (first + int(part[begin[i]]), int(size[i]), i - int(begin[i]) + 1)
    return out


def _verify(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, doc_id, start, region, item_id, tokens, diagonal in zip(*(batch[c].to_pylist() for c in ("row", "doc_id", "start", "region", "item_id", "tokens", "diagonal")), strict=True):
                item = np.frombuffer(tokens, np.uint64)
                at, n, same = overlap(np.frombuffer(region, np.uint64), item, diagonal, p)
                if n >= min(p.least, len(item)):
                    rows.append((row, doc_id, item_id, start + at, n, same))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i else pa.binary()) for i in range(6)], ["row", "doc_id", "item_id", "start", "tokens", "equal"])

    return run


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """row, doc_id, item_id, start, tokens, equal of the overlaps that count, written to the shared folder; `row` is the row_key of the document.

    Tokens are words, lower-cased and without punctuation at their ends. Of benchmark rows with the same tokens the
    smallest item_id stands for all. Null and empty texts, and items too short for every mask, have no overlap. Rows
    that repeat a doc_id, or have none, have each their own overlaps; rows equal in id and text share them. Texts of any
    length are read whole.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").mapInArrow(_items(p), "item_id long, tokens binary, hash array<long>, at array<long>")
    items = save(items.groupBy("tokens").agg(F.min("item_id").alias("item_id"), F.min_by("hash", "item_id").alias("hash"), F.min_by("at", "item_id").alias("at")).withColumn("key", F.xxhash64("tokens")), "bench-items")
    pairs = save(items.select("key", F.explode(F.arrays_zip("hash", "at")).alias("z")).select("key", "z.hash", "z.at"), "bench-hashes")
    reach = items.agg(F.max(F.octet_length("tokens") / 8).alias("n")).first()["n"]
    packed = spark.sparkContext.broadcast(_filter(pairs).tobytes())
    regions = docs.select("doc_id", "text", row_key().alias("row")).mapInArrow(_regions(p, packed, int(reach or 1)), "doc_id long, row binary, start long, region binary, hash array<long>, at array<long>")
    regions = save(regions.withColumn("rkey", F.xxhash64("row", "start", "region")), "bench-regions")
    hits = regions.select("rkey", F.explode(F.arrays_zip("hash", "at")).alias("z")).select("rkey", "z.hash", F.col("z.at").alias("doc_at"))
    lines = hits.join(pairs, "hash").select("rkey", "key", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct()
    whole = lines.join(items.select("key", "item_id", "tokens"), "key").join(regions.select("rkey", "row", "doc_id", "start", "region"), "rkey")
    return save(whole.mapInArrow(_verify(p), "row binary, doc_id long, item_id long, start long, tokens long, equal long").distinct(), "bench-spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of `docs`, all columns kept, without an overlap that counts. A clean row stays whatever other rows have its doc_id, or none as well."""
    found = save(contaminated_spans(docs, benchmark, p).select(F.col("row").alias("_leak")).distinct(), "bench-docs")
    inner, at, back = tucked(docs)
    return inner.withColumn("_row", row_key(at["doc_id"], at["text"])).join(found, F.col("_row") == F.col("_leak"), "left_anti").select(*back)


def op5_spaced_seeds(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """Every row's doc_id with contaminated (0, 1), its number of overlaps and the item, length and equal tokens of the longest."""
    spans = contaminated_spans(docs, benchmark, p)
    best = spans.groupBy(F.col("row").alias("_d")).agg(F.count("*").alias("n"), F.max(F.struct("equal", "tokens", (-F.col("item_id")).alias("i"))).alias("m"))
    out = docs.select("doc_id", row_key().alias("row")).join(best, F.col("row") == F.col("_d"), "left")
    return out.select("doc_id", F.col("n").isNotNull().cast("int").alias("contaminated"), F.coalesce("n", F.lit(0)).alias("overlaps"), (-F.col("m.i")).alias("item_id"), F.col("m.tokens").alias("tokens"), F.col("m.equal").alias("equal"))

"""Dedup of byte strings that occur more than once anywhere in the corpus, by external induced sorting.

Sampled suffixes are sorted first and all others are induced from them. A 400-byte window samples one suffix that
starts in it: of its 64-byte grams the one with the least hash, the leftmost of equal ones. Equal windows sample the
same gram at the same offset, so only suffixes that begin with the same gram can lie next to each other with 400 bytes
in common. Grams sampled once are let go, and of those with equal bytes all around one stands for all.

The rest are suffix tuples: the gram, the bytes from it on, the bytes before it, and the place. Spark's external sort
(runs on disk, merged) puts them in order, a gram's tuples one after the other, and neighbours' common prefixes are
measured. Then, byte by byte to the left, the suffixes that start one earlier are induced: a stable distribution of the
tuples by the byte before them keeps their order, and the new common prefix of neighbours is the least one between them
in the old order, plus one. A window repeats where a neighbour has its whole length in common. Bytes are compared, not
hashes. Recursion isn't needed: 400 bytes bound what the sort of the sampled suffixes has to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_bits, filter_of, mix64, passes, pieces, save, sliding_argmin, slices

_RNG = np.random.default_rng(23)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 4 + 3
_POWERS: dict[int, np.ndarray] = {}


#: A row of the documents: its doc_id (one from its text where that is null) and a hash of both, 128 bits in all.
ROW = ["doc", "rid"]


def row_key() -> list[Column]:
    return [F.coalesce("doc_id", F.xxhash64(F.lit(1), "text")).alias("doc"), F.xxhash64("doc_id", "text").alias("rid")]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.concatenate((np.array([1], np.uint64), np.full(size, base & ((1 << 64) - 1), np.uint64))), dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(len(data))[0], dtype=np.uint64)))


def string_hashes(prefix: np.ndarray, start: np.ndarray | slice, length: int) -> np.ndarray:
    """Hash of the `length` bytes from each start."""
    n = len(prefix) - length
    if isinstance(start, slice):
        return mix64((prefix[length:] - prefix[:n]) * _powers(n)[1])
    return mix64((prefix[start + length] - prefix[start]) * _powers(n)[1][start])


def _samples(texts: list[bytes], window: int, gram: int):
    """Of the documents one after the other: bytes, gram hashes, all whole windows' starts and sampled grams, and the documents' bounds."""
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < window:
        return None
    ok = np.zeros(len(data) - window + 1, bool)
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= window:
            ok[a : b - window + 1] = True
    if not ok.any():
        return None
    h = string_hashes(prefix_hash(data), slice(None), gram)
    at = np.flatnonzero(ok)
    return data, h, at, sliding_argmin(h, window - gram + 1)[at], first


def _long(texts: list[bytes], window: int, cut: int = 8 << 20) -> Iterator[tuple[int, list[bytes], int]]:
    """Pieces of at most `cut` bytes and their offset; a longer single text goes in pieces that overlap by a window less a byte."""
    if len(texts) == 1 and len(texts[0]) > cut:
        for at in range(0, len(texts[0]) - window + 1, cut):
            yield 0, [texts[0][at : at + cut + window - 1]], at
    else:
        yield 0, texts, 0


def _grams(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches):
            for _, part, _ in _long(texts, window):
                if (found := _samples(part, window, gram)) is not None:
                    _, h, at, least, _ = found
                    new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(at) > 1))))
                    yield pa.RecordBatch.from_arrays([pa.array(h[least[new]].view(np.int64))], ["value"])

    return run


def _occurrences(texts: list[bytes], window: int, gram: int) -> Iterator[tuple]:
    """Sampled grams of a piece: bytes and their prefix hashes, starts of each one's first window and their number, gram hashes, windows' distances before the gram, rows of the batch, places in the documents."""
    for _, part, offset in _long(texts, window):
        if (found := _samples(part, window, gram)) is not None:
            data, h, at, least, first = found
            new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(at) > 1))))
            start, size = at[new], np.diff(np.concatenate((new, [len(at)])))
            doc = np.searchsorted(first, start, "right") - 1
            yield data, start, size, h[least[new]], least[new] - start, doc, start - first[doc] + offset


def _key(rid: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix64(rid.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64))


def _marks(window: int, gram: int, bits: int, shared):
    """For each sampled gram that passes: its windows' place and number, a hash of all bytes they span, and a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        for batch, texts in pieces(batches):
            rids, docs = batch["rid"].to_numpy(), batch["doc"].to_numpy()
            for data, start, size, value, before, row, at in _occurrences(texts, window, gram):
                keep = np.flatnonzero(passes(packed, value, bits))
                prefix, inverse = prefix_hash(data), _powers(len(data))[1]
                a, n, row, at = start[keep], size[keep], row[keep], at[keep]
                whole = mix64((prefix[a + n + window - 1] - prefix[a]) * inverse[a] + (before[keep] * 65536 + n).astype(np.uint64))
                columns = (value[keep].view(np.int64), whole.view(np.int64), docs[row], rids[row], at, n, _key(rids[row], at).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["value", "whole", "doc", "rid", "at", "size", "key"])

    return run


TUPLES = "value long, core long, width int, doc long, rid long, at long, size long, before binary, from binary"
_NAMES = [x.split()[0] for x in TUPLES.split(", ")]
STEP = 16  #: of a crowded gram's windows so many that start next to each other are compared together


def _tuples(window: int, gram: int, bits: int, shared, most: int, more: int):
    """Suffix tuples of the sampled grams whose key is among `keys` of their row or, without that column, passes the filter.

    `at` and `size` are the first window that samples the gram and their number; the bytes before and from the gram on
    reach as far as these windows do, and are compared over `width` bytes. A gram with more than `most` surroundings
    would crowd one task. So its windows are dealt out, STEP neighbours at a time, by a hash (`core`) of the bytes that
    they all hold, and only the bytes left and right of these stay to be compared; those of a gram with more than `more`
    are dealt out one by one, by a hash of the whole window, with nothing left to compare.
    """

    def narrowed(value: int, doc: int, rid: int, at: int, size: int, b: bytes, f: bytes, step: int) -> Iterator[tuple]:
        text, n = b + f, len(b)
        low = n - size + 1
        for k in range(low // step, n // step + 1):
            last, first = max(low, step * k), min(n, step * k + step - 1)  # distances before the gram
            middle, end = n - step * k, n - step * k + window - step + (step == 1)
            yield middle, (value, step if step > 1 else 0, doc, rid, at + n - first, first - last + 1, text[n - first : middle], text[end : n - last + window] if step > 1 else b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, crowded = shared.value
        packed = np.frombuffer(packed, np.uint8)
        for batch, texts in pieces(batches):
            rids, docs = batch["rid"].to_numpy(), batch["doc"].to_numpy()
            listed = batch["keys"].flatten().to_numpy().view(np.uint64) if "keys" in batch.schema.names else None
            for data, start, size, value, before, row, at in _occurrences(texts, window, gram):
                key = _key(rids[row], at)
                keep = np.flatnonzero(passes(packed, key, bits) if listed is None else np.isin(key, listed))
                raw, rows = data.tobytes(), []
                hashes: dict[int, list[int]] = {STEP: [], 1: []}
                dealt: dict[int, list[tuple]] = {STEP: [], 1: []}
                for v, d, r, a, n, s, g in zip(*(x[keep].tolist() for x in (value.view(np.int64), docs[row], rids[row], at, size, start, start + before)), strict=True):
                    b, f = raw[s:g], raw[g : s + n + window - 1]
                    if (many := crowded.get(v, 0)) > most:
                        step = STEP if many <= more else 1
                        for middle, x in narrowed(v, d, r, a, n, b, f, step):
                            hashes[step].append(s + middle)
                            dealt[step].append(x)
                    else:
                        rows.append((v, 0, window, d, r, a, n, b, f))
                for step, found in dealt.items():
                    if found:
                        length = window - step + (step == 1)
                        core = string_hashes(prefix_hash(data), np.array(hashes[step]), length).view(np.int64).tolist()
                        rows += [(x[0], c, *x[1:]) for x, c in zip(found, core, strict=True)]
                types = (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _NAMES)

    return run


def _grid(strings: pa.Array, width: int, flush_right: bool) -> tuple[np.ndarray, np.ndarray]:
    """The strings as rows of bytes, and their lengths."""
    size = pc.binary_length(strings).to_numpy().astype(np.int64)
    out = np.zeros((len(size), width), np.uint8)
    column = np.arange(width)
    inside = column >= (width - size)[:, None] if flush_right else column < size[:, None]
    out[inside] = np.frombuffer(b"".join(strings.to_pylist()), np.uint8)
    return out, size


def induce(value: np.ndarray, before: pa.Array, after: pa.Array, size: np.ndarray, window: int) -> np.ndarray:
    """For suffix tuples sorted by gram and the bytes from it on: which windows, by tuple and distance before the gram, start elsewhere too.

    `order` holds the tuples that still take part in the order of the suffixes that start `d` bytes before their gram,
    those with the same gram and the same d bytes before it in a row, and `lcp` each one's common prefix with the one
    before.
    """
    left, most = _grid(before, window, True)
    right, length = _grid(after, window, False)
    m = len(value)
    repeats = np.zeros((m, window), bool)
    order, kin = np.arange(m), np.concatenate(([False], value[1:] == value[:-1]))
    differ = np.concatenate((right[1:] != right[:-1], np.ones((m - 1, 1), bool)), axis=1).argmax(1)
    lcp = np.where(kin, np.concatenate(([0], np.minimum(differ, np.minimum(length[1:], length[:-1])))), 0)
    for d in range(window):
        near = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
        repeats[order[near >= window], d] = True
        # Of those with a neighbour of the same gram and bytes so far, and a byte before: one step to the left.
        with_kin = kin | np.concatenate((kin[1:], [False]))
        keep = np.flatnonzero(with_kin & (most[order] > d))
        if len(keep) < 2:
            break
        group = np.cumsum(~kin)
        key = group[keep] * 256 + left[order[keep], window - 1 - d]
        by = np.argsort(key, kind="stable")
        old, key = keep[by], key[by]
        kin = np.concatenate(([False], key[1:] == key[:-1]))
        at = np.flatnonzero(kin)
        bounds = np.stack((old[at - 1] + 1, old[at] + 1), axis=1).ravel()
        least = np.minimum.reduceat(np.concatenate((lcp, [0])), bounds)[::2] if len(at) else at
        order, lcp = order[old], np.zeros(len(old), np.int64)
        lcp[at] = least + 1
    # Only windows that sample the gram themselves count; any other's bytes end before its tuple's do.
    distance = np.arange(window)
    return repeats & (distance <= most[:, None]) & (distance > (most - size)[:, None])


def _runs(part: pa.Table, repeats: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows, as starts in their row; `repeats` is by tuple and distance before the gram."""
    edge = np.diff(np.pad(repeats[:, ::-1], ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (i, start), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    first = (part["at"].to_numpy() + pc.binary_length(part["before"]).to_numpy())[i] - (repeats.shape[1] - 1)
    return pa.RecordBatch.from_arrays([pa.array(part[c].to_numpy()[i]) for c in ROW] + [pa.array(first + start), pa.array(first + end)], [*ROW, "start", "end"])


def _new_group(part: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Which rows begin a group of equal value, width and core."""
    same = np.ones(max(part.num_rows - 1, 0), bool)
    for c in ("value", "width", "core"):
        x = part[c].to_numpy()
        same &= x[1:] == x[:-1]
    return np.concatenate(([True], ~same))[: part.num_rows]


def _induced(rows: int = 4000):
    """Over suffix tuples in order: runs of the windows that repeat. Groups are kept whole, some `rows` tuples at a time."""

    def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(parts).combine_chunks()
        group, widths = np.cumsum(_new_group(part)), part["width"].to_numpy()
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            one = part.take(pa.array(chosen)).combine_chunks().to_batches()[0]
            if width:
                repeats = induce(group[chosen], one["before"], one["from"], one["size"].to_numpy(), width)
            else:
                repeats = np.bincount(group)[group[chosen]][:, None] > 1
            yield _runs(one, repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in slices(batches, rows):
            if not batch.num_rows:
                continue
            begins = _new_group(batch)
            if held:
                begins[0] = _new_group(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]))[1]
            last = np.flatnonzero(begins)
            if len(last):
                if held or last[-1]:
                    yield from found([*held, batch.slice(0, int(last[-1]))])
                held = []
            held.append(batch.slice(int(last[-1]) if len(last) else 0))
            if not held[0]["width"][0].as_py() and sum(x.num_rows for x in held) > 2:
                # Whole windows of one kind repeat from the second on: two of them are enough to go on with.
                yield from found(held)
                held = [pa.concat_batches(held).slice(0, 2)]
        if held:
            yield from found(held)

    return run


def repeated_windows(docs: DataFrame, window: int = 400, gram: int = 64, most_bits: int = 29, most: int = 20_000, more: int = 1_000_000) -> DataFrame:
    """doc, rid, start, end: for rows of `docs` by their key, runs of starts (end exclusive) of byte strings that start anywhere else too.

    The filters over grams and keys have a fixed greatest size. Beyond it the first one lets all grams pass, a row for
    some 170 bytes; in place of the second the documents are joined with their keys. Grams with more than `most` (and
    `more`) surroundings are few: one for each `most` kinds at the most, fewer than 2**20.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text", *row_key())
    grams = rows.select("text").mapInArrow(_grams(window, gram), "value long")
    twice = save(grams.groupBy("value").count().where("count > 1").select("value"), "byte-grams")
    bits = filter_bits(twice.count(), most_bits)
    shared = context.broadcast(filter_of(twice, bits).tobytes())
    marks = save(rows.mapInArrow(_marks(window, gram, bits, shared), "value long, whole long, doc long, rid long, at long, size long, key long"), "byte-marks")
    kinds = save(marks.groupBy("value", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", *ROW)).alias("one")), "byte-kinds")
    # Where all bytes around a gram occur again, so do all its windows.
    same = marks.join(kinds.where("n > 1").select("value", "whole"), ["value", "whole"]).select(*ROW, F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
    # Where a gram has several surroundings, one of each kind goes on to be sorted.
    several = save(kinds.groupBy("value").count().where("count > 1"), "byte-several")
    chosen = save(kinds.join(several.select("value"), "value", "left_semi").select("one.*"), "byte-keys")
    n = chosen.count()
    most = max(most, n >> 20)
    crowded = {r["value"]: r["count"] for r in several.where(F.col("count") > most).toLocalIterator()}
    bits = filter_bits(n, most_bits)
    if n << 4 <= 1 << bits:
        source, packed = rows, filter_of(chosen.select(F.col("key").alias("value")), bits)
    else:
        source, packed = rows.join(chosen.groupBy(*ROW).agg(F.collect_list("key").alias("keys")), ROW), np.zeros(8, np.uint8)
    shared2 = context.broadcast((packed.tobytes(), crowded))
    tuples = source.mapInArrow(_tuples(window, gram, bits, shared2, most, more), TUPLES)
    dealt = tuples.repartition("value", "width", "core").sortWithinPartitions("value", "width", "core", "from")
    return same.unionByName(dealt.mapInArrow(_induced(), f"{', '.join(f'{c} long' for c in ROW)}, start long, end long"))


def _finish(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            rows = []
            for text, spans in zip(texts, batch["spans"].to_pylist(), strict=True):
                runs, kept, at = 0, [], 0
                end = -1
                for a, b in sorted((s["start"], s["end"] + window - 1) for s in spans or ()):
                    if a > end:  # touching runs are one
                        kept.append(text[at:a] if end < 0 else text[end:a])
                        runs += 1
                        end = b
                    else:
                        end = max(end, b)
                kept.append(text[max(end, 0) :])
                left = b"".join(kept)
                rows.append((len(text), len(text) - len(left), runs, left))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], pa.array([r[3] for r in rows], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 400, gram: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: every text without the bytes of `window`-byte strings that occur twice.

    Texts are UTF-8 bytes, null ones empty; strings don't cross documents, and one that repeats within a document or
    overlaps itself counts. Equal rows remove each other whole if long enough; null and repeated doc_ids are rows like
    others. An empty table gives an empty result.
    """
    spans = save(repeated_windows(docs, window, gram), "byte-spans")
    spans = spans.distinct().groupBy(*ROW).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = docs.select("doc_id", "text", *row_key())
    return rows.join(spans, ROW, "left").select("doc_id", "text", "spans").mapInArrow(_finish(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op7_byte_repeats(docs: DataFrame) -> DataFrame:
    """What remove_repeats leaves of every row, by its hash. Nulls, empty and repeated rows are as there; very long texts are cut with an overlap, so that nothing is lost; other columns are not read."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

"""Substring dedup of repeated word windows by fixed-block anchors.

Each document's words are cut into non-overlapping reference blocks of half a window. They are the index: any window of
another document that equals one of this holds such a block whole, at whatever offset, so every rolling block of every
document probes it. A rolling block that occurs more than once and is a reference block somewhere is a hit. Around each
hit the windows that hold it are candidates as far as all their rolling blocks repeat; of several hits in a window the
one of the least hash stands for it, in all documents alike. Under each hit the windows of all documents are then
compared by their whole word sequence, to find the smallest document each starts in; overlapping ones add up to the
maximal repeats.

The rolling blocks travel as sorted, delta-coded hashes, a packed list for each task and range of hashes. The windows of
a hit that very many documents share are dealt out by their own hashes, so that no task gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, hashes, mix64, passes, pieces, save, sliding_argmin, word_hash

_RANDOM = np.random.default_rng(17).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = int(np.iinfo(np.int64).max)
_MOST = np.iinfo(np.uint64).max


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def gram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n tokens."""
    m = len(tokens) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += tokens[j : j + m] * _RANDOM[j]
    return mix64(out)


def _stream(texts: list[bytes], memo: Memo, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the documents that have a window, one after the other; each one's index and first word."""
    split = [t.split() for t in texts]
    keep = [i for i, w in enumerate(split) if len(w) >= window]
    if not keep:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    tokens = np.concatenate([hashes(split[i], memo) for i in keep])
    return tokens, np.array(keep), np.concatenate(([0], np.cumsum([len(split[i]) for i in keep])))


def _inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whether a run of n words from each position ends in the document it starts in."""
    ok = np.zeros(max(total - n + 1, 0), bool)
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        ok[a : max(b - n + 1, a)] = True
    return ok


def _blocks(window: int, ranges: int, flush: int = 3 << 20):
    block = (window + 1) // 2

    def pack(found: list[np.ndarray]) -> pa.RecordBatch:
        h = np.sort(np.concatenate(found))  # the lowest bit tells a reference block
        value, ref = h >> np.uint64(2), h & np.uint64(1)
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(h) else np.zeros(0, np.int64)
        many = np.diff(np.concatenate((first, [len(h)]))) > 1
        any_ref = np.maximum.reduceat(ref, first) if len(h) else ref
        value = value[first]
        cut = np.searchsorted(value, (np.arange(ranges + 1, dtype=np.uint64) * np.uint64((1 << 62) // ranges)))
        rows = []
        for i in range(ranges):
            a, b = int(cut[i]), int(cut[i + 1]) if i < ranges - 1 else len(value)
            if a < b:
                # 44 bits of each hash, two signs below them
                coded = (value[a:b] >> np.uint64(18) << np.uint64(2)) | (many[a:b].astype(np.uint64) << np.uint64(1)) | any_ref[a:b]
                step = np.diff(coded, prepend=np.uint64(0))
                kind = "<u4" if int(step[1:].max(initial=0)) < 1 << 32 else "<u8"
                rows.append((i, int(coded[0]), kind == "<u4", step[1:].astype(kind).tobytes()))
        types = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["range", "start", "short", "steps"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, found, size = Memo(word_hash), [], 0
        for _, texts in pieces(batches):
            tokens, keep, first = _stream(texts, memo, window)
            if not len(keep):
                continue
            h = gram_hashes(tokens, block) & ~np.uint64(3)
            ok = _inside(first, block, len(tokens))
            at = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))[: len(h)]
            found.append((h | (at % block == 0).astype(np.uint64))[ok])
            size += len(found[-1])
            if size > flush:
                yield pack(found)
                found, size = [], 0
        if found:
            yield pack(found)

    return run


def _repeated(bits: int):
    """Of one range of hashes its part of two filters: blocks that repeat, and those among them that have a reference block."""

    def run(rows: pa.Table) -> pa.Table:
        lists = []
        for start, short, steps in zip(rows["start"].to_pylist(), rows["short"].to_pylist(), rows["steps"].to_pylist(), strict=True):
            step = np.frombuffer(steps, "<u4" if short else "<u8").astype(np.uint64)
            lists.append(np.cumsum(np.concatenate((np.array([start], np.uint64), step)), dtype=np.uint64))
        coded = np.sort(np.concatenate(lists))
        value = coded >> np.uint64(2)
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        signs = np.bitwise_or.reduceat(coded & np.uint64(3), first)
        repeats = (np.diff(np.concatenate((first, [len(value)]))) > 1) | (signs & np.uint64(2) > 0)
        anchors = repeats & (signs & np.uint64(1) > 0)
        place = (value[first] >> np.uint64(44 - bits)).astype(np.int64)
        out = []
        for chosen in (repeats, anchors):
            p = np.unique(place[chosen])
            byte, sign = p >> 3, np.uint8(1) << (p & 7).astype(np.uint8)
            at = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1]))) if len(p) else p
            out.append((byte[at], np.bitwise_or.reduceat(sign, at) if len(p) else sign))
        return pa.table([pa.array([x.astype(t).tobytes()], pa.binary()) for pair in out for x, t in zip(pair, ("<i8", "u1"), strict=True)], ["r_at", "r", "a_at", "a"])

    return run


def _candidates(window: int, bits: int, shared, hot: frozenset = frozenset()):
    """Candidate windows in a row, under the hit that stands for them: its hash, the document, the first window's place and the windows' hashes.

    Of a hit in `hot` each window is a row of its own, under its own hash as well (`sub`, else 0).
    """
    block = (window + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_hash)
        repeats, anchors = (np.frombuffer(x, np.uint8) for x in shared.value)
        many = np.array(sorted(hot), np.int64).view(np.uint64)
        width = window - block + 1
        for batch, texts in pieces(batches):
            tokens, keep, first = _stream(texts, memo, window)
            if not len(keep):
                continue
            h = gram_hashes(tokens, block)
            again = np.concatenate(([0], np.cumsum(passes(repeats, h, bits))))
            anchor = np.concatenate(([0], np.cumsum(passes(anchors, h, bits))))
            ok = _inside(first, window, len(tokens))
            m = len(ok)
            ok &= (again[width : width + m] - again[:m] == width) & (anchor[width : width + m] > anchor[:m])
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            hits = np.where(np.diff(anchor) > 0, h, np.uint64(_MOST))
            least, whole = sliding_argmin(hits, width)[at], gram_hashes(tokens, window)[at].view(np.int64)
            crowded = np.isin(h[least], many)
            new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(at) > 1) | crowded[1:])))
            doc = np.searchsorted(first, at[new], "right") - 1
            row = keep[doc]
            ids = batch["doc_id"].fill_null(_LAST).to_numpy()[row]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate((new, [len(at)])), pa.int32()), pa.array(whole, pa.int64()))
            sub = np.where(crowded[new], whole[new] | 1, 0)
            columns = [pa.array(h[least[new]].view(np.int64)), pa.array(sub), pa.array(ids), batch["rid"].take(pa.array(row)), pa.array((at[new] - first[doc]).astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["least", "sub", "doc", "rid", "at", "windows"])

    return run


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by hit, `sub` and document: which windows start in a smaller document too, as bits from `at`.

    The first document met with a window is the smallest. What the last hit of a batch has met is kept for the next.
    """
    last, met = None, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        least, sub, doc = (batch[c].to_numpy() for c in ("least", "sub", "doc"))
        lists = batch["windows"]
        n = np.diff(lists.offsets.to_numpy())
        h = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(n)), n)
        _, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        smallest = doc[owner[index]][inverse]
        begins = np.flatnonzero(np.concatenate(([last != (least[0], sub[0])], (least[1:] != least[:-1]) | (sub[1:] != sub[:-1]))))
        part = int(n[: begins[0]].sum()) if len(begins) else len(h)  # windows of the hit that the batch before ended with
        if part:
            old = np.fromiter((met.get(x, _LAST) for x in h[:part].tolist()), np.int64, part)
            smallest[:part] = np.minimum(smallest[:part], old)
        if len(begins):
            last, met = (least[-1], sub[-1]), {}
        tail = owner >= (begins[-1] if len(begins) else 0)
        for x, d in zip(h[tail].tolist(), smallest[tail].tolist(), strict=True):
            met.setdefault(x, d)
        hit = smallest < doc[owner]
        start = np.concatenate(([0], np.cumsum(n)))[:-1]
        mask = np.add.reduceat(np.where(hit, np.int64(1) << (np.arange(len(h)) - start[owner]), 0), start)
        some = np.flatnonzero(mask)
        yield pa.RecordBatch.from_arrays([batch["doc"].take(pa.array(some)), batch["rid"].take(pa.array(some)), batch["at"].take(pa.array(some)), pa.array(mask[some])], ["doc", "rid", "at", "mask"])


SAMPLE = 64  #: one in so many rows is read first to find crowded hits
HOT = 4096  #: crowded hits, at most


def covered_windows(docs: DataFrame, window: int = 13, bytes_per_range: int = 12 << 20, most_bits: int = 29, crowd: int = 20_000) -> DataFrame:
    """doc, rid, at, mask: for rows of `docs` by their key, windows that start in a smaller doc_id too (bit i: the one at `at` + i).

    A hit with some `crowd` rows or more and a HOT-th of all rows at least, by a sample of the documents, has its windows
    dealt out one by one; this moves rows and changes none.
    """
    if not 2 <= window <= 60:
        raise ValueError("a window has 2 to 60 words")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # Ranges of hashes and places in the filters both follow from the size: some five bytes make a word.
    ranges = 1 << max(4, (size // bytes_per_range).bit_length())
    bits = min(most_bits, max(20, (size // 3).bit_length()))
    rows = docs.select("doc_id", "text", row_key().alias("rid"))
    packed = rows.select("text").mapInArrow(_blocks(window, ranges), "range int, start long, short boolean, steps binary")
    parts = packed.groupBy("range").applyInArrow(_repeated(bits), "r_at binary, r binary, a_at binary, a binary")
    filters = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(2)]
    for row in parts.toLocalIterator():
        for filter_, at, value in ((filters[0], row["r_at"], row["r"]), (filters[1], row["a_at"], row["a"])):
            filter_[np.frombuffer(at, "<i8")] |= np.frombuffer(value, "u1")
    shared = spark.sparkContext.broadcast(tuple(f.tobytes() for f in filters))
    schema = "least long, sub long, doc long, rid long, at int, windows array<long>"
    seen = save(rows.where(F.pmod("rid", F.lit(SAMPLE)) == 0).mapInArrow(_candidates(window, bits, shared), schema).groupBy("least").count(), "block-seen")
    least = max(crowd / SAMPLE, (seen.agg(F.sum("count")).first()[0] or 0) / HOT)
    hot = frozenset(r["least"] for r in seen.where(F.col("count") >= least).select("least").collect())  # HOT at most
    found = rows.mapInArrow(_candidates(window, bits, shared, hot), schema)
    return found.repartition("least", "sub").sortWithinPartitions("least", "sub", "doc").mapInArrow(_covered, "doc long, rid long, at int, mask long")


def _finish(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            rows = []
            for text, spans in zip(texts, batch["spans"].to_pylist(), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    mask, at = s["mask"], s["at"]
                    while mask:
                        i = (mask & -mask).bit_length() - 1
                        gone[at + i] += 1
                        gone[min(at + i + window, len(words))] -= 1
                        mask &= mask - 1
                out = np.cumsum(gone[:-1]) > 0
                kept = words if not spans else [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept)))
            columns = [batch["doc_id"], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept: every text without the words of windows that start in a smaller doc_id too.

    Words are runs of anything but ASCII white space, unchanged; the kept ones are joined by single spaces. Null texts
    have none. A null doc_id counts as the largest. Rows that repeat a doc_id don't remove each other's words. An empty
    table gives an empty result. Windows are told apart by 64-bit hashes of their words.
    """
    spans = save(covered_windows(docs, window), "block-spans")
    spans = spans.distinct().groupBy("doc", "rid").agg(F.collect_list(F.struct("at", "mask")).alias("spans"))
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), row_key().alias("rid"))
    return rows.join(spans, ["doc", "rid"], "left").select("doc_id", "text", "spans").mapInArrow(_finish(window), "doc_id long, n_words long, n_removed long, kept string")


def op6_block_anchors(docs: DataFrame) -> DataFrame:
    """What remove_repeats leaves of every row, by its hash. Nulls, empty and repeated rows are as there; texts of any length are read whole, other columns not at all."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

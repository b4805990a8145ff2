"""Plain single-machine versions of the operators, to test against."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import xxhash


def simhash(rows: list[tuple[int, str | None]], distance: int = 4) -> dict[int, tuple[str, int]]:
    prints = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    ids, parent = sorted(prints), {d: d for d in prints}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def word_windows(rows: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple[int, int, str]]:
    smallest: dict[tuple, int] = {}
    words = {d: (t or "").encode().split() for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            smallest[k] = min(d, smallest.get(k, d))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if smallest[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def byte_windows(rows: list[tuple[int, str | None]], window: int = 400) -> dict[int, tuple[int, int, int, str]]:
    count: dict[bytes, int] = defaultdict(int)
    texts = {d: (t or "").encode() for d, t in rows}
    for t in texts.values():
        for i in range(len(t) - window + 1):
            count[hashlib.blake2b(t[i : i + window], digest_size=16).digest()] += 1
    out = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if count[hashlib.blake2b(t[i : i + window], digest_size=16).digest()] > 1:
                gone[i : i + window] = b"\1" * window
        runs = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        out[d] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def crc_of_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def water_levels(sizes: dict, weights=(5, 2, 1), most: int = 3) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: float(most * sizes[s]) if s in capped else level * weight[s] for s in names}
        capped.update(over)

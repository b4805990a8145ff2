"""Token ids in a compressed binary format: adaptive context mixing with a range coder.

A block holds up to LANES * STEPS ids. It is cut into lanes, each with a range coder of its own; all lanes advance
together, one id each at a step, and share one model that starts afresh in each block. The model mixes three
predictions of the next id: the id last seen after the same two ids (order 2), after the same id (order 1), and the
frequencies so far (order 0). The weights of the first two follow how often predictions of the same confidence have
come true. A block is decoded alone and ends with a checksum of its ids.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, save, scratch_path

IDS = 1 << 16  #: ids are below this
LANES, STEPS = 8192, 512
CHUNK = LANES * STEPS
END_ID = 2
MAGIC = b"CMR2"
_SURE = 16  #: steps of a context's confidence
_W, _TOTAL = 1 << 16, 1 << 22  #: totals of the mixing weights and of the order-0 frequencies
_LEAST = 1 << 32  #: a lane's interval is no narrower between two ids
_U = np.uint64
_PLACES = 16  #: bits of the table that finds an id by its place among the order-0 frequencies
#: Confidence after a miss, then after a hit.
_NEXT = np.array([1] * _SURE + [min(i + 1, _SURE - 1) for i in range(_SURE)], np.int64) << 16


class _Model:
    """What encoder and decoder know alike before each step.

    A context of one or two ids has a slot with the id last seen after it and, above that, how sure it is. The three
    predictions are mixed: P(id) = w2 [id is order 2's] + w1 [id is order 1's] + w0 * order 0's frequency of it, so an
    id that several predict has the sum of their shares. The weights are learned for each pair of confidences.
    """

    def __init__(self, lanes: int, ids: int):
        self.one, self.two = np.zeros(IDS, np.int32), np.zeros(1 << 20, np.int32)
        self.hits = np.tile(np.array([4.0, 1.0, 1.0, 0.0]), (2 * _SURE * _SURE, 1))  # neither, order 1, order 2
        self.count, self.pending = np.ones(ids, np.int64), []
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0
        self.weigh()
        self.rebuild()

    def weigh(self) -> None:
        share = self.hits / self.hits.sum(1, keepdims=True) * _W
        w2, w1 = np.clip(share[:, 2], 64, None), np.clip(share[:, 1], 64, None)
        w1[_SURE * _SURE :] = 0  # where both predict the same id
        most = np.minimum((_W - 2048) / (w1 + w2), 1)
        self.w2, self.w1 = (w2 * most).astype(np.uint32), (w1 * most).astype(np.uint32)
        self.w0 = np.uint32(_W) - self.w2 - self.w1

    def rebuild(self) -> None:
        if self.pending:
            self.count += 32 * np.bincount(np.concatenate(self.pending), minlength=len(self.count))
            self.pending = []
        f = self.count * (_TOTAL - len(self.count)) // self.count.sum() + 1
        self.frequency, self.cum = f.astype(np.uint32), np.concatenate(([0], np.cumsum(f))).astype(np.uint32)
        self.total, self.share = self.cum[-1], self.frequency >> np.uint32(6)
        edge = -(-self.cum[1:].astype(np.int64) >> 6)  # places of 64 that an id's end lies behind
        self.first = np.repeat(np.arange(len(f)), np.diff(np.minimum(edge, 1 << _PLACES), prepend=0))

    def find(self, inner: np.ndarray) -> np.ndarray:
        """The id within whose frequency each number lies."""
        found, last = self.first[inner >> np.uint32(6)], len(self.frequency) - 1
        for step in (32, 16, 8, 4, 2, 1):  # 64 places hold no more ids than that
            ahead = np.minimum(found + step, last)
            found = np.where(self.cum[ahead] <= inner, ahead, found)
        return found

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """Of the first n lanes: slots, candidates, place in the weights, and both candidates' shares."""
        last = self.last[:n]
        slot = (last * 0x9E3779B1 + self.before[:n] * 0x85EBCA6B >> 12) & 0xFFFFF
        two, one = self.two[slot].astype(np.int64), self.one[last].astype(np.int64)
        id2, id1 = two & 0xFFFF, one & 0xFFFF
        same = id2 == id1
        place = (two >> 16 << 4) + (one >> 16) + (same << 8)
        w0 = self.w0[place]
        s2 = self.w2[place] + ((w0 * self.share[id2]) >> np.uint32(16))
        s1 = self.w1[place] + ((w0 * self.share[id1]) >> np.uint32(16))
        s1[same] = 0
        return slot, id2, id1, place, s2, s1

    def rest(self, id2: np.ndarray, id1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For lanes that neither candidate took: the two ids left out, the lower one first, their frequencies, and the total of all others."""
        a, b = np.minimum(id2, id1), np.maximum(id2, id1)
        fa, fb = self.frequency[a], np.where(a == b, np.uint32(0), self.frequency[b])
        return a, b, fa, fb, (self.total - fa - fb).astype(_U)

    def start(self, seen: np.ndarray, a, b, fa, fb) -> np.ndarray:
        """Where an id begins among all but those left out."""
        return (self.cum[seen] - np.where(a < seen, fa, np.uint32(0)) - np.where(b < seen, fb, np.uint32(0))).astype(_U)

    def update(self, seen: np.ndarray, slot, id2, id1, place) -> None:
        n = len(seen)
        right2, right1 = seen == id2, seen == id1
        outcome = (place << 2) + np.where(right2, 2, right1)
        self.hits *= 0.98
        self.hits += np.bincount(outcome, minlength=self.hits.size).reshape(self.hits.shape)
        self.hits += (0.04, 0.01, 0.01, 0.0)
        last = self.last[:n]
        self.two[slot] = seen | _NEXT[(place >> 4 & 15) + (right2 << 4)]
        self.one[last] = seen | _NEXT[(place & 15) + (right1 << 4)]
        self.before[:n], self.last[:n] = last.copy(), seen
        self.pending.append(seen)
        self.step += 1
        if self.step & (self.step - 1) == 0 or self.step % 16 == 0:
            self.rebuild()
        if self.step < 32 or self.step % 4 == 0:
            self.weigh()


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids: short blocks get fewer lanes."""
    lanes = max(1, min(LANES, n // 64))
    return lanes, -(-n // lanes)


def _lanes_at(s: int, n: int, steps: int, lanes: int) -> int:
    """Lanes that still have an id at step s: all but the last ones."""
    return min(lanes, -(-(n - s) // steps)) if n > s else 0


def encode_block(ids: np.ndarray) -> bytes:
    """Header, length of each lane's words, words, crc32 of the ids as little-endian unsigned 32-bit integers."""
    n, top = len(ids), int(ids.max(initial=0)) + 1
    lanes, steps = _shape(n)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[:n] = ids
    grid, model = np.ascontiguousarray(grid.reshape(lanes, steps).T), _Model(lanes, top)
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    out, fill = np.zeros((steps + 3, lanes), _U), np.zeros(lanes, np.int64)
    for s in range(steps):
        m = _lanes_at(s, n, steps, lanes)
        seen = grid[s, :m].astype(np.int64)
        slot, id2, id1, place, s2, s1 = model.predict(m)
        was, width = low[:m], span[:m]
        unit = width >> _U(16)
        first, second = s2 * unit, s1 * unit
        right2 = seen == id2
        at = was + np.where(right2, _U(0), first)
        miss = np.flatnonzero(~right2 & (seen != id1))
        a, b, fa, fb, total = model.rest(id2[miss], id1[miss])
        x = seen[miss]
        unit = (width[miss] - first[miss] - second[miss]) // total
        at[miss] += second[miss] + model.start(x, a, b, fa, fb) * unit
        width = np.where(right2, first, second)
        width[miss] = model.frequency[x] * unit
        carry = np.flatnonzero(at < was)
        if len(carry):
            out[fill[carry] - 1, carry] += _U(1)  # may reach 2**32, settled below
        go = np.flatnonzero(width < _LEAST)
        x = at[go]
        out[fill[go], go] = x >> _U(32)
        fill[go] += 1
        at[go] = x << _U(32)
        width[go] <<= _U(32)
        low[:m], span[:m] = at, width
        model.update(seen, slot, id2, id1, place)
    for shift in (32, 0):
        out[fill, np.arange(lanes)] = (low >> _U(shift)) & _U(0xFFFFFFFF)
        fill += 1
    for k in range(len(out) - 1, 0, -1):
        out[k - 1] += out[k] >> _U(32)
    words = out.T[np.arange(len(out)) < fill[:, None]]
    return MAGIC + struct.pack("<II", n, top) + fill.astype("<u4").tobytes() + words.astype("<u4").tobytes() + struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes()))


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; ValueError if it isn't one or the checksum differs."""
    if data[:4] != MAGIC or len(data) < 16:
        raise ValueError("not a block of token ids")
    n, top = struct.unpack_from("<II", data, 4)
    lanes, steps = _shape(n)
    if top > IDS or len(data) < 16 + 4 * lanes:
        raise ValueError("a block of token ids is damaged")
    fill = np.frombuffer(data, "<u4", lanes, 12).astype(np.int64)
    if len(data) != 16 + 4 * lanes + 4 * int(fill.sum()):
        raise ValueError("a block of token ids is damaged")
    words = np.zeros((lanes, int(fill.max()) + 1), _U)
    words[np.arange(words.shape[1]) < fill[:, None]] = np.frombuffer(data, "<u4", int(fill.sum()), 12 + 4 * lanes)
    words = np.ascontiguousarray(words.T)
    end = len(words) - 1
    grid, model = np.zeros((steps, lanes), np.uint32), _Model(lanes, top)
    ahead, span, at = (words[0] << _U(32)) | words[min(1, end)], np.full(lanes, (1 << 64) - 1, _U), np.full(lanes, 2, np.int64)
    for s in range(steps):
        m = _lanes_at(s, n, steps, lanes)
        slot, id2, id1, place, s2, s1 = model.predict(m)
        x, width = ahead[:m], span[:m]
        unit = width >> _U(16)
        first, second = s2 * unit, s1 * unit
        right2 = x < first
        seen = np.where(right2, id2, id1)
        x = x - np.where(right2, _U(0), first)
        miss = np.flatnonzero(~right2 & (x >= second))
        a, b, fa, fb, total = model.rest(id2[miss], id1[miss])
        unit = (width[miss] - first[miss] - second[miss]) // total
        y = x[miss] - second[miss]
        inner = np.minimum(y // np.maximum(unit, _U(1)), total - _U(1)).astype(np.uint32)
        inner += np.where(inner >= model.cum[a], fa, np.uint32(0))
        inner += np.where(inner >= model.cum[b], fb, np.uint32(0))
        found = model.find(inner)
        x[miss] = y - model.start(found, a, b, fa, fb) * unit
        seen[miss] = found
        width = np.where(right2, first, second)
        width[miss] = model.frequency[found] * unit
        go = np.flatnonzero(width < _LEAST)
        x[go] = (x[go] << _U(32)) | words[np.minimum(at[go], end), go]
        at[go] += 1
        width[go] <<= _U(32)
        ahead[:m], span[:m], grid[s, :m] = x, width, seen
        model.update(seen, slot, id2, id1, place)
    ids = grid.T.ravel()[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != struct.unpack_from("<I", data, len(data) - 4)[0]:
        raise ValueError("a block of token ids is damaged")
    return ids


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on in turn."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


class WordIds(dict):
    """Piece of a word -> its ids as little-endian 16-bit integers. Tokens of these tokenizers don't cross white space, so the distinct words of a batch are encoded one by one.

    Pieces stay here until they are more than `limit`; then they are forgotten and learned again.

    For a tokenizer of the kind "NFC, white space, lower case; split by pattern, byte level; word ends", words of Latin-1
    letters and ASCII signs are cut here as its pattern does, and only pieces not known yet go through its merges, many
    at a time: each ends with the only id of it that has the word end. Other words, and all words of other tokenizers,
    go through the whole of it.
    """

    def __init__(self, tokenizer_path: str, limit: int = 800_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit = Tokenizer.from_file(tokenizer_path), limit
        with open(tokenizer_path, encoding="utf-8") as f:
            told = json.load(f)
        kinds = [[x["type"] for x in (told.get(k) or {}).get(n, [])] for k, n in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        end, self.merges = told["model"].get("end_of_word_suffix"), None
        if kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and end:
            split, byte_level = told["pre_tokenizer"]["pretokenizers"]
            if split["pattern"].get("Regex") == _PATTERN and not byte_level["add_prefix_space"]:
                self.merges = Tokenizer(self.tokenizer.model)
                self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
                self.special = [t["content"] for t in told.get("added_tokens", [])]
                self.signs = np.array([ord(x) for x in _byte_signs()], "<u4")
                self.signs[0x20] = 0x20  # stands between pieces
                self.ends = np.zeros(IDS, bool)
                self.ends[[i for token, i in told["model"]["vocab"].items() if token.endswith(end)]] = True

    def _merge(self, pieces: list[str]) -> None:
        shown = " ".join(pieces)
        if not shown.isascii():
            shown = self.signs[np.frombuffer(shown.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u2")
        last = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        raw = ids.tobytes()
        self.update(zip(pieces, [raw[2 * a : 2 * b] for a, b in zip([0, *last], last, strict=False)], strict=True))

    def _plain(self, words: list[str]) -> list[bytes]:
        cut = _PIECES("\n".join(words).lower() + "\n")
        new = list(set(cut) - self.keys())
        for at in range(0, len(new), 2000):
            self._merge(new[at : at + 2000])
        return b"".join(map(self.__getitem__, cut)).split(_MARK)[: len(words)]

    def _odd(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self]
        for text, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self[text] = struct.pack(f"<{len(e.ids)}H", *e.ids)
        return [self[w] for w in words]

    def ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self) > self.limit:
            self.clear()
        self["\n"] = _MARK
        if self.merges is None:
            return self._odd(words)
        whole = "".join(words)
        if not _ODD(whole) and not any(x in whole for x in self.special):
            return self._plain(words)
        odd = np.fromiter((bool(_ODD(w)) or any(x in w for x in self.special) for w in words), bool, len(words)).tolist()
        known = [iter(f([w for w, o in zip(words, odd, strict=True) if o is kind])) for f, kind in ((self._plain, False), (self._odd, True))]
        return [next(known[o]) for o in odd]

    def flat(self, texts: pa.Array, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with `end` at its end, and how many each text has. Null counts as empty."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        ids = [*self.ids(words), struct.pack("<H", end)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        at = np.insert(at.astype(np.int64), bounds[1:], len(words))
        n = size[at]
        first, stop = np.cumsum(size) - size, np.cumsum(n)
        stream = np.frombuffer(b"".join(ids), "<u2")[np.arange(stop[-1] if len(stop) else 0) + np.repeat(first[at] - stop + n, n)]
        ends = stop[bounds[1:] + np.arange(len(texts))]
        return stream, np.diff(ends, prepend=0)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, then END_ID."""
        stream, n = self.flat(pa.array(texts, pa.binary()).cast(pa.string()))
        return np.split(stream, np.cumsum(n)[:-1])


@lru_cache(maxsize=1)
def word_ids(tokenizer_path: str) -> WordIds:
    """One lookup a worker process, so that its later tasks find the tokenizer loaded and frequent words known."""
    return WordIds(tokenizer_path)


#: Anything but printable ASCII and the letters of Latin-1, which composing and lower-casing treat sign by sign.
_ODD = re.compile(r"[^\x21-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]").search
#: The pattern for which `_PIECES` cuts lower-cased words of those signs, joined by line ends, in the same way.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^\s0-9a-z\xDF-\xF6\xF8-\xFF]+").findall
_MARK = b"\xff\xff"  #: no id has this high byte: ids of words stay below 0xFF00

FILE_SCHEMA = "part int, chunk int, doc_ids array<long>, lengths array<long>, blocks array<binary>"


def _write(tokenizer_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunk, words = TaskContext.get().partitionId(), 0, word_ids(tokenizer_path)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            stream = np.concatenate([x[2] for x in held])
            blocks = [encode_block(stream[i : i + CHUNK]) for i in range(0, len(stream), CHUNK)]
            columns = ([part], [chunk], [[d for x in held for d in x[0].to_pylist()]], [np.concatenate([x[1] for x in held])], [blocks])
            types = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "chunk", "doc_ids", "lengths", "blocks"])

        for batch, _ in pieces(batches, 6 << 20, 4000):
            stream, n = words.flat(batch["text"])
            if size and size + len(stream) > CHUNK:
                yield close()
                held, size, chunk = [], 0, chunk + 1
            held.append((batch["doc_id"], n, stream))
            size += len(stream)
        if held:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, bytes_per_part: int = 16 << 20) -> DataFrame:
    """Writes the ids of every document, in ascending doc_id order (null first), under `path`; returns the files read.

    A row of the files is a chunk of some CHUNK ids: whole documents, their doc_ids and numbers of ids, and the encoded blocks. `part` and
    `chunk` give the order. Null texts are empty and have the end id only. Rows that repeat a doc_id keep each their ids,
    in an order that their texts set. An empty table gives no chunks.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(2 * spark.sparkContext.defaultParallelism, size // bytes_per_part + 1)
    ordered = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
    ordered.select("doc_id", "text").mapInArrow(_write(tokenizer_path), FILE_SCHEMA).write.option("compression", "none").parquet(path)
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32")
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.concatenate([decode_block(x) for x in row["blocks"]]).astype("<u4")
            at = np.concatenate(([0], np.cumsum(row["lengths"])))
            if at[-1] != len(ids):
                raise ValueError("a chunk's documents and blocks differ in length")
            raw, n = ids.tobytes(), len(row["doc_ids"])
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            columns = ([row["part"]] * n, [row["chunk"]] * n, row["doc_ids"], at[:-1].tolist(), row["lengths"], crc)
            types = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded files."""
    rows = save(files.mapInArrow(_read, "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long"), "token-rows")
    sizes = rows.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_at"))  # a row a part
    starts = sizes.select("part", "chunk", (F.sum("n").over(Window.partitionBy("part").orderBy("chunk")) - F.col("n")).alias("chunk_at")).join(parts, "part")
    return rows.join(starts, ["part", "chunk"]).select("doc_id", (F.col("part_at") + F.col("chunk_at") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op4_context_mixing(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Encodes, writes and reads back every document; by default with the tokenizer `word_bpe_49k.json`."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return read_tokens(write_tokens(docs, scratch_path(docs.sparkSession, "token-ids"), tokenizer_path))

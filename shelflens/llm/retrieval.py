"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

The documents are laid down once as blocks of an inverted index over the terms that the items hold; a bit filter of
bounded size tells these terms while texts are read. Each task then searches its blocks for a block of items at a time.
An item's terms are taken rarest first. While a document not met yet could still come among the best, its accumulator
is made; once what the terms left can add at most is less than the kth partial score, only the accumulators there are
are updated, to their exact scores. The best of all tasks are merged for each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import Memo, filter_bits, filter_of, passes, pieces, save

#: Bytes of a term stay, A-Z in lower case; all others part terms.
TERM_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
BLOCK_DOCS, BLOCK_BYTES = 4096, 32 << 20
INDEX_SCHEMA = "doc_ids array<long>, n array<long>, terms array<string>, sizes array<int>, places binary, tfs binary"


def cut_terms(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct terms of all texts, the place of each occurrence's term in that list, and where each text's occurrences begin."""
    split = pc.ascii_split_whitespace(pa.array([x.translate(TERM_BYTES).strip() for x in texts], pa.binary()).cast(pa.string()))
    coded = split.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), split.offsets.to_numpy().astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the distinct terms of each item; items that share an id are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            words, codes, starts = cut_terms(texts)
            ids = batch["item_id"].take(pa.array(np.repeat(np.arange(len(texts)), np.diff(starts))))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(words, pa.string()).take(pa.array(codes))], ["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, "item_id long, term string").where("term <> ''").distinct()


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Blocks of up to BLOCK_DOCS documents or BLOCK_BYTES of text: ids and lengths of all documents, and the postings of
    those of their terms that `terms` (term) holds, or nearly so: a few others pass its filter.

    A term's postings are `sizes` numbers of `places` (in the block) and of `tfs`, one term after the other.
    """
    hashed = save(terms.select(F.xxhash64("term").alias("value")).distinct(), "lexical-terms")
    bits = filter_bits(hashed.count())
    packed = docs.sparkSession.sparkContext.broadcast(filter_of(hashed, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Memo(lambda word: bool(word) and bool(passes(packed.value, np.array([xxhash.xxh64_intdigest(word, 42)], np.uint64), bits)[0]))
        ids, lengths, found, held = [], [], [], 0
        known: dict[str, int] = {}

        def close() -> pa.RecordBatch:
            term, place, tf = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((place, term))
            columns = ([ids], [np.concatenate(lengths)], [list(known)], [np.bincount(term, minlength=len(known))], [place[order].astype("<i4").tobytes()], [tf[order].astype("<i4").tobytes()])
            types = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_ids", "n", "terms", "sizes", "places", "tfs"])

        for batch, texts in pieces(batches, 4 << 20):
            size = sum(map(len, texts))
            if ids and (len(ids) + len(texts) > BLOCK_DOCS or held + size > BLOCK_BYTES):
                yield close()
                ids, lengths, found, held, known = [], [], [], 0, {}
            words, codes, starts = cut_terms(texts)
            place = np.repeat(np.arange(len(texts)), np.diff(starts))
            real = np.array([w != "" for w in words], bool)
            lengths.append(np.bincount(place[real[codes]], minlength=len(texts)))
            keep = np.array([wanted[w] for w in words], bool)[codes]
            pair, tf = np.unique(codes[keep] * len(texts) + place[keep], return_counts=True)
            code, at = np.divmod(pair, len(texts)) if len(texts) else (pair, pair)
            local, inverse = np.unique(code, return_inverse=True)
            numbers = np.array([known.setdefault(words[c], len(known)) for c in local.tolist()], np.int64)
            found.append((numbers[inverse] if len(numbers) else code, at + len(ids), tf))
            ids = ids + batch["doc_id"].to_pylist()
            held += size
        if ids:
            yield close()

    return save(docs.select("doc_id", "text").mapInArrow(run, INDEX_SCHEMA), "lexical-index")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block:
    """Postings of one block with what each may add to a score, for a term at a time."""

    def __init__(self, row: dict, documents: int, length: int):
        self.doc_ids = row["doc_ids"]
        self.m = np.array([10 + 90 * n * documents // length if length else 10 for n in row["n"]], np.int64)
        ends = np.cumsum(row["sizes"], dtype=np.int64)
        self.span = {t: (b - s, b) for t, b, s in zip(row["terms"], ends.tolist(), row["sizes"], strict=True)}
        self.places, self.tfs = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["tfs"], "<i4")
        self.parts: dict[str, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: str) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Documents of a term, ascending, their share of its weight, and the greatest share."""
        if term not in self.span:
            return None
        if term not in self.parts:
            a, b = self.span[term]
            place, tf = self.places[a:b], self.tfs[a:b].astype(np.int64)
            part = 1_000_000_000 * tf // (1000 * tf + 8 * self.m[place])
            self.parts[term] = place, part, int(part.max())
        return self.parts[term]

    def best(self, terms: list[tuple[str, int]], k: int, floor: int = -1) -> list[tuple[int, int | None]]:
        """(score, doc_id) of the k best documents for terms (term, weight), the rarest first; ties by smaller doc_id, null last.

        `floor` is a score that k documents elsewhere have already.
        """
        lists = [(w, *found) for term, w in terms if w > 0 and (found := self.postings(term))]
        if not lists:
            return []
        bounds = [w * most for w, _, _, most in lists]
        rest, before = sum(bounds), 0
        score, met, closed = np.zeros(len(self.doc_ids), np.int64), np.zeros(len(self.doc_ids), bool), False
        for (w, place, part, _), bound in zip(lists, bounds, strict=True):
            if not closed and (rest < floor or (rest < before and self._kth(score, k) > rest)):
                closed = True  # no document first met from here on can come among the best
            if closed:
                known = met[place]
                place, part = place[known], part[known]
            else:
                met[place] = True
            score[place] += w * part
            rest, before = rest - bound, before + bound
        least = max(self._kth(score, k), 1, floor)
        found = np.flatnonzero(score >= least)
        return sorted(((int(score[i]), self.doc_ids[i]) for i in found.tolist()), key=_rank)[:k]

    @staticmethod
    def _kth(score: np.ndarray, k: int) -> int:
        return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0


def _rank(row: tuple[int, int | None]) -> tuple:
    score, doc = row
    return -score, doc is None, doc or 0


def _search(queries: list[tuple[int | None, list[tuple[str, int]]]], documents: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in queries.value]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], documents, length)
                for q, (_, terms) in enumerate(queries.value):
                    had = best[q]
                    if new := block.best(terms, k, had[-1][0] if len(had) == k else -1):
                        best[q] = sorted(had + new, key=_rank)[:k]
        rows = [(item, doc, score) for (item, _), found in zip(queries.value, best, strict=True) for score, doc in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["item_id", "doc_id", "score"])

    return run


def _blocks(rows: Iterator[Row], documents: int, size: int) -> Iterator[list[tuple[int | None, list[tuple[str, int]]]]]:
    """Items with their weighted terms, in blocks of some `size` terms (or one item); rows (item_id, term, df) come sorted by item, the rarest term first."""
    block, held = [], 0
    for item, group in groupby(rows, key=lambda r: r["item_id"]):
        terms = [(r["term"], weight(documents, r["df"])) for r in group]
        if block and held + len(terms) > size:
            yield block
            block, held = [], 0
        block.append((item, terms))
        held += len(terms)
    if block:
        yield block


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = 200_000) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` documents of the highest scores above 0 for each item, ties by ascending doc_id.

    Terms are runs of ASCII letters, digits and signs beyond ASCII; only A-Z are lower-cased. Of a document of n terms
    (N documents have any, L terms in all) a term that occurs tf times in it and in df documents adds
    w * (10^9 tf div (1000 tf + 8 m)) with w = floor(1000 ln((2N+2)/(2df+1))) and m = 10 + (90 n N div L).

    Items with the same id are one item with the terms of all of them, a null id like any other; items without a term
    that occurs have no rows. Null and empty texts hold no term. Each row of `docs` is a document, those that repeat a
    doc_id too; a null doc_id stands last among equal scores. Texts of any length are read whole; a document longer
    than BLOCK_BYTES is a block alone. Other columns are not read. Empty tables give no rows.

    The items go to the tasks in blocks of `block_terms` terms, so what a task and the driver hold of them is bounded.
    """
    spark = docs.sparkSession
    asked = save(item_terms(items), "lexical-items")
    index = build_index(docs, asked.select("term"))
    lengths = index.select(F.explode("n").alias("n")).agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    postings = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.sizes").alias("df"))
    rows = save(asked.join(postings, "term").select("item_id", "term", "df"), "lexical-weights").orderBy("item_id", "df", "term")
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in _blocks(rows.toLocalIterator(), lengths["documents"], block_terms):
        queries = spark.sparkContext.broadcast(block)
        found = found.unionByName(save(index.mapInArrow(_search(queries, lengths["documents"], lengths["length"], k), found.schema), "lexical-found"))
        queries.unpersist()
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rank_documents(docs, items)

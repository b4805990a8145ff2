"""Toxicity by maximum-scoring segments of token log-odds.

A word counts as three tokens, itself and two prefixes that stand for its stem, hashed to a fixed number of buckets. A
bucket's score is the log-odds of a document holding it between toxic and clean labelled documents, under a Dirichlet
prior in proportion to the documents of the whole corpus that hold it, drawn towards zero by its own uncertainty. A
word scores as its surest token, wherever it stands (less if it stood a few words before), less a small drift, so that a run of ordinary words scores below
zero. One pass over a text finds every maximal positive segment. The best segments' score, set against the extreme-value (Gumbel) law that clean labelled texts of that
length follow, is turned into a probability by a logistic curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PUNCTUATION, Memo, pieces, save

BITS = 19
BUCKETS = 1 << BITS
PREFIXES = (7, 5)
#: Words from which a repeated one scores in full; nearer ones score in proportion, so that a word said over and over isn't a passage.
REPEAT = 20
#: Labelled documents are scored for the calibration by weights of all folds but their own, so nearly by those of new documents.
FOLDS = 10
PARTS = 8  #: tasks that count the labelled documents, each with a table of all folds and buckets


@dataclass(frozen=True)
class Params:
    max_train: int = 40_000  #: labelled documents to learn from, at most; the rest of the labels is not read
    prior: float = 0.2  #: tokens that the Dirichlet prior counts for, to those of the labelled documents
    z: float = 1.64  #: standard errors by which log-odds are drawn towards zero
    drift: float = 0.2  #: taken from each word's score
    p_value: float = 0.01  #: of a segment that is reported as a toxic passage
    threshold: float = 0.7  #: score from which a document is predicted toxic


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    scale: float  #: Gumbel scale of the best segment in clean texts
    location: float  #: its location for a text of one word, growing with the logarithm of the length
    slope: float
    intercept: float
    params: Params

    def surprise(self, best: float, words: int) -> float:
        """-ln P(a clean text of so many words has as good a segment)."""
        if best <= 0:  # any text has as good a one
            return 0.0
        x = (best - self.location) / self.scale - math.log(max(words, 1))
        tail = -math.expm1(-math.exp(-x)) if x > -30 else 1.0
        return -math.log(tail) if tail > 1e-280 else x

    def score(self, best: float, words: int) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.intercept + self.slope * self.surprise(best, words)))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), ends exclusive, in linear time.

    Words of negative score only add to the gap between the positive ones, so only the latter are visited.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    before = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # start, end, sum before it, sum at its end, nearest earlier one that began lower
    for i, left, right in zip(at.tolist(), before[at].tolist(), before[at + 1].tolist(), strict=True):
        start, end = i, i + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, r - l) for a, b, l, r, _ in found]


def tokens_of(word: bytes) -> int:
    """The buckets of a word and of its prefixes, lower-cased and without punctuation at its ends, in one number."""
    token, out = word.decode("utf-8", "replace").lower().strip(PUNCTUATION.decode()), 0
    for i, n in enumerate((None, *PREFIXES)):
        out |= (xxhash.xxh64_intdigest(token[:n].encode(), 11) % BUCKETS) << (BITS * i)
    return out


def _words(text: bytes, memo: Memo) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))


def _buckets(words: np.ndarray) -> np.ndarray:
    return words[:, None] >> (BITS * np.arange(1 + len(PREFIXES))) & (BUCKETS - 1)


def word_scores(words: np.ndarray, weights: np.ndarray, drift: float) -> np.ndarray:
    odds = weights[_buckets(words)]
    score = np.take_along_axis(odds, np.abs(odds).argmax(1)[:, None], 1)[:, 0].astype(float)
    order = np.argsort(words, kind="stable")
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]]) + 1
    gap = np.full(len(words), REPEAT)
    gap[order[again]] = np.minimum(order[again] - order[again - 1], REPEAT)
    return np.where(score > 0, score * (gap / REPEAT), score) - drift


def _count_labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each bucket, by fold and label."""
    memo, counts = Memo(tokens_of), np.zeros((FOLDS, 2, BUCKETS), np.int32)
    for batch, texts in pieces(batches):
        for text, label, fold in zip(texts, batch["label"].to_pylist(), batch["fold"].to_pylist(), strict=True):
            counts[fold, label, np.unique(_buckets(np.unique(_words(text, memo))))] += 1
    at = np.flatnonzero(counts.ravel())
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts.ravel()[at], pa.int64())], ["place", "n"])


def _count_all(asked):
    """Documents that hold each of the buckets that labelled ones hold, and those of all buckets together under -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts, total = Memo(tokens_of), np.zeros(BUCKETS, np.int64), 0
        for _, texts in pieces(batches):
            for text in texts:
                found = np.unique(_buckets(np.unique(_words(text, memo))))
                counts[found] += 1
                total += len(found)
        at = np.flatnonzero((counts > 0) & np.unpackbits(np.frombuffer(asked.value, np.uint8)).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(counts[at], total), pa.int64())], ["place", "n"])

    return run


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Counts by place from 0 to `size`, and that of place -1 last."""
    out = np.zeros(size + 1, np.int64)
    for batch in rows.groupBy("place").agg(F.sum("n").alias("n")).toArrow().to_batches():  # a row a place
        out[batch["place"].to_numpy()] = batch["n"].to_numpy()
    return out


def log_odds(clean: np.ndarray, toxic: np.ndarray, corpus: np.ndarray, p: Params) -> np.ndarray:
    """Of each bucket; `corpus` ends with the sum of all, those without a labelled document too."""
    prior = p.prior * float(clean.sum() + toxic.sum()) * corpus[:-1] / max(corpus[-1], 1) + 1e-9
    a, b = toxic + prior, clean + prior
    odds = np.log(a / a.sum()) - np.log(b / b.sum())
    sure = np.maximum(np.abs(odds) - p.z * np.sqrt(1 / a + 1 / b), 0) * np.sign(odds)
    return sure.astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """text, label (0, 1) and fold of at most `max_train` labelled documents, written to the shared folder.

    Only rows whose crc32(doc_id as text) mod 3 isn't 1 may teach. Of repeated labels the largest counts; null labels
    don't. The labels are broadcast: `max_train` bounds them.
    """
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(p.max_train)
        .withColumn("fold", (F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(FOLDS))).cast("int"))
    )
    return save(docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("text", "label", "fold"), "toxic-labelled")


def _best(found: list[tuple[int, int, float]], scale: float) -> float:
    """The segments' scores together: their soft maximum, which is the best one's unless others come near."""
    if not found:
        return 0.0
    top = max(x[2] for x in found)
    return top + scale * math.log(sum(math.exp((x[2] - top) / scale) for x in found))


def _samples(weights, drift: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(tokens_of)
        for batch, texts in pieces(batches):
            rows = [
                (label, len(found), _best(segments(word_scores(found, weights.value[fold], drift)), 1.0))
                for text, label, fold in zip(texts, batch["label"].to_pylist(), batch["fold"].to_pylist(), strict=True)
                for found in [_words(text, memo)]
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.float64()))], ["label", "words", "best"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept by Newton steps with a slight ridge."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve(a.T @ (a * (q * (1 - q))[:, None]) + np.diag([1e-2, 1e-2]), a.T @ (y - q) - 1e-2 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Learns from `labels` (doc_id, toxic); the prior is the token counts of all of `docs`.

    With no label of either kind every score is the share of toxic labels, or 0 if there is none.
    """
    spark, known = docs.sparkSession, labelled(docs, labels, p)
    taught = _summed(known.coalesce(PARTS).mapInArrow(_count_labelled, "place long, n long"), FOLDS * 2 * BUCKETS)[:-1].reshape(FOLDS, 2, BUCKETS)
    whole = taught.sum(0)
    asked = spark.sparkContext.broadcast(np.packbits(whole.sum(0) > 0).tobytes())
    corpus = _summed(docs.select("text").mapInArrow(_count_all(asked), "place long, n long"), BUCKETS)
    held_out = [log_odds(*(whole - fold), corpus, p) for fold in taught]
    weights, shared = log_odds(*whole, corpus, p), spark.sparkContext.broadcast(np.stack(held_out))
    sample = known.mapInArrow(_samples(shared, p.drift), "label int, words long, best double").toPandas()
    y, n, best = sample["label"].to_numpy(float), np.maximum(sample["words"].to_numpy(float), 1), sample["best"].to_numpy(float)
    shared.unpersist()
    return calibrate(weights, y, n, best, p)


def calibrate(weights: np.ndarray, y: np.ndarray, n: np.ndarray, best: np.ndarray, p: Params) -> Model:
    """The Gumbel law of clean texts' best segments and the logistic curve, from labels, lengths and scores that no document's own label has shaped."""
    if not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        return Model(weights, 1.0, 0.0, 0.0, math.log((share + 1e-6) / (1 - share + 1e-6)), p)
    # Best segments of clean texts: location + scale * (ln words + a standard Gumbel variable), by moments.
    null, length = best[y == 0], np.log(n[y == 0])
    scale = max(float(np.std(null)) * math.sqrt(6) / math.pi, 0.25)
    model = Model(weights, scale, float(null.mean() - scale * (length.mean() + np.euler_gamma)), 1.0, 0.0, p)
    slope, intercept = _logistic(np.array([model.surprise(b, int(w)) for b, w in zip(best, n, strict=True)]), y)
    return Model(weights, scale, model.location, slope, intercept, p)


def _score(model: Model, passages: bool):
    weights, drift, names = model.weights, model.params.drift, ["score", "predicted", "passages"]

    def one(text: bytes, memo: Memo) -> tuple[float, list]:
        found = _words(text, memo)
        cuts = segments(word_scores(found, weights, drift))
        score = model.score(_best(cuts, 1.0), len(found))
        if not passages:
            return score, []
        limit = -math.log(model.params.p_value)
        return score, [{"start": a, "end": b, "score": s} for a, b, s in cuts if model.surprise(s, len(found)) >= limit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(tokens_of)
        for batch, texts in pieces(batches, column="_text"):
            rows = [one(text, memo) for text in texts]
            score = pa.array([r[0] for r in rows], pa.float64())
            predicted = pa.array([int(r[0] >= model.params.threshold) for r in rows], pa.int32())
            spans = pa.array([r[1] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            own = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in own] + [score, predicted, spans], [batch.schema.names[i] for i in own] + names)

    return run


def score_documents(docs: DataFrame, labels: DataFrame, p: Params = Params(), passages: bool = True) -> DataFrame:
    """doc_id, score, predicted and `passages` (word offsets and scores of the significant toxic segments) of every document.

    Null and empty texts have no segment and get the score of a clean text; an empty table gives an empty result;
    repeated rows are scored alike. Columns other than doc_id and text are not read.
    """
    model = fit(docs, labels, p)
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(
        _score(model, passages), "doc_id long, score double, predicted int, passages array<struct<start:long,end:long,score:double>>"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of `docs`, all columns kept, that aren't predicted toxic by their own whole text.

    Null and empty texts stay unless most labels are toxic; rows that repeat a doc_id, or have none, are judged each by
    its text. An empty table stays empty.
    """
    model = fit(docs, labels, p)
    columns = docs.columns
    inner = [f"_c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, docs.schema.fields, strict=True))
    marked = docs.select(F.col("text").alias("_text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, inner, strict=True)]).mapInArrow(
        _score(model, False), f"{schema}, score double, predicted int, passages array<struct<start:long,end:long,score:double>>"
    )
    return marked.where("predicted = 0").select(*[F.col(n).alias(c) for c, n in zip(columns, inner, strict=True)])

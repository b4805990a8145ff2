"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade <= k) = logistic(threshold_k - w.x): one weight vector over hashed text features is shared by all grades, and
the thresholds are kept in order by writing each as the one before plus a positive step. Training is L-BFGS on the
full gradient; each step is one Spark job over the featurised sample. Expected grade and tail probability select.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, pieces, save, token_bucket

BUCKETS = 1 << 16
_RUNS = re.compile(r"([a-zß-ÿ])[a-zß-ÿ]*|([A-ZÀ-Þ])[A-ZÀ-Þ]*|(\d)\d*")


@dataclass(frozen=True)
class Params:
    max_train: int = 20_000  #: rated documents to learn from, at most
    max_grades: int = 100
    parts: int = 8  #: of the sample
    ridge: float = 1e-4
    steps: int = 30
    tail: float = 0.5  #: a document is kept if P(grade >= the grade asked for) reaches this


@dataclass(frozen=True)
class Model:
    grades: tuple[float, ...]
    weights: np.ndarray
    thresholds: np.ndarray


def shape(word: bytes) -> int:
    """Bucket of a word's outline: runs of lower-case letters, capitals and digits shrink to one sign each."""
    text = _RUNS.sub(lambda m: "a" if m[1] else "A" if m[2] else "0", word.decode("utf-8", "replace"))
    return xxhash.xxh64_intdigest(text.encode(), 17) % BUCKETS


def features(text: bytes, tokens: Memo, shapes: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: damped frequencies of tokens and outlines as unit vectors, shares of repeated words and of an empty text."""
    words = text.split()
    if not words:
        return np.array([xxhash.xxh64_intdigest(b"empty", 19) % BUCKETS]), np.ones(1)
    out: Counter = Counter()
    for memo in (tokens, shapes):
        found = Counter(map(memo.__getitem__, words))
        x = np.log1p(np.fromiter(found.values(), float, len(found)))
        x /= np.sqrt((x * x).sum())
        for k, v in zip(found, x.tolist(), strict=True):
            out[k] += v
    again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
    for name, v in ((b"again", again), (b"distinct", len(set(words)) / len(words)), (b"length", np.log1p(len(words)) / 10)):
        out[xxhash.xxh64_intdigest(name, 19) % BUCKETS] += v
    return np.fromiter(out.keys(), np.int64, len(out)), np.fromiter(out.values(), float, len(out))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, shapes = Memo(token_bucket(BUCKETS)), Memo(shape)
    for batch, texts in pieces(batches):
        rows = [features(x, tokens, shapes) for x in texts]
        yield pa.RecordBatch.from_arrays([batch["grade"], pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["grade", "at", "x"])


def unpack(theta: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logarithms of the steps."""
    return np.cumsum(np.concatenate((theta[:1], np.exp(theta[1:]))))


def loss_and_gradient(at: np.ndarray, x: np.ndarray, row: np.ndarray, grade: np.ndarray, w: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """[loss, gradient by weights, gradient by theta] summed over rows; `row` names the row of each feature."""
    score = np.bincount(row, x * w[at], len(grade))
    cut = np.concatenate(([-np.inf], unpack(theta), [np.inf]))
    hi, lo = 1 / (1 + np.exp(-np.clip(cut[grade + 1] - score, -60, 60))), 1 / (1 + np.exp(-np.clip(cut[grade] - score, -60, 60)))
    p = np.maximum(hi - lo, 1e-12)
    d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
    g_w = np.bincount(at, x * ((d_hi - d_lo) / p)[row], len(w))
    k = len(theta)
    g_cut = np.bincount(np.minimum(grade, k - 1), np.where(grade < k, -d_hi / p, 0), k) + np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, d_lo / p, 0), k)
    g_theta = np.cumsum(g_cut[::-1])[::-1].copy()
    g_theta[1:] *= np.exp(theta[1:])
    return np.concatenate(([-np.log(p).sum()], g_w, g_theta))


def _partial(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, theta = shared.value
        total = np.zeros(1 + len(w) + len(theta))
        for batch in batches:
            at, x = batch["at"], batch["x"]
            n = np.diff(at.offsets.to_numpy())
            total += loss_and_gradient(at.flatten().to_numpy(), x.flatten().to_numpy().astype(float), np.repeat(np.arange(len(n)), n), batch["grade"].to_numpy(), w, theta)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return run


def lbfgs(value, start: np.ndarray, steps: int, keep: int = 8) -> np.ndarray:
    """Minimises value(x) -> (f, gradient) by limited-memory BFGS with halving steps."""
    x = start
    f, g = value(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, alphas = -g, []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            alphas.append(a)
            d = d - a * y
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(alphas), strict=True):
            d = d + s * (a - (y @ d) / (s @ y))
        step = 1.0 if pairs else 1.0 / max(np.linalg.norm(g), 1e-12)
        for _ in range(12):
            new, (nf, ng) = x + step * d, value(x + step * d)
            if nf <= f + 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            break
        if (new - x) @ (ng - g) > 1e-12:
            pairs = [*pairs, (new - x, ng - g)][-keep:]
        small = f - nf < 1e-6 * max(abs(f), 1e-9)
        x, f, g = new, nf, ng
        if small:
            break
    return x


def fit(docs: DataFrame, ratings: DataFrame, grade: str = "quality", p: Params = Params()) -> Model:
    """Learns from `ratings` (doc_id and the graded column); at most `max_train` rated documents, the same at each run.

    Null ratings teach nothing; of repeated ones the largest counts. A single grade, or none, gives a model that
    expects it (0 if there is none).
    """
    rated = ratings.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col(grade).cast("double")).alias("_g"))
    grades = [r["_g"] for r in rated.select("_g").distinct().orderBy("_g").limit(p.max_grades + 1).collect()]
    if len(grades) > p.max_grades:
        raise ValueError(f"more than {p.max_grades} grades")
    if len(grades) < 2:
        return Model(tuple(grades) or (0.0,), np.zeros(BUCKETS), np.zeros(0))
    sample = rated.orderBy(F.xxhash64("_id"), "_id").limit(p.max_train).withColumn("grade", (F.array_position(F.array(*map(F.lit, grades)), F.col("_g")) - 1).cast("int"))
    known = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("text", "grade").repartition(p.parts)  # each sends a gradient to the driver at each step
    table = save(known.mapInArrow(_featurise, "grade int, at array<int>, x array<float>"), "quality-features")
    count = {r["grade"]: r["count"] for r in table.groupBy("grade").count().collect()}
    n = sum(count.values())
    if not n:
        return Model((grades[0],), np.zeros(BUCKETS), np.zeros(0))
    below = np.cumsum([count.get(i, 0) + 0.5 for i in range(len(grades))])[:-1] / (n + 0.5 * len(grades))
    cut = np.log(below / (1 - below))
    theta = np.concatenate((cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))))
    context = docs.sparkSession.sparkContext

    def value(v: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((v[:BUCKETS], v[BUCKETS:]))
        total = sum(np.frombuffer(r["part"]) for r in table.mapInArrow(_partial(shared), "part binary").toLocalIterator(prefetchPartitions=True)) / n
        shared.destroy()
        w = v[:BUCKETS]
        total[1 : 1 + BUCKETS] += 2 * p.ridge * w
        return float(total[0] + p.ridge * (w @ w)), total[1:]

    v = lbfgs(value, np.concatenate((np.zeros(BUCKETS), theta)), p.steps)
    return Model(tuple(grades), v[:BUCKETS], unpack(v[BUCKETS:]))


def probabilities(model: Model, score: float) -> np.ndarray:
    """P(grade >= k) of every grade."""
    return np.concatenate(([1.0], 1 - 1 / (1 + np.exp(-np.clip(model.thresholds - score, -60, 60)))))


def rate(docs: DataFrame, model: Model, least: float | None = None, p: Params = Params()) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of `least` or better; null: the best grade) and keep of every document.

    Null texts count as empty, which is a feature of its own; repeated rows are rated alike.
    """
    asked = len(model.grades) - 1 if least is None else min(i for i, g in enumerate([*model.grades, np.inf]) if g >= least)
    value = np.array(model.grades)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tokens, shapes = Memo(token_bucket(BUCKETS)), Memo(shape)
        for batch, texts in pieces(batches):
            rows = []
            for text in texts:
                at, x = features(text, tokens, shapes)
                tail = probabilities(model, float(x @ model.weights[at]))
                expected = value[0] + float(np.diff(value) @ tail[1:])
                best = float(tail[asked]) if asked < len(tail) else 0.0
                rows.append((expected, best, int(best >= p.tail)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.float64(), pa.int32()))]], ["doc_id", "expected_grade", "tail_probability", "keep"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, keep int")


def op1_ordinal_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, tail_probability, keep of every row of `docs`, rated by its whole text.

    Null and empty texts have a feature of their own; rows that repeat a doc_id, or have none, are rated each by its
    text, so equal texts have equal grades. Null labels don't teach. Without labels, or with one grade only, all rows
    are rated alike. Other columns are not read. An empty table gives an empty result.
    """
    return rate(docs, fit(docs, labels))

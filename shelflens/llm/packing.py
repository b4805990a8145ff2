"""Packing of documents into training sequences whose mixture is controlled.

Each source is a queue of token ids. The windows that the sequences fill are taken in runs. Up to the start of a run
each queue has served what its share comes to, rounded; this needs nothing but the queues' lengths, so every task knows
which part of a queue belongs to which run. A run is then packed by deficit round-robin: a window adds to each queue's
deficit what its share of the window comes to, each queue serves the whole ids it is owed, and what is left over or
short carries on to the next window, and from the last window of a run to the next run.

A queue may hold a third of all ids: runs cut across queues, and all hold the same number of ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, save
from .tokencoding import word_ids

WINDOW, RUN = 2048, 128  #: ids of a sequence, windows of a run
END_ID = 1
MOST_QUEUES = 4096  #: with more sources than that, sources share queues by their hash
SMALL = 200_000  #: rows of a table that is broadcast

TOKENS = "part int, source string, at long, doc_id long, n long, ids binary"
CUT = "run long, queue int, pos long, doc_id long, start long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source_queue int, ids binary"


class Plan:
    """Which ids of each queue belong to which run. `sizes`: the ids of each queue; `weights`: their shares, by default the sizes."""

    def __init__(self, sizes: np.ndarray, weights: np.ndarray | None = None, window: int = WINDOW, run: int = RUN):
        self.sizes, self.window, self.run = sizes.astype(np.int64), window, run
        self.weights = (sizes if weights is None else weights).astype(np.float64)
        self.total = int(self.sizes.sum())
        self.runs = -(-self.total // (window * run))
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _count(self, v: float) -> np.ndarray:
        return np.minimum(self.sizes, np.floor(v * self.weights + 0.5).astype(np.int64))

    def served(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids that each queue has served before a run, and what its share of all these comes to.

        The ids of all queues are in the order of the times at which their shares come to them, so each queue's part
        grows from run to run. Times are halved until no number lies between those before and after.
        """
        if run not in self.known:
            if len(self.known) > 4096:
                self.known.clear()
            n = min(run * self.run * self.window, self.total)
            top = 2 * (self.sizes / np.where(self.sizes > 0, self.weights, 1.0)).max(initial=1.0) + 1
            low, high = 0, int(np.float64(top).view(np.int64))
            time = lambda bits: float(np.int64(bits).view(np.float64))
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if int(self._count(time(middle)).sum()) <= n else (low, middle)
            done = self._count(time(low))
            more = self._count(time(high)) - done
            done = done + np.clip(n - int(done.sum()) - (np.cumsum(more) - more), 0, more)
            self.known[run] = done, np.minimum(self.sizes, time(low) * self.weights)
        return self.known[run]

    def run_of(self, queue: int, pos: int) -> int:
        """The run that the id at a place of a queue belongs to."""
        guess = min(int(pos / int(self.sizes[queue]) * self.runs), self.runs - 1)
        low, high = max(guess - 1, 0), min(guess + 2, self.runs)
        before = lambda run: int(self.served(run)[0][queue])
        low, high = (0 if before(low) > pos else low), (self.runs if before(high) <= pos else high)
        return bisect_right(range(low, high), pos, key=before) + low - 1

    def windows(self, run: int) -> list[int]:
        """Ids of the run's sequences. What fills no whole window at the very end is cut at powers of two, which need no padding."""
        left = min(self.total - run * self.run * self.window, self.run * self.window)
        rest = left % self.window
        return [self.window] * (left // self.window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]

    def takes(self, run: int) -> np.ndarray:
        """Deficit round-robin over a run: ids of each queue (columns) in each of its windows (rows)."""
        (done, due), after = self.served(run), self.served(run + 1)[0]
        left, deficit = after - done, due - done
        out = np.zeros((len(self.windows(run)), len(left)), np.int64)
        for take, cap in zip(out, self.windows(run), strict=True):
            spare, open_ = float(cap), left > 0
            while abs(spare) >= 1 and open_.any():  # a queue that ends leaves its share to the others
                share = np.where(open_, self.weights, 0.0)
                deficit += share * (spare / share.sum())
                take[:] = np.clip(np.floor(deficit), 0, left)
                open_ = left > take
                spare = float((deficit - take)[~open_].sum())
                deficit = np.where(open_, deficit, take)
            while (short := cap - int(take.sum())) > 0:  # the next round: an id more of the queues that are owed most
                open_ = np.flatnonzero(left > take)
                first = open_[np.argsort(take[open_] - deficit[open_], kind="stable")][:short]
                take[first] += np.minimum(max(short // len(open_), 1), left[first] - take[first])
            while short < 0:  # an id less of those that are owed least
                some = np.flatnonzero(take)
                last = some[np.argsort(deficit[some] - take[some], kind="stable")][:-short]
                take[last] -= 1
                short += len(last)
            deficit -= take
            left = left - take
        return out


def _tokenize(tokenizer_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, words = TaskContext.get().partitionId(), word_ids(tokenizer_path)
        seen: dict[str | None, int] = defaultdict(int)
        for batch, _ in pieces(batches, 6 << 20, 4000):
            stream, n = words.flat(batch["text"], END_ID)
            at, sources = [], batch["source"].to_pylist()
            for source, size in zip(sources, n.tolist(), strict=True):
                at.append(seen[source])
                seen[source] += size
            raw = stream.astype("<u2").tobytes()
            ends = np.concatenate(([0], 2 * np.cumsum(n)))
            ids = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), batch["source"], pa.array(at, pa.int64()), batch["doc_id"], pa.array(n, pa.int64()), ids], ["part", "source", "at", "doc_id", "n", "ids"])

    return run


def _cut(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for queue, pos, doc, n, ids in zip(*(batch[c].to_pylist() for c in ("queue", "pos", "doc_id", "n", "ids")), strict=True):
                start, now = 0, plan.run_of(queue, pos)
                while start < n:
                    stop = min(n, int(plan.served(now + 1)[0][queue]) - pos)
                    if stop > start:
                        rows.append((now, queue, pos + start, doc, start, n, ids[2 * start : 2 * stop]))
                    start, now = max(start, stop), now + 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["run", "queue", "pos", "doc_id", "start", "doc_tokens", "ids"])

    return run


def _fill(plan: Plan, run: int, rows: pa.Table, keep_ids: bool) -> pa.RecordBatch:
    """The pieces of a run from its rows by (queue, pos)."""
    takes, caps = plan.takes(run), len(plan.windows(run))
    first = plan.served(run)[0]
    queue, pos, start = (rows[c].to_numpy() for c in ("queue", "pos", "start"))
    whole = np.frombuffer(b"".join(rows["ids"].to_pylist()), "<u2").astype("<u4")
    edges = np.flatnonzero(np.diff(queue)) + 1
    base, out = 0, []
    # Round-robin: each window begins with another queue.
    order = (np.arange(takes.shape[1]) + np.arange(caps)[:, None]) % max(takes.shape[1], 1)
    served = np.take_along_axis(takes, order, 1)
    ahead = np.empty_like(takes)
    np.put_along_axis(ahead, order, np.cumsum(served, 1) - served, 1)
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(queue)], strict=True):
        q = int(queue[a])
        begin, ends = pos[a:b] - first[q], np.cumsum(takes[:, q])
        cuts = np.union1d(begin, np.concatenate(([0], ends[:-1])))
        cuts = cuts[cuts < ends[-1]]
        row, window = np.searchsorted(begin, cuts, "right") - 1, np.searchsorted(ends, cuts, "right")
        if begin[0] != 0:
            raise ValueError("a queue's ids are missing")
        size = np.diff(cuts, append=ends[-1])
        out.append((row + a, start[row + a] + cuts - begin[row], size, window, ahead[window, q] + cuts - (ends[window] - takes[window, q]), base + cuts, np.full(len(cuts), q)))
        base += int(ends[-1])
    row, at, size, window, offset, place, q = (np.concatenate(x) for x in zip(*out, strict=True))
    if base != len(whole) or base != int(takes.sum()):
        raise ValueError("a run's ids are missing")
    raw = memoryview(whole.tobytes())
    cut = [raw[4 * a : 4 * b] for a, b in zip(place.tolist(), (place + size).tolist(), strict=True)]
    taken = pa.array(row)
    columns = [
        rows["doc_id"].combine_chunks().take(taken), pa.array(at, pa.int64()), pa.array(size, pa.int64()), pa.array([zlib.crc32(x) for x in cut], pa.int64()), rows["doc_tokens"].combine_chunks().take(taken),
        pa.array(run * plan.run + window, pa.int64()), pa.array(offset, pa.int64()), pa.array(q, pa.int32()), pa.array([bytes(x) for x in cut] if keep_ids else [None] * len(cut), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])


def _pack(plan: Plan, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            runs = batch["run"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if now is not None and runs[a] != now:
                    yield _fill(plan, now, pa.Table.from_batches(held), keep_ids)
                    held = []
                now = int(runs[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield _fill(plan, now, pa.Table.from_batches(held), keep_ids)

    return run


def pack(docs: DataFrame, tokenizer_path: str, weights: Mapping[str | None, float] | None = None, window: int = WINDOW, run: int = RUN, keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of `window` ids: sequence_id, offset in it, doc_id, start in the document,
    length, doc_tokens, ids_crc32, source_queue, and the ids as little-endian unsigned 32-bit integers if `keep_ids`.

    A document's ids end with END_ID. Each of its ids lies in one piece. Every sequence is full; what is left at the
    very end makes sequences of powers of two, so nothing is padded. Windows hold the sources by their share of all
    ids, each to within a few ids; or by `weights` (source -> weight above 0, 1 where not given), and then by those of the sources
    that still have ids. The queue of a source has its documents in the order of the input's files.

    Null and empty texts have the end id only. Rows that repeat a doc_id, or have none, are packed each for itself; a
    null source is a source. Texts of any length are cut over as many windows as they need. Other columns are not
    read. An empty table has no pieces. With over MOST_QUEUES sources several share a queue by their hash (not with `weights`).

    The ids go through one shuffle, by run; a run holds `window` * `run` ids whatever the sources' sizes. The driver
    holds MOST_QUEUES numbers at most.
    """
    spark = docs.sparkSession
    rows = save(docs.select("doc_id", "text", "source").mapInArrow(_tokenize(tokenizer_path), TOKENS), "packing-ids")
    parts = save(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "packing-parts")
    sources = parts.groupBy("source").agg(F.sum("n").alias("total"))
    if sources.count() > MOST_QUEUES:
        queued = parts.withColumn("queue", F.pmod(F.xxhash64("source"), F.lit(MOST_QUEUES)).cast("int"))
    else:
        named = sources.select(F.col("source").alias("_s"), (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("queue"))  # a row a source
        queued = parts.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    queued = save(queued.withColumn("before", F.sum("n").over(Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1))), "packing-offsets")
    found = {r["queue"]: r for r in queued.groupBy("queue").agg(F.sum("n").alias("n"), F.first("source").alias("source")).collect()}
    count = max(found, default=-1) + 1
    sizes = np.array([found[q]["n"] if q in found else 0 for q in range(count)], np.int64)
    shares = np.array([weights.get(found[q]["source"], 1.0) if q in found else 0.0 for q in range(count)]) if weights else None
    plan = Plan(sizes, shares, window, run)
    offsets = queued.select(F.col("part").alias("_p"), F.col("source").alias("_s"), "queue", F.coalesce("before", F.lit(0)).alias("before"))
    if queued.count() <= SMALL:
        offsets = F.broadcast(offsets)
    placed = rows.join(offsets, (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).select("queue", (F.col("before") + F.col("at")).alias("pos"), "doc_id", "n", "ids")
    cut = placed.mapInArrow(_cut(plan), CUT).repartition("run").sortWithinPartitions("run", "queue", "pos")
    return cut.mapInArrow(_pack(plan, keep_ids), PIECES)


def op11_mixture_packing(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The pieces of all documents, packed by their sources' shares; by default with the tokenizer `word_bpe_49k.json`."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, tokenizer_path, keep_ids=False).drop("ids", "source_queue")

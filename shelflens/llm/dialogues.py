"""Repair of conversations' structure by the cheapest audit of edits.

Faults are found by grouping: equal rows of a conversation are counted first, and of equal messages the earliest turn
stays. The rows, ordered by conversation and turn, are dealt out by ranges, so a long conversation lies in many tasks.
Each task runs a dynamic program over the states of a legal conversation and keeps, for each state that a part can
begin and end in, the cheapest edits. Edits that begin alike share linked nodes; of equally cheap ones the least is
found by the longest common prefix, with jumps to ancestors and rolling hashes. The parts of a conversation are then
joined, sixteen at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

BLANK = " \t\n\x0b\f\r"
DELETE, RELABEL, INSERT, TRUNCATED = 2, 1, 5, 5
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, system, user, assistant. A state's role on keeping a row, and the state after an empty or relabelled one.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
ROWS = 4096  #: rows of a part of a conversation

PARTS = (
    "conv_id long, part long, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long, "
    "paths array<struct<entry: int, exit: int, cost: long, edits: string>>"
)
_PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
Path = tuple[int, bytes]


class Edits:
    """Strings of edits that share their beginnings: a node is the string of its parent and a letter more."""

    _BASE, _PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [0], [0], [0], [[]]

    def grown(self, node: int, letter: int, times: int = 1) -> int:
        for _ in range(times):
            up, j = [node], 0
            while len(self.up[up[j]]) > j:  # the ancestor 2^(j+1) letters back
                up.append(self.up[up[j]][j])
                j += 1
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * self._BASE + letter) % self._PRIME)
            self.up.append(up)
            node = len(self.up) - 1
        return node

    def ancestor(self, node: int, depth: int) -> int:
        back = self.depth[node] - depth
        while back:
            j = back.bit_length() - 1
            node = self.up[node][j]
            back -= 1 << j
        return node

    def common(self, a: int, b: int) -> int:
        """Letters that both strings begin with."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[a] != self.hash[b]:
            for j in range(len(self.up[a]) - 1, -1, -1):
                if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                    a, b = self.up[a][j], self.up[b][j]
            a, b = self.up[a][0], self.up[b][0]
        depth = self.depth[a]
        while a != b:  # equal hashes of other nodes: compare their letters
            if self.letter[a] != self.letter[b]:
                depth = self.depth[a] - 1
            a, b = self.up[a][0], self.up[b][0]
        return depth

    def less(self, a: int, x: int, b: int, y: int) -> bool:
        """Whether the string of `a` and then `x` comes before that of `b` and then `y`."""
        if a == b:
            return x < y
        n = self.common(a, b)
        tails = [bytes([self.letter[self.ancestor(node, n + 1)]]) if self.depth[node] > n else bytes([letter]) for node, letter in ((a, x), (b, y))]
        if tails[0] != tails[1]:
            return tails[0] < tails[1]
        return self.text(a) + bytes([x]) < self.text(b) + bytes([y])  # one string ends where the other goes on

    def text(self, node: int) -> bytes:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return bytes(out[::-1])


class Heads:
    """The cheapest edits to each state, of the rows so far, from one state before them."""

    def __init__(self, entry: int):
        self.edits, self.best = Edits(), {entry: (0, 0)}

    def _offer(self, into: dict, state: int, cost: int, node: int, letter: int) -> None:
        had = into.get(state)
        if had is None or cost < had[0] or (cost == had[0] and self.edits.less(node, letter, had[1], had[2])):
            into[state] = cost, node, letter

    def insert(self) -> None:
        """An empty row more where that is the cheapest way to a state."""
        for state in (0, 1, 3, 2):
            if state in self.best:
                (cost, node), to = self.best[state], NEXT[state]
                had = self.best.get(to)
                if had is None or cost + INSERT < had[0] or (cost + INSERT == had[0] and self._before(node, had[1])):
                    self.best[to] = cost + INSERT, self.edits.grown(node, ord("I"))

    def _before(self, node: int, other: int) -> bool:
        return self.edits.less(node, ord("I"), self.edits.up[other][0], self.edits.letter[other]) if other else False

    def row(self, initial: str, truncated: bool) -> None:
        self.insert()
        found: dict[int, tuple[int, int, int]] = {}
        more = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, node, ord("D"))
            if (state, initial) in KEEP:
                self._offer(found, KEEP[state, initial], cost + more, node, ord("K"))
            self._offer(found, NEXT[state], cost + RELABEL + more, node, ord("R"))
        self.best = {state: (cost, self.edits.grown(node, letter)) for state, (cost, node, letter) in found.items()}

    def drop(self, times: int) -> None:
        """Rows that must go. An empty row is never put before them: after them it is as cheap and sorts lower."""
        self.best = {state: (cost + DELETE * times, self.edits.grown(node, ord("D"), times)) for state, (cost, node) in self.best.items()}

    def paths(self) -> dict[int, Path]:
        return {state: (cost, self.edits.text(node)) for state, (cost, node) in self.best.items()}


def joined_paths(a: dict[tuple[int, int], Path], b: dict[tuple[int, int], Path]) -> dict[tuple[int, int], Path]:
    """Edits of one part and then of the next. Equally cheap edits of the same rows never begin one with the other, so the least of the first part stays least."""
    out: dict[tuple[int, int], Path] = {}
    for (entry, middle), (cost, edits) in a.items():
        for (begin, end), (cost2, edits2) in b.items():
            if begin == middle:
                had = out.get((entry, end))
                if had is None or cost + cost2 <= had[0]:
                    new = cost + cost2, edits + edits2
                    out[entry, end] = new if had is None else min(had, new)
    return out


def joined(parts: list[dict]) -> dict:
    """Consecutive parts of a conversation as one, joined in pairs."""
    while len(parts) > 1:
        pairs = []
        for a, b in zip(parts[::2], parts[1::2], strict=False):
            if not a["rows"] or not b["rows"]:
                pairs.append(a if a["rows"] else b)
                continue
            one = {"first": a["first"], "last": b["last"], "low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"]}
            one |= {c: a[c] + b[c] for c in _COUNTS}
            one["illegal"] += a["last"] + b["first"] not in LEGAL
            one["turns"] -= a["high"] is not None and a["high"] == b["low"]
            one["paths"] = joined_paths(a["paths"], b["paths"])
            pairs.append(one)
        parts = pairs + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]


class Part:
    """Counts and edits of consecutive rows of a conversation."""

    def __init__(self, entries: tuple[int, ...]):
        self.heads = [(e, Heads(e)) for e in entries]
        self.seen = {"rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "first": None, "last": None, "low": None, "high": None}

    def add(self, turn: int | None, n: int, initial: str, blank: bool, repeated: bool, truncated: bool) -> None:
        seen = self.seen
        if seen["rows"] and seen["last"] + initial not in LEGAL:
            seen["illegal"] += 1
        seen["illegal"] += n - 1  # a role never follows itself
        seen["first"] = initial if seen["first"] is None else seen["first"]
        seen["last"] = initial
        seen["rows"] += n
        if turn is not None:
            seen["turns"] += turn != seen["high"]
            seen["low"] = turn if seen["low"] is None else seen["low"]
            seen["high"] = turn
        seen["blank"] += n if blank else 0
        gone = n if blank or repeated else n - 1
        seen["duplicate"] += 0 if blank else gone
        if gone < n:
            seen["truncated"] += truncated
        for _, heads in self.heads:
            if gone < n:
                heads.row(initial, truncated)
            if gone:
                heads.drop(gone)

    def done(self) -> dict:
        return self.seen | {"paths": {(entry, state): path for entry, heads in self.heads for state, path in heads.paths().items()}}


def _batch(rows: list[tuple[int | None, int, dict]]) -> pa.RecordBatch:
    paths = [[{"entry": e, "exit": x, "cost": c, "edits": s.decode()} for (e, x), (c, s) in sorted(r["paths"].items())] for *_, r in rows]
    names = [f.split()[0] for f in PARTS.split(", ")][:12]
    columns = [[r[0] for r in rows], [r[1] for r in rows], *[[r[2][c] for r in rows] for c in names[2:]]]
    types = [pa.string() if c in ("first", "last") else pa.int64() for c in names]
    return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], pa.array(paths, _PATHS)], [*names, "paths"])


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of the task, whose rows come in order. Only the first may have begun elsewhere."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    rows = (row for batch in batches for row in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "n", "initial", "blank", "repeated", "truncated")), strict=True))
    out: list[tuple[int | None, int, dict]] = []
    for place, (conv, group) in enumerate(groupby(rows, key=lambda r: r[0])):
        parts, now, count = [], Part((0,) if place else (0, 1, 2, 3)), 0
        for _, *row in group:
            if count == ROWS:
                parts.append(now.done())
                now, count = Part((0, 1, 2, 3)), 0
            now.add(*row)
            count += 1
        out.append((conv, part, joined([*parts, now.done()])))
        if len(out) == 500:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _join(rows: pa.Table) -> pa.Table:
    told = sorted(rows.to_pylist(), key=lambda r: r["part"])
    one = joined([r | {"paths": {(p["entry"], p["exit"]): (p["cost"], p["edits"].encode()) for p in r["paths"]}} for r in told])
    return pa.Table.from_batches([_batch([(told[0]["conv_id"], told[0]["part"] >> 4, one)])])


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one space for a null role or text."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def audit(conversations: DataFrame) -> DataFrame:
    """conv_id, rows, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation.

    Rows are taken by turn (nulls first), those of one turn in an order that role and text set; null roles and texts are
    one space, and a null conv_id is a conversation of its own. A row's first fault counts: blank text, role and text
    seen earlier in the conversation, or a last sign that is none of `.!?`. `gaps` are missing turns between the least
    and the greatest, `illegal` neighbours whose roles' initials are none of su, ua, au. `audit` has the initials of the
    cheapest edits that make the roles' initials `(s?(ua)+)?`, the ASCII-least of them: Keep 0, Rerole to user or
    assistant 1, Delete 2 (a must for blank and duplicate rows), Insert an empty user or assistant row 5; a truncated
    row that isn't deleted costs 5 more. A row with an empty role has no initial and can't be kept as it is.

    Equal rows are counted before they are sorted, so copies of one message cost one row. Texts of any length are read
    by their digest alone. Other columns are not read. An empty table has no rows.
    """
    spark = conversations.sparkSession
    end = F.rtrim("text", F.lit(BLANK))
    narrow = plain(conversations).select("conv_id", "turn", _digest(F.col("role"), F.col("text")).alias("digest"), F.substring("role", 1, 1).alias("initial"), (F.length(end) == 0).alias("blank"), (~F.right(end, F.lit(1)).isin(*".!?")).alias("truncated"))
    rows = narrow.groupBy("conv_id", "turn", "digest").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("initial", "blank", "truncated")])
    at = F.struct(F.col("turn").isNotNull(), "turn")
    several = rows.groupBy(F.col("conv_id").alias("_c"), F.col("digest").alias("_d")).agg(F.min(at).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    marked = rows.join(several, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d")), "left")
    marked = save(marked.select("conv_id", "turn", "digest", "n", "initial", "blank", "truncated", F.coalesce(at > F.col("_first"), F.lit(False)).alias("repeated")), "dialogue-rows")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "digest")]
    parts = save(marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest").mapInArrow(_audit, PARTS), "dialogue-parts")
    split = save(parts.groupBy(F.col("conv_id").alias("_c")).count().where("count > 1").select("_c"), "dialogue-split")
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    whole = parts.join(split, same, "left_anti")
    rest, most = parts.join(split, same, "left_semi"), parts.agg(F.max("part").alias("most")).first()["most"] or 0
    if not split.isEmpty():
        while most:
            rest, most = save(rest.groupBy("conv_id", F.shiftright("part", 4).alias("_part")).applyInArrow(_join, PARTS), "dialogue-joined"), most >> 4
        whole = whole.unionByName(rest)
    ends = F.filter("paths", lambda p: p["entry"] == 0)
    more = lambda p, what, none: F.when(p["exit"] == 2, F.lit(what)).when(p["exit"] == 1, F.lit(2 * what)).otherwise(F.lit(none))
    best = F.array_min(F.transform(ends, lambda p: F.struct((p["cost"] + more(p, INSERT, 0)).alias("cost"), F.concat(p["edits"], more(p, "I", "")).alias("audit"))))
    gaps = F.when(F.col("turns") == 0, F.lit(0)).otherwise(F.least(F.col("high").cast("decimal(20,0)") - F.col("low") + 1 - F.col("turns"), F.lit((1 << 63) - 1))).cast("long")
    return whole.withColumn("_best", best).select("conv_id", "rows", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "_best.cost", "_best.audit")


REPAIRED = "conv_id long, position long, edit string, turn long, role string, text string"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, after a first one with the conversation's audit in `text`."""
    conv, edits, at, state, position = None, "", 0, 0, 0
    out: list[tuple] = []

    def inserted() -> None:
        nonlocal at, state, position
        while at < len(edits) and edits[at] == "I":
            state = NEXT[state]
            out.append((conv, position, "I", None, ROLE[state], ""))
            at, position = at + 1, position + 1

    for batch in batches:
        for key, kind, turn, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "kind", "turn", "role", "text")), strict=True):
            if not kind:
                inserted()
                if at != len(edits):
                    raise ValueError("a conversation's rows and audit differ")
                conv, edits, at, state, position = key, text, 0, 0, 0
                continue
            inserted()
            edit, at = edits[at], at + 1
            if edit == "D":
                continue
            state = NEXT[state] if edit == "R" else KEEP[state, role[:1]]
            out.append((conv, position, edit, turn, ROLE[state] if edit == "R" else role, text))
            position += 1
        yield _rows(out)
        out.clear()
    inserted()
    yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], [f.split()[0] for f in REPAIRED.split(", ")])


def repair(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position, edit, turn, role, text: the rows that the audits leave, in order within a conversation; inserted rows have no turn.

    The rows of a conversation lie together and in order in one partition and are streamed one by one; of a
    conversation only its audit is held.
    """
    rows = plain(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", _digest(F.col("role"), F.col("text")).alias("digest"), "role", "text")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "digest")])
    return ordered.drop("digest").mapInArrow(_repair, REPAIRED)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id and the hash of its lines; a conversation's rows follow one another."""
    state, conv, ids, found = None, None, [], []
    for batch in batches:
        for key, position, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "position", "role", "text")), strict=True):
            if not position:
                if state:
                    ids.append(conv)
                    found.append(state.hexdigest())
                state, conv = hashlib.sha256(), key
            state.update(f"{chr(10) if position else ''}{role}:{text}".encode())
    if state:
        ids.append(conv)
        found.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as `plain` gives them, damaged by a hash of conversation and turn: some dropped, emptied, without their stops, repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = plain(conversations).withColumn("_case", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("_case") == 1, F.lit("")).when(F.col("_case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.where("_case <> 0").select("conv_id", "turn", F.when(F.col("_case") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("_case") == 3, 2).otherwise(1).alias("_times"))
    return rows.withColumn("_time", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times", "_time")


def op13_audit_repair(conversations: DataFrame) -> DataFrame:
    """Every conversation after the damage: its faults, the cheapest audit and a hash of what it leaves. One without rows has zeros and an empty audit."""
    damaged = damage(conversations)
    audits = save(audit(damaged), "dialogue-audits")
    hashes = repair(damaged, audits).mapInArrow(_hash, "conv_id long, repaired_sha256 string")
    found = audits.join(hashes.withColumnRenamed("conv_id", "_h"), F.col("conv_id").eqNullSafe(F.col("_h")), "left").drop("_h").withColumnRenamed("conv_id", "_c")
    whole = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))

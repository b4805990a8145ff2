"""Repair of conversations against a plain version that works from the end of each conversation."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache
from itertools import product

import pytest
from shelflens.llm import dialogues

WHITE = " \t\n\x0b\f\r"
KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        case = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if case == 1 else "".join(x for x in text if x not in ".!?") if case == 2 else text
        out += [(conv, turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


def plain_repair(rows) -> tuple:
    """rows (turn, role, text) in order -> all that the query returns but the id."""
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(WHITE)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, *_ in rows if t is not None}

    @lru_cache(None)
    def best(i: int, state: str, inserts: int) -> tuple[int, str]:
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:
            cost, edits = best(i, AFTER[state], inserts + 1)
            found.append((cost + 5, "I" + edits))
        if i < len(rows):
            cost, edits = best(i + 1, state, 0)
            found.append((cost + 2, "D" + edits))
            if faults[i] not in ("blank", "duplicate"):
                more, role = 5 * (faults[i] == "truncated"), rows[i][1][:1]
                if (state, role) in KEEP:
                    cost, edits = best(i + 1, KEEP[state, role], 0)
                    found.append((cost + more, "K" + edits))
                for name in "ua":
                    if name == AFTER[state]:
                        cost, edits = best(i + 1, name, 0)
                        found.append((cost + 1 + more, "R" + edits))
        return min(found, default=(10**9, ""))

    for i in range(len(rows) - 1, -1, -1):  # fills the table from the end, so that nothing recurses deeply
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, edits = best(0, "", 0)
    lines, i, state = [], 0, ""
    for e in edits:
        if e == "I":
            state = AFTER[state]
            lines.append(f"{NAMES[state]}:")
            continue
        _, role, text = rows[i]
        i += 1
        if e != "D":
            state = KEEP[state, role[:1]] if e == "K" else AFTER[state]
            lines.append(f"{role if e == 'K' else NAMES[state]}:{text}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_all(rows) -> dict:
    by: dict = {conv: [] for conv, *_ in rows}
    for conv, *row in damaged(rows):
        by[conv].append(row)
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {conv: plain_repair(sorted(map(tuple, told), key=order)) for conv, told in by.items()}


def _got(df) -> dict:
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string, kind int, n string, digest string, part int, _c string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], SCHEMA).repartition(5)


def _odd_rows():
    rng = random.Random(3)
    text = lambda: rng.choice(["", " \t", "one.", "two!", "three", "four? ", "five.\n", "six", None, "é.", " "])
    rows = [(c, rng.choice([None, -2, *range(12)]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "ut"]), text()) for c in [*range(150), None] for _ in range(rng.randint(1, 9))]
    rows += rows[:20]
    rows += [(900, t, ("user", "assistant")[t % 2], f"message {t}.") for t in range(40)] + [(901, 5, "user", "w " * 300_000 + ".")]
    return rows


def test_repairs_match_a_plain_version(spark):
    rows = _odd_rows()
    assert _got(dialogues.op13_audit_repair(_frame(spark, rows))) == plain_all(rows)
    assert dialogues.op13_audit_repair(_frame(spark, [])).count() == 0


def test_a_conversation_in_many_parts(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "user", "system"]), rng.choice([f"{t}.", f"{t}", "same.", ""])) for t in range(12_000)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(8, 30) for t in range(6)] + [(3, 1, "user", "yes.")] * 5000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert _got(dialogues.op13_audit_repair(_frame(spark, rows))) == plain_all(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repaired_rows_are_legal(spark):
    frame = _frame(spark, _odd_rows())
    audits = dialogues.audit(frame)
    by: dict = {}
    for r in dialogues.repair(frame, audits).collect():
        by.setdefault(r["conv_id"], {})[r["position"]] = r
    for told in by.values():
        assert sorted(told) == list(range(len(told)))
        initials = "".join(told[i]["role"][0] for i in range(len(told)))
        assert initials.removeprefix("s").replace("ua", "") == "" and not initials.endswith("s")
        assert all(told[i]["text"] == "" for i in told if told[i]["edit"] == "I")


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_every_short_conversation(size):
    """All roles and faults of up to four rows, in one part and in parts of one row."""
    for kinds in product(("s", "u", "a", "x"), repeat=size):
        for faults in product((0, 1, 2), repeat=size):
            rows = [(i, k, (f"{i}.", " ", f"{i}")[f]) for i, (k, f) in enumerate(zip(kinds, faults, strict=True))]
            want = plain_repair(rows)[5:7]
            one, many = dialogues.Part((0,)), []
            for turn, role, text in rows:
                told = (turn, 1, role, not text.strip(), False, not text.endswith("."))
                one.add(*told)
                many.append(dialogues.Part((0, 1, 2, 3)))
                many[-1].add(*told)
            for found in (one.done(), dialogues.joined([p.done() for p in many])):
                ends = {x: p for (e, x), p in found["paths"].items() if e == 0}
                got = min((c + more, s + tail) for x, more, tail in ((0, 0, b""), (3, 0, b""), (2, 5, b"I"), (1, 10, b"II")) if x in ends for c, s in [ends[x]])
                assert (got[0], got[1].decode()) == want


def test_common_prefixes_with_colliding_hashes():
    edits, rng = dialogues.Edits(), random.Random(1)
    for constant in (False, True):
        if constant:  # every string of a length collides
            edits._BASE = 0
            edits.grown = lambda node, letter, times=1, f=edits.grown: (f(node, letter, times), edits.hash.__setitem__(-1, 7))[0]
        nodes = [0]
        for _ in range(400):
            nodes.append(edits.grown(rng.choice(nodes[-30:]), rng.choice(b"DK")))
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            x, y = edits.text(a), edits.text(b)
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert edits.common(a, b) == n
            assert edits.less(a, 68, b, 75) == (x + b"D" < y + b"K")

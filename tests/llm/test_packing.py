"""Packing and lexical search against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from shelflens.llm import packing, retrieval
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, queue int, n long, at long, part int, _p int, run long, item_id long, term string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7, "t") for r in rows], SCHEMA).repartition(3)


def _rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(200)
    rows = [(1, base, "a"), (1, base, "a"), (2, base, "b"), (None, base, None), (None, None, None), (3, None, "a"), (4, "", "b"), (5, " \n\t", "c"), (6, "x", "d"), (7, text(40_000), "a"), (8, "z" * 100_000, "b")]
    return rows + [(10 + i, text(rng.randint(1, 200)), "abc"[min(i % 7, 2)]) for i in range(150)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


def _check(found, rows, window, tokenizer=Tokenizer.from_file(PATH)):
    """Every id in one piece, sequences full or a power of two, offsets gapless, ids right."""
    wanted = defaultdict(Counter)
    for doc, text, _ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        wanted[doc][len(ids), zlib.crc32(ids.tobytes())] += 1
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
        assert r["length"] > 0 and len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
    assert sorted(by_seq) == list(range(len(by_seq)))
    for told in by_seq.values():
        told.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in told])
        assert [r["offset"] for r in told] == [0, *ends[:-1].tolist()]
        assert ends[-1] <= window and (ends[-1] & (ends[-1] - 1)) == 0
    assert sum(sum(r["length"] for r in t) == window for t in by_seq.values()) >= len(by_seq) - window.bit_length()
    assert set(by_doc) == set(wanted)
    for doc, told in by_doc.items():
        if sum(wanted[doc].values()) == 1:
            told.sort(key=lambda r: r["start"])
            whole = b"".join(r["ids"] for r in told)
            assert [r["start"] for r in told] == [0, *np.cumsum([r["length"] for r in told])[:-1].tolist()]
            assert {(len(whole) // 4, zlib.crc32(whole))} == set(wanted[doc]) and all(r["doc_tokens"] == len(whole) // 4 for r in told)
        else:
            assert sum(r["length"] for r in told) == sum(n * k for (n, _), k in wanted[doc].items())
    return by_seq


def test_windows_hold_the_sources_by_their_shares(spark, rows):
    found = packing.pack(_frame(spark, rows), PATH, window=256, run=8).collect()
    by_seq = _check(found, rows, 256)
    total = Counter()
    for r in found:
        total[r["source_queue"]] += r["length"]
    share = {q: n / sum(total.values()) for q, n in total.items()}
    carried = Counter()
    for seq in sorted(by_seq):
        got, size = Counter(), sum(r["length"] for r in by_seq[seq])
        for r in by_seq[seq]:
            got[r["source_queue"]] += r["length"]
        for q in share:
            carried[q] += got[q] - size * share[q]
            assert abs(got[q] - size * share[q]) < 3 and abs(carried[q]) < 3  # also from one run to the next


def test_weights_hold_until_a_source_ends(spark, rows):
    weights = {"a": 1.0, "b": 3.0, "c": 2.0, None: 1.0, "d": 1.0}
    found = packing.pack(_frame(spark, rows), PATH, weights, 256, 8).collect()
    by_seq = _check(found, rows, 256)
    got = Counter()
    for r in by_seq[0]:
        got[r["source_queue"]] += r["length"]
    assert [got[q] for q in range(5)] == pytest.approx([32, 96, 64, 32, 32], abs=33)  # the only document of "d" is shorter than its share
    assert abs(got[1] - 3 * got[0]) <= 6 and abs(got[2] - 2 * got[0]) <= 6


def test_packing_of_empty_tables_and_more_sources_than_queues(spark, rows, monkeypatch):
    assert packing.op11_mixture_packing(_frame(spark, [])).count() == 0
    monkeypatch.setattr(packing, "MOST_QUEUES", 2)
    monkeypatch.setattr(packing, "SMALL", 0)
    _check(packing.pack(_frame(spark, rows), PATH, window=512, run=4).collect(), rows, 512)


def test_runs_are_served_whole():
    rng = np.random.default_rng(2)
    for sizes in ([5], [1, 1, 1, 100_000], [0, 7, 0], rng.integers(0, 3000, 60).tolist(), [10**6, 3]):
        plan = packing.Plan(np.array(sizes), window=64, run=4)
        served = [plan.served(r)[0] for r in range(plan.runs + 1)]
        assert served[0].sum() == 0 and served[-1].tolist() == sizes
        for r, (a, b) in enumerate(zip(served, served[1:], strict=False)):
            assert (b >= a).all() and (b - a).sum() == min(256, plan.total - 256 * r)
            takes = plan.takes(r)
            assert (takes >= 0).all() and takes.sum(0).tolist() == (b - a).tolist() and takes.sum(1).tolist() == plan.windows(r)
        for q, n in enumerate(sizes):
            for pos in {0, n // 3, n - 1} & set(range(n)):
                run = plan.run_of(q, pos)
                assert served[run][q] <= pos < served[run + 1][q]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _ranked(rows, items, k):
    docs = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in rows]
    count, length = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df, asked = Counter(t for _, c in docs for t in c), defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = set()
    for item, terms in asked.items():
        scores = []
        for doc, c in docs:
            m = 10 + 90 * c.total() * count // length if length else 10
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc))
        out |= {(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])}
    return out


def _search_rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["Über", "ÉTÉ", "naïve", "x9"]
    pick = lambda: words[min(int(rng.expovariate(0.02)), len(words) - 1)]
    rows = [(i, rng.choice(" -\n.'").join(pick() for _ in range(rng.randint(1, 120)))) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[3][1]), (None, None), (2000, None), (2001, ""), (2002, " .\n"), (2003, "w1 " * 50_000 + "W5"), (2004, "w7\0w8")]
    items = [(i, " ".join(pick() for _ in range(rng.randint(1, 25)))) for i in range(60)]
    items += [(3, "w290 w291"), (None, "w1, w2"), (None, "w3"), (100, None), (101, ""), (102, "nowhere"), (103, "ÜBER über été ÉTÉ X9"), (104, rows[3][1]), (105, " ".join(words))]
    return rows, items


@pytest.mark.parametrize("k", [1, 10])
def test_search_matches_a_plain_version(spark, k):
    rows, items = _search_rows()
    docs = _frame(spark, [(d, t, "a") for d, t in rows])
    asked = spark.createDataFrame([(*x, 1, "t", 2, 3) for x in items], "item_id long, text string, doc_id int, term string, df int, rank int")
    want = _ranked(rows, items, k)
    for block in (200_000, 7):  # items one by one, too
        got = retrieval.rank_documents(docs, asked, k, block).collect()
        assert len(got) == len(want) and {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got} == want
        items = items[:6]
        asked, want = asked.where("item_id < 6 and text not like 'w290%'"), _ranked(rows, items, k)


def test_accumulators_stop_and_survivors_stay_exact():
    """With accumulators limited the k best and their scores are those of all documents."""
    rng, closed = random.Random(6), 0
    for _ in range(200):
        n, sizes, places, tfs, terms = 60, [], [], [], []
        for t in range(12):
            docs = sorted(rng.sample(range(n), rng.choice([1, 2, 30, 55])))
            terms.append(f"t{t}")
            sizes.append(len(docs))
            places += docs
            tfs += [rng.choice([1, 1, 1, 5]) for _ in docs]
        row = {"doc_ids": [d // 2 for d in range(n)], "n": [rng.randint(5, 60) for _ in range(n)], "terms": terms, "sizes": sizes, "places": np.array(places, "<i4").tobytes(), "tfs": np.array(tfs, "<i4").tobytes()}
        block = retrieval.Block(row, n, sum(row["n"]))
        query = sorted(((t, retrieval.weight(n, s)) for t, s in zip(terms, sizes, strict=True)), key=lambda x: -x[1])
        score = np.zeros(n, np.int64)
        for t, w in query:
            place, part, _ = block.postings(t)
            score[place] += w * part
        want = sorted(((int(s), d) for s, d in zip(score, row["doc_ids"], strict=True) if s > 0), key=retrieval._rank)
        assert block.best(query, 5) == want[:5]
        floor = want[7][0]
        got = block.best(query, 5, floor)
        assert got == [x for x in want if x[0] >= floor][:5]


def test_search_of_empty_tables(spark):
    rows, items = _search_rows()
    docs, none = _frame(spark, [(d, t, "a") for d, t in rows]), _frame(spark, [])
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert retrieval.op12_lexical_search(none, asked).count() == retrieval.op12_lexical_search(docs, asked.where("false")).count() == 0

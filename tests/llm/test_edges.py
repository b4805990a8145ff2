"""Every operator on nulls, empty and very long texts, repeated rows, empty tables, and columns with clashing names."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from shelflens.llm import blockdedup, bytededup, decontamination, mixing, neighbours, quality, sharding, simhash, tokencoding, toxicity

EXTRA = ["_order", "_tie", "_bucket", "_before", "_index", "_shard", "_slot", "_size", "_source", "_target", "_rate", "_copies", "_text", "_leak", "_gone", "_id", "c0", "c1", "size", "count", "value", "rid", "doc", "label", "copy", "target"]
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in EXTRA)


def _rows():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(200)
    told = [(1, base, "a"), (1, base, "a"), (2, base, "b"), (None, base, None), (None, None, None), (3, None, "a"), (4, "", "b"), (5, " \n\t", "c"), (6, "x", "a"), (6, "y", "a"), (7, text(60_000), "a"), (8, "z" * 200_000, "b")]
    return [(*r, *["kept"] * len(EXTRA)) for r in told + [(10 + i, text(40), "abc"[i % 3]) for i in range(30)]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(1, 40)] + [(None, 1, 1), (9, None, None), (9, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(_rows()[0][1].split()[5:40])), (2, None), (2, ""), (None, "too short")], "item_id long, text string")


N = len(_rows())


def _whole(df):
    assert all(r["_target"] == r["c0"] == r["count"] == "kept" for r in df.select("_target", "c0", "count").collect())


def test_quality(odd, none, labels):
    out = quality.op1_ordinal_quality(odd, labels).collect()
    assert len(out) == N and all(0 <= r["expected_grade"] <= 1 and 0 <= r["tail_probability"] <= 1 for r in out)
    assert len({r["expected_grade"] for r in out if r["doc_id"] == 1}) == 1
    assert quality.op1_ordinal_quality(none, labels).count() == 0


def test_shuffle(odd, none, tmp_path):
    out = sharding.external_shuffle(odd, str(tmp_path / "a"), 4)
    assert out.columns == [*odd.columns, "__shard", "__slot"]
    _whole(out)
    counts = sorted(r["count"] for r in out.groupBy("__shard").count().collect())
    assert sum(counts) == N and counts[-1] - counts[0] <= 1
    assert sorted(map(str, out.select("doc_id", F.crc32("text")).collect())) == sorted(map(str, odd.select("doc_id", F.crc32("text")).collect()))
    assert sharding.external_shuffle(none, str(tmp_path / "b"), 4).count() == 0


def test_near_duplicates(odd, none):
    out = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert {(1, 1), (2, 1), (None, 1)} <= out and simhash.near_duplicates(odd).count() == N
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    _whole(kept)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(6) == 2 and ids.count(None) == 0  # both rows without an id are like others
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def test_tokens(odd, none):
    out = sorted(tokencoding.op4_context_mixing(odd).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in _rows()), key=lambda d: (d is not None, d or 0))
    ends = np.cumsum([r["n_tokens"] for r in out])
    assert [r["start"] for r in out] == [0, *ends[:-1].tolist()] and all(r["n_tokens"] == 1 for r in out if r["doc_id"] in (3, 4, 5))
    assert tokencoding.op4_context_mixing(none).count() == 0


def test_damaged_token_files(odd, tmp_path, spark):
    import public_tokenizers

    files = tokencoding.write_tokens(odd, str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json"))
    chunk = next(r for r in files.collect() if len(r["doc_ids"]) > 2)
    for at, change in ((5, 1), (len(chunk["blocks"][0]) // 2, 64), (-1, 7)):
        block = bytearray(chunk["blocks"][0])
        block[at] ^= change
        with pytest.raises(ValueError):
            tokencoding.decode_block(bytes(block))
    with pytest.raises(ValueError):
        tokencoding.decode_block(chunk["blocks"][0][:-9])


def test_leaks(odd, none, bench):
    out = decontamination.op5_spaced_seeds(odd, bench)
    assert out.count() == N
    assert {r["doc_id"] for r in out.where("contaminated = 1").collect()} == {1, 2, None}
    kept = decontamination.decontaminate(odd, bench)
    assert kept.columns == odd.columns and kept.where("doc_id IN (1, 2)").count() == 0
    _whole(kept)
    assert decontamination.op5_spaced_seeds(none, bench).count() == 0
    assert decontamination.op5_spaced_seeds(odd, bench.limit(0)).where("contaminated = 0").count() == N


def test_repeats(odd, none):
    words = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in blockdedup.op6_block_anchors(odd).collect()}
    assert {(1, 200, 0), (2, 200, 200), (None, 200, 200), (None, 0, 0), (3, 0, 0), (8, 1, 0)} <= words
    size = len(_rows()[0][1])
    raw = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in bytededup.op7_byte_repeats(odd).collect()}
    assert {(1, size, size), (2, size, size), (None, size, size), (None, 0, 0), (8, 200_000, 200_000)} <= raw
    assert blockdedup.op6_block_anchors(none).count() == bytededup.op7_byte_repeats(none).count() == 0


def test_neighbours(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (50, [2.0, 0.0]), (6, []), (7, [1.0]), (100, [3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted(tuple(r) for r in neighbours.op8_prefix_forest(vectors).collect())
    assert out == [(50, 1, 1, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 1.0), (50, 4, 4, 1.0), (50, 5, 3, 0.0), (100, 1, 7, 1.0)]
    assert neighbours.op8_prefix_forest(vectors.limit(0)).count() == 0


def test_mixing(odd, none):
    out = mixing.op9_entropy_mix(odd).collect()
    assert len(out) == N and all(r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"] for r in out)
    taken = mixing.mixture(odd)
    assert taken.columns == odd.columns
    _whole(taken)
    assert mixing.op9_entropy_mix(none).count() == mixing.mixture(none).count() == 0


def test_toxicity(odd, none, labels):
    out = toxicity.score_documents(odd, labels).collect()
    assert len(out) == N and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (3, 4, 5)}) == 1
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns
    _whole(kept)
    assert toxicity.score_documents(none, labels).count() == 0

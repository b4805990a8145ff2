from __future__ import annotations

import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from shelflens.llm import decontamination, mixing, neighbours, quality, sharding, tokencoding, toxicity


def test_shards_hold_every_row_once(docs, rows):
    out = sharding.op2_external_shuffle(docs, 5).collect()
    assert sorted(r["doc_id"] for r in out) == [r[0] for r in rows]
    shards = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(5)}
    assert all(v == list(range(len(v))) for v in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) and r["size"] == len(text[r["doc_id"]]) + 8 for r in out)
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.op2_external_shuffle(docs.repartition(5), 5).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in out}


def test_fisher_yates_is_even():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_mixture_meets_targets(docs, rows):
    out = {r["doc_id"]: r for r in mixing.op9_entropy_mix(docs).collect()}
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += size[r[0]]
    target = brute.water_levels(dict(total))
    for r in rows:
        o = out[r[0]]
        assert (o["size"], o["source_size"]) == (size[r[0]], total[r[3]])
        assert o["target"] == pytest.approx(target[r[3]])
        assert o["taken"] <= 3 * o["size"]
    assert {k: v["taken"] for k, v in out.items()} == {r["doc_id"]: r["taken"] for r in mixing.op9_entropy_mix(docs.repartition(7)).collect()}


def test_mixture_of_many_comes_near(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 60)), "abc"[min(int(rng.integers(0, 6)), 2)]) for i in range(1500)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy(F.col("c2").alias("source"), F.col("target").alias("_target")).agg({"*": "count", "size": "sum"}).collect()
    taken = Counter()
    for r in mixing.op9_entropy_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        taken[rows[r["doc_id"]][2]] += r["taken"]
    assert all(abs(taken[r["source"]] / r["_target"] - 1) < 0.02 for r in out)


def test_mixture_of_few_large_documents_comes_near(spark):
    """Sources of 50 documents, the largest a fifth of the words or more: others make up for the rounding of the large."""
    rng = np.random.default_rng(8)
    sizes = {s: [*map(int, rng.integers(20, 400, 49)), 3000] for s in "abcd"}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate((s, n) for s, found in sizes.items() for n in found)]
    taken, target = Counter(), brute.water_levels({s: sum(n) for s, n in sizes.items()})
    for r in mixing.op9_entropy_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        assert r["taken"] <= 3 * r["size"] and r["taken"] % r["size"] == 0
        taken[rows[r["doc_id"]][2]] += r["taken"]
    assert all(abs(taken[s] / t - 1) < 0.01 for s, t in target.items())


def test_blocks_round_trip_and_detect_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 5000, 40_000):
        ids = (rng.zipf(1.3, n) % 49_408).astype(np.int64)
        assert (tokencoding.decode_block(tokencoding.encode_block(ids)) == ids).all()
    data = bytearray(tokencoding.encode_block(np.arange(3000) % 7))
    data[-1] ^= 1
    with pytest.raises(ValueError):
        tokencoding.decode_block(bytes(data))


def test_token_files(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, {}
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want[r[0]] = (at, len(ids), brute.crc_of_ids(ids))
        at += len(ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in tokencoding.op4_context_mixing(docs).collect()} == want


def test_words_are_cut_like_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Don't 'll it's x<|endoftext|>y ½ ²3 ÀÉ ß×÷ naïve œuvre İstanbul áb  c 12,5% <b> Ώ 漢字"]
    ids = tokencoding.WordIds(path).encode([t.encode() for t in texts])
    assert ids[0].tolist() == tokencoding.WordIds(path).tokenizer.encode(texts[0], add_special_tokens=False).ids + [2]


def test_leaks_with_substitutions(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    item = [word() for _ in range(20)]
    changed = [w if i not in (5, 11) else "zzz" for i, w in enumerate(item)]
    other = [word() for _ in range(60)]
    rows = [(0, " ".join(other[:30] + item + other[30:])), (1, " ".join(other[:9] + changed)), (2, " ".join(other)), (3, None), (4, ""), (5, " ".join(item[:4] + other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item).upper()), (8, " ".join(item).upper()), (9, None), (10, "a b")], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontamination.op5_spaced_seeds(docs, bench).collect()}
    assert [d for d, r in sorted(out.items()) if r["contaminated"]] == [0, 1]
    assert (out[0]["item_id"], out[0]["tokens"], out[1]["equal"]) == (7, 20, 18)
    assert sorted(r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()) == [2, 3, 4, 5]
    assert decontamination.op5_spaced_seeds(docs, bench.limit(0)).where("contaminated = 1").count() == 0


def test_lengthening_a_leak_never_clears_it(spark):
    item = np.arange(200, dtype=np.uint64)
    leak = np.where((np.arange(200) >= 10) & (np.arange(200) % 3 == 0), 999, item)
    for part in (leak, leak[::-1]):
        source, sizes = (item if part is leak else item[::-1]), []
        for n in range(10, 201):
            _, size, same = decontamination.overlap(part[:n], source, 0, decontamination.Params())
            assert same >= 0.75 * size
            sizes.append(size)
            _, size, same = decontamination.overlap(part[200 - n :], source, n - 200, decontamination.Params())
            assert same >= 0.75 * size and (n < 200 or size >= 10)
        assert sizes[0] >= 10 * (part is leak) and sizes == sorted(sizes)
    words = [f"w{i}" for i in range(100)]
    changed = [w if i < 10 or i % 3 else "zzz" for i, w in enumerate(words)]
    docs = spark.createDataFrame([(n, " ".join(changed[:n])) for n in (10, 40, 43, 58, 100)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert decontamination.op5_spaced_seeds(docs, bench).where("contaminated = 1").count() == 5


def test_overlap_is_the_longest_that_counts():
    rng = np.random.default_rng(4)
    for _ in range(200):
        same = rng.random(40) < rng.choice([0.5, 0.7, 0.85])
        doc = np.where(same, np.arange(40), 99).astype(np.uint64)
        got = decontamination.overlap(doc, np.arange(40, dtype=np.uint64), 0, decontamination.Params())
        want = 0
        for a in np.flatnonzero(same):
            for b in np.flatnonzero(same) + 1:
                part = same[a:b]
                if b > a and part.sum() >= 0.75 * (b - a) and "000" not in "".join("01"[int(x)] for x in part):
                    want = max(want, b - a)
        assert got[1] == want and same[got[0] : got[0] + got[1]].sum() == got[2]


def test_nearest_has_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 16)).astype(np.float32)
    x[5] = x[6]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] + [1.0] * 15), (None, [1.0] * 16), (703, [None] + [1.0] * 15)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()
    d = x.astype(float)
    norm, hit = np.linalg.norm(d, axis=1), 0
    for q in range(0, 600, 50):
        score = d @ d[q] / norm / norm[q]
        score[q] = -2
        got = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - score[r["vec_id"]]) < 1e-12 for r in got)
        hit += len({r["vec_id"] for r in got} & set(np.argsort(-score)[:5].tolist()))
    assert {r["query_id"] for r in out} == set(range(0, 600, 50)) and hit >= 0.9 * 60


def test_repeated_queries_keep_their_neighbours(spark):
    x = np.random.default_rng(8).standard_normal((120, 8)).round(3)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 50 = 0")
    twice = asked.unionByName(asked.where("vec_id = 50")).unionByName(spark.createDataFrame([(50, x[7].tolist())], vectors.schema))
    p = neighbours.Params(rows=40, queries=2)
    once = sorted(map(tuple, neighbours.nearest(vectors, asked, p=p).collect()))
    assert [r[:2] for r in once] == [(q, i) for q in (0, 50, 100) for i in range(1, 6)]
    other = sorted(map(tuple, neighbours.nearest(vectors, twice.where(F.col("embedding") == F.lit(x[7].tolist())), p=p).collect()))
    assert len(other) == 5 and other[0][2] == 7
    assert sorted(map(tuple, neighbours.nearest(vectors, twice, p=p).collect())) == sorted(once + [r for r in once if r[0] == 50] + other)


def test_segments_are_the_maximal_ones():
    assert toxicity.segments(np.array([-1.0, 2, -1, 2, -5, 1])) == [(1, 4, 3.0), (5, 6, 1.0)]
    assert toxicity.segments(np.array([-1.0, 0.0])) == []
    assert [(a, b) for a, b, _ in toxicity.segments(np.array([4.0, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]))] == [(0, 1), (2, 3), (4, 11)]


def test_toxicity_on_rows_that_taught_nothing(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda toxic: " ".join([*rng.choice(words, 40), *(["awfully", "vile"] if toxic else []), *rng.choice(words, 20)])
    rows = [(i, text(i % 5 == 0)) for i in range(600)] + [(9000, None), (9001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(out[i]["predicted"] == int(i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert out[9000]["predicted"] == out[9001]["predicted"] == 0 and 0 <= out[9000]["score"] <= 1
    assert toxicity.score_documents(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_toxic_words_count_wherever_they_stand():
    weights, memo = np.full(toxicity.BUCKETS, -0.2, np.float32), toxicity.Memo(toxicity.tokens_of)
    bad = [b"awful", b"vile", b"nasty", b"rotten"]
    for w in bad:
        weights[toxicity._buckets(np.array([memo[w]]))] = 2.0
    plain = [f"w{i}".encode() for i in range(60)]
    cuts = lambda *parts: [x[:2] for x in toxicity.segments(toxicity.word_scores(toxicity._words(b" ".join(w for p in parts for w in p), memo), weights, 0.05)) if x[2] > 4]
    assert cuts(plain, bad, plain, bad, plain) == [(60, 64), (124, 128)]
    scattered = [w for b in bad for w in [*plain, b]]
    assert cuts(scattered, plain, bad, plain) == [(304, 308)]


def test_ordinal_grades(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(200)]
    rows, grades = [], []
    for i in range(600):
        g = i % 4
        rows.append((i, " ".join([*rng.choice(words, 30), *["good"] * (3 * g), *["bad"] * (3 * (3 - g))])))
        grades.append((i, g))
    docs, ratings = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(grades[:400], "doc_id long, quality int")
    model = quality.fit(docs, ratings)
    assert (np.diff(model.thresholds) > 0).all()
    out = {r["doc_id"]: r for r in quality.rate(docs, model, least=2).collect()}
    assert np.mean([abs(out[i]["expected_grade"] - g) for i, g in grades[400:]]) < 0.5
    assert np.mean([out[i]["keep"] == (g >= 2) for i, g in grades[400:]]) > 0.95
    assert quality.op1_ordinal_quality(docs, ratings.limit(0)).count() == 600


def test_ordinal_gradient():
    rng = np.random.default_rng(0)
    at, row, x, grade = rng.integers(0, 5, 40), np.sort(rng.integers(0, 10, 40)), rng.random(40), rng.integers(0, 4, 10)
    v = rng.standard_normal(8) * 0.3
    f = lambda v: quality.loss_and_gradient(at, x, row, grade, v[:5], v[5:])
    got = f(v)[1:]
    for i in range(8):
        e = np.zeros(8)
        e[i] = 1e-6
        assert got[i] == pytest.approx((f(v + e)[0] - f(v - e)[0]) / 2e-6, rel=1e-4, abs=1e-6)

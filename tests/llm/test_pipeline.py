"""The pipeline's stages on a small corpus, each against a plain version on its own input."""

from __future__ import annotations

import random
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pytest
from shelflens.llm import decontamination, simhash, toxicity
from shelflens.llm.common import Memo, table

BAD = ["vileword", "nastyword", "foulword", "rottenword"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [prose(40) for _ in range(5)]
    rows, labels = [], []
    for i in range(400):
        text = prose(rng.randint(60, 160))
        if i % 8 == 0:
            text[20:20] = [rng.choice(BAD) for _ in range(6)]
        if i % 50 == 3:
            text[10:10] = items[i % 5][5:30]
        rows.append((i, " ".join(text), "en", "abcd"[min(i % 7, 3)], 0))
        if i % 2 == 0:
            labels.append((i, i % 3 % 2, int(i % 8 == 0)))
    for i in range(30):
        text = rows[9 * i][1].split()
        text[len(text) // 2] = "changed"
        rows.append((1000 + i, " ".join(text), "en", "a", 0))
    rows += [(2000, None, "en", None, 0), (2001, "", "en", "a", 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _toxic(model, text: str) -> bool:
    """Plain quadratic search of the segments; their scores together decide."""
    memo = Memo(toxicity.tokens_of)
    words = np.array([memo[w] for w in text.encode().split()], np.int64)
    scores = toxicity.word_scores(words, model.weights, model.params.drift).tolist()
    found, rest = [], [(0, len(scores))]
    while rest:  # the best segment, then those on both sides of it
        a, b = rest.pop()
        best = (0.0, 0, 0)
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > best[0] + 1e-12:
                    best = (total, i, j + 1)
        if best[0] > 0:
            found.append(best)
            rest += [(a, best[1]), (best[2], b)]
    best = toxicity._best([(i, j, s) for s, i, j in found], 1.0)
    return model.score(best, len(scores)) >= model.params.threshold


def test_stages_match_plain_versions(spark, corpus):
    docs = table(spark, corpus, "documents")
    plain = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_dedup", "decontamination", "source_mixing", "token_ids"]

    clean = stages["toxicity"](spark, docs, corpus).cache()
    model = toxicity.fit(docs, table(spark, corpus, "labels"))
    assert {r["doc_id"] for r in clean.collect()} == {d for d, t in plain.items() if not _toxic(model, t)}
    assert {d for d in range(400) if d % 8 == 0}.isdisjoint(r["doc_id"] for r in clean.collect()) and clean.count() > 330

    texts, parent = {r["doc_id"]: (r["text"] or "").encode() for r in clean.collect()}, {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    prints = {d: simhash.fingerprint(t, 5) for d, t in texts.items()}
    for a in sorted(texts):
        for b in (d for d in texts if d > a):
            bits = (prints[a] ^ prints[b]).bit_count()
            if not bits or bits <= 12 and simhash.jaccard(texts[a], texts[b], 5) >= 0.8:
                x, y = sorted((find(a), find(b)))
                if x != y:
                    parent[y] = x
    one = stages["simhash_near_dedup"](spark, clean, corpus).cache()
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({find(d) for d in texts})
    assert one.where("doc_id BETWEEN 1000 AND 1999").count() <= 5  # copies of documents that are toxic stand alone

    item = {r["item_id"]: r["text"] for r in table(spark, corpus, "benchmark").collect()}
    memo, p = Memo(decontamination.token_hash), decontamination.Params()
    tokens = lambda t: np.array([memo[w] for w in t.encode().split()], np.uint64)

    def leaked(doc: np.ndarray) -> bool:
        h, at = decontamination.mask_hashes(doc, p.masks)
        for text in item.values():
            other = tokens(text)
            g, where = decontamination.mask_hashes(other, p.masks)
            for x, i in zip(h.tolist(), at.tolist(), strict=True):
                for k in np.flatnonzero(g == x).tolist():
                    if decontamination.overlap(doc, other, i - int(where[k]), p)[1] >= min(p.least, len(other)):
                        return True
        return False

    safe = stages["decontamination"](spark, one, corpus).cache()
    assert sorted(r["doc_id"] for r in safe.collect()) == sorted(r["doc_id"] for r in one.collect() if not leaked(tokens(r["text"] or "")))
    assert safe.where("doc_id < 400 AND doc_id % 50 = 3").count() == 0

    mixed = stages["source_mixing"](spark, safe, corpus).cache()
    words = lambda df: Counter({r["source"]: 0 for r in df.collect()}) + Counter(s for r in df.collect() for s in [r["source"]] * len((r["text"] or "").split()))
    target, taken = brute.water_levels(dict(words(safe))), words(mixed)
    assert mixed.columns == docs.columns and all(abs(taken[s] - t) <= 0.1 * t for s, t in target.items() if t > 2000)
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in mixed.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], len(ids), brute.crc_of_ids(ids)))
    out = stages["token_ids"](spark, mixed, corpus).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == sorted(want)
    assert sorted(r["start"] for r in out) == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in sorted(out, key=lambda r: r["start"])])[:-1])).tolist()
    assert corpus_pipeline.ORACLE_SQL is None

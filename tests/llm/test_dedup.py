from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from shelflens.llm import blockdedup, bytededup, decontamination, simhash
from shelflens.llm.common import sliding_argmin


def _two(rows):
    return [(r[0], r[1]) for r in rows]


def test_simhash_matches_brute_force(spark, docs, rows):
    got = {r["doc_id"]: (f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute.simhash(_two(rows))


def test_simhash_keeps_one_of_each_group(docs, rows):
    texts = [(d, t or "") for d, t in _two(rows)]
    parent = {d: d for d, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(texts):
        for b, y in texts[i + 1 :]:
            bits = (simhash.fingerprint(x.encode(), 5) ^ simhash.fingerprint(y.encode(), 5)).bit_count()
            if not bits or bits <= 12 and simhash.jaccard(x.encode(), y.encode(), 5) >= 0.8:
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(d) for d, _ in texts})


def test_near_copies_of_five_word_shingles(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    rows, near, far = [], [], []
    for i in range(120):
        words = [word() for _ in range(rng.randint(120, 300))]
        rows.append((10 * i, " ".join(words)))
        at = rng.sample(range(len(words)), max(1, int(len(words) * (0.02 if i % 2 else 0.012))))
        copy = [word() if j in at else w for j, w in enumerate(words)]
        rows.append((10 * i + 1, " ".join(copy)))
        (near if simhash.jaccard(rows[-1][1].encode(), rows[-2][1].encode(), 5) >= 0.8 else far).append(10 * i + 1)
        half = words[: len(words) // 2] + [word() for _ in range(len(words) // 2)]
        rows.append((10 * i + 2, " ".join(half)))
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    missed = sum(d in kept for d in near)
    print(len(near), missed)
    assert len(near) > 80 and missed <= 0.1 * len(near)
    assert all(d in kept for d in far) and all(10 * i in kept and 10 * i + 2 in kept for i in range(120))


def _families(rng, count, size, words=(40, 90)):
    """Texts in families of near copies, most of them around the similarity that counts."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    rows = []
    for f in range(count):
        base = [word() for _ in range(rng.randint(*words))]
        for m in range(size):
            text = list(base)
            for at in rng.sample(range(len(text)), rng.randint(0, 2)):
                text[at] = word()
            rows.append((10 * f + m, " ".join(text)))
    return rows


def test_families_keep_all_links_that_pass(spark):
    """Where the closest link of two groups fails, a farther one that passes still joins them: equal to all pairs."""
    rows = _families(random.Random(3), 150, 6)
    prints = {d: simhash.fingerprint(t.encode(), 5) for d, t in rows}
    texts = {d: t.encode() for d, t in rows}

    def joined(most):
        parent = {d: d for d, _ in rows}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for f in range(150):
            for a in range(10 * f, 10 * f + 6):
                for b in range(a + 1, 10 * f + 6):
                    bits = (prints[a] ^ prints[b]).bit_count()
                    if not bits or bits <= most and simhash.jaccard(texts[a], texts[b], 5) >= 0.8:
                        x, y = sorted((find(a), find(b)))
                        parent[y] = x
        return find

    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.similar(df.withColumn("row", simhash.row_key())).collect()
    group = {r["doc_id"]: r["group"] for r in found}
    sure, most = joined(10), joined(12)
    assert len({sure(d) for d in group}) < 0.9 * len(group)
    assert all(group[d] == group[sure(d)] for d in group)  # fingerprints up to 10 bits apart are sure to meet
    by_group: dict = {}
    for d, g in group.items():
        by_group.setdefault(g, set()).add(most(d))
    assert all(len(x) == 1 for x in by_group.values())


def test_large_families_keep_all_links_that_pass(spark, monkeypatch):
    """Families far larger than the links tried for each text, most pairs too unlike: as all pairs of close fingerprints would join them, across chunks too."""
    monkeypatch.setattr(simhash, "CHUNK", 100, raising=False)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    rows = []
    for f in range(2):
        base = [word() for _ in range(110)]
        for _ in range(400):
            text = list(base)
            for at in rng.sample(range(len(text)), rng.randint(2, 4)):
                text[at] = word()
            rows.append((len(rows), f, " ".join(text)))
    prints = [simhash.fingerprint(t.encode(), 5) for *_, t in rows]
    sets = [set(simhash.shingles(t.encode(), 5).tolist()) for *_, t in rows]

    def joined(most):
        root = list(range(len(rows)))
        for a, (_, f, _) in enumerate(rows):
            for b in range(a + 1, len(rows)):
                if rows[b][1] == f and (prints[a] ^ prints[b]).bit_count() <= most and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                    x, y = sorted((root[a], root[b]))
                    root = [x if r == y else r for r in root]
        return root

    df = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, text string")
    group = {r["doc_id"]: r["group"] for r in simhash.similar(df.withColumn("row", simhash.row_key())).collect()}
    sure, most = joined(10), joined(12)
    assert 2 < len(set(sure)) < 0.9 * len(rows)
    assert all(group[d] == group[r] for d, r in enumerate(sure))
    by_group: dict = {}
    for d, g in group.items():
        by_group.setdefault(g, set()).add(most[d])
    assert all(len(x) == 1 for x in by_group.values())


def test_passing_joins_what_all_pairs_join():
    rng = np.random.default_rng(5)
    for two in (False, True):
        for _ in range(20):
            n = 40
            base = rng.integers(-(1 << 60), 1 << 60, 30)
            found = [np.unique(np.concatenate((base[rng.random(30) < 0.93], rng.integers(0, 1 << 60, rng.integers(0, 3))))) for _ in range(n)] + [np.zeros(0, np.int64)]
            fps = np.unique(rng.integers(-(1 << 62), 1 << 62)) ^ np.array([sum(1 << int(x) for x in set(rng.integers(0, 60, 3))) ^ (i << 40) for i in range(n + 1)])
            groups, chunks = rng.integers(0, 12, n + 1), rng.integers(3, 5, n + 1) if two else np.full(n + 1, 3)
            rows = pa.table({"fp": fps, "group": groups, "chunk": chunks, "found": pa.array(found, pa.list_(pa.int64()))})

            def roots(links, groups=groups):
                root = {int(g): int(g) for g in groups}
                for a, b in links:
                    x, y = sorted((root[a], root[b]))
                    root = {g: x if r == y else r for g, r in root.items()}
                return root

            near = lambda i, j: ((int(fps[i]) ^ int(fps[j])) % (1 << 64)).bit_count() <= 8 and len(np.intersect1d(found[i], found[j])) / max(len(np.union1d(found[i], found[j])), 1) >= 0.8  # noqa: E731, B023
            every = [(int(groups[i]), int(groups[j])) for i in range(n + 1) for j in range(i) if (chunks[i] != chunks[j] or not two) and near(i, j)]
            at = {int(f): i for i, f in enumerate(fps)}
            links = simhash.passing(rows, 8, 0.8)
            assert all(near(at[a], at[b]) for a, b in links) and len(links) < 12
            assert roots([(int(groups[at[a]]), int(groups[at[b]])) for a, b in links]) == roots(every)


def test_chance_links_hold_no_sets_together(spark, monkeypatch):
    """Of a large part that unlike documents of close fingerprints make, only those whose sets can be alike are laid out as sets; all links that pass are found."""
    monkeypatch.setattr(simhash, "CHUNK", 32)
    monkeypatch.setattr(simhash, "ROUGH", 64, raising=False)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    texts = [" ".join(word() for _ in range(rng.choice((60, 70, 200, 1500)))) for _ in range(300)]
    alike = rng.sample(range(300), 12)
    texts += [texts[i] + " " + word() for i in alike]
    fps = sorted({(1 << 40) ^ (1 << a) ^ (1 << b) for a in range(38) for b in range(a)})
    rng.shuffle(fps)
    written = {}
    save = simhash.save

    def counted(df, label):
        out = save(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(simhash, "save", counted)
    nodes = spark.createDataFrame([(f, f, 7) for f, _ in zip(fps, texts)], "fp long, group long, part long")
    links = simhash._across(nodes, spark.createDataFrame(list(zip(fps, texts)), "fp long, text string"), 5, 0.8, 12).collect()
    assert {frozenset(x) for x in links} == {frozenset((fps[i], fps[300 + k])) for k, i in enumerate(alike)}
    assert written["simhash-sets"] <= 40


def test_sizes_leave_out_what_cannot_pass_alone(spark):
    rng = np.random.default_rng(12)
    centre = int(rng.integers(0, 1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (120, 2))})
    sizes = [int(x) for x in np.exp(rng.uniform(0, 9, len(fps)))]
    links = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame(list(zip(fps, sizes)), "fp long, n int"), joined=simhash.nearest_forest, similarity=0.8, most=30).collect()]
    known = dict(zip(fps, sizes))
    near = lambda a, b: (a ^ b).bit_count() <= 4 and min(known[a], known[b]) >= 0.8 * max(known[a], known[b])

    def joined(pairs):
        root = {f: f for f in fps}
        for a, b in pairs:
            x, y = sorted((root[a], root[b]))
            root = {f: x if r == y else r for f, r in root.items()}
        return root

    assert all(near(a, b) for a, b in links) and len(fps) > 100
    assert joined(links) == joined([(a, b) for i, a in enumerate(fps) for b in fps[:i] if near(a, b)])


def test_profiles_allow_whatever_passes():
    rng = np.random.default_rng(13)
    for n in (1, 5, 40, 400, 40_000):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for share in (0.5, 0.79, 0.8, 0.95):
            b = np.unique(np.concatenate((a[: int(np.ceil(len(a) * share))], rng.integers(0, 1 << 62, int(n * (1 - share) / 9)).astype(np.uint64))))
            rows = pa.table({"fp": [0, 1], "group": [0, 1], "chunk": [0, 0], "own": [True, False], "n": [len(a), len(b)], "profile": [simhash.profile(a), simhash.profile(b)]})
            passes = len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
            assert simhash.may_pass(rows, 12, 0.8) == [(0, 1)] or not passes
    other = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    a = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    assert not simhash.may_pass(pa.table({"fp": [0, 1], "group": [0, 1], "chunk": [0, 0], "own": [True, True], "n": [400, 400], "profile": [simhash.profile(a), simhash.profile(other)]}), 12, 0.8)


def test_rows_of_one_id_go_for_their_own_text(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    text = lambda n=120: " ".join(word() for _ in range(n))
    base, leak = text(), text(30)
    near = base.replace(base.split()[5], "changed")
    rows = [(1, base), (5, near), (5, text()), (None, near + " more"), (None, text()), (7, text()), (7, leak + " " + text()), (None, leak), (8, text()), (8, "  "), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    as_set = lambda out: sorted(map(repr, ((r["doc_id"], r["text"]) for r in out.collect())))
    assert as_set(simhash.keep_one(df)) == sorted(map(repr, [rows[0], rows[2], *rows[4:10]]))
    clean = [r for r in rows if leak not in (r[1] or "")]
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    assert as_set(decontamination.decontaminate(df, bench)) == sorted(map(repr, clean))
    told = decontamination.op5_spaced_seeds(df, bench).collect()
    assert len(told) == len(rows) and sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in told if r["contaminated"]) == [(False, 7), (True, 0)]


def test_links_between_groups_leave_out_failed_ones():
    rng = np.random.default_rng(9)
    for _ in range(30):
        centre = int(rng.integers(0, 1 << 62))
        fps = np.unique([centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (25, 2))])
        groups = rng.integers(0, 6, len(fps))
        failed = [[int(x) for x in rng.choice(fps, 4)] for _ in fps]
        bits = lambda a, b: ((int(a) ^ int(b)) % (1 << 64)).bit_count()
        told = rng.integers(0, 2, (len(fps), 2)) * np.int64(-1 >> 1) * (rng.random((len(fps), 1)) < 0.2)  # some differ in all bits
        rows = pa.table([pa.array(groups, pa.int64()), pa.array(list(told), pa.list_(pa.int64())), pa.array(failed, pa.list_(pa.int64()))], ["group", "sketch", "failed"])
        far = lambda i, j: sum(bits(x, y) for x, y in zip(told[i], told[j], strict=True)) > simhash.HASHES - simhash.AGREE
        for most in (3, 100):
            found = simhash.nearest_links(fps, 4, rows, most)
            for i, (a, g, tried) in enumerate(zip(fps, groups, failed, strict=True)):
                near = sorted(bits(a, b) for j, (b, h) in enumerate(zip(fps, groups, strict=True)) if g != h and bits(a, b) <= 4 and int(b) not in tried and not far(i, j))
                mine = [b for x, b in found if x == a]
                assert sorted(bits(a, b) for b in mine) == near[:most] and not set(mine) & set(tried)


def test_nearest_forest_joins_what_close_links_join():
    rng = np.random.default_rng(6)
    for _ in range(20):
        centres = rng.integers(-(1 << 62), 1 << 62, 5)
        fps = np.unique([c ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(d)) for c in centres for a, b, d in rng.integers(0, 60, (30, 3))])
        both = [simhash.forest(fps, 4), simhash.nearest_forest(fps, 4)]

        def groups(links):
            parent = {int(f): int(f) for f in fps}

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in links:
                assert ((a ^ b) % (1 << 64)).bit_count() <= 4
                parent[max(find(a), find(b))] = min(find(a), find(b))
            return {f: find(f) for f in parent}

        assert groups(both[0]) == groups(both[1])


def test_simhash_hot_keys_go_to_the_second_round(spark):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (200, 2))})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.links(df, most=8).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        assert ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 4
        parent[find(r["a"])] = find(r["b"])
    assert len({find(f) for f in fps}) == 1


def test_word_windows_match_brute_force(docs, rows):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in blockdedup.op6_block_anchors(docs).collect()}
    assert got == brute.word_windows(_two(rows))


def test_byte_windows_match_brute_force(docs, rows):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bytededup.op7_byte_repeats(docs).collect()}
    assert got == brute.byte_windows(_two(rows))


def test_induced_common_prefixes_match_brute_force():
    rng = random.Random(3)
    for width in (6, 9):
        tuples = []
        for gram in range(12):
            for _ in range(rng.randint(1, 9)):
                n, size = rng.randint(0, width - 3), rng.randint(1, 3)
                size = min(size, n + 1)
                tuples.append((gram, bytes([65 + gram]) * 2 + bytes(rng.choice(b"ab") for _ in range(width - (n - size + 1) - 2)), bytes(rng.choice(b"ab") for _ in range(n)), size))
        tuples.sort(key=lambda t: t[:2])
        got = bytededup.induce(np.array([t[0] for t in tuples]), pa.array([t[2] for t in tuples], pa.binary()), pa.array([t[1] for t in tuples], pa.binary()), np.array([t[3] for t in tuples]), width)
        strings = [{d: (t[0], (t[2] + t[1])[len(t[2]) - d :][:width]) for d in range(len(t[2]) - t[3] + 1, len(t[2]) + 1)} for t in tuples]
        count = Counter((d, x) for s in strings for d, x in s.items())
        assert [sorted(np.flatnonzero(r).tolist()) for r in got] == [sorted(d for d, x in s.items() if count[d, x] > 1) for s in strings]


def _byte_rows(docs, **more):
    spans = bytededup.repeated_windows(docs, **more).collect()
    return {(r["doc"], p) for r in spans for p in range(r["start"], r["end"])}


def _repeated_starts(rows, window):
    count = Counter(t[i : i + window] for t in (r[1].encode() for r in rows) for i in range(len(t) - window + 1))
    return {(r[0], i) for r in rows for t in [r[1].encode()] for i in range(len(t) - window + 1) if count[t[i : i + window]] > 1}


def test_crowded_grams_and_full_filters_find_the_same(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 20))) + passage[rng.randint(0, 40) : rng.randint(150, 240)] + word()) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = _repeated_starts(rows, 100)
    assert want and _byte_rows(docs, window=100, gram=20) == want
    assert _byte_rows(docs, window=100, gram=20, most=3) == want
    assert _byte_rows(docs, window=100, gram=20, most=3, more=3) == want
    assert _byte_rows(docs, window=100, gram=20, most_bits=6) == want


def test_texts_are_cut_without_loss(monkeypatch):
    texts = [bytes(random.Random(1).choices(b"abcdefgh ", k=5000))]
    whole = [x for part in bytededup._occurrences(texts, 100, 20) for x in zip(part[3].tolist(), part[6].tolist(), part[2].tolist(), strict=True)]
    monkeypatch.setattr(bytededup._long, "__defaults__", (700,))
    cut = [x for part in bytededup._occurrences(texts, 100, 20) for x in zip(part[3].tolist(), part[6].tolist(), part[2].tolist(), strict=True)]
    starts = lambda found: {(v, p) for v, at, n in found for p in range(at, at + n)}
    assert len(cut) > len(whole) and starts(cut) == starts(whole)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(150))
    rows = [(1, text), (1, text), (None, text), (None, text[9:]), (None, None), (2, "x" + text[:450]), (2, None), (3, "")]
    out = sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in bytededup.op7_byte_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = len(text)
    assert out == sorted([(n, n, 1)] * 3 + [(n - 9, n - 9, 1), (0, 0, 0), (451, 450, 1), (0, 0, 0), (0, 0, 0)])


def test_many_sharing_one_passage(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(90))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 40))) + " " + passage[: rng.randint(380, 530)] + " " + word()) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in bytededup.op7_byte_repeats(docs).collect()}
    assert got == brute.byte_windows(rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in blockdedup.op6_block_anchors(docs).collect()}
    assert got == brute.word_windows(rows)


def test_empty_tables(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert blockdedup.op6_block_anchors(empty).count() == 0
    assert bytededup.op7_byte_repeats(empty).count() == 0


def test_sliding_argmin():
    values = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64)
    assert sliding_argmin(values, 7).tolist() == [i + int(np.argmin(values[i : i + 7] >> np.uint64(24))) for i in range(494)]


def test_sliding_argmin_of_long_runs_goes_in_parts(monkeypatch):
    """Positions have 24 bits, so a text of more words than that is searched in parts; shown with short ones."""
    values = np.random.default_rng(5).integers(0, 1 << 63, 5000, dtype=np.uint64)
    whole = {w: sliding_argmin(values, w) for w in (2, 7, 60)}
    monkeypatch.setattr("shelflens.llm.common._PART", 64)
    for width, want in whole.items():
        for n in (width, 63, 64 + width, 64 + width + 1, 5000):
            if n >= width:
                assert sliding_argmin(values[:n], width).tolist() == want[: n - width + 1].tolist()


def test_windows_of_crowded_hits_and_odd_rows(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(30)]
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 9))] + passage[rng.randint(0, 9) : rng.randint(20, 30)] + [word()] * rng.randint(0, 2))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " ".join(passage) * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.word_windows(rows)
    for crowd in (64, 20_000):
        spans = blockdedup.covered_windows(docs, crowd=crowd).collect()
        covered = {(r["doc"], r["at"] + i + j) for r in spans for i in range(60) if r["mask"] >> i & 1 for j in range(13)}
        assert Counter(d for d, _ in covered) == Counter({d: n for d, (_, n, _) in want.items() if n})
    odd = [(3, " ".join(passage)), (3, " ".join(passage)), (None, " ".join(passage)), (1, " ".join(passage[:13])), (2, None)]
    out = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in blockdedup.op6_block_anchors(spark.createDataFrame(odd, "doc_id long, text string")).collect())
    assert out == [(False, 1, 13, 0), (False, 2, 0, 0), (False, 3, 30, 13), (False, 3, 30, 13), (True, 0, 30, 30)]

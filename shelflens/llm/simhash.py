"""Near-duplicate documents by SimHash fingerprints, pigeonhole blocks and connected components.

Fingerprints at most `distance` bits apart agree in at least `blocks - distance` of `blocks` blocks. Every choice of
`agree` blocks is a key, so each close pair shares a key. Equal fingerprints are one node from the start. Within a key
the nodes are joined by a spanning forest of verified links, never by all pairs. A key with very many fingerprints is
left to a second round of longer keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, row_key, save, slices, text_bytes, tucked
from .components import connected_components

SHINGLE, SEED, BITS = 4, 42, 64
#: Bits of a sketch, and those that have to agree, in nearest_links: of pairs of similarity 0.8 one in some 2,000 has fewer.
HASHES, AGREE = 128, 104
_BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of `size` words of the lower-cased text, repeats included; of the whole of a shorter one."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    length = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(length + 1) - 1
    first, last = (end - length)[: n - size + 1].tolist(), end[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the `size`-word shingles (repeats included) of the lower-cased text: a bit is set if over half of the hashes have it."""
    return _print_of(shingles(text, size))


def _print_of(found: np.ndarray) -> int:
    if not len(found):
        return 0
    column = (found.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(8) * 256).ravel()
    ones = (np.bincount(column, minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(found), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SHINGLE, kept: str = "doc_id long", counted: bool = False) -> DataFrame:
    """The columns `kept` and fp (the fingerprint's bits as a signed long) of every row; null texts count as empty. `counted` adds n, its different shingles."""
    names = [c.split()[0] for c in kept.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            found = [shingles(x, size) for x in texts]
            told = {"fp": pa.array(np.array([_print_of(x) for x in found], np.uint64).view(np.int64), pa.int64())}
            if counted:
                told["n"] = pa.array([len(np.unique(x)) for x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], *told.values()], [*names, *told])

    return docs.select(*names, "text").mapInArrow(run, f"{kept}, fp long" + ", n int" * counted)


def block_keys(fp: Column, blocks: int, agree: int) -> Column:
    """An array with a key for every choice of `agree` of the `blocks` blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), agree)):
        key = F.lit(k).cast("long")
        for i in chosen:
            key = F.shiftleft(key, cuts[i + 1] - cuts[i]).bitwiseOR(part[i])
        keys.append(key)
    return F.array(*keys)


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of at most `distance` bits that join what such links can join. A node leaves the search once reached, so dense groups cost little."""
    links, rest = [], fps
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            node = todo.pop()
            near = np.bitwise_count((rest ^ node).view(np.uint64)) <= distance  # of a signed number it counts the magnitude's bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                links += [(int(node), int(x)) for x in reached]
                todo += list(reached)
    return links


def nearest_forest(fps: np.ndarray, distance: int, sizes: np.ndarray | None = None, similarity: float = 0.0) -> list[tuple[int, int]]:
    """Of the links of at most `distance` bits a minimum spanning forest: whatever they join, by the closest ones.

    With the `sizes` of the documents' sets, links count only between sizes that allow a similarity (Jaccard) of `similarity`.
    """
    links: list[tuple[int, int]] = []
    sizes = np.zeros(len(fps), np.int64) if sizes is None else sizes

    def bits(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
        d = np.bitwise_count((a ^ b).view(np.uint64))
        return np.where(np.minimum(n, m) >= similarity * np.maximum(n, m), d, BITS + 1) if similarity else d

    # most documents of a key have no link at all
    step = max(1, (1 << 20) // max(len(fps), 1))
    linked = [(bits(fps[i : i + step, None], sizes[i : i + step, None], fps, sizes) <= distance).sum(1) > 1 for i in range(0, len(fps), step)]
    if linked:
        at = np.concatenate(linked)
        fps, sizes = fps[at], sizes[at]
    while len(fps) > 1:
        rest, held = fps[1:], sizes[1:]
        best, source = bits(rest, held, fps[0], sizes[0]), np.full(len(rest), fps[0])
        while len(rest) and best[i := int(best.argmin())] <= distance:
            node, n = rest[i], held[i]
            links.append((int(source[i]), int(node)))
            rest, held, best, source = (np.delete(x, i) for x in (rest, held, best, source))
            d = bits(rest, held, node, n)
            closer = d < best
            best, source = np.where(closer, d, best), np.where(closer, node, source)
        fps, sizes = rest, held
    return links


def nearest_links(fps: np.ndarray, distance: int, rows: pa.Table, most: int) -> list[tuple[int, int]]:
    """For each fingerprint its `most` closest links of at most `distance` bits to ones of other groups, but those in its list of `failed` and those whose sketches agree in fewer than AGREE bits."""
    links: list[tuple[int, int]] = []
    groups, told = rows["group"].to_numpy(), rows["sketch"].combine_chunks().flatten().to_numpy().reshape(len(fps), -1)
    for fp, group, own, tried in zip(fps.tolist(), groups.tolist(), told, rows["failed"].to_pylist(), strict=True):
        bits = np.bitwise_count((fps ^ fp).view(np.uint64))
        at = np.flatnonzero((bits <= distance) & (groups != group))
        at = at[np.bitwise_count((told[at] ^ own).view(np.uint64)).sum(1) <= HASHES - AGREE]
        if tried and len(at):
            at = at[~np.isin(fps[at], tried)]
        if len(at) > most:
            at = at[np.argsort(bits[at], kind="stable")[:most]]
        links += [(fp, x) for x in fps[at].tolist()]
    return links


def _link(distance: int, most: int | None, joined=forest, similarity: float | None = None):
    """Over rows sorted by key: links (a, b), and (a, null) for each fingerprint of a key with more than `most`.

    Rows may have the columns group, sketch and failed, which `joined` then takes as well. With a `similarity` the keys
    end in the sizes of the documents' sets, and `joined` takes these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, size, over = None, [], 0, False

        def close() -> list[tuple[int, int | None]]:
            if size < 2 or over:
                return []
            fps = np.concatenate([x[0] for x in kept])
            if kept[0][1] is None:
                return joined(fps, distance)
            if similarity is not None:
                return joined(fps, distance, np.concatenate([x[1] for x in kept]), similarity)
            return joined(fps, distance, pa.Table.from_batches([x[1] for x in kept]))

        for batch in batches:
            keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy()
            if not len(keys):
                continue
            more = "group" in batch.schema.names
            sizes = keys & MOST
            if similarity is not None:
                keys = keys >> SIZE_BITS
            edge = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(keys)]))
            out: list[tuple[int, int | None]] = []
            whole = (ends - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1)
            for a, b in zip(starts[whole].tolist(), ends[whole].tolist(), strict=True):  # groups of one row inside the batch have no link
                if keys[a] != key:
                    out += close()
                    key, kept, size, over = keys[a], [], 0, False
                part = fps[a:b]
                if most is not None and size + len(part) > most:
                    out += [(int(x), None) for x in np.concatenate([*[k[0] for k in kept], part])]
                    kept, size, over = [], size + len(part), True
                else:
                    kept.append((part, sizes[a:b] if similarity is not None else batch.slice(a, b - a) if more else None))
                    size += len(part)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
        out = close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return run


#: The end of a key for the size of a document's set; larger sets count as this large. WIDE: a class of sizes spans so many times what two may differ.
SIZE_BITS, CLASS_BITS, WIDE = 20, 5, 6
MOST = (1 << SIZE_BITS) - 1


def _sized(key: Column, n: Column, similarity: float) -> Column:
    """An array with the key in the class of sizes of a set of `n`, and in the next one if sets of that class may be as similar; the size itself comes last."""
    size = F.least(n, F.lit(MOST)).cast("long")
    of = lambda x: F.floor(F.log(F.greatest(x, F.lit(1))) / (WIDE * -np.log(similarity)))
    both = F.array_distinct(F.array(of(size), F.least(of(size / similarity * (1 + 1e-9)), F.lit((1 << CLASS_BITS) - 1))))
    return F.transform(both, lambda c: F.shiftleft(F.shiftleft(key, CLASS_BITS).bitwiseOR(c), SIZE_BITS).bitwiseOR(size))


def links(fps: DataFrame, distance: int = 4, blocks: int = 6, agree: int = 2, most: int = 8192, blocks2: int = 8, agree2: int = 4, joined=forest, reach: int | None = None, similarity: float | None = None) -> DataFrame:
    """Links a, b between distinct fingerprints that join all that are within `distance` bits of each other, step by step.

    `agree` of `blocks` sets the key's length (21 bits at 2 of 6); take more for more than some 100 million
    fingerprints. A key with more than `most` fingerprints has them dealt again by `agree2` of `blocks2` (32 bits).
    Within a key links of up to `reach` bits count (`distance` if not given); beyond `distance` some pairs share no key.
    `fps` (fp) may have the columns group, sketch and failed, for `joined` as nearest_links. With a `similarity` it has
    n, the size of the document's set, and links count only where the sizes allow that similarity (0.5 or more).
    """
    reach = reach or distance
    if blocks - distance < agree or blocks2 - distance < agree2:
        raise ValueError("fewer blocks are sure to agree than a key takes")

    def keyed(df: DataFrame, blocks: int, agree: int) -> DataFrame:
        rows = df.select("*", F.explode(block_keys(F.col("fp"), blocks, agree)).alias("key"))
        if similarity is None:
            return rows.repartition("key").sortWithinPartitions("key", "fp")
        rows = rows.select("fp", F.explode(_sized(F.col("key"), F.col("n"), similarity)).alias("key"))
        return rows.repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key", "fp")

    first = save(keyed(fps, blocks, agree).mapInArrow(_link(reach, most, joined, similarity), "a long, b long"), "simhash-links")
    found = first.where("b is not null")
    if first.where("b is null").isEmpty():
        return found.distinct()
    over = first.where("b is null").select(F.col("a").alias("fp")).distinct()
    second = keyed(fps.join(over, "fp", "left_semi"), blocks2, agree2).mapInArrow(_link(reach, None, joined, similarity), "a long, b long")
    return found.unionByName(second).distinct()


def components(fps: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every row of `fps`: the smallest doc_id that the links between fingerprints reach."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(links)
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = save(named, "simhash-nodes")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    whole = named.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return fps.join(whole, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, distance: int = 4) -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id that links of at most `distance` bits reach.

    Texts without words share the fingerprint zero and are linked like any others. Rows with a null doc_id take part;
    their id is never the smallest unless no row of the component has one.
    """
    fps = save(fingerprints(docs), "simhash-fp")
    return components(fps, links(fps.select("fp").distinct(), distance))


def jaccard(a: bytes, b: bytes, size: int) -> float:
    x, y = np.unique(shingles(a, size)), np.unique(shingles(b, size))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(len(x) + len(y) - both, 1)


FEW = 500_000  #: pairs whose fingerprints, at most a million longs, are broadcast to find their texts


def _verified(near: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """a, b, ok: whether the shingle sets of the texts (fp, text) of two fingerprints have `similarity` at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], 200):
                ok = [jaccard(a, b, size) >= similarity for a, b in zip(text_bytes(part["text_a"]), text_bytes(part["text_b"]), strict=True)]
                yield pa.RecordBatch.from_arrays([part["a"], part["b"], pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    ends = near.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    if near.count() <= FEW:
        texts = save(texts.join(F.broadcast(ends), "fp"), "simhash-some")
    pairs = near.join(texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b")), "b")
    return save(pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, ok boolean"), "simhash-verified")


def _grouped(groups: DataFrame, links: DataFrame) -> DataFrame:
    """fp, group with the groups that the links join as one."""
    named = lambda c: groups.select(F.col("fp").alias(c), F.col("group").alias(f"group_{c}"))
    roots = connected_components(links.join(named("a"), "a").join(named("b"), "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
    return save(groups.join(roots, groups["group"] == roots["node"], "left").select("fp", F.coalesce("root", "group").alias("group")), "simhash-groups")


def _parts(links: DataFrame) -> DataFrame:
    """group, part of the groups that the links (a, b) hold together."""
    ends = links.select(F.explode(F.array("a", "b")).alias("group")).distinct()
    return ends.join(connected_components(links), F.col("group") == F.col("node"), "left").select("group", F.coalesce("root", "group").alias("part"))


CHUNK, HELD = 1024, 500_000  #: documents of a chunk, and their shingles, on average
ROUGH, BINS = 16_384, 256  #: documents of a chunk that holds profiles alone, on average; counts of a profile


def profile(found: np.ndarray) -> bytes:
    """How many shingles of a set fall into each of BINS classes; 255 stands for that many or more."""
    return np.minimum(np.bincount((found & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def may_pass(rows: pa.Table, reach: int, similarity: float) -> list[tuple[int, int]]:
    """Links between documents of different groups, of at most `reach` bits, whose profiles allow `similarity`, that join whatever all such links join.

    `rows` has fp, group, chunk, own, n (the document's different shingles) and profile. Sets have no more in common than
    the least counts of each class add up to. Documents of one chunk are compared with each other, those of two chunks
    across; of two documents one at least is an `own` one.
    """
    fps, sizes, own = (rows[c].to_numpy() for c in ("fp", "n", "own"))
    sizes = sizes.astype(np.int64)
    told = np.frombuffer(b"".join(rows["profile"].to_pylist()), np.uint8).reshape(len(fps), BINS)
    joined = np.unique(rows["group"].to_numpy(), return_inverse=True)[1]
    chunks = rows["chunk"].to_numpy()
    two, places = chunks.min() < chunks.max(), np.arange(len(fps))
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(chunks == chunks.min()).tolist():
        near = (np.bitwise_count((fps ^ fps[i]).view(np.uint64)) <= reach) & ((chunks != chunks[i]) if two else (places > i))
        at = np.flatnonzero(near & (own | own[i]) & (joined != joined[i]))
        least = np.minimum(told[at], told[i])
        both = np.where((least == 255).any(1), np.minimum(sizes[at], sizes[i]), least.sum(1, dtype=np.int64))
        for j in at[both / (sizes[i] + sizes[at] - both) >= similarity].tolist():
            if joined[j] != joined[i]:
                links.append((int(fps[i]), int(fps[j])))
                joined[joined == joined[j]] = joined[i]
    return links


def _links_of(find, *told):
    """A function of a group's rows that gives the links of `find` as a table."""

    def run(rows: pa.Table) -> pa.Table:
        out = find(rows, *told)
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def _finer(nodes: DataFrame, texts: DataFrame, size: int, similarity: float, reach: int) -> DataFrame:
    """`nodes` (fp, group, part) with parts of over CHUNK documents split: a pair of different groups that passes stays in one part.

    Chance links hold very many documents together in a large table, of which hardly two are alike. So such a part is
    first compared by profiles of a few bytes, within classes of sizes that can be as similar, and what profiles that allow the
    similarity hold together is a part. Groups without such a pair go.
    """
    large = save(nodes.groupBy("part").count().where(F.col("count") > CHUNK).select("part"), "simhash-large")
    if large.isEmpty():
        return nodes

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in pieces(batches):
            sets = [np.unique(shingles(x, size)) for x in found]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in ("fp", "group", "part")], pa.array([len(x) for x in sets], pa.int32()), pa.array([profile(x) for x in sets], pa.binary())], ["fp", "group", "part", "n", "profile"])

    some = nodes.join(large, "part", "left_semi").join(texts, "fp").select("fp", "group", "part", "text")
    rows = save(some.mapInArrow(told, "fp long, group long, part long, n int, profile binary"), "simhash-profiles")
    kind = F.floor(F.log("n") / (-np.log(similarity) * (1 + 1e-9)))  # sizes that allow the similarity are of one class or two that adjoin
    cells = rows.where("n > 0").withColumn("cell", F.explode(F.array(kind, kind + 1))).withColumn("own", F.col("cell") == kind)
    dealt = cells.join(cells.groupBy("part", "cell").agg(F.ceil(F.count("*") / ROUGH).cast("int").alias("chunks")), ["part", "cell"])
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = dealt.select("part", "cell", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "fp", "group", "chunk", "own", "n", "profile")
    found = met.groupBy("part", "cell", "first", "second").applyInArrow(_links_of(may_pass, reach, similarity), "a long, b long")
    named = lambda c: nodes.select(F.col("fp").alias(c), F.col("group").alias(f"group_{c}"))
    held = save(found.join(named("a"), "a").join(named("b"), "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b")), "simhash-may")
    finer = nodes.join(large, "part", "left_semi").drop("part").join(_parts(held), "group")
    return nodes.join(large, "part", "left_anti").select("fp", "group", "part").unionByName(finer.select("fp", "group", "part"))


def passing(rows: pa.Table, reach: int, similarity: float) -> list[tuple[int, int]]:
    """Links between documents of different groups, of at most `reach` bits and of `similarity` at least, that join whatever all such links join.

    `rows` has fp, group, chunk and found (the document's distinct shingles); documents of one chunk are compared with
    each other, those of two chunks across. Every pair is judged by its whole sets, but those that a link has joined.
    """
    fps, sizes = rows["fp"].to_numpy(), rows["found"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
    joined = np.unique(rows["group"].to_numpy(), return_inverse=True)[1]
    told, ids = np.unique(rows["found"].combine_chunks().flatten().to_numpy(), return_inverse=True)
    starts, mine = np.cumsum(sizes) - sizes, np.zeros(len(told), bool)
    chunks = rows["chunk"].to_numpy()
    two, places = chunks.min() < chunks.max(), np.arange(len(fps))
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(chunks == chunks.min()).tolist():
        other = (chunks != chunks[i]) if two else (places > i)
        near = other & (joined != joined[i]) & (np.bitwise_count((fps ^ fps[i]).view(np.uint64)) <= reach)
        at = np.flatnonzero(near & (np.minimum(sizes, sizes[i]) / np.maximum(np.maximum(sizes, sizes[i]), 1) >= similarity))
        if not len(at) or not sizes[i]:
            continue
        own = ids[starts[i] : starts[i] + sizes[i]]
        mine[own] = True
        ends = np.cumsum(sizes[at])
        theirs = ids[np.arange(ends[-1]) + np.repeat(starts[at] - ends + sizes[at], sizes[at])]
        both = np.add.reduceat(mine[theirs], ends - sizes[at], dtype=np.int64)
        mine[own] = False
        for j in at[both / (sizes[i] + sizes[at] - both) >= similarity].tolist():
            if joined[j] != joined[i]:
                links.append((int(fps[i]), int(fps[j])))
                joined[joined == joined[j]] = joined[i]
    return links


def _across(nodes: DataFrame, texts: DataFrame, size: int, similarity: float, reach: int) -> DataFrame:
    """Links a, b that pass between documents of `nodes` (fp, group, part) of one part and different groups, enough to join what all of them join.

    A part is dealt out in chunks, by number and shingles, and each two chunks meet in a task of their own: no pair is left
    out, no pair that fails is written down, and no task holds more than two chunks, however large a part is.
    """

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, told in pieces(batches):
            found = pa.array([np.unique(shingles(x, size)).view(np.int64) for x in told], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in ("fp", "group", "part")], found], ["fp", "group", "part", "found"])

    sets = save(_finer(nodes, texts, size, similarity, reach).join(texts, "fp").select("fp", "group", "part", "text").mapInArrow(shingled, "fp long, group long, part long, found array<long>"), "simhash-sets")
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum(F.size("found")) / HELD)).cast("int")
    dealt = sets.join(sets.groupBy("part").agg(chunks.alias("chunks")), "part").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("part", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "fp", "group", "chunk", "found")
    return met.groupBy("part", "first", "second").applyInArrow(_links_of(passing, reach, similarity), "a long, b long")


def similar(docs: DataFrame, size: int = 5, similarity: float = 0.8, distance: int = 10, reach: int = 12) -> DataFrame:
    """row, doc_id, fp, group of every row of `docs` (row, doc_id, text): rows of one group are linked by fingerprints and verified by their shingles.

    Fingerprints of `size`-word shingles up to `distance` bits apart meet in two of `distance` + 2 blocks (a very large
    key in three of `distance` + 3), and nearly all up to `reach` do. The closest links that hold them together count if
    the shingle sets of two documents with these fingerprints have `similarity` (Jaccard) at least. Where some don't,
    all documents that close fingerprints hold together are compared, each with every one of another group up to `reach`
    bits away. So documents are joined as all pairs would join them, in families of any size. Equal fingerprints are one
    document here.
    Pairs at 0.8 differ by 9 or 10 bits on average, so some of the least similar that would count lie further apart and
    aren't found: about one in five at 0.8, one in twenty at 0.85. A greater `distance` and `reach` find more, with more
    and shorter keys.
    """
    fps = save(fingerprints(docs, size, "row binary, doc_id long", counted=True), "simhash-fp")
    sized = fps.groupBy("fp").agg(F.min_by("n", "row").alias("n"))  # of the document that stands for it
    near = links(sized, distance, distance + 2, 2, 8192, distance + 3, 3, nearest_forest, reach, similarity)
    near = save(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-near")
    linked = save(near.select(F.col("a").alias("fp")).unionByName(near.select(F.col("b").alias("fp"))).distinct(), "simhash-linked")
    first = fps.join(linked, "fp", "left_semi").groupBy("fp").agg(F.min("row").alias("row"))  # one document for each linked fingerprint
    texts = save(docs.select("row", "text").join(first, "row").groupBy("fp").agg(F.min("text").alias("text")), "simhash-texts")
    told = _verified(near, texts, size, similarity)
    groups, failed = _grouped(linked.withColumn("group", F.col("fp")), told.where("ok")), told.where("not ok").select("a", "b")
    apart = failed.join(groups.select(F.col("fp").alias("a"), F.col("group").alias("group_a")), "a").join(groups.select(F.col("fp").alias("b"), F.col("group").alias("group_b")), "b").where("group_a <> group_b")
    apart = save(apart.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")).distinct(), "simhash-apart")
    if not apart.isEmpty():
        # groups that failed links hold together: a pair of different groups can only be found within such a part
        nodes = groups.join(_parts(apart), "group")
        groups = _grouped(groups, save(_across(nodes, texts, size, similarity, reach), "simhash-across"))
    rows = fps.join(groups, "fp", "left")
    return rows.select("row", "doc_id", "fp", F.coalesce("group", "fp").alias("group"))


def keep_one(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of `docs`, all columns kept, of which one stays for each group of `similar` ones: that of its smallest doc_id.

    Rows are told apart by id and text, so a row goes for its own text alone, whatever else has its doc_id. A row
    without a doc_id stays if its group has none with one. Of rows equal in id and text one stays. Null and empty texts
    are alike. Texts of any length are read whole. An empty table stays empty.
    """
    found = save(similar(docs.select("doc_id", "text", row_key().alias("row")), similarity=similarity), "simhash-rows")
    firsts = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count("*").alias("n")).where("n > 1").select("group", F.col("first.row").alias("first"))
    gone = save(found.join(firsts, "group").where("row <> first").select(F.col("row").alias("_gone")).distinct(), "simhash-gone")
    again = save(found.groupBy("row").count().where("count > 1").select(F.col("row").alias("_again")), "simhash-again")
    inner, at, back = tucked(docs)
    keyed = inner.withColumn("_row", row_key(at["doc_id"], at["text"]))
    kept = keyed.join(gone, F.col("_row") == F.col("_gone"), "left_anti")
    if again.isEmpty():
        return kept.select(*back)
    twice = kept.join(again, F.col("_row") == F.col("_again"), "left_semi").dropDuplicates(["_row"])
    return kept.join(again, F.col("_row") == F.col("_again"), "left_anti").unionByName(twice).select(*back)

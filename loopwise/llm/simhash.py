"""Near-duplicates by 64-bit SimHash, joined on themselves by a binary trie."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions, split_table

BITS = 64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprints(texts: list[str | None], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """uint64 fingerprints: a bit is set where over half of the shingles' XXH64 have it set; no word: 0."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() changes A-Z alone
        if len(words) <= shingle:
            hashes += [digest(b" ".join(words), seed)] if words else []
            counts.append(min(1, len(words)))
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes += [digest(line[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
        counts.append(len(words) - shingle + 1)
    n = np.array(counts, np.int64)
    out = np.zeros(len(n), np.uint64)
    if not hashes:
        return out
    flat = np.array(hashes, np.uint64)
    full = np.flatnonzero(n)
    edges = (np.cumsum(n) - n)[full]
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_ = np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    out[full] = np.packbits(2 * set_ > n[full][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


# -- the trie join -------------------------------------------------------------

#: Blocks of bits that are asked to be equal, one level after the other. With at most 3 differing bits over 4 blocks, one block has none.
#: At the last level 27 bits are left: the fourth block has 6, as blocks must not overlap.
LEVELS = (16, 12, 9, 7)


def _rotations(width: int, taken: int) -> list[tuple[int, int]]:
    """(shift, block bits) of the four blocks in the last ``width`` bits, of which ``taken`` are asked to be equal."""
    return [(i * taken, taken) for i in range(4)]


def _bring_forward(fp: np.ndarray, prefix: int, block: int, size: int) -> np.ndarray:
    """The bits after the first ``prefix`` rotated so that their block number ``block`` of ``size`` bits comes first."""
    width = BITS - prefix
    k = np.uint64(block * size)
    if block == 0:
        return fp
    low = np.uint64((1 << width) - 1)
    rest = fp & low
    rest = ((rest << k) | (rest >> (np.uint64(width) - k))) & low
    return (fp & ~low) | rest if prefix else rest


def trie_links(group: np.ndarray, fp: np.ndarray, budget: int, slice_pairs: int = 200_000):
    """Index pairs (i < j) of rows of the same group whose fingerprints differ in 1 to ``budget`` bits.

    Rows must be sorted by (group, fp) and be distinct. Each group is a binary
    trie: a node is a range of rows that agree on the first bits. Node pairs go
    down together, one bit a step; a step that takes the two nodes different
    ways costs one bit, and a pair over the budget is dropped. Pairs go down in
    slices, so that memory stays bounded.
    """
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    last = np.append(first[1:], len(group))
    big = last - first > 1
    stack = [(0, first[big], last[big], first[big], last[big], np.zeros(int(big.sum()), np.int8))]
    while stack:
        depth, a0, a1, b0, b1, err = stack.pop()
        if len(a0) > slice_pairs:
            for k in range(0, len(a0), slice_pairs):
                s = slice(k, k + slice_pairs)
                stack.append((depth, a0[s], a1[s], b0[s], b1[s], err[s]))
            continue
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if depth == BITS or single.any():
            if depth == BITS:
                single[:] = True
            i, j, e = a0[single], b0[single], err[single]
            mask = np.uint64(((1 << (BITS - depth)) - 1) if depth < BITS else 0)
            d = e + np.bitwise_count((fp[i] ^ fp[j]) & mask)
            good = (i != j) & (d <= budget)
            if good.any():
                yield i[good], j[good]
            rest = ~single
            a0, a1, b0, b1, err = a0[rest], a1[rest], b0[rest], b1[rest], err[rest]
        if not len(a0):
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        am, bm = _middle(fp, a0, a1, bit), _middle(fp, b0, b1, bit)
        same = (a0 == b0) & (a1 == b1)
        parts = []
        for x0, x1, y0, y1, cost, keep in (
            (a0, am, b0, bm, 0, None),
            (am, a1, bm, b1, 0, None),
            (a0, am, bm, b1, 1, None),
            (am, a1, b0, bm, 1, ~same),  # a node with itself: its two halves meet once
        ):
            ok = (x1 > x0) & (y1 > y0) & (err + cost <= budget)
            if keep is not None:
                ok &= keep
            ok &= ~((x0 == y0) & (x1 - x0 == 1) & (y1 - y0 == 1))
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], (err[ok] + cost).astype(np.int8)))
        nxt = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if len(nxt[0]):
            stack.append((depth + 1, *nxt))


def _middle(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """First row of each range [lo, hi) that has ``bit``; within a range, rows without it come first."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        has = (fp[np.minimum(mid, len(fp) - 1)] & bit) != 0
        hi = np.where(open_ & has, mid, hi)
        lo = np.where(open_ & ~has, mid + 1, lo)


def forest(n: int, pairs) -> np.ndarray:
    """The smallest index that each of n rows is linked to, over an iterator of index pair arrays."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            np.minimum.at(root, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
            while (root[root] != root).any():
                root = root[root]
    return root


def _solve(batches, budget: int):
    """Of rows sorted by (key, fp), star edges (low, high) of each key's components; keys may span batches."""
    keys, fps, rows = [], [], 0

    def flush(key, fp):
        order = np.lexsort((fp, key))
        key, fp = key[order], fp[order]
        root = forest(len(fp), trie_links(key, fp, budget))
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return key[moved], fp[root[moved]], fp[moved]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys.append(batch.column("key").to_numpy())
        fps.append(batch.column("rot").to_numpy().view(np.uint64))
        rows += batch.num_rows
        if rows < 50_000:
            continue
        key, fp = np.concatenate(keys), np.concatenate(fps)
        open_from = np.searchsorted(key, key[-1])  # the last key may go on in the next batch
        if open_from:
            yield flush(key[:open_from], fp[:open_from])
        keys, fps, rows = [key[open_from:]], [fp[open_from:]], len(key) - open_from
    if rows:
        yield flush(np.concatenate(keys), np.concatenate(fps))


def link_edges(distinct: DataFrame, budget: int = 3, most: int = 8192) -> DataFrame:
    """Edges (low, high) between fingerprints (column fp, distinct) that leave the same components as all links of up to ``budget`` (3) bits.

    By the pigeonhole principle two linked fingerprints agree on one of four
    blocks of 16 bits: each fingerprint goes, with each of its four blocks
    brought to the front, to that block's trie. A trie with more than ``most``
    fingerprints is dealt again by one of four blocks of 12 of its remaining 48
    bits, and so on over 9 and 7 bits (6 in the fourth block of the last 27);
    then 43 bits agree at least, and no trie can hold more than 2**21. No link is lost and no trie is collected unbounded.
    """
    if budget > 3:
        raise ValueError("four blocks allow for three differing bits")
    spark = distinct.sparkSession
    todo = distinct.select(F.col("fp").alias("rot"), F.lit(0).alias("turns"))
    edges, prefix = None, 0
    for level, size in enumerate(LEVELS):

        def turn(batches, prefix=prefix, size=size):
            for b in batches:
                rot, turns = b.column("rot").to_numpy().view(np.uint64), b.column("turns").to_numpy()
                for k in range(4):
                    new = _bring_forward(rot, prefix, k, size)
                    t = turns * 4 + k
                    top = new >> np.uint64(BITS - prefix - min(size, BITS - prefix - k * size))
                    # the key names the blocks that were brought forward and their bits
                    key = (top << np.uint64(8)) | t.astype(np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(new.view(np.int64)), pa.array(t, pa.int32())], names=["key", "rot", "turns"])

        dealt = todo.mapInArrow(turn, "key long, rot long, turns int")
        last = level == len(LEVELS) - 1
        hot = None
        if not last:
            dealt = materialise(dealt, "tries")
            hot = materialise(dealt.groupBy("key").count().where(F.col("count") > most).select("key"), "large-tries")
            if hot.isEmpty():
                hot = None
        small = dealt if hot is None else dealt.join(hot, "key", "left_anti")

        def solve(batches, level=level):
            for key, low, high in _solve(batches, budget):
                turns = (key.view(np.uint64) & np.uint64(255)).astype(np.int64)
                low, high = _undo(low, turns, level), _undo(high, turns, level)
                yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], names=["a", "b"])

        found = small.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "rot").mapInArrow(solve, "a long, b long")
        found = materialise(found, "trie-links")
        edges = found if edges is None else edges.unionByName(found)
        if hot is None:
            break
        todo = dealt.join(hot, "key", "left_semi").select("rot", "turns")
        prefix += size
    return edges


def _undo(fp: np.ndarray, turns: np.ndarray, level: int) -> np.ndarray:
    """The fingerprints as they were before their blocks were brought to the front."""
    fp = fp.copy()
    prefixes = [sum(LEVELS[:k]) for k in range(level + 1)]
    for back, (prefix, size) in enumerate(zip(reversed(prefixes), reversed(LEVELS[: level + 1]), strict=True)):
        block = (turns >> (2 * back)) & 3
        for k in range(1, 4):
            of = block == k
            if of.any():
                width = BITS - prefix
                low = np.uint64((1 << width) - 1)
                rest = fp[of] & low
                s = np.uint64(k * size)
                rest = ((rest >> s) | (rest << (np.uint64(width) - s))) & low
                fp[of] = (fp[of] & ~low) | rest
    return fp


# -- components ----------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) is linked to; as signed longs.

    Large and small stars in turn, until nothing changes. The smallest
    neighbour is a pre-aggregated minimum, so no node's neighbours are ever
    gathered; every round is written, so a lost executor costs one round.
    """
    cur = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        nxt = materialise(small.where("u <> v").distinct(), "edges")
        # a star forest: no centre is itself a leaf, and each leaf has one centre
        centres = nxt.select(F.col("v").alias("u")).distinct()
        leaves, edges_n = nxt.select("u").distinct(), nxt.count()
        if leaves.count() == edges_n and leaves.join(centres, "u", "left_semi").isEmpty():
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("root"))
        cur = nxt
    raise RuntimeError("components didn't settle")


def simhash_components(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text).

    fingerprint: 16 lowercase hex digits; component_id: the smallest doc_id
    that can be reached over links between fingerprints that differ in at most
    ``budget`` bits. Null and empty texts have fingerprint zero and are linked
    like any other. A null doc_id keeps its row and takes no part in the
    minimum (a component of null ids alone has a null id); repeated rows keep
    their own rows. Equal fingerprints are one node of the join however many
    rows share them. An empty table gives an empty result.
    """

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 400_000):
                fp = fingerprints(part.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    prints = materialise(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, fp long"), "fingerprints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "nodes")
    roots = components(link_edges(nodes.select("fp"), budget))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of = materialise(labelled.join(least, "root").select("fp", "component_id", "n"), "labels")
    labels = _with_labels(prints, of)
    return labels.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_labels(prints: DataFrame, of: DataFrame, most: int = 100_000, hot_rows: int = 1_000_000) -> DataFrame:
    """``prints`` (doc_id, fp) with the component_id of their fingerprint in ``of`` (fp, component_id, n rows).

    Fingerprints of more than ``most`` rows, such as that of all empty texts,
    would meet in one task each: their labels are broadcast. They are rows of
    16 bytes, and ``most`` goes up with the table so that there can't be more
    than ``hot_rows`` of them.
    """
    rows = of.agg(F.sum("n")).first()[0] or 0
    most = max(most, rows // hot_rows)
    hot = of.where(F.col("n") > most).select("fp", "component_id")
    cold = of.where(F.col("n") <= most).select("fp", "component_id")
    if hot.isEmpty():
        return prints.join(cold, "fp")
    of_hot = prints.join(F.broadcast(hot.withColumnRenamed("component_id", "_hot").withColumn("_is_hot", F.lit(True))), "fp", "left")
    there = of_hot.where("_is_hot").select("doc_id", "fp", F.col("_hot").alias("component_id"))
    return there.unionByName(of_hot.where("_is_hot is null").select("doc_id", "fp").join(cold, "fp").select("doc_id", "fp", "component_id"))


def near_dedup(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """The row with the smallest doc_id (null first) of each SimHash component of ``docs``; columns unchanged."""
    names = docs.columns
    ids = docs.select(F.col("doc_id").alias("_near_id"))
    if ids.groupBy("_near_id").count().where("count > 1 or _near_id is null").limit(1).isEmpty():
        first = simhash_components(docs, shingle, budget).where("doc_id = component_id").select(F.col("doc_id").alias("_near_id"))
        return docs.join(first.hint("shuffle_hash"), docs["doc_id"] == F.col("_near_id"), "left_semi").select(*names)
    rows = materialise(docs.withColumn("_near_uid", F.monotonically_increasing_id()), "rows")
    found = simhash_components(rows.select(F.col("_near_uid").alias("doc_id"), "text"), shingle, budget).select(F.col("doc_id").alias("_near_uid"), "component_id")
    first = rows.select("_near_uid", F.col("doc_id").alias("_near_id")).join(found, "_near_uid").groupBy("component_id").agg(F.min(F.struct("_near_id", "_near_uid")).alias("low")).select(F.col("low._near_uid").alias("_near_uid"))
    return rows.join(first, "_near_uid", "left_semi").select(*names)

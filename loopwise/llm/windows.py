"""Which fixed-length windows of the documents also start earlier: prefix doubling by Spark over sampled places.

A *window* is W consecutive symbols of one document. One row for each place
and round would shuffle tens of times the input, so places are sampled, in a
way that depends on content alone and loses no window:

1. Inside a task, names of 1, 2, 4, ... symbols are made by doubling (the name
   of 2h symbols is that of a pair of names h apart), up to W. Each window has
   an *anchor*: of its substrings of K symbols the one with the smallest name,
   the leftmost of equals. Equal windows have their anchor at the same place,
   so only windows with equal anchors need to meet. Windows next to each other
   that share an anchor form a *cell*; a cell is one row.
2. Spark sorts the cells by (name of the anchor, name of the whole cell) and
   ranks the anchors. An anchor that occurs once is discarded. Cells that are
   equal as a whole are settled: but for the earliest, their windows also
   start earlier. Cells whose anchor has several surroundings stay open.
3. An open cell is parted by the place of the anchor in the window, first into
   runs of at most 16 windows, then of 4, then of 1. All windows of a run share
   a *core*, which grows with every round until it is the window itself. Spark
   sorts the pairs (rank from the round before, name of the core), ranks them
   anew, and discards what is unique; runs that are equal as a whole are
   settled, and what is left goes to the next round.

The sort streams: however many rows one rank has, a task holds one batch.
Names are 64 bits, and rows are compared by two of them at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import combine, materialise, shuffle_partitions

CHUNK = 400_000  # bytes of text that are worked on at once
_POS = np.uint64((1 << 24) - 1)  # symbols of a chunk, at the foot of an anchor's sort key
_FIELD = (1 << 16) - 1  # the largest number of windows, and place of the anchor, that a packed run holds


@dataclass(frozen=True)
class Windows:
    """W: symbols of a window; K: of an anchor (a power of two); symbols: texts to (uint64 symbols, symbols of each text).

    strict: only a window of another, earlier document counts (else an earlier
    start in the same document does too). sources: whether runs say where they
    start earlier.
    """

    W: int
    K: int
    symbols: Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]
    strict: bool
    sources: bool = True

    def __post_init__(self):
        if self.W < 1 or not 1 <= self.K <= self.W or self.K & (self.K - 1) or self.W - self.K >= _FIELD:
            raise ValueError(f"an anchor of {self.K} symbols doesn't fit a window of {self.W}: it must be a power of two, not longer than the window, and at most {_FIELD} shorter")

    def rounds(self) -> list[int]:
        """Windows of a run in each round after the first: powers of four, down to 1."""
        out = [1]
        while 8 * out[0] <= self.W - self.K + 1:
            out.insert(0, 4 * out[0])
        return out


def names(symbols: np.ndarray, width: int, upto: int) -> dict[int, np.ndarray]:
    """Names of the substrings of 1, 2, 4, ... ``upto`` and of ``width`` symbols, by where they start."""
    out, h = {1: symbols}, 1
    while 2 * h <= max(upto, width):
        out[2 * h] = combine(out[h][:-h], out[h][h:])
        h *= 2
        if h * 2 > width and h >= upto:
            break
    if width not in out:
        half = max(k for k in out if k < width)
        count = len(symbols) - width + 1
        out[width] = combine(out[half][:count], out[half][width - half : width - half + count])
    return out


def stretches(symbols: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of the substrings [at, at + length): a pair of the longest doubled names that cover them, and the length."""
    out = np.zeros(len(at), np.uint64)
    half = np.frexp(length)[1] - 1  # 2**half is the largest power of two that fits
    named, h = symbols, 1
    for k in range(int(half.max(initial=-1)) + 1):
        of = half == k
        out[of] = combine(combine(named[at[of]], named[at[of] + length[of] - h]), length[of].astype(np.uint64))
        if 2 * h <= len(symbols):
            named = combine(named[:-h], named[h:])
        h *= 2
    return out


def cells(spec: Windows, symbols: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """The cells of a concatenation of documents: doc (its place), start, n (windows), off (anchor's place), g and c (names)."""
    W, K = spec.W, spec.K
    count = len(symbols) - W + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return {"doc": none, "start": none, "n": none, "off": none, "g": none.view(np.uint64), "c": none.view(np.uint64)}
    if len(symbols) > int(_POS):
        raise ValueError("a chunk is too long")
    named = names(symbols, W, K)
    g, whole = named[K], named[W]
    low = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
    span, h = W - K + 1, 1
    while 2 * h <= span:
        low = np.minimum(low[:-h], low[h:])
        h *= 2
    if span > h:
        low = np.minimum(low[: len(low) - (span - h)], low[span - h :])
    anchor = (low[:count] & _POS).astype(np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    valid = doc[:count] == doc[W - 1 :]
    new = np.ones(count, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:count] != doc[: count - 1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, count))
    start, n = start[valid[start]], n[valid[start]]
    off = anchor[start] - start
    # a cell's name covers all its symbols: its first and last windows and one between them overlap
    c = combine(combine(whole[start] + off.astype(np.uint64), whole[start + n - 1] + n.astype(np.uint64)), whole[start + n // 2])
    d = doc[start]
    return {"doc": d, "start": start - (np.cumsum(lengths) - lengths)[d], "n": n, "off": off, "g": g[anchor[start]], "c": c}


def pack(start: np.ndarray, n: np.ndarray, off: np.ndarray) -> np.ndarray:
    return (start << 32) | (n << 16) | off


def unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return p >> 32, (p >> 16) & _FIELD, p & _FIELD


def _chunks(symbols: Callable, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, symbols, lengths) of slices of a column; a very long text comes alone."""
    values = texts.to_pylist()
    at = 0
    while at < len(values):
        to, size = at, 0
        while to < len(values) and (to == at or size + len(values[to] or "") <= CHUNK):
            size += len(values[to] or "")
            to += 1
        yield at, to, *symbols(values[at:to])
        at = to


_FIELDS = ("kind", "key", "c", "rid", "p", "ref", "at")
_SCHEMA = "kind byte, key long, c long, rid long, p long, ref long, at long"


def _found(spec: Windows, key, c, rid, p, ref, at) -> pa.RecordBatch:
    return _rows(FOUND, key, c, rid, p, ref, at) if spec.sources else _rows(FOUND, key, c, rid, p)


def _rows(kind: int, key, c, rid, p, ref=None, at=None) -> pa.RecordBatch:
    n = len(rid)
    zero = np.zeros(n, np.int64)
    cols = [x.view(np.int64) if x.dtype == np.uint64 else x for x in (key, c, rid, p, zero if ref is None else ref, zero if at is None else at)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *map(pa.array, cols)], names=list(_FIELDS))


CELL, FOUND, OPEN = 0, 1, 2


def _split_long(spec: Windows, symbols: np.ndarray, lengths: np.ndarray, limit: int = 1 << 22):
    """(first document, offset in it, symbols, lengths) in pieces that a sort key can number; pieces of a document overlap.

    Cells at a cut are cut too, which is harmless: a window's anchor doesn't
    depend on the cut, and runs of windows are parted at places that depend on
    the anchor alone.
    """
    if len(symbols) <= limit:
        yield 0, 0, symbols, lengths
        return
    ends = np.cumsum(lengths)
    for d in range(len(lengths)):
        own = symbols[ends[d] - lengths[d] : ends[d]]
        for a in range(0, max(1, len(own) - spec.W + 1), limit):
            piece = own[a : a + limit + spec.W - 1]
            yield d, a, piece, np.array([len(piece)])


def _settled_here(spec: Windows, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Rows (key, c, rid, p) of one batch, the equal ones settled on the spot, so a frequent passage leaves one row a batch."""
    if not parts:
        return
    g, c, r, p = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(g):
        return
    o = np.lexsort((p, r, c, g))
    g, c, r, p = g[o], c[o], r[o], p[o]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    done = r > r[head] if spec.strict else ~new
    yield _rows(CELL, g[~done], c[~done], r[~done], p[~done])
    if done.any():
        yield _found(spec, r[done], np.zeros(int(done.sum()), np.int64), r[done], p[done], r[head[done]], p[head[done]] >> 32)


def _anchored(spec: Windows):
    """Documents (rid, text) to cells."""

    def run(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            found = []
            for a, b, symbols, lengths in _chunks(spec.symbols, batch.column("text")):
                for first, offset, sy, le in _split_long(spec, symbols, lengths):
                    x = cells(spec, sy, le)
                    found.append((x["g"], x["c"], rid[a:b][first + x["doc"]], pack(x["start"] + offset, x["n"], x["off"])))
            yield from _settled_here(spec, found)

    return run


def _settle(spec: Windows):
    """Rows sorted by (key, c, rid, p) to found runs and to open ones, whose key is their rank; found rows pass through."""

    def run(batches):
        from pyspark import TaskContext

        rank = np.int64(TaskContext.get().partitionId()) << 40  # of the first row of a batch; ranks go up with the sort
        held = None  # rows of the last key that may still be discarded, or its last settled row
        several = False  # whether that key has been seen with more than one surrounding
        ghost = False  # whether the first held row has been given out
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind == FOUND).any():
                yield batch.filter(pa.array(kind == FOUND))
            mine = kind == CELL
            if not mine.any():
                continue
            rows = [batch.column(k).to_numpy()[mine] for k in ("key", "c", "rid", "p")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            g, c, r, p = rows
            skip = np.zeros(len(g), bool)
            skip[0] = held is not None and ghost
            new_g = np.ones(len(g), bool)
            new_g[1:] = g[1:] != g[:-1]
            new = new_g.copy()
            new[1:] |= c[1:] != c[:-1]
            head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
            done = r > r[head] if spec.strict else ~new
            group = np.cumsum(new_g) - 1
            many = np.bincount(group, weights=new) > 1
            many[0] |= held is not None and several
            if done.any():
                zero = np.zeros(int(done.sum()), np.int64)
                yield _found(spec, zero, zero, r[done], p[done], r[head[done]], p[head[done]] >> 32)
            give = ~done & ~skip & many[group]
            if give.any():
                yield _rows(OPEN, rank + group[give], c[give], r[give], p[give])
            rank += group[-1]
            several = bool(many[-1])
            if several:
                k = head[-1]  # the earliest of the last surrounding is enough to judge what follows
                held, ghost = [x[k : k + 1] for x in rows], True
            else:
                wait = (group == group[-1]) & ~done
                held, ghost = [x[wait] for x in rows], False

    return run


def parted(spec: Windows, size: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows parted by the place of their anchor in the window, ``size`` places together.

    Returns (row it comes from, packed run, number of its places, start and
    length of its core): the core is what all windows with these places share.
    """
    start, n, off = unpack(p)
    low = off - n + 1  # the anchor's place goes down as a window goes on
    count = off // size - low // size + 1
    each = np.repeat(np.arange(len(p)), count)
    j = (low // size)[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    anchor = (start + off)[each]
    top = np.minimum(off[each], j * size + size - 1)
    few = top - np.maximum(low[each], j * size) + 1
    last = np.minimum(j * size + size - 1, spec.W - spec.K)
    return each, pack(anchor - top, few, top), j, anchor - j * size, spec.W - (last - j * size)


def _grown(spec: Windows, size: int):
    """Documents with their open runs to smaller runs, keyed by (rank, place, name of the core) and by their own name."""

    def run(batches):
        for batch in batches:
            rid, lists = batch.column("rid").to_numpy(), batch.column("open")
            flat = lists.flatten()
            rank, p = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            per = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(per)), per)
            found = []
            for a, b, symbols, lengths in _chunks(spec.symbols, batch.column("text")):
                of = np.flatnonzero((row >= a) & (row < b))
                if not len(of):
                    continue
                each, q, j, core, size_ = parted(spec, size, p[of])
                base = (np.cumsum(lengths) - lengths)[row[of][each] - a]
                start, n, off = unpack(q)
                key = combine(combine(rank[of][each].view(np.uint64), j.astype(np.uint64)), stretches(symbols, base + core, size_))
                c = combine(stretches(symbols, base + start, n + spec.W - 1), off.astype(np.uint64))
                found.append((key, c, rid[row[of][each]], q))
            yield from _settled_here(spec, found)

    return run


def repeated_windows(docs: DataFrame, spec: Windows) -> DataFrame:
    """(rid, found): for each document with any, the array of (p, ref, at) runs of windows that also start earlier (without sources: of p).

    docs: (rid, text), bucketed by rid, each rid once. p packs (start, windows,
    place of the anchor) of a run; ref and at are the document and place where
    it starts earlier.
    """
    parts = shuffle_partitions(docs.sparkSession)

    def ranked(rows: DataFrame, name: str) -> DataFrame:
        ordered = rows.repartition(parts, "key").sortWithinPartitions("kind", "key", "c", "rid", "p")
        return materialise(ordered.mapInArrow(_settle(spec), _SCHEMA), name)

    settled = [ranked(docs.mapInArrow(_anchored(spec), _SCHEMA), "anchors")]
    for size in spec.rounds():
        left = settled[-1].where(F.col("kind") == OPEN)
        if left.isEmpty():
            break
        lists = left.groupBy("rid").agg(F.collect_list(F.struct("key", "p")).alias("open"))
        rows = docs.join(lists.hint("shuffle_hash"), "rid").select("rid", "text", "open").mapInArrow(_grown(spec, size), _SCHEMA)
        settled.append(ranked(rows, f"runs-{size}"))
    columns = ["p", "ref", "at"] if spec.sources else ["p"]
    found = reduce(DataFrame.unionByName, [x.where(F.col("kind") == FOUND).select("rid", *columns) for x in settled])
    return found.groupBy("rid").agg(F.collect_list(F.struct(*columns)).alias("found"))


def covered(length: int, W: int, p: np.ndarray) -> np.ndarray:
    """Which of a document's symbols lie in one of the runs of windows."""
    start, n, _ = unpack(p)
    depth = np.zeros(length + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, np.minimum(start + n + W - 1, length), -1)
    return np.cumsum(depth[:length]) > 0

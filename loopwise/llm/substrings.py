"""Removal of text that repeats across documents: by words (relative Lempel-Ziv) and by bytes (prefix doubling)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import bucketed, each_copy, with_row_key
from .windows import Windows, covered, repeated_windows, unpack


class _WordNames(dict):
    """64-bit names of words; forgets them all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = name = xxhash.xxh3_64_intdigest(word)
        return name


_names = _WordNames()


def _encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def word_symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    split = [_encode(t).split() for t in texts]  # bytes.split() parts at \\x20 and \\x09-\\x0D alone
    lengths = np.array([len(x) for x in split], np.int64)
    look = _names.__getitem__
    return np.fromiter((look(w) for x in split for w in x), np.uint64, int(lengths.sum())), lengths


_BYTE_NAMES = np.random.default_rng(100).integers(0, 2**64, 256, dtype=np.uint64)


def byte_symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [_encode(t) for t in texts]
    return _BYTE_NAMES[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(x) for x in raw], np.int64)


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    texts, ids = with_row_key(docs)
    return bucketed(texts, "rid", "texts"), ids


def _anchor(anchor: int, window: int) -> int:
    """The anchor asked for, or the largest power of two that fits a shorter window."""
    return min(anchor, 1 << (window.bit_length() - 1))


def _runs(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """(p, ref, at) of row i as arrays; p alone where runs have no sources."""
    value = batch.column("found")[i]
    if not value.is_valid:
        return np.zeros((3, 0), np.int64)
    flat = value.values
    return np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)])


def matches(runs: np.ndarray, W: int) -> np.ndarray:
    """Maximal known matches (start, end, reference, place there) of a document, from its runs of repeated windows, by start.

    Runs that continue both the document and the reference are one match.
    """
    start, n, _ = unpack(runs[0])
    ref, shift = runs[1], runs[2] - start
    o = np.lexsort((start, shift, ref))
    start, n, ref, shift = start[o], n[o], ref[o], shift[o]
    last = start + n  # one past the last window
    new = np.ones(len(o), bool)
    new[1:] = (ref[1:] != ref[:-1]) | (shift[1:] != shift[:-1]) | (start[1:] > last[:-1])
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(last, first) + W - 1 if len(first) else last
    out = np.stack([start[first], end, ref[first], start[first] + shift[first]])
    return out[:, np.argsort(out[0], kind="stable")]


def factors(found: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The greedy parse of a document: factors (start, end, reference, place there), none overlapping another.

    From the left, each factor takes the match that goes on furthest from
    where the last one ended; words that no match holds are literals.
    """
    out, at, k, best = [], 0, 0, -1
    start, end, ref, place = (x.tolist() for x in found)
    while True:
        while k < len(start) and start[k] <= at:
            if best < 0 or end[k] > end[best]:
                best = k
            k += 1
        if best >= 0 and end[best] > at:
            out.append((at, end[best], ref[best], place[best] + at - start[best]))
            at = end[best]
        elif k < len(start):
            at = start[k]
        else:
            return out


def spans(parse: list[tuple[int, int, int, int]], found: np.ndarray, W: int) -> list[tuple[int, int]]:
    """The duplicate spans of a parse, apart and in order.

    A factor of W words and more is a span. A shorter one was cut at the
    boundary to the factor before it: it is followed back over the boundary,
    through its own reference, which makes at least W words, as every match
    has so many.
    """
    own = {(r, e, p - s): s for s, e, r, p in zip(*(x.tolist() for x in found), strict=True)}
    out: list[tuple[int, int]] = []
    for a, b, ref, place in parse:
        back = a if b - a >= W else own.get((ref, b, place - a), a)
        if out and out[-1][1] >= back:
            out[-1] = (min(out[-1][0], back), b)
        else:
            out.append((back, b))
    return out


RLZ_SCHEMA = "rid long, n_words long, n_removed long, kept_sha256 string, n_factors long, longest_factor long"


def rlz_dedup(docs: DataFrame, window: int = 50, anchor: int = 8, with_text: bool = False) -> DataFrame:
    """Remove each word in ``window`` consecutive words that also start in a document with a smaller doc_id.

    Relative Lempel-Ziv: every document is a reference block for those after
    it. The index over the blocks (see ``windows``) gives, for each stretch of
    a document that some earlier block holds, the earliest such block and the
    place there. The document is then parsed greedily into the longest of
    these matches and literals; factors of ``window`` words and more, and
    shorter ones, followed back over the boundary to the factor before, are the
    spans that are removed.

    This is relative Lempel-Ziv in its result, not in how matches are found:
    the index already holds complete matches, so the parse rejects none of
    them. A parse against the text needs every earlier place of a seed (README
    has the figures, and of what the earliest places alone would lose).

    docs: (doc_id, text); other columns are ignored. Null and empty texts have
    no words. Where doc_ids are null or repeat, documents are ordered by
    (doc_id, nulls first, hash of the text), and rows alike in both are one
    document that comes back once for each row. with_text adds ``kept`` (the
    kept words joined by a space). ``anchor`` (a power of two) is shortened to
    fit a shorter window.
    """
    spec = Windows(W=window, K=_anchor(anchor, window), symbols=word_symbols, strict=True)
    texts, ids = _prepared(docs)
    found = repeated_windows(texts, spec)
    schema = RLZ_SCHEMA + ", kept string" * with_text

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(5 + with_text)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = _encode(text).split()
                n, gone, parse = len(words), 0, []
                runs = _runs(batch, i)
                if runs.shape[1]:
                    known = matches(runs, window)
                    parse = factors(known)
                    left, at = [], 0
                    for a, b in spans(parse, known, window):
                        left += words[at:a]
                        gone, at = gone + b - a, b
                    words = left + words[at:]
                kept = b" ".join(words)
                row = [n, gone, hashlib.sha256(kept).hexdigest(), len(parse), max((b - a for a, b, _, _ in parse), default=0)]
                for c, x in zip(cols, row + [kept.decode("utf-8", "surrogatepass")] * with_text, strict=True):
                    c.append(x)
            kinds = [pa.int64()] * 2 + [pa.string()] + [pa.int64()] * 2 + [pa.string()] * with_text
            yield pa.RecordBatch.from_arrays([batch.column("rid"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[x.split()[0] for x in schema.split(", ")])

    parsed = texts.join(found.hint("shuffle_hash"), "rid", "left").select("rid", "text", "found").mapInArrow(run, schema)
    return each_copy(parsed, ids)


BYTES_SCHEMA = "rid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_dedup(docs: DataFrame, window: int = 100, anchor: int = 32, with_text: bool = False) -> DataFrame:
    """Remove each byte in a ``window``-byte string that also starts earlier (smaller doc_id, or earlier in the document).

    Prefix doubling up to the threshold: Spark sorts places by the name of
    their first ``anchor`` bytes and ranks them, then sorts the pairs of that
    rank and the name of more bytes, and so on in growing steps, until a place
    is unique (and dropped) or ``window`` bytes are reached (see ``windows``; a
    sampled set of places stands for all, without loss).

    docs: (doc_id, text); other columns are ignored. A null text is empty.
    Where doc_ids are null or repeat, documents are ordered by (doc_id, nulls
    first, hash of the text), and rows alike in both are one document that
    comes back once for each row. with_text adds ``kept`` (binary: the
    remaining bytes, which may cut a character). ``anchor`` (a power of two)
    is shortened to fit a shorter window.
    """
    spec = Windows(W=window, K=_anchor(anchor, window), symbols=byte_symbols, strict=False, sources=False)
    texts, ids = _prepared(docs)
    found = repeated_windows(texts, spec)
    schema = BYTES_SCHEMA + ", kept binary" * with_text

    def run(batches):
        for batch in batches:
            sizes, gone, n_spans, digests, kept = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = _encode(text)
                sizes.append(len(raw))
                p = _runs(batch, i)[0]
                n = 0
                if len(p):
                    mask = covered(len(raw), window, p)
                    n = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    gone.append(int(mask.sum()))
                    raw = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                else:
                    gone.append(0)
                n_spans.append(n)
                digests.append(hashlib.sha256(raw).hexdigest())
                kept.append(raw)
            cols = [batch.column("rid"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * with_text, names=[x.split()[0] for x in schema.split(", ")])

    cut = texts.join(found.hint("shuffle_hash"), "rid", "left").select("rid", "text", "found").mapInArrow(run, schema)
    return each_copy(cut, ids)

"""Quality rules on repeated text, by a suffix array and its common-prefix intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import combine, split_table

WORD_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long, n_maximal_repeats long"
)


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of an integer sequence, and the common prefix lengths of its neighbours.

    Prefix doubling: suffixes sorted by h symbols are sorted by 2h through the
    ranks h further on; only those that still share a rank are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    rank = np.zeros(n + 1, np.int64)  # the first place of its group, from 1; 0: past the end
    rank[order] = 1 + np.maximum.accumulate(np.where(np.concatenate(([True], ordered[1:] != ordered[:-1])), np.arange(n), 0))
    levels, h, sa = [(1, rank)], 1, order
    while True:
        ranks = rank[sa]
        tied = np.zeros(n, bool)
        tied[1:] = ranks[1:] == ranks[:-1]
        tied[:-1] |= tied[1:]
        slots = np.flatnonzero(tied)  # a group's places are next to each other
        if not len(slots):
            break
        active = sa[slots]
        first, second = rank[active], rank[np.minimum(active + h, n)]
        o = np.lexsort((second, first))
        active, first, second = active[o], first[o], second[o]
        sa = sa.copy()
        sa[slots] = active
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank, h = rank.copy(), 2 * h
        rank[active] = 1 + np.maximum.accumulate(np.where(new, slots, 0))
        levels.append((h, rank))
    a, b = sa[:-1], sa[1:]
    lcp = np.zeros(max(0, n - 1), np.int64)
    for h, rank in reversed(levels):
        x = rank[np.minimum(a + lcp, n)]
        lcp[(x > 0) & (x == rank[np.minimum(b + lcp, n)])] += h
    return sa, lcp


def shared_windows(words: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a window of ``size`` words that its document holds twice or more."""
    n = len(words)
    if n < size:
        return np.zeros(n, bool)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    name, last = words.astype(np.uint64), n - size + 1
    gram = combine(name[:last] + np.uint64(1), doc[:last].astype(np.uint64) + np.uint64(1))
    for j in range(1, size):
        gram = combine(gram, name[j : last + j])
    at = np.flatnonzero(doc[:last] == doc[size - 1 :])
    order = at[np.argsort(gram[at])]
    same = gram[order[1:]] == gram[order[:-1]]
    shared = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, shared, 1)
    np.add.at(depth, shared + size, -1)
    return np.cumsum(depth[:n]) > 0


def per_document(mask: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many words of each document are marked."""
    total, ends = np.concatenate(([0], np.cumsum(mask))), np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def lcp_intervals(lcp: np.ndarray, least: int) -> np.ndarray:
    """(first, last, prefix) of all common-prefix intervals of a suffix array whose prefix has ``least`` symbols or more.

    An interval is a largest range of suffixes that share a prefix of this
    length: one for each repeated substring that can't go on to the right.
    """
    out, stack = [], []  # stack: (prefix, first) of open intervals, the prefixes going up
    for k, n in enumerate([*lcp.tolist(), 0]):
        first = k
        while stack and stack[-1][0] > n:
            prefix, first = stack.pop()
            out.append((first, k, prefix))
        if n >= least and (not stack or stack[-1][0] < n):
            stack.append((n, first))
    return np.array(out, np.int64).reshape(-1, 3)


def repeats(words: np.ndarray, lengths: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Maximal repeats of ``least`` words or more inside each document of a concatenation: words covered, the longest, and how many.

    words: word numbers of all documents, one after the other; lengths: words of
    each. A word outside every window of ``least`` words that its document
    repeats lies in no such repeat, so the suffix array is built over the runs
    of the other words, each closed by a symbol of its own.
    """
    n, docs = len(words), len(lengths)
    doc = np.repeat(np.arange(docs), lengths)
    out = {k: np.zeros(docs, np.int64) for k in ("covered", "longest", "maximal")}
    run = shared_windows(words, lengths, least)
    where = np.flatnonzero(run)
    if not len(where):
        return out
    brk = run.copy()
    brk[1:] &= ~run[:-1] | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(brk[where])  # of the runs, among their words
    text = np.insert(doc[where] * (int(words.max()) + 1) + words[where], starts[1:], -1 - np.arange(len(starts) - 1))
    place = np.insert(where, starts[1:], n)
    sa, lcp = suffix_array(text)
    found = lcp_intervals(lcp, least)
    # an interval whose suffixes don't all follow the same symbol can't go on to the left either: it is a maximal repeat
    before = np.where(sa > 0, text[np.maximum(sa - 1, 0)], np.iinfo(np.int64).min)
    changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    found = found[changes[found[:, 1]] > changes[found[:, 0]]]
    own = doc[place[sa[found[:, 0]]]]
    np.maximum.at(out["longest"], own, found[:, 2])
    np.add.at(out["maximal"], own, 1)
    # the union of all their spans: from each place the deepest interval it is in (where that is not maximal, a place before has a longer one that covers it)
    deepest = np.zeros(n + 1, np.int64)
    np.maximum.at(deepest, place[sa[:-1]], lcp)
    np.maximum.at(deepest, place[sa[1:]], lcp)
    starts = np.flatnonzero(deepest[:n] >= least)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + deepest[starts], -1)
    out["covered"] = per_document(np.cumsum(depth[:n]) > 0, lengths)
    return out


BASE_WINDOW = 5  # words of the windows that the base rule counts


def _measure(texts: list[str | None], least: int) -> dict[str, np.ndarray]:
    numbers: dict[bytes, int] = {}
    flat, lengths, chars, symbols, dup_lines = [], [], [], [], []
    for text in texts:
        text = text or ""
        words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() parts at exactly the six characters of WORD_SPACE
        lengths.append(len(words))
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
        chars.append(len(text) - sum(map(text.count, WORD_SPACE)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        lines = [x for x in text.split("\n") if x.strip(WORD_SPACE)]
        dup_lines.append(len(lines) - len(set(lines)))
    n, words = np.array(lengths, np.int64), np.array(flat, np.int64)
    base = per_document(shared_windows(words, n, BASE_WINDOW), n)
    return {"n_words": n, "word_chars": np.array(chars), "n_symbols": np.array(symbols), "n_dup_lines": np.array(dup_lines), "n_repeat_words": base} | repeats(words, n, least)


def _verdicts(m: dict[str, np.ndarray], max_covered: float, max_longest: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of measured texts."""
    n = m["n_words"]
    failed = (n < min_words) | (100 * m["n_repeat_words"] > 20 * n)
    return failed, ~failed & ~(m["covered"] > max_covered * n) & ~(m["longest"] > max_longest)


def quality_rules(docs: DataFrame, least_repeat: int = 20, max_covered: float = 0.1, max_longest: int = 100, min_words: int = 10) -> DataFrame:
    """Measures and verdict of each row of ``docs`` (doc_id, text); one row out for each row in.

    A text's word-level suffix array gives, through its common-prefix
    intervals, every maximal repeat of ``least_repeat`` words or more; their
    spans together are the covered words. A document is kept if the base rule
    holds (on 5-word windows, whatever ``least_repeat``), the covered words
    are at most ``max_covered`` of its words, and its longest repeat is at most
    ``max_longest`` words, however long the text. Null and empty texts have no
    word and fail the base rule; null and repeated ids are passed on as they
    are; other columns are ignored. Texts are handled in slices of a few
    hundred kilobytes, so memory follows the longest text, not the partition.
    """

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 400_000):
                m = _measure(part.column("text").to_pylist(), least_repeat)
                failed, kept = _verdicts(m, max_covered, max_longest, min_words)
                counts = [pa.array(m[k], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                more = [pa.array(m[k], pa.int64()) for k in ("covered", "longest", "maximal")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array(failed), pa.array(kept), *more], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def keep_quality(docs: DataFrame, least_repeat: int = 20, max_covered: float = 0.1, max_longest: int = 100, min_words: int = 10) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 400_000):
                m = _measure(part.column("text").to_pylist(), least_repeat)
                yield part.filter(pa.array(_verdicts(m, max_covered, max_longest, min_words)[1]))

    return docs.mapInArrow(run, docs.schema)

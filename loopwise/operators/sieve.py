"""Sieves: rows whose key has no partner on the other side of a join are dropped before they are shuffled; never one too many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 16  # of 64 bits each in a block
BITS = 16  # for each key, as long as there are blocks enough
MOST_BLOCKS = 1 << 16  # 8 MB of bits: with more keys a sieve lets more through


def _place(names: list[str], blocks: int) -> tuple[str, str, str]:
    """SQL of a key's block, word and bit."""
    name = f"xxhash64({', '.join(names)})"
    return f"pmod(shiftright({name}, 10), {blocks})", f"cast(pmod(shiftright({name}, 6), {WORDS}) AS int)", f"cast(pmod({name}, 64) AS int)"


@dataclass
class Sieve:
    bits: DataFrame  # (block, words); blocks without a key are left out
    blocks: int


def sieve(keys: DataFrame, names: list[str]) -> Sieve:
    """A Bloom filter with one hash of the columns ``names``: one aggregation with map-side combining. ``keys`` is read twice."""
    blocks = min(MOST_BLOCKS, keys.count() * BITS // (64 * WORDS) + 1)
    block, word, bit = _place(names, blocks)
    marked = keys.selectExpr(f"{block} AS block", f"{word} AS w", f"shiftleft(1L, {bit}) AS b")
    words = [F.expr(f"bit_or(CASE WHEN w = {j} THEN b ELSE 0L END)") for j in range(WORDS)]
    return Sieve(marked.groupBy("block").agg(F.array(*words).alias("words")), blocks)


def sifted(rows: DataFrame, names: list[str], by: Sieve) -> DataFrame:
    """Those of ``rows`` whose columns ``names``, of the same types, may be a key of the sieve: all that are, and about one in sixteen others."""
    block, word, bit = _place(names, by.blocks)
    return rows.join(F.broadcast(by.bits), F.expr(f"{block} = block AND getbit(words[{word}], {bit}) = 1"), "left_semi")

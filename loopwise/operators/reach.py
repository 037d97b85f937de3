"""Which companies can be reached within some hops, by labels of a fixed size: never too few, sometimes too many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise

WORDS = 16  # of 64 bits each
LABEL = [f"l{j}" for j in range(WORDS)]


def _bit(company: str) -> tuple[str, str]:
    """SQL of a company's word and bit in a label."""
    name = f"xxhash64({company})"
    return f"pmod(shiftright({name}, 6), {WORDS})", f"cast(pmod({name}, 64) AS int)"


def may_reach(company: str) -> str:
    """SQL that is true where the label of the row holds ``company``: always if it can be reached, else by chance."""
    word, bit = _bit(company)
    return f"getbit(CASE {word} {' '.join(f'WHEN {j} THEN l{j}' for j in range(WORDS))} END, {bit}) = 1"


def reach_labels(hops: DataFrame, most: int) -> list[DataFrame]:
    """For 1 .. ``most`` hops (v, l0 .. l15): the bits of all companies that v reaches by as many hops (src, dst) or fewer.

    A label is a Bloom filter with one hash: 128 bytes for each company and
    number of hops, where all pairs in reach are up to the square of the
    companies. Labels of one hop more are those of the next companies put
    together, one join and one aggregation with map-side combining. Companies
    that lead nowhere have none. Beyond about a thousand companies in reach a
    label is full and lets all through.
    """
    hops = materialise(hops.select("src", "dst").distinct(), "hops")
    word, bit = _bit("dst")
    both = lambda rows: rows.groupBy("v").agg(*[F.expr(f"bit_or({c})").alias(c) for c in LABEL])
    marked = hops.selectExpr("src AS v", f"{word} AS w", f"shiftleft(1L, {bit}) AS b")
    one = materialise(both(marked.selectExpr("v", *[f"CASE WHEN w = {j} THEN b ELSE 0L END AS {c}" for j, c in enumerate(LABEL)])), "labels")
    out = [one]
    for _ in range(most - 1):
        further = hops.join(out[-1].withColumnRenamed("v", "dst"), "dst").selectExpr("src AS v", *LABEL)
        out.append(materialise(both(further.unionByName(one)), "labels"))
    return out

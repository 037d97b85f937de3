"""Embedding whitening: an exact scatter matrix from residues modulo several primes, and its leading components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import integer_blocks, integers, tree_reduce, usable

OFFSET = 100_000
COMPONENTS = 8
LARGEST_PRIME = 1 << 20
AT_ONCE = 4096  # rows of one product: 2**12 products of residues below 2**20 stay below 2**53, where doubles are exact
NOTHING = 1e-10  # of the largest eigenvalue: below, doubles can't tell a direction from rounding


def primes_over(bound: int) -> list[int]:
    """The largest primes below 2**20 whose product exceeds ``bound``."""
    out, product, p = [], 1, LARGEST_PRIME - 1
    while product <= bound:
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
    return out


def residue_products(x: np.ndarray, n: int, sums: list[int], primes: list[int]) -> np.ndarray:
    """For each prime p the matrix sum of z z^T mod p over the columns of ``x``, where z = n * x - sums."""
    out = np.zeros((len(primes), len(x), len(x)), np.int64)
    for k, p in enumerate(primes):
        shift = np.array([s % p for s in sums], np.int64)[:, None]
        for a in range(0, x.shape[1], AT_ONCE):
            z = ((x[:, a : a + AT_ONCE] % p) * (n % p) - shift) % p
            z = z.astype(np.float64)
            out[k] = (out[k] + (z @ z.T).astype(np.int64) % p) % p
    return out


def from_residues(residues: np.ndarray, primes: list[int]) -> list[list[int]]:
    """The integers of smallest absolute value that have these residues (Chinese remainders)."""
    product = math.prod(primes)
    weights = [product // p * pow(product // p, -1, p) for p in primes]
    whole = sum(residues[k].astype(object) * w for k, w in enumerate(weights)) % product
    return [[int(v) - product if 2 * int(v) > product else int(v) for v in row] for row in whole]


@dataclass(frozen=True)
class Moments:
    """n vectors of integers with ``sums`` by component; reach: the largest |n * x - sums| that occurs."""

    n: int
    sums: list[int]
    reach: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums of columns ``x``, exact: 64-bit where they fit (n * x may wrap round, the difference is right nevertheless), else Python integers."""
        if self.reach < 2**62:
            return x * np.int64(self.n) - np.array([(s + 2**63) % 2**64 - 2**63 for s in self.sums], np.int64)[:, None]
        return x.astype(object) * self.n - np.array(self.sums, object)[:, None]


@dataclass(frozen=True)
class Whitening:
    """basis (length, k) and eigenvalues (k) of the covariance, the largest first, and its trace."""

    moments: Moments
    basis: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def whiten(self, z: np.ndarray) -> np.ndarray:
        """(k, rows): centred columns projected on the components, over the root of their eigenvalues."""
        return (self.basis.T @ (z / self.moments.n).astype(np.float64)) / np.sqrt(self.eigenvalues)[:, None]


def exact_moments(blocks: DataFrame, length: int) -> Moments:
    """First tree reduction: count, sums and ranges of the components, as Python integers, so that no sum overflows."""

    def zero():
        return 0, [0] * length, None, None

    def add(acc, block):
        block = block.astype(np.int64) + OFFSET
        high, low = (block >> 31).sum(axis=1).tolist(), (block & (2**31 - 1)).sum(axis=1).tolist()
        return merge(acc, (block.shape[1], [(h << 31) + v for h, v in zip(high, low, strict=True)], block.min(axis=1).tolist(), block.max(axis=1).tolist()))

    def merge(a, b):
        pick = lambda f, u, v: v if u is None else u if v is None else list(map(f, u, v))
        return a[0] + b[0], [u + v for u, v in zip(a[1], b[1], strict=True)], pick(min, a[2], b[2]), pick(max, a[3], b[3])

    n, sums, least, largest = tree_reduce(blocks, length, zero, add, merge)
    return Moments(n, sums, max((max(n * hi - s, s - n * lo) for lo, hi, s in zip(least or [], largest or [], sums, strict=bool(least))), default=0))


def exact_scatter(blocks: DataFrame, length: int, moments: Moments) -> list[list[int]]:
    """Second tree reduction: the sum of z z^T over all vectors, z = n * x - sums, exact.

    Each task multiplies residues as doubles, without rounding, and the
    residues of its products are reduced. The primes suffice for a bound that
    follows from n and the range of the components.
    """
    primes = primes_over(2 * moments.n * moments.reach**2 + 1)

    def add(acc, block):
        return merge(acc, residue_products(block.astype(np.int64) + OFFSET, moments.n, moments.sums, primes))

    def merge(a, b):
        return (a + b) % np.array(primes, np.int64)[:, None, None]

    residues = tree_reduce(blocks, length, lambda: np.zeros((len(primes), length, length), np.int64), add, merge)
    return from_residues(residues, primes)


def fit(blocks: DataFrame, length: int, most: int = COMPONENTS) -> Whitening:
    """Leading eigenvectors of the exact scatter, each entry of which is rounded to a double once; their largest entry is positive."""
    moments = exact_moments(blocks, length)
    scatter = exact_scatter(blocks, length, moments)
    covariance = np.array([[v / moments.n**3 for v in row] for row in scatter], np.float64).reshape(length, length)
    values, basis = np.linalg.eigh(covariance) if length else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(0.0, NOTHING * values.max(initial=0.0))]
    basis = basis[:, order]
    if basis.size:
        basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    return Whitening(moments, basis, values[order], sum(scatter[d][d] for d in range(length)) / moments.n**3)


def identity_error(blocks: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; each block is centred before it is multiplied, and blocks are merged about their common mean."""
    k = len(fitted.eigenvalues)
    shared = blocks.sparkSession.sparkContext.broadcast(fitted)

    def zero():
        return 0, np.zeros(k), np.zeros((k, k))

    def add(acc, block):
        for a in range(0, block.shape[1], AT_ONCE):
            w = shared.value.whiten(shared.value.moments.centred(block[:, a : a + AT_ONCE].astype(np.int64) + OFFSET))
            mean = w.mean(axis=1)
            acc = merge(acc, (w.shape[1], mean, (w - mean[:, None]) @ (w - mean[:, None]).T))
        return acc

    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        apart = b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    n, _, scatter = tree_reduce(blocks, len(fitted.moments.sums), zero, add, merge)
    shared.unpersist()
    return float(np.abs(scatter / n - np.eye(k)).max(initial=0.0))


def whitened_embeddings(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row for each usable vector and leading component.

    Entries become x = floor(1024 * c) + 100000. All usable vectors are fitted;
    null ids and repeated rows count like others and come back each on its own.
    Left out are vectors that are null or hold null or non-finite entries, and
    those of another length than most have. Components without variance are no
    components: equal vectors alone, or an empty table, give no rows. deviation
    is a long; only where n and the range are so large that one can't hold the
    exact sum is it a decimal(38,0), and beyond that an error.
    The driver holds one scatter matrix and its residues, whose size depends on
    the vectors' length alone.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    length, blocks = integer_blocks(vectors, column)
    if blocks is None:
        return spark.createDataFrame([], schema)
    fitted = fit(blocks, length, most)
    k = len(fitted.eigenvalues)
    if not k:
        return spark.createDataFrame([], schema)
    off = identity_error(blocks, fitted)
    most_deviation = length * fitted.moments.reach**2
    wide = most_deviation >= 2**63
    if most_deviation >= 10**38:
        raise OverflowError("deviations of so many or so large vectors don't fit 38 digits")
    shared = spark.sparkContext.broadcast(fitted)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        w = shared.value
        for batch in batches:
            for _, at, columns in integers(batch.column("v")):
                z = w.moments.centred(columns + OFFSET)
                far = z.astype(object) if wide else z
                deviation = (far * far).sum(axis=0)
                deviation = pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)) if wide else pa.array(deviation.astype(np.int64))
                each = np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(at[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), w.moments.n, np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array(w.whiten(z).T.ravel()),
                        pa.array(np.tile(w.eigenvalues / w.trace, len(at))),
                        pa.array(np.full(len(each), off)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    rows = vectors.where(usable(column) & (F.size(column) == length)).select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return rows.mapInArrow(apply, schema.replace("deviation long", "deviation decimal(38,0)") if wide else schema)

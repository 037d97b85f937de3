"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, split_table

BUCKETS = 1 << 16
STATISTICS = 12
SYMBOLS = b"#*$%&|<>!"
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = out = zlib.crc32(word) % BUCKETS
        return out


_buckets = _Buckets()


@dataclass
class Sparse:
    """Rows of (feature, value) pairs: those of row i are edges[i]:edges[i + 1]."""

    index: np.ndarray
    value: np.ndarray
    edges: np.ndarray

    def rows(self, which: np.ndarray) -> Sparse:
        size = np.diff(self.edges)[which]
        edges = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.edges[which] - edges[:-1], size) + np.arange(edges[-1])
        return Sparse(self.index[at], self.value[at], edges)


def features(texts: list[str | None], n_chars: list[int | None]) -> Sparse:
    """Word buckets with damped counts of unit length, then the statistics; every row has all statistics."""
    flat, lengths, stats = [], [], []
    look = _buckets.__getitem__
    for text, said in zip(texts, n_chars, strict=True):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.lower().split()
        flat += map(look, words)
        n, size = len(words), max(1, len(raw))
        lengths.append(n)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        different = len(set(words))
        gone = lambda chars: 1 - len(raw.translate(None, chars)) / size  # noqa: B023, E731
        triples = len(set(zip(words, words[1:], words[2:], strict=False)))
        stats.append(
            (
                1.0,
                np.log1p(n) / 5,
                different / max(1, n),
                (size / max(1, n)) / 10,
                np.sqrt(gone(SYMBOLS)),
                gone(_CAPITALS),
                gone(_DIGITS),
                1 - len(set(lines)) / max(1, len(lines)),
                triples / max(1, n - 2),
                np.log1p(len(lines)) / 5,
                float(n < 10),
                # metadata: the length the table states; the text's own where it states none
                np.log1p(max(0, len(text or "") if said is None else said)) / 8,
            )
        )
    lengths = np.array(lengths, np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    key, count = np.unique(row * BUCKETS + np.array(flat, np.int64), return_counts=True) if len(flat) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    row, index = key // BUCKETS, key % BUCKETS
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=len(texts)))
    value = value / norm[row] if len(row) else value
    rows = np.concatenate((row, np.repeat(np.arange(len(texts)), STATISTICS)))
    order = np.argsort(rows, kind="stable")
    index = np.concatenate((index, np.tile(BUCKETS + np.arange(STATISTICS), len(texts))))[order]
    value = np.concatenate((value, np.array(stats, np.float64).reshape(-1)))[order]
    return Sparse(index, value, np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts))))))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # features x rank

    def raw(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """(scores, sums of factors); pairs cost linear time: half of (sum v x)**2 - sum (v x)**2."""
        if len(x.edges) == 1:
            return np.zeros(0), np.zeros((0, self.factors.shape[1]))
        vx = self.factors[x.index] * x.value[:, None]
        sums = np.add.reduceat(vx, x.edges[:-1], axis=0)
        squares = np.add.reduceat(vx * vx, x.edges[:-1], axis=0)
        line = np.add.reduceat(self.linear[x.index] * x.value, x.edges[:-1])
        return self.bias + line + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x)[0], -40, 40)))


def fit(x: Sparse, labels: np.ndarray, rank: int = 8, epochs: int = 6, rate: float = 0.1, decay: float = 1e-4, batch: int = 128, seed: int = 4) -> Machine:
    """Logistic loss by AdaGrad over small batches; without rows, everything scores one half."""
    n = BUCKETS + STATISTICS
    rnd = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(n), rnd.normal(0, 0.02, (n, rank)))
    if not len(labels):
        return Machine(0.0, np.zeros(n), np.zeros((n, rank)))
    seen_l, seen_f, seen_b = np.full(n, 1e-6), np.full((n, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rnd.permutation(len(labels))
        for a in range(0, len(order), batch):
            which = order[a : a + batch]
            own = x.rows(which)
            raw, sums = m.raw(own)
            err = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[which]) / len(which)
            each = np.repeat(err, np.diff(own.edges)) * own.value
            row = np.repeat(np.arange(len(which)), np.diff(own.edges))
            used, inverse = np.unique(own.index, return_inverse=True)
            g = np.bincount(inverse, weights=each) + decay * m.linear[used]
            pairs = each[:, None] * (sums[row] - m.factors[own.index] * own.value[:, None])
            gf = np.stack([np.bincount(inverse, weights=pairs[:, k]) for k in range(rank)], axis=1) + decay * m.factors[used]
            seen_l[used] += g * g
            seen_f[used] += gf * gf
            m.linear[used] -= rate * g / np.sqrt(seen_l[used])
            m.factors[used] -= rate * gf / np.sqrt(seen_f[used])
            seen_b += err.sum() ** 2
            m.bias -= rate * err.sum() / np.sqrt(seen_b)
    return m


def _with_length(docs: DataFrame) -> list:
    return [F.col("n_chars").cast("long").alias("n_chars") if "n_chars" in docs.columns else F.lit(None).cast("long").alias("n_chars")]


def _remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = 8000, fit_features: int = 8_000_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text, n_chars if there).

    labels: (doc_id, quality). The machine is fitted on at most ``fit_rows``
    labelled rows that aren't held out (crc32 of doc_id as text, mod 3, is not
    1), the first by a hash of their id, and of these on as many as have
    ``fit_features`` features together, so that what the driver gets is
    bounded (12 bytes a feature) however long the texts; an id labelled twice
    counts once, by its larger label, and of several rows with one id the
    least text counts. A null doc_id is never held out. Null and empty texts
    get the score of their statistics. Repeated ids keep their rows; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_with_length(docs))
    known = labels.where("doc_id is not null and quality is not null").where(_remainder(F.col("doc_id")) != 1)
    known = known.groupBy(F.col("doc_id").alias("l_id")).agg(F.max("quality").cast("int").alias("label")).orderBy(F.xxhash64("l_id"), "l_id").limit(fit_rows)

    def prepare(batches):
        for batch in batches:
            for part in split_table(batch, 400_000):
                x = features(part.column("text").to_pylist(), part.column("n_chars").to_pylist())
                cuts = list(zip(x.edges, x.edges[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(np.diff(x.edges), pa.int64()), pa.array([x.index[a:b].astype("<i4").tobytes() for a, b in cuts], pa.binary()), pa.array([x.value[a:b].astype("<f4").tobytes() for a, b in cuts], pa.binary())],
                    names=["doc_id", "label", "size", "index", "value"],
                )

    # bounded by fit_rows: the ids for the broadcast, and one row for each of them
    sample = base.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).groupBy("doc_id", "label").agg(F.min(F.struct("text", "n_chars")).alias("row")).select("doc_id", "label", "row.*")
    ready = materialise(sample.mapInArrow(prepare, "doc_id long, label int, size long, index binary, value binary"), "labelled-features")
    so_far = F.sum("size").over(W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0))  # over ids and sizes, at most fit_rows rows
    chosen = ready.select("doc_id", "size").withColumn("so_far", so_far).where(F.col("so_far") <= fit_features).select("doc_id")
    got = ready.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "label", "index", "value").toArrow().sort_by([("doc_id", "ascending")])
    index, value = (got.column(k).to_pylist() for k in ("index", "value"))
    x = Sparse(np.frombuffer(b"".join(index), "<i4").astype(np.int64), np.frombuffer(b"".join(value), "<f4").astype(np.float64), np.concatenate(([0], np.cumsum([len(v) // 4 for v in index]))).astype(np.int64))
    machine = spark.sparkContext.broadcast(fit(x, got.column("label").to_numpy().astype(np.float64)))

    def run(batches):
        m = machine.value
        for batch in batches:
            for part in split_table(batch, 400_000):
                s = m.score(features(part.column("text").to_pylist(), part.column("n_chars").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[k.split()[0] for k in SCHEMA.split(", ")])

    return base.select("doc_id", F.coalesce(_remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "text", "n_chars").mapInArrow(run, SCHEMA)

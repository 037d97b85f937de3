"""Best-fit packing of tokenized documents into sequences, by minimum bin slack."""

from __future__ import annotations

import json
import re
import zlib
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions, split_table

# Characters that normalise and lower-case one by one, so that words may be tokenized on their own.
_OTHER = re.compile("[^\t\n\x0b\x0c\r -~\xa1-\xac\xae-įı-ſ]")


class Tokens(dict):
    """Token ids (little-endian uint32) of words between white space, looked up word by word.

    The tokenizer file drops white space and never joins across it, so a text's
    ids are those of its words. Words are remembered; a text with characters
    whose treatment depends on neighbours goes to the tokenizer as a whole, as
    does everything if the file is built in another way.
    """

    def __init__(self, path: str, remembered: int = 700_000):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.remembered = remembered
        self.parts: dict[str, bytes] = {}
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.simple = steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in parts] == ["Split", "ByteLevel"] and not spec.get("post_processor")
        self.pattern = regex.compile(parts[0]["pattern"]["Regex"]) if self.simple else None
        # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def _part(self, part: str) -> bytes:
        """Ids of one match of the pattern."""
        if (out := self.parts.get(part)) is None:
            shown = part if part.isascii() else "".join(map(self.alphabet.__getitem__, part.encode()))
            ids = [t.id for t in self.model.tokenize(shown)]
            if len(self.parts) >= self.remembered // 2:
                self.parts.clear()
            self.parts[part] = out = pack(f"<{len(ids)}I", *ids)
        return out

    def __missing__(self, word: str) -> bytes:
        low = word.lower()
        if low.isalpha():  # letters alone are one match, and with a mark behind them two
            out = self._part(low)
        elif low[:-1].isalpha() and low[-1] in ".,":
            out = self._part(low[:-1]) + self._part(low[-1])
        else:
            out = b"".join(map(self._part, self.pattern.findall(low)))
        if len(self) >= self.remembered:
            self.clear()
        self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        if not self.simple or "<|" in text or _OTHER.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """The pieces of each row of (doc_id, text): its ids, then ``end_id``, cut after every ``capacity`` ids."""

    def run(batches):
        tokens = tokens_of(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in split_table(batch, 1_000_000):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = tokens.ids(text or "") + end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[a : a + 4 * capacity]
                        rows.append((doc, k, a // 4, len(own) // 4, zlib.crc32(own)))
                if rows:
                    cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(cols)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECES)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination of lengths (descending (length, count)) with the largest sum up to ``room``, long items first.

    Bitset subset-sum: bit s of a state is set if some of the items so far add
    up to s. The states are kept for finding the way back.
    """
    if room <= 0:
        return {}
    mask, state = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, copies, state before them
    for length, count in available:
        if length > room:
            continue
        left, take = min(count, room // length), 1
        while left > 0:  # 1, 2, 4, ... copies stand for any number of them
            take = min(take, left)
            steps.append((length, take, state))
            state |= (state << (length * take)) & mask
            left -= take
            take *= 2
        if state >> room:
            break
    at, out = state.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, how many of it)]), which together use up the histogram.

    Each bin takes the longest piece that is left and the combination that
    leaves least slack beside it; a combination is used as often as the counts
    allow before the next is looked for. The work depends on the number of
    lengths (at most ``capacity``), not of pieces.
    """
    left, bins = {k: v for k, v in histogram.items() if v}, []
    while left:
        longest = max(left)
        rest = sorted(((k, v - (k == longest)) for k, v in left.items()), reverse=True)
        taken = fullest([x for x in rest if x[1]], capacity - longest)
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[k] // n for k, n in taken.items())
        bins.append((times, sorted(taken.items(), reverse=True)))
        for k, n in taken.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return bins


def slots(bins: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """(length, first number, sequence, offset, how many in a sequence) of runs of places, sorted by the first two."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, taken in bins:
        offset = 0
        for length, n in taken:
            out.append((length, used.get(length, 0), sequence, offset, n))
            used[length] = used.get(length, 0) + n * times
            offset += length * n
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 5)


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens; one row for each piece.

    tokenizer: path of a tokenizer file on every machine (None: the public
    word BPE). A null text is empty and gives its end token alone; null and
    repeated ids are documents of their own; other columns are ignored; an
    empty table gives an empty result. The driver gets one count for each
    length, at most ``capacity`` of them, and plans bins by minimum bin slack;
    pieces of a length are numbered over salted groups and look up their place
    in a table of bins, whose size depends on ``capacity`` alone.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, capacity), "pieces")
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(shuffle_partitions(spark))).cast("int"))
    counts = materialise(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    if not histogram:
        return spark.createDataFrame([], PACKED)
    places = spark.sparkContext.broadcast(slots(minimum_bin_slack(histogram, capacity)))
    before = counts.withColumn("base", F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))).select("length", "salt", F.coalesce("base", F.lit(0)).alias("base"))
    within = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    # one row for each length and salt: it grows with the partitions, so it is shuffled to them, not broadcast
    numbered = salted.withColumn("k", within).join(before.hint("shuffle_hash"), ["length", "salt"]).withColumn("number", F.col("base") + F.col("k") - 1)

    def place(batches):
        table = places.value
        keys = table[:, 0] * (1 << 48) + table[:, 1]
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            run = table[np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1]
            j = number - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")] + [pa.array(run[:, 2] + j // run[:, 4]), pa.array(run[:, 3] + j % run[:, 4] * length)],
                names=[x.split()[0] for x in PACKED.split(", ")],
            )

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, PACKED)

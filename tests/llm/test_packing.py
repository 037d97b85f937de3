"""Packing: token ids and pieces by an exact round trip, bins against brute force."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from loopwise.llm.packing import Tokens, fullest, minimum_bin_slack, pack_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, offset string"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_the_tokenizers(tokenizer):
    rnd = random.Random(4)
    bits = ["Hello", "world's", "don't", " ", "\n", "\t", "'ll", "É", "ß", "straße", "İ", "ŉ", "²", "½", "12", "a_b", "<|endoftext|>", "...", "日本", "é", "\xa0", "\x1c", "ª", "x" * 40, "\x85", "🙂", "A1b2", "ſ"]
    own = Tokens(public_tokenizers.path("word_bpe_49k.json"), remembered=40)
    assert own.simple
    for _ in range(2000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
        assert np.frombuffer(own.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_fullest_against_brute_force():
    rnd = random.Random(5)
    for _ in range(200):
        items = [rnd.randrange(1, 30) for _ in range(rnd.randrange(0, 9))]
        room = rnd.randrange(0, 60)
        got = fullest(sorted(Counter(items).items(), reverse=True), room)
        sums = {sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k)}
        assert sum(k * n for k, n in got.items()) == max(s for s in sums if s <= room)
        assert all(n <= items.count(k) for k, n in got.items())


def test_bins_use_up_the_histogram():
    rnd = random.Random(6)
    for _ in range(30):
        h = {rnd.randrange(1, 65): rnd.randrange(1, 50) for _ in range(rnd.randrange(1, 20))}
        bins = minimum_bin_slack(h, 64)
        used = Counter()
        for times, taken in bins:
            assert times > 0 and sum(k * n for k, n in taken) <= 64
            used.update({k: n * times for k, n in taken})
        assert used == Counter(h)


def test_round_trip(spark, tokenizer):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["the", "quick", "Fox's", "jümps", "over", "日本", "42"]) for _ in range(rnd.choice([0, 3, 5000, *range(20, 1200, 7)]))), "x") for i in range(150)]
    rows += [(1000, None, None), (1001, "", "x"), (None, "a b", "x"), (3, rows[3][1], "again"), (3, "else", "again")]
    out = pack_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    want = Counter()
    total = 0
    for doc, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), 2048)):
            own = ids[a : a + 2048]
            want[(doc, k, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter(tuple(r[:5]) for r in out) == want
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for x in by.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-total // 2048) + 1
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0

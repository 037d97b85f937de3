"""The pipeline stage by stage: each result held against a brute-force version on the stage's own input."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from loopwise.llm.mixing import label_domains, mixing_rates
from loopwise.llm.secrets import find_secrets, redact

from .test_quality import brute as repeats_of
from .test_simhash import brute as components_of
from .test_simhash import print_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(12)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(5, 200))) for _ in range(60)]
    texts += [t + " extra" for t in texts[:10]] + texts[10:20] + ["a b c " * 30, "secret=abcdefgh " + texts[30], "", " ".join(rnd.choices(words, k=100)) + " AKIA" + "Z" * 16]
    texts += [" ".join(rnd.choices(words, k=60)) + " vile nasty" for _ in range(20)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)] + [(500, None, None, None, None)]
    labels = [(i, int(len(t) > 40), int("vile" in t)) for i, t in enumerate(texts) if i % 3]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def keeps(text):
    w = (text or "").split()
    base, (covered, longest) = repeats_of(w)[0], repeats_of(w, 20)
    return len(w) >= 10 and 100 * base <= 20 * len(w) and covered <= 0.1 * len(w) and longest <= 100


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialise(stage(spark, docs, folder), "t")
        seen.append((before, docs))
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    for before, after in seen[:4]:
        assert after.columns == columns == before.columns
    before, after = map(text, seen[0])
    assert after == {d: t for d, t in before.items() if keeps(t)}
    before, after = map(text, seen[1])
    ids = sorted(before)
    assert set(after) == set(components_of([print_of(before[d]) for d in ids], ids)) and len(after) < len(before)
    before, after = map(text, seen[2])
    assert after == {d: redact(t, find_secrets(t)[1]) for d, t in before.items()} and any("[SECRET]" in t for t in after.values())
    assert all(r.n_chars == len(r.text) for r in seen[2][1].collect())
    rates = {r.doc_id: r.rate for r in mixing_rates(seen[3][0], label_domains(spark.read.parquet(f"{folder}/labels.parquet")), max_rate=1.0, keep="clean").collect()}  # as the stage does
    before, after = map(text, seen[3])
    assert all(d in after for d, r in rates.items() if r >= 1) and set(after) <= {d for d, r in rates.items() if r > 0}
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for d, x in after.items():
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        want |= {(d, k, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 2048))}
    assert {tuple(r[:5]) for r in seen[4][1].collect()} == want


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None

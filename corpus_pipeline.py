"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loopwise.llm.common import materialise
from loopwise.llm.mixing import label_domains, mixing_rates, take_copies
from loopwise.llm.packing import pack_documents
from loopwise.llm.quality import keep_quality
from loopwise.llm.secrets import redact_secrets
from loopwise.llm.simhash import near_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_quality(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are likeliest clean, with at most the target weights of the other domains; none is taken more than once.

    Documents of a domain that is too scarce for its weight keep a rate of about
    one; those of a domain there is too much of are taken with their rate, by a
    hash of their id.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rates = mixing_rates(docs, label_domains(labels), max_rate=1.0, keep="clean")
    return take_copies(docs, rates.select("doc_id", "rate"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, packed into sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", dedup),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]
#: No stage but the first can be put in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs

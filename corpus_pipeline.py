"""From documents to token ids: language, near-duplicates, secrets, mix and encoding, one operator for each stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm import bpe, mixing, ppm, secret_scan, simhash
from linkrank.llm.common import Work

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those with a null text or without a letter."""
    return ppm.keep_identified(docs, ppm.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by fingerprints of three-word shingles within two bits, the one with the smallest id stays."""
    return simhash.keep_one(docs, limit=2, shingle=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document taken, their number, and the text they decode to."""
    return bpe.round_trip(docs, VOCABULARY).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: SQL can express neither fingerprints nor languages nor token ids; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; what each returns is written in the shared folder and read again."""
    work, docs = Work(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return docs

"""Registered queries of this subpackage: each applies an operator to a whole table and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm import bisectors, bpe, chat_format, embedding_forest, html_blocks, mixing, nbsvm, oracle, periodic_runs, ppm, quality_rules, secret_scan, simhash, warc
from linkrank.llm.common import crc_part


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, findings = secret_scan.scan(_table(spark, sf_dir, "documents"))
    spans = F.coalesce("spans", F.array())

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [count(k) for k in ("assign", "access", "hex")]
    rows = paths.join(findings, "blob", "left").select(F.col("path").alias("doc_id"), spans.alias("spans"))
    listed = secret_scan.spans_text(F.col("spans"))
    return rows.select("doc_id", *kinds, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(_table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, archive, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.learn(pages))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = ppm.identify(documents, ppm.learn(documents))
    return rows.select("doc_id", F.coalesce(crc_part("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = nbsvm.score(documents, nbsvm.fit(documents, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc_part("doc_id", 4) == 2, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_bisectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.with_inertia(*bisectors.cluster(_table(spark, sf_dir, "embeddings")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.find_runs(periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda x: F.struct((-x["length"]).alias("short"), x["start"].alias("start"), x["period"].alias("period"), x["length"].alias("length"))))
    listed = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(oracle.PROBE).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    read = chat_format.read_chats(chat_format.format_chats(rows))
    said, loss = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), F.array_join("loss", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_secret_scan, op2_warc, op3_html_blocks, op4_simhash, op5_embedding_forest, op6_mixing, op7_bpe, op8_isolation_forest, op9_ppm_language, op10_nbsvm_quality, op11_bisectors, op12_periodic_runs, op13_chat_format)
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = {"op1_secret_scan": oracle.secrets_sql(), "op2_warc": oracle.warc_sql(), "op5_embedding_forest": oracle.near_vectors_sql(), "op6_mixing": oracle.mixing_sql(), "op11_bisectors": oracle.bisectors_sql(), "op13_chat_format": oracle.chats_sql()}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

"""Named queries of the operators over the given tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityflow.llm import (
    decontaminate,
    divergence,
    fertility,
    infill,
    language,
    mixing,
    neighbours,
    pii,
    quality,
    secret_scan,
    simhash,
    token_files,
    toxicity,
)
from cityflow.llm.common import held_out, table


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.withColumn("held_out", held_out())


def op3_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("held_out", held_out())


def op5_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_digest(table(spark, sf_dir, "documents"))


def op8_embedding_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).withColumn("held_out", held_out())


def op11_infill_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mix, op2_language_codes, op3_benchmark_containment, op4_quality_additive,
        op5_pii_anchors, op6_secret_ledger, op7_token_orc, op8_embedding_collisions,
        op9_simhash_pivots, op10_toxicity_network, op11_infill_chunks,
        op12_source_divergence, op13_fertility_rules,
    )
}

ORACLES = {
    "op1_source_mix": "WITH" + mixing.REPORT_SQL.format(docs="documents") + "SELECT * FROM report",
    "op3_benchmark_containment": decontaminate.MATCHES_SQL,
    "op6_secret_ledger": secret_scan.DIGEST_SQL,
    "op11_infill_chunks": infill.DIGEST_SQL,
    "op12_source_divergence": divergence.AUDIT_SQL,
}

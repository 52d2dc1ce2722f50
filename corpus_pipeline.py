"""A corpus made ready for training: five stages, each a table that the next one reads.

Quality, near-duplicates, benchmark passages, the mix of sources, token ids.
Every stage works on all rows its predecessor kept. In all of them a null text is
an empty one, long texts count whole, other columns are carried as they are whatever
their names, rows may repeat and ids may be null or repeat; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityflow.llm import decontaminate, mixing, quality, simhash, token_files
from cityflow.llm.common import table
from cityflow.session import run_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled ones among them.

    Repeated rows share their fate. Without labels every text has the same score.
    """
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints: three-word shingles, two bits, as the operator's contract has it.

    Texts without words are one group; repeated rows leave one row, null ids come last.
    """
    return simhash.one_of_each(docs, width=3, radius=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item inside; empty texts stay, repeated rows share their fate."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; a null source is one of the sources."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC, and their digest read back from the files; an empty text has its end id only."""
    return token_files.write_and_digest(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

# The quality model and the tokenizer have no SQL form; tests hold run() to plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = run_dir(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs

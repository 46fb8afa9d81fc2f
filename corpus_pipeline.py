"""The corpus pipeline: quality rules, near-duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one
reads it from Parquet. All but the last return the columns of documents, and
rows that an earlier stage dropped are never seen again. Repeated rows, nulls in
any column and an empty table pass through every stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import mixing, packing, quality, secret_scan, simhash
from pitchlake.llm.common import stage
from pitchlake.session import ensure_defaults, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust distance keep."""
    return quality.keep(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near fingerprints."""
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars is the new length."""
    cleaned = secret_scan.redact_secrets(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with the same expected number of rows, as many rows as before."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces' places in sequences; copies of a document are documents of their own."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", redact_secrets),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the robust estimates nor the tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    ensure_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

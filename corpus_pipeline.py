"""The corpus pipeline: every stage works on all rows its predecessor kept.

Stages up to the last take and return the columns of ``documents``; each result is written as
Parquet to the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm import byte_bpe, decontaminate, identifiers, quality, simhash
from cartflow.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.one_of_each(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    return decontaminate.clean_rows(spark, docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal identifiers in their texts replaced by the names of their kinds."""
    named = {"text": identifiers.redacted_text(F.col("text"))}
    redacted = docs.select(*[named.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
    if "n_chars" not in docs.columns:
        return redacted
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that show their exact decoding."""
    rows = byte_bpe.tokenized(spark, docs, "doc_id", offsets=False)
    return byte_bpe.digests(rows, "doc_id", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("byte_level_bpe", byte_level_bpe),
]

#: The last stage's token ids have no SQL form; tests compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

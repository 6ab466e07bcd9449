"""Corpus pipeline: documents in, packed training pieces out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept;
all but the last return the columns of ``documents``. Null texts pass as empty
ones; documents without doc_id take part in every stage but line dedup; columns of
any other name pass through; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, lines, minhash, packing, toxicity
from tessera.llm.common import cut, free_name, table
from tessera.llm.queries import TOXIC_FROM


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic; the model learns from the labelled documents of ``sf_dir``."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    toxic = free_name(docs, "toxic")
    return toxicity.score(docs, model, toxic).where(F.col(toxic) < TOXIC_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned blocks of lines that an earlier document has; a document of which nothing is left goes."""
    removed = free_name(docs, "n_removed")
    out = lines.dedup_lines(docs, count=removed).where((F.col(removed) == 0) | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near duplicates (five-word shingles, similarity 0.8): of the smallest doc_id, then text hash."""
    return minhash.first_of_each(docs, k=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document that was kept."""
    return packing.pack(docs)


STAGES = [("toxicity", without_toxic), ("line dedup", without_repeated_lines), ("near duplicates", without_near_duplicates),
          ("decontamination", without_benchmark), ("packing", packed)]

#: No SQL: classifier, alignment and tokenizers are beyond it; tests/llm compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is materialised for the next, which reads it more than once."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs

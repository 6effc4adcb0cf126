"""A corpus from raw documents to packed sequences, in stages that each read what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm.stages import best_fit_packing, line_dedup, mixing, ngram_join, toxicity

STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]
#: A fitted classifier and a tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each kept as Parquet for the next."""
    from matchloom.llm.common import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, name)
    return docs

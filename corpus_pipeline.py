"""Corpus pipeline: documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tally.llm import jaccard_join, language_id, mixture, packing, quality_rules
from tally.llm.common import stash, table

STAGES = [
    ("language ID", language_id.stage),
    ("quality rules", quality_rules.stage),
    ("n-gram Jaccard join", jaccard_join.stage),
    ("source mixing", mixture.stage),
    ("best-fit packing", packing.stage),
]

# Trained models, seeded draws and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stash(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs

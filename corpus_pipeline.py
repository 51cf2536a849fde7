"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, packing.

``STAGES`` are applied in order; each takes what its predecessor kept, written as Parquet in the
shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import stages
from strandline.llm.common import saved, table
from strandline.session import configure

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("toxicity", stages.drop_toxic),
    ("near_dedup", stages.near_dedup),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack),
]

# SQL has neither the fitted model nor the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, f"pipeline-{name}")
    return docs

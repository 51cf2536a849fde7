"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import mixing, neardup, packing, quality, toxicity
from strandline.llm.common import crc_mod, table


def shielded(docs: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``needed`` under names that no operator uses, and the columns that give
    the old names back."""
    new = {c: c if c in needed else f"_column_{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*(F.col(f"`{c}`").alias(n) for c, n in new.items())),
            [F.col(n).alias(c) for c, n in new.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, with all their columns.  A null or empty text has no words and goes; rows that
    repeat an id are judged each; an empty table gives an empty result."""
    rows, back = shielded(docs, ("doc_id", "text"))
    return quality.cascade(rows).where("kept").select(*back)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold, with all their columns; the model learns from the labels of ``sf_dir``
    for the documents that are still there.  Null and empty texts score 0 and stay, rows with a null id are scored but
    never learnt from; without labels of both kinds every score is 0 and all stay; an empty table gives an empty result."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learnt = labels.where(crc_mod(F.col("doc_id"), 4) != 2)
    rows, back = shielded(docs, ("doc_id", "text"))
    scored = toxicity.score(rows, toxicity.fit(rows, learnt))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*back)


NEAR_PERCENT = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.  Documents go by id: all rows of a kept
    id stay, also where they repeat one text, and rows with a null id are compared with nothing and stay."""
    found = neardup.near_duplicates(docs, percent=NEAR_PERCENT)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it, with all its columns.  Null sources are one source; null and empty
    texts have no words and are taken whole times only; rows that repeat an id, or have none, are documents of their
    own; an empty table gives an empty result."""
    rows, back = shielded(docs, ("doc_id", "text", "source"))
    mixed = mixing.mix(rows, keep=tuple(rows.columns))
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents and their places in the sequences.  A null or empty text is its end id; every row is
    packed, also copies and rows without an id; an empty table gives an empty result."""
    return packing.pack_documents(docs, special=True)

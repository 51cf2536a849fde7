"""Strand inference from the three counting modes, and strand selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Strand codes and their labels (0 unstranded, 1 stranded, 2 reversely stranded).
STRAND_LABELS = {0: "unstranded", 1: "stranded", 2: "reversely stranded", -1: "unknown"}


def strandness_ratio(counts: DataFrame) -> DataFrame:
    """F8: per sample n0, n1, n2 (assigned per mode) and strandness = n1 / (n1 + n2); null when 0/0."""
    n = {m: F.sum(F.when(F.col("strand_mode") == m, F.col("count")).otherwise(F.lit(0))).cast("bigint").alias(f"n{m}")
         for m in (0, 1, 2)}
    r = counts.groupBy("sample").agg(n[0], n[1], n[2])
    den = F.col("n1") + F.col("n2")
    return r.withColumn("strandness", F.when(den > 0, F.col("n1").cast("double") / den.cast("double")))


def classify_strand(ratios: DataFrame, *, tolerance: float = 0.15) -> DataFrame:
    """< tol -> 2, > 1 - tol -> 1, within 0.5 +/- tol -> 0, otherwise -1 (unknown)."""
    if not 0 <= tolerance <= 0.25:
        raise ValueError("tolerance must lie in [0, 0.25]")
    s = F.col("strandness")
    strand = (F.when(s.isNull(), F.lit(-1)).when(s < tolerance, F.lit(2)).when(s > 1 - tolerance, F.lit(1))
              .when((s >= 0.5 - tolerance) & (s <= 0.5 + tolerance), F.lit(0)).otherwise(F.lit(-1)))
    return ratios.withColumn("strand", strand.cast("int"))


def project_strand(classified: DataFrame) -> DataFrame:
    """one row.  ``strand`` = the common value when every sample agrees, else -1;
    ``most_frequent`` = sample strand with the highest count, ties to the smallest code."""
    freq = classified.groupBy("strand").agg(F.count(F.lit(1)).alias("_n"))
    return freq.agg(
        F.when(F.min("strand") == F.max("strand"), F.min("strand")).otherwise(F.lit(-1)).cast("int").alias("strand"),
        F.min_by("strand", F.struct(-F.col("_n"), F.col("strand"))).cast("int").alias("most_frequent"))


def override_strand(project: DataFrame, user_strand: int | None) -> DataFrame:
    """a user choice in {0, 1, 2} wins over the guess (0 is a real choice); None keeps the guess."""
    if user_strand is None:
        return project
    if user_strand not in (0, 1, 2):
        raise ValueError("strand choice must be 0, 1 or 2")
    return project.withColumn("strand", F.lit(user_strand).cast("int"))


def select_strand(counts: DataFrame, project: DataFrame) -> DataFrame:
    """keep the chosen mode's counts; when the choice is unknown (-1) keep all three.

    The one-row choice is broadcast-joined, so no value travels through the driver.
    """
    choice = F.broadcast(project.select(F.col("strand").alias("_choice")))
    return counts.join(choice, (F.col("_choice") == -1) | (F.col("strand_mode") == F.col("_choice"))).drop("_choice")


def strand_label(df: DataFrame, column: str = "strand") -> DataFrame:
    """numeric strand code -> label."""
    expr = F.lit(None).cast("string")
    for code, label in STRAND_LABELS.items():
        expr = F.when(F.col(column) == code, F.lit(label)).otherwise(expr)
    return df.withColumn("strand_label", expr)


def annotation_rate(summary: DataFrame, project: DataFrame | None = None, strand: int | None = None) -> DataFrame:
    """F16: % of records assigned per sample in the chosen strand mode."""
    if project is not None:
        s = summary.join(F.broadcast(project.select(F.col("strand").alias("strand_mode"))), "strand_mode")
    else:
        s = summary.where(F.col("strand_mode") == (0 if strand is None else strand))
    r = s.groupBy("sample").agg(F.sum(F.when(F.col("status") == "Assigned", F.col("count")).otherwise(0)).alias("_a"),
                                F.sum("count").alias("_t"))
    return r.select("sample", F.round(F.col("_a") * 100.0 / F.col("_t"), 6).alias("annotation_rate"))

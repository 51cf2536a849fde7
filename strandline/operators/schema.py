"""Columns that operators expect, filled in for tables that come straight from a reader.

Readers keep the names of their formats (``start``/``end``, an ``attributes`` map, SAM fields); operators
ask for ``start_pos``/``end_pos``/``gene_id`` and for ``pos_end``/``base_quality_sum``/``nh``.  What a
table already has is left as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.alignment import reference_span


def annotation_columns(features: DataFrame, *, id_attribute: str = "ID", parent_attribute: str | None = None) -> DataFrame:
    """Adds ``start_pos``, ``end_pos`` and ``gene_id`` (an attribute; for parts of genes its parent)."""
    out = features
    for new, old in (("start_pos", "start"), ("end_pos", "end")):
        if new not in out.columns and old in out.columns:
            out = out.withColumn(new, F.col(old).cast("bigint"))
    if "gene_id" not in out.columns and "attributes" in out.columns:
        keys = [k for k in ("gene_id", parent_attribute, id_attribute) if k]
        out = out.withColumn("gene_id", F.coalesce(*(F.col("attributes")[k] for k in keys)))
    return out


def alignment_columns(alignments: DataFrame, *, fill_hits: bool = True) -> DataFrame:
    """Adds ``pos_end``, ``base_quality_sum`` (bases of quality 15 or more) and with ``fill_hits`` ``nh`` (1 where the
    aligner writes no hit count)."""
    out = alignments
    if "pos_end" not in out.columns:
        out = out.withColumn("pos_end", F.col("pos") + reference_span("pos", "cigar") - 1)
    if "base_quality_sum" not in out.columns:
        if "qual" in out.columns:
            scores = F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33)
            total = F.aggregate(F.filter(scores, lambda x: x >= 15), F.lit(0), lambda a, x: a + x)
            out = out.withColumn("base_quality_sum", F.coalesce(total, F.lit(0)).cast("double"))
        else:
            out = out.withColumn("base_quality_sum", F.lit(0.0))
    if not fill_hits:
        return out
    nh = F.coalesce(F.col("nh"), F.lit(1)) if "nh" in out.columns else F.lit(1)
    return out.withColumn("nh", nh)

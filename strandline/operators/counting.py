"""Feature counting: reads/fragments -> meta-features, three strand modes in one pass.

Semantics (featureCounts defaults, public documentation):

* a record with the unmapped bit is ``Unassigned_Unmapped``; a record with
  NH > 1 is ``Unassigned_MultiMapping`` (counted per record, before any overlap);
* the remaining records are grouped per fragment ``(sample, frag_id)`` (both
  mates of a pair share it; mate 2's strand is flipped);
* a fragment overlapping (>= 1 base of an aligned block) exactly one
  meta-feature compatible with the strand mode is ``Assigned`` to it, none is
  ``Unassigned_NoFeatures``, more than one is ``Unassigned_Ambiguity``;
* strand modes: 0 any strand, 1 same strand, 2 opposite strand.

Plan: aligned blocks are joined to the (broadcast, size-checked) features on
``(chrom, bin)``; one aggregation per fragment keeps, for every mode, the
smallest and largest compatible meta-feature key (equal => exactly one);
a second, map-side-combined aggregation tallies ``(sample, mode, status,
feature)``.  Meta-feature keys are 64-bit hashes so both aggregations run as
hash aggregations on fixed-width buffers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.alignment import (SECONDARY, SUPPLEMENTARY, UNMAPPED, cigar_blocks, fragment_strand,
                                            has_flag)
from strandline.operators.intervals import fits_broadcast, overlap_join

MODES = (0, 1, 2)
ASSIGNED = "Assigned"
UNMAPPED_STATUS = "Unassigned_Unmapped"
MULTI_STATUS = "Unassigned_MultiMapping"
NOFEATURE_STATUS = "Unassigned_NoFeatures"
AMBIGUOUS_STATUS = "Unassigned_Ambiguity"


def meta_features(features: DataFrame, *, feature_type: str | list[str] = "gene", attribute: str = "ID",
                  id_column: str | None = None) -> DataFrame:
    """Features of the chosen type(s) with their meta-feature id (``f_meta``) and hash key (``f_key``).

    ``features`` has either an ``attributes`` map (parsed GFF) or, with
    ``id_column``, a plain id column.  Columns: f_chrom, f_start, f_end, f_strand, f_meta, f_key.
    """
    types = [feature_type] if isinstance(feature_type, str) else list(feature_type)
    meta = F.col(id_column) if id_column else F.col("attributes")[attribute]
    start = "start" if "start" in features.columns else "start_pos"
    end = "end" if "end" in features.columns else "end_pos"
    f = features.where(F.col("type").isin(types)).select(
        F.col("seqid").alias("f_chrom"), F.col(start).cast("bigint").alias("f_start"),
        F.col(end).cast("bigint").alias("f_end"), F.col("strand").alias("f_strand"), meta.alias("f_meta"))
    return f.where(F.col("f_meta").isNotNull()).withColumn("f_key", F.xxhash64("f_meta"))


def _compatible(mode: int) -> Column:
    if mode == 0:
        return F.lit(True)
    same = F.col("a_strand") == F.col("f_strand")
    return same if mode == 1 else ~same


def _eligible(alignments: DataFrame) -> DataFrame:
    nh = F.coalesce(F.col("nh"), F.lit(1)) if "nh" in alignments.columns else F.lit(1)
    return alignments.where(~has_flag("flag", UNMAPPED) & (nh <= 1)
                            & ~has_flag("flag", SECONDARY) & ~has_flag("flag", SUPPLEMENTARY))


def pre_overlap_status(alignments: DataFrame) -> DataFrame:
    """Per-record statuses decided before any overlap: (sample, status, n)."""
    nh = F.coalesce(F.col("nh"), F.lit(1)) if "nh" in alignments.columns else F.lit(1)
    status = F.when(has_flag("flag", UNMAPPED), F.lit(UNMAPPED_STATUS)).when(nh > 1, F.lit(MULTI_STATUS))
    return (alignments.select("sample", status.alias("status")).where(F.col("status").isNotNull())
            .groupBy("sample", "status").agg(F.count(F.lit(1)).alias("n")))


def aligned_blocks(alignments: DataFrame) -> DataFrame:
    """(sample, frag_id, a_chrom, a_strand, a_start, a_end) for eligible records, one row per block."""
    e = _eligible(alignments)
    b = e.select("sample", "frag_id", F.col("ref").alias("a_chrom"), fragment_strand("flag").alias("a_strand"),
                 F.explode(cigar_blocks("pos", "cigar")).alias("_b"))
    return b.select("sample", "frag_id", "a_chrom", "a_strand",
                    F.col("_b.start").alias("a_start"), F.col("_b.end").alias("a_end"))


def fragment_assignments(alignments: DataFrame, feats: DataFrame, *, bin_size: int | None = None) -> DataFrame:
    """One row per fragment: for each mode m, ``lo_m``/``hi_m`` = min/max compatible feature key."""
    blocks = aligned_blocks(alignments)
    j = overlap_join(blocks, feats, left_cols=("a_chrom", "a_start", "a_end"),
                     right_cols=("f_chrom", "f_start", "f_end"), bin_size=bin_size, how="left_bins")
    aggs = []
    for m in MODES:
        k = F.when(F.col("f_key").isNotNull() & _compatible(m), F.col("f_key"))
        aggs += [F.min(k).alias(f"lo{m}"), F.max(k).alias(f"hi{m}")]
    return j.groupBy("sample", "frag_id").agg(*aggs)


def tally(alignments: DataFrame, feats: DataFrame, *, bin_size: int | None = None) -> DataFrame:
    """(sample, strand_mode, status, f_key, n): the shared core of all counting outputs."""
    fa = fragment_assignments(alignments, feats, bin_size=bin_size)
    per_mode = []
    for m in MODES:
        lo, hi = F.col(f"lo{m}"), F.col(f"hi{m}")
        status = (F.when(lo.isNull(), F.lit(NOFEATURE_STATUS)).when(lo != hi, F.lit(AMBIGUOUS_STATUS))
                  .otherwise(F.lit(ASSIGNED)))
        per_mode.append(F.struct(F.lit(m).alias("strand_mode"), status.alias("status"),
                                 F.when(lo == hi, lo).alias("f_key")))
    x = fa.select("sample", F.explode(F.array(*per_mode)).alias("_m")).select("sample", "_m.*")
    return x.groupBy("sample", "strand_mode", "status", "f_key").agg(F.count(F.lit(1)).alias("n"))


def _named(counts: DataFrame, feats: DataFrame) -> DataFrame:
    names = feats.select("f_key", "f_meta").distinct()
    return counts.join(F.broadcast(names) if fits_broadcast(names) else names, "f_key").drop("f_key")


def count_features_all_strands(alignments: DataFrame, features: DataFrame, *, feature_type="gene", attribute="ID",
                               id_column=None, bin_size: int | None = None) -> DataFrame:
    """long counts (sample, strand_mode, gene_id, count) for modes 0, 1, 2 from one join.

    Only non-zero counts are emitted; ``merge_counts`` fills zeros against the annotation.
    """
    feats = meta_features(features, feature_type=feature_type, attribute=attribute, id_column=id_column)
    t = tally(alignments, feats, bin_size=bin_size).where(F.col("status") == ASSIGNED)
    return _named(t.select("sample", "strand_mode", "f_key", F.col("n").alias("count")), feats) \
        .select("sample", F.col("strand_mode").cast("int").alias("strand_mode"),
                F.col("f_meta").alias("gene_id"), F.col("count").cast("bigint").alias("count"))


def count_features(alignments: DataFrame, features: DataFrame, *, strand: int = 0, **kw) -> DataFrame:
    """counts for one strand mode: (sample, gene_id, count)."""
    if strand not in MODES:
        raise ValueError("strand must be 0, 1 or 2")
    c = count_features_all_strands(alignments, features, **kw)
    return c.where(F.col("strand_mode") == strand).drop("strand_mode")


def count_multi_overlap(alignments: DataFrame, features: DataFrame, *, strand: int = 0, feature_type="gene",
                        attribute="ID", id_column=None, bin_size: int | None = None) -> DataFrame:
    """F4 (-O): a fragment counts once for every compatible meta-feature it overlaps."""
    feats = meta_features(features, feature_type=feature_type, attribute=attribute, id_column=id_column)
    blocks = aligned_blocks(alignments)
    j = overlap_join(blocks, feats, left_cols=("a_chrom", "a_start", "a_end"),
                     right_cols=("f_chrom", "f_start", "f_end"), bin_size=bin_size, how="inner")
    hits = j.where(_compatible(strand)).select("sample", "frag_id", "f_key").distinct()
    c = hits.groupBy("sample", "f_key").agg(F.count(F.lit(1)).alias("count"))
    return _named(c, feats).select("sample", F.col("f_meta").alias("gene_id"), F.col("count").cast("bigint"))


def assignment_summary(alignments: DataFrame, features: DataFrame, *, feature_type="gene", attribute="ID",
                       id_column=None, bin_size: int | None = None) -> DataFrame:
    """(sample, strand_mode, status, count) — Assigned / Unassigned_* per sample and mode."""
    feats = meta_features(features, feature_type=feature_type, attribute=attribute, id_column=id_column)
    t = tally(alignments, feats, bin_size=bin_size).groupBy("sample", "strand_mode", "status") \
        .agg(F.sum("n").alias("count"))
    modes = F.explode(F.array(*[F.lit(m) for m in MODES]))
    pre = pre_overlap_status(alignments).select("sample", modes.alias("strand_mode"), "status", F.col("n").alias("count"))
    return t.unionByName(pre).select("sample", F.col("strand_mode").cast("int"), "status",
                                     F.col("count").cast("bigint"))


def extra_attributes(counts: DataFrame, features: DataFrame, *, attributes: list[str], feature_type="gene",
                     attribute="ID") -> DataFrame:
    """attach extra attributes (first value per meta-feature) to a count table keyed by gene_id."""
    types = [feature_type] if isinstance(feature_type, str) else list(feature_type)
    extra = (features.where(F.col("type").isin(types))
             .select(F.col("attributes")[attribute].alias("gene_id"),
                     *[F.col("attributes")[a].alias(a) for a in attributes])
             .groupBy("gene_id").agg(*[F.min(a).alias(a) for a in attributes]))
    return counts.join(extra, "gene_id", "left")


def merge_counts(counts: DataFrame, genes: DataFrame, samples: list[str]) -> DataFrame:
    """long counts -> one matrix, one row per annotated gene, one column per sample, zeros filled.

    ``samples`` are the explicit pivot values (from the design table), so no
    extra job is spent discovering them.
    """
    wide = counts.groupBy("gene_id").pivot("sample", samples).agg(F.sum("count"))
    out = genes.select("gene_id").distinct().join(wide, "gene_id", "left")
    return out.select("gene_id", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in samples])

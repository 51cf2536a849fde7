"""Alignment QC against an annotation (the RSeQC role): distances, duplication, junctions, strand rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.alignment import (DUPLICATE, PROPER_PAIR, QC_FAIL, SECONDARY, UNMAPPED, cigar_blocks,
                                            fragment_strand, has_flag, junctions)
from strandline.operators.intervals import fits_broadcast, overlap_join
from strandline.operators.regions import introns
from strandline.operators.schema import annotation_columns

# Defaults of the tools' command lines.
INNER_DISTANCE_LOWER, INNER_DISTANCE_UPPER, INNER_DISTANCE_STEP = -250, 250, 5
MAPQ_CUTOFF = 30
SATURATION_LEVELS = list(range(5, 101, 5))


def without_introns(pairs: DataFrame, exons: DataFrame) -> DataFrame:
    """``pairs`` (sample, frag_id, ref, end1, pos2) with ``pos2`` moved up by the introns that lie between the mates,
    so that distances are those on the transcript.  Bases of overlapping introns of several transcripts count once."""
    known = introns(exons).select("chrom", "intron_start", "intron_end").distinct()
    gaps = pairs.where(F.col("pos2") - F.col("end1") > 1).select(
        "sample", "frag_id", F.col("ref").alias("_ref"), (F.col("end1") + 1).alias("_from"), (F.col("pos2") - 1).alias("_to"))
    hits = overlap_join(gaps, known, left_cols=("_ref", "_from", "_to"), right_cols=("chrom", "intron_start", "intron_end"))
    inside = hits.where((F.col("intron_start") >= F.col("_from")) & (F.col("intron_end") <= F.col("_to")))
    w = Window.partitionBy("sample", "frag_id").orderBy("intron_start", "intron_end")  # the introns between two mates
    reached = F.max("intron_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("intron_end") - F.greatest(F.col("intron_start") - 1, F.coalesce("_reached", F.lit(0))), F.lit(0))
    total = inside.withColumn("_reached", reached).groupBy("sample", "frag_id").agg(F.sum(new).alias("_introns"))
    j = pairs.join(total, ["sample", "frag_id"], "left")
    return j.withColumn("pos2", F.col("pos2") - F.coalesce(F.col("_introns"), F.lit(0))).drop("_introns")


def inner_distance(pairs: DataFrame, *, lower: int = INNER_DISTANCE_LOWER, upper: int = INNER_DISTANCE_UPPER,
                   step: int = INNER_DISTANCE_STEP) -> DataFrame:
    """B1: histogram of the gap between mates (mate 2 start - mate 1 end - 1; negative = overlap).

    ``pairs`` has one row per fragment: (sample, end1, pos2).  Bins are
    [lo, lo + step) from ``lower`` to ``upper``; what lies outside is counted at the two
    ends, in bins that start and end there.
    """
    d = (F.col("pos2") - F.col("end1") - 1)
    b = pairs.select("sample", d.alias("d"))
    lo = (F.when(F.col("d") >= upper, F.lit(upper)).when(F.col("d") < lower, F.lit(lower))
          .otherwise(F.floor((F.col("d") - lower) / step) * step + lower))
    hi = F.when((F.col("d") >= lower) & (F.col("d") < upper), lo + step).otherwise(lo)
    return b.groupBy("sample", lo.cast("bigint").alias("bin_start"), hi.cast("bigint").alias("bin_end")) \
        .agg(F.count(F.lit(1)).alias("count"))


def read_duplication(reads: DataFrame | None = None, alignments: DataFrame | None = None) -> DataFrame:
    """(sample, method, occurrence, unique_reads): how many distinct sequences / positions occur k times."""
    parts = []
    if reads is not None:
        by_seq = reads.groupBy("sample", "seq").agg(F.count(F.lit(1)).alias("occurrence"))
        parts.append(by_seq.groupBy("sample", "occurrence").agg(F.count(F.lit(1)).alias("unique_reads"))
                     .withColumn("method", F.lit("sequence")))
    if alignments is not None:
        mapped = alignments.where(~has_flag("flag", UNMAPPED))
        key = F.concat_ws(":", F.col("ref"), F.col("pos").cast("string"),
                          F.to_json(cigar_blocks("pos", "cigar")))
        by_pos = mapped.groupBy("sample", key.alias("_k")).agg(F.count(F.lit(1)).alias("occurrence"))
        parts.append(by_pos.groupBy("sample", "occurrence").agg(F.count(F.lit(1)).alias("unique_reads"))
                     .withColumn("method", F.lit("position")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("sample", "method", "occurrence", "unique_reads")


def junction_events(alignments: DataFrame, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per spliced read junction: (sample, frag_id, chrom, intron_start, intron_end, *extra_cols)."""
    mapped = alignments.where(~has_flag("flag", UNMAPPED) & F.col("cigar").contains("N"))
    j = mapped.select("sample", "frag_id", *extra_cols, F.col("ref").alias("chrom"),
                      F.explode(junctions("pos", "cigar")).alias("_j"))
    return j.select("sample", "frag_id", "chrom", F.col("_j.start").alias("intron_start"),
                    F.col("_j.end").alias("intron_end"), *extra_cols)


def _classify_junctions(events: DataFrame, known: DataFrame) -> DataFrame:
    donors = known.select(F.col("chrom").alias("_dc"), F.col("intron_start").alias("_d")).distinct() \
        .withColumn("_dk", F.lit(True))
    acceptors = known.select(F.col("chrom").alias("_ac"), F.col("intron_end").alias("_a")).distinct() \
        .withColumn("_ak", F.lit(True))
    if fits_broadcast(donors):
        donors, acceptors = F.broadcast(donors), F.broadcast(acceptors)
    e = events.join(donors, (F.col("chrom") == F.col("_dc")) & (F.col("intron_start") == F.col("_d")), "left")
    e = e.join(acceptors, (F.col("chrom") == F.col("_ac")) & (F.col("intron_end") == F.col("_a")), "left")
    d, a = F.col("_dk").isNotNull(), F.col("_ak").isNotNull()
    cat = F.when(d & a, "known").when(d | a, "partial_novel").otherwise("complete_novel")
    return e.withColumn("category", cat).drop("_dc", "_d", "_dk", "_ac", "_a", "_ak")


def junction_annotation(alignments: DataFrame, exons: DataFrame) -> DataFrame:
    """(sample, level, category, count) — splice events and distinct junctions by known / partial / complete novel."""
    ev = _classify_junctions(junction_events(alignments), introns(exons))
    by_event = ev.groupBy("sample", "category").agg(F.count(F.lit(1)).alias("count")).withColumn("level", F.lit("event"))
    by_junction = ev.select("sample", "chrom", "intron_start", "intron_end", "category").distinct() \
        .groupBy("sample", "category").agg(F.count(F.lit(1)).alias("count")).withColumn("level", F.lit("junction"))
    return by_event.unionByName(by_junction).select("sample", "level", "category", "count")


def junction_saturation(alignments: DataFrame, exons: DataFrame, *, bucket: Column,
                        levels: list[int] = SATURATION_LEVELS) -> DataFrame:
    """Per sample, distinct junctions (all / known / novel) seen when using ``level`` % of the reads.

    ``bucket`` is a deterministic 0..99 read bucket (a hash of the read id); a
    read belongs to every level above its bucket.  Each junction's first level is
    its smallest bucket, so the curve needs one aggregation and no re-sampling.
    """
    ev = junction_events(alignments.withColumn("_bucket", bucket), extra_cols=("_bucket",))
    ev = _classify_junctions(ev, introns(exons))
    first = ev.groupBy("sample", "chrom", "intron_start", "intron_end", "category").agg(F.min("_bucket").alias("_b"))
    lv = F.explode(F.array(*[F.lit(x) for x in levels])).alias("level")
    x = first.select("sample", "category", "_b", lv).where(F.col("_b") < F.col("level"))
    return x.groupBy("sample", "level").agg(
        F.count(F.lit(1)).alias("all_junctions"), F.count_if(F.col("category") == "known").alias("known"),
        F.count_if(F.col("category") != "known").alias("novel"))


def infer_experiment(alignments: DataFrame, genes: DataFrame, *, mapq: int = MAPQ_CUTOFF,
                     feature_type: str | None = "gene", bin_size: int | None = None) -> DataFrame:
    """Share of reads whose strand agrees (++,--) or disagrees (+-,-+) with the overlapped genes'.

    Uniquely mapped records with MAPQ >= ``mapq`` and features of ``feature_type`` (None: all) are used.
    Mates count as one fragment with the strand of mate 1.  A fragment overlapping
    genes on both strands counts as ``failed``.  Shares are over reads that
    overlap at least one gene.
    """
    unique = F.coalesce(F.col("nh"), F.lit(1)) <= 1 if "nh" in alignments.columns else F.lit(True)
    a = alignments.where(~has_flag("flag", UNMAPPED) & ~has_flag("flag", SECONDARY) & ~has_flag("flag", QC_FAIL)
                         & (F.col("mapq") >= mapq) & unique)
    blocks = a.select("sample", "frag_id", F.col("ref").alias("a_chrom"), fragment_strand("flag").alias("a_strand"),
                      F.explode(cigar_blocks("pos", "cigar")).alias("_b")) \
              .select("sample", "frag_id", "a_chrom", "a_strand", F.col("_b.start").alias("a_start"),
                      F.col("_b.end").alias("a_end"))
    genes = annotation_columns(genes)
    if feature_type is not None and "type" in genes.columns:
        genes = genes.where(F.col("type") == feature_type)
    g = genes.select(F.col("seqid").alias("g_chrom"), F.col("start_pos").alias("g_start"),
                     F.col("end_pos").alias("g_end"), F.col("strand").alias("g_strand"))
    j = overlap_join(blocks, g, left_cols=("a_chrom", "a_start", "a_end"), right_cols=("g_chrom", "g_start", "g_end"),
                     bin_size=bin_size)
    per_read = j.groupBy("sample", "frag_id").agg(
        F.max(F.when(F.col("g_strand") == "+", 1).otherwise(0)).alias("_plus"),
        F.max(F.when(F.col("g_strand") == "-", 1).otherwise(0)).alias("_minus"),
        F.max("a_strand").alias("_rs"))
    failed = (F.col("_plus") == 1) & (F.col("_minus") == 1)
    gs = F.when(F.col("_plus") == 1, F.lit("+")).otherwise(F.lit("-"))
    s = per_read.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(failed).alias("_f"),
        F.count_if(~failed & (F.col("_rs") == gs)).alias("_same"),
        F.count_if(~failed & (F.col("_rs") != gs)).alias("_opp"))
    frac = lambda c: F.round(F.col(c) / F.col("reads"), 6)
    return s.select("sample", "reads", frac("_f").alias("fraction_failed"), frac("_same").alias("fraction_same"),
                    frac("_opp").alias("fraction_opposite"))


def alignment_stats(alignments: DataFrame, *, mapq: int = MAPQ_CUTOFF) -> DataFrame:
    """Per-sample record counts by flag bits, MAPQ and splicing."""
    mapped = ~has_flag("flag", UNMAPPED)
    primary = ~has_flag("flag", SECONDARY)
    unique = mapped & primary & ~has_flag("flag", QC_FAIL) & ~has_flag("flag", DUPLICATE) & (F.col("mapq") >= mapq)
    return alignments.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(has_flag("flag", QC_FAIL)).alias("qc_failed"),
        F.count_if(has_flag("flag", DUPLICATE)).alias("duplicates"),
        F.count_if(~primary).alias("non_primary"),
        F.count_if(~mapped).alias("unmapped"),
        F.count_if(mapped & primary & (F.col("mapq") < mapq)).alias("mapq_low"),
        F.count_if(unique).alias("mapq_high"),
        F.count_if(unique & ~has_flag("flag", 16)).alias("forward"),
        F.count_if(unique & has_flag("flag", 16)).alias("reverse"),
        F.count_if(unique & F.col("cigar").contains("N")).alias("splice_reads"),
        F.count_if(unique & ~F.col("cigar").contains("N")).alias("non_splice_reads"),
        F.count_if(unique & has_flag("flag", PROPER_PAIR)).alias("proper_pairs"),
    )


def clipping_profile(alignments: DataFrame) -> DataFrame:
    """Per sample, soft-clipped bases per read position (0-based from the read start), mapped records."""
    m = alignments.where(~has_flag("flag", UNMAPPED))
    lead = F.coalesce(F.regexp_extract("cigar", r"^([0-9]+)S", 1).try_cast("int"), F.lit(0))
    trail = F.coalesce(F.regexp_extract("cigar", r"([0-9]+)S$", 1).try_cast("int"), F.lit(0))
    rlen = F.expr("aggregate(regexp_extract_all(cigar, '([0-9]+)[MIS=X]', 1), 0, (a, x) -> a + cast(x as int))")
    x = m.select("sample", F.explode(F.concat(
        F.when(lead > 0, F.sequence(F.lit(0), lead - 1)).otherwise(F.array().cast("array<int>")),
        F.when(trail > 0, F.sequence(rlen - trail, rlen - 1)).otherwise(F.array().cast("array<int>")))).alias("position"))
    return x.groupBy("sample", "position").agg(F.count(F.lit(1)).alias("clipped"))


def read_gc(reads: DataFrame) -> DataFrame:
    """Per sample, reads by GC% (two decimals) over all bases of the read."""
    from strandline.functions.sequence import gc_count

    gc = F.round(gc_count("seq") * 100.0 / F.length("seq"), 2)
    return reads.where(F.length("seq") > 0).groupBy("sample", gc.alias("gc_percent")).agg(F.count(F.lit(1)).alias("reads"))


def transcripts_to_features(quant: DataFrame, features: DataFrame, *, attribute: str, id_attribute: str = "ID",
                            feature_type: str | None = None) -> DataFrame:
    """A3: transcript-level estimates summed per feature attribute value: (sample, feature, num_reads)."""
    f = features if feature_type is None else features.where(F.col("type") == feature_type)
    m = f.select(F.col("attributes")[id_attribute].alias("transcript"), F.col("attributes")[attribute].alias("feature")) \
        .where(F.col("feature").isNotNull()).distinct()
    if fits_broadcast(m):
        m = F.broadcast(m)
    return quant.join(m, "transcript").groupBy("sample", "feature").agg(
        F.round(F.sum("num_reads"), 6).alias("num_reads"))

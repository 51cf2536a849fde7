"""Expression QC (the RNA-SeQC role): read classes, detected genes, gene tables, coverage statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.alignment import DUPLICATE, fragment_strand, has_flag
from strandline.operators.coverage import depth, read_blocks
from strandline.operators.intervals import overlap_join
from strandline.operators.regions import interval_union
from strandline.operators.schema import annotation_columns

# Tool defaults.
DETECTION_THRESHOLD = 5
END_WINDOW = 50
SECOND_MATE = 128  # the flag bit


def read_class_rates(alignments: DataFrame, exons: DataFrame, genes: DataFrame, *, rrna_type: str = "rRNA") -> DataFrame:
    """Per sample, shares of uniquely mapped reads that are exonic, intronic, intergenic,
    ambiguous (exons of several genes) and rRNA, the duplicate rate, and the end-sense rate
    (exonic reads on the strand of their gene)."""
    uniq = alignments.where(F.coalesce(F.col("nh"), F.lit(1)) <= 1) if "nh" in alignments.columns else alignments
    exons, genes = annotation_columns(exons, parent_attribute="Parent"), annotation_columns(genes)
    blocks = read_blocks(uniq, extra={"a_strand": fragment_strand("flag"), "_dup": has_flag("flag", DUPLICATE)}) \
        .withColumnRenamed("chrom", "a_chrom").withColumnRenamed("start", "a_start").withColumnRenamed("end", "a_end")
    # exons and genes as one set of regions: one join and one aggregation per read
    def regions(df: DataFrame, gene, kind) -> DataFrame:
        return df.select(F.col("seqid").alias("g_chrom"), F.col("start_pos").alias("g_start"), F.col("end_pos").alias("g_end"),
                         F.col("strand").alias("g_strand"), gene.cast("long").alias("e_gene"), kind.cast("string").alias("g_type"))

    r = regions(exons, F.xxhash64("gene_id"), F.lit(None)).unionByName(regions(genes, F.lit(None), F.coalesce("type", F.lit(""))))
    j = overlap_join(blocks, r, left_cols=("a_chrom", "a_start", "a_end"), right_cols=("g_chrom", "g_start", "g_end"), how="left_bins")
    r = j.groupBy("sample", "frag_id").agg(
        F.min("e_gene").alias("_glo"), F.max("e_gene").alias("_ghi"),
        F.max((F.col("e_gene").isNotNull() & (F.col("g_strand") == F.col("a_strand"))).cast("int")).alias("_sense"),
        F.max(F.col("_dup").cast("int")).alias("_dup"),
        F.max(F.when(F.col("g_type").isNotNull(), 1).otherwise(0)).alias("_in_gene"),
        F.max(F.when(F.col("g_type") == rrna_type, 1).otherwise(0)).alias("_rrna"))
    cls = (F.when(F.col("_glo").isNotNull() & (F.col("_glo") != F.col("_ghi")), "ambiguous")
           .when(F.col("_glo").isNotNull(), "exonic").when(F.col("_in_gene") == 1, "intronic").otherwise("intergenic"))
    r = r.withColumn("_c", cls)
    s = r.groupBy("sample").agg(
        F.count(F.lit(1)).alias("mapped_unique"),
        *[F.count_if(F.col("_c") == c).alias(f"_{c}") for c in ("exonic", "intronic", "intergenic", "ambiguous")],
        F.sum("_rrna").alias("_rrna"), F.sum("_dup").alias("_dup"),
        F.count_if((F.col("_c") == "exonic") & (F.col("_sense") == 1)).alias("_sense"))
    rate = lambda c, d="mapped_unique": F.round(F.col(c) / F.col(d), 6)
    return s.select("sample", "mapped_unique", rate("_exonic").alias("exonic_rate"),
                    rate("_intronic").alias("intronic_rate"), rate("_intergenic").alias("intergenic_rate"),
                    rate("_ambiguous").alias("ambiguous_rate"), rate("_rrna").alias("rrna_rate"),
                    rate("_dup").alias("duplicate_rate"), rate("_sense", "_exonic").alias("end_sense_rate"))


def genes_detected(counts: DataFrame, *, threshold: int = DETECTION_THRESHOLD) -> DataFrame:
    """Per sample, genes with at least ``threshold`` unambiguous reads."""
    return counts.groupBy("sample").agg(F.count_if(F.col("count") >= threshold).alias("genes_detected"))


def gene_tpm(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Reads and TPM per (sample, gene): rate = count / length, TPM = rate / sum(rate) * 1e6."""
    r = counts.join(lengths, "gene_id").withColumn("_rate", F.col("count") / F.col("length"))
    tot = r.groupBy("sample").agg(F.sum("_rate").alias("_tot"))
    return r.join(F.broadcast(tot), "sample").select(
        "sample", "gene_id", "count", F.round(F.col("_rate") / F.col("_tot") * 1e6, 6).alias("tpm"))


def read_exons(alignments: DataFrame, exons: DataFrame) -> DataFrame:
    """(sample, frag_id, mate, gene_id, exon_id, exon_length, share): the exons that each uniquely mapped read of one gene
    touches, with its share of bases in each (a read's shares add up to 1).  Exons are the merged exons of all transcripts of a
    gene, numbered along the contig; reads that touch exons of several genes are left out.  One interval join serves
    the exon and the gene table."""
    uniq = alignments.where(F.coalesce(F.col("nh"), F.lit(1)) <= 1) if "nh" in alignments.columns else alignments
    merged = interval_union(annotation_columns(exons, parent_attribute="Parent"), group=["seqid", "gene_id"])
    order = Window.partitionBy("gene_id").orderBy("seqid", "start_pos")  # the exons of one gene
    e = merged.select(F.col("seqid").alias("e_chrom"), F.col("start_pos").alias("e_start"), F.col("end_pos").alias("e_end"), "gene_id",
                      F.concat("gene_id", F.lit("_"), F.row_number().over(order).cast("string")).alias("exon_id"))
    blocks = read_blocks(uniq, extra={"mate": F.when(has_flag("flag", SECOND_MATE), 2).otherwise(1)}) \
        .withColumnRenamed("chrom", "a_chrom").withColumnRenamed("start", "a_start").withColumnRenamed("end", "a_end")
    j = overlap_join(blocks, e, left_cols=("a_chrom", "a_start", "a_end"), right_cols=("e_chrom", "e_start", "e_end"))
    bases = F.least("a_end", "e_end") - F.greatest("a_start", "e_start") + 1
    per = j.groupBy("sample", "frag_id", "mate").agg(  # a read touches a few exons
        F.min("gene_id").alias("_lo"), F.max("gene_id").alias("_hi"), F.sum(bases).alias("_all"),
        F.collect_list(F.struct("exon_id", (F.col("e_end") - F.col("e_start") + 1).alias("exon_length"), bases.alias("n"))).alias("_e"))
    one = per.where(F.col("_lo") == F.col("_hi")).select("sample", "frag_id", "mate", F.col("_lo").alias("gene_id"), "_all", F.inline("_e"))
    return one.groupBy("sample", "frag_id", "mate", "gene_id", "exon_id", "exon_length").agg(
        F.sum(F.col("n") / F.col("_all")).alias("share"))


def exon_tpm(hits: DataFrame) -> DataFrame:
    """(sample, gene_id, exon_id, reads, fragments, tpm): reads by their shares, fragments with a mate in the exon, and
    TPM over exon lengths.  ``hits``: ``read_exons``."""
    per = hits.groupBy("sample", "gene_id", "exon_id", "exon_length", "frag_id").agg(F.sum("share").alias("_s")) \
        .groupBy("sample", "gene_id", "exon_id", "exon_length").agg(F.sum("_s").alias("_reads"), F.count(F.lit(1)).alias("fragments"))
    rate = F.col("_reads") / F.col("exon_length")
    tot = F.broadcast(per.groupBy("sample").agg(F.sum(rate).alias("_tot")))  # one row per sample
    return per.join(tot, "sample").select("sample", "gene_id", "exon_id", F.round("_reads", 6).alias("reads"), "fragments",
                                          F.round(rate / F.col("_tot") * 1e6, 6).alias("tpm"))


def gene_table(hits: DataFrame, exons: DataFrame) -> DataFrame:
    """(sample, gene_id, reads, fragments, tpm): reads and fragments of each gene, and TPM over its exonic length."""
    length = interval_union(annotation_columns(exons, parent_attribute="Parent"), group=["seqid", "gene_id"]).groupBy("gene_id").agg(
        F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("_len"))
    per = hits.groupBy("sample", "gene_id", "frag_id").agg(F.count_distinct("mate").alias("_m")).groupBy("sample", "gene_id").agg(
        F.sum("_m").alias("reads"), F.count(F.lit(1)).alias("fragments")).join(length, "gene_id")
    rate = F.col("reads") / F.col("_len")
    tot = F.broadcast(per.groupBy("sample").agg(F.sum(rate).alias("_tot")))
    return per.join(tot, "sample").select("sample", "gene_id", "reads", "fragments", F.round(rate / F.col("_tot") * 1e6, 6).alias("tpm"))


def _gene_depth(alignments: DataFrame, regions: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(sample, gene_id, depth, n_bases, *extra) for every overlap of a depth segment with a region."""
    seg = depth(alignments)
    r = regions.select(F.col("seqid").alias("r_chrom"), F.col("start_pos").alias("r_start"),
                       F.col("end_pos").alias("r_end"), "gene_id", *extra)
    j = overlap_join(seg, r, left_cols=("chrom", "seg_start", "seg_end"), right_cols=("r_chrom", "r_start", "r_end"))
    n = F.least("seg_end", "r_end") - F.greatest("seg_start", "r_start") + 1
    return j.select("sample", "gene_id", "depth", n.alias("n_bases"), *extra)


def without_ends(exons: DataFrame, bases: int) -> DataFrame:
    """The exonic parts of every gene that lie at least ``bases`` exonic bases away from both of its ends."""
    order = Window.partitionBy("gene_id").orderBy("start_pos").rowsBetween(Window.unboundedPreceding, -1)  # exons of a gene
    length = F.col("end_pos") - F.col("start_pos") + 1
    before = F.coalesce(F.sum(length).over(order), F.lit(0))
    after = F.sum(length).over(Window.partitionBy("gene_id")) - before - length
    e = exons.withColumn("_b", before).withColumn("_a", after)
    e = e.withColumn("start_pos", F.col("start_pos") + F.greatest(F.lit(0), bases - F.col("_b"))) \
         .withColumn("end_pos", F.col("end_pos") - F.greatest(F.lit(0), bases - F.col("_a")))
    return e.where(F.col("start_pos") <= F.col("end_pos")).drop("_b", "_a")


def coverage_stats(alignments: DataFrame, exons: DataFrame, *, exclude_ends: int = 0) -> DataFrame:
    """Per (sample, gene) mean, standard deviation and CV of per-base depth over the exonic bases
    (uncovered bases count as depth 0), without ``exclude_ends`` exonic bases at either end of a gene."""
    exons = annotation_columns(exons, parent_attribute="Parent")
    if exclude_ends:
        exons = without_ends(exons, exclude_ends)
    length = exons.groupBy("gene_id").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("_len"))
    d = _gene_depth(alignments, exons).groupBy("sample", "gene_id").agg(
        F.sum(F.col("depth") * F.col("n_bases")).alias("_s1"),
        F.sum(F.col("depth") * F.col("depth") * F.col("n_bases")).alias("_s2"))
    d = d.join(length, "gene_id")
    mean = F.col("_s1") / F.col("_len")
    sd = F.sqrt(F.greatest(F.col("_s2") / F.col("_len") - mean * mean, F.lit(0.0)))
    return d.select("sample", "gene_id", F.round(mean, 6).alias("mean_coverage"), F.round(sd, 6).alias("sd_coverage"),
                    F.round(sd / mean, 6).alias("cv"))


def end_bias(alignments: DataFrame, genes: DataFrame, *, window: int = END_WINDOW) -> DataFrame:
    """Per (sample, gene): mean depth over the last ``window`` bases (3') over the first (5')."""
    g = annotation_columns(genes).select("seqid", "start_pos", "end_pos", "strand", "gene_id")
    first = F.when(F.col("strand") == "-", F.col("end_pos") - window + 1).otherwise(F.col("start_pos"))
    five = g.select("seqid", first.alias("start_pos"), (first + window - 1).alias("end_pos"),
                    "gene_id", F.lit("5").alias("_end"))
    last = F.when(F.col("strand") == "-", F.col("start_pos")).otherwise(F.col("end_pos") - window + 1)
    three = g.select("seqid", last.alias("start_pos"), (last + window - 1).alias("end_pos"),
                     "gene_id", F.lit("3").alias("_end"))
    d = _gene_depth(alignments, five.unionByName(three), ("_end",)).groupBy("sample", "gene_id", "_end").agg(
        F.sum(F.col("depth") * F.col("n_bases")).alias("_s"))
    p = d.groupBy("sample", "gene_id").agg(F.sum(F.when(F.col("_end") == "5", F.col("_s"))).alias("_five"),
                                           F.sum(F.when(F.col("_end") == "3", F.col("_s"))).alias("_three"))
    return p.select("sample", "gene_id", F.round(F.col("_three") / F.col("_five"), 6).alias("end_bias"))

"""Round trips through files: every sink writes a fixture table to the shared folder, a reader reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strandline.operators import annotation as A
from strandline.operators import coverage as CV
from strandline.operators import dge as D
from strandline.plans.q_counting import annotation
from strandline.plans.q_dge import SAMPLES, matrix, results
from strandline.plans.registry import query
from strandline.session import ensure_checkpoint_dir
from strandline.sources import annotation as SA
from strandline.sources import fixtures as fx
from strandline.sources import readers as R
from strandline.sources import sinks as K
from strandline.sources.fastq import read_fastq


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}/{name}"


@query("fastq_round_trip", oracle="select sample, mate, read_id, seq, qual from fx_mate_reads")
def q_fastq(spark, sf_dir):
    """Reads of both mates as gzip FASTQ per sample and mate."""
    path = _folder(spark, "fastq")
    K.write_fastq(fx.fx_mate_reads(spark, sf_dir), path)
    return read_fastq(spark, path).select("sample", F.col("mate").cast("int").alias("mate"), "read_id", "seq", "qual")


@query("sample_manifest", oracle="""
select sample, string_agg(distinct cast(mate as varchar), ',' order by cast(mate as varchar)) as mates, count(distinct mate) = 2 as paired
from fx_mate_reads group by sample""")
def q_manifest(spark, sf_dir):
    """S2 over the files of K8."""
    path = _folder(spark, "fastq")
    K.write_fastq(fx.fx_mate_reads(spark, sf_dir), path)
    m = R.sample_manifest(spark, path, pattern="*.gz", strict=True)
    return m.select("sample", F.array_join(F.col("mates").cast("array<string>"), ",").alias("mates"), "paired")


@query("fasta_round_trip", oracle="select name, seq, length from fx_contigs")
def q_fasta(spark, sf_dir):
    """K5 and S3."""
    path = _folder(spark, "fasta")
    K.write_fasta(fx.fx_contigs(spark, sf_dir), path)
    return R.read_fasta(spark, path).select("name", "seq", "length")


@query("gff_round_trip", oracle="""
select seqid, type, start_pos as start, end_pos as "end", strand, gene_id, gene_name from fx_features""")
def q_gff(spark, sf_dir):
    """K4 and S4."""
    path = _folder(spark, "gff")
    K.write_gff(annotation(spark, sf_dir), path)
    g = SA.read_gff(spark, path)
    return g.select("seqid", "type", "start", "end", "strand", F.col("attributes")["ID"].alias("gene_id"),
                    F.col("attributes")["Name"].alias("gene_name"))


@query("counts_round_trip", oracle="select sample, gene_id, n as count from fx_counts")
def q_counts(spark, sf_dir):
    """K1 and S6."""
    path = _folder(spark, "counts")
    K.write_counts(fx.fx_counts(spark, sf_dir).withColumnRenamed("n", "count"), path)
    return R.read_counts(spark, path)


@query("count_summary_round_trip", oracle="""
select sample, 'Assigned' as status, cast(sum(n) as bigint) as count from fx_counts group by sample""")
def q_count_summary(spark, sf_dir):
    """The summaries beside the counts."""
    path, counts = _folder(spark, "counts"), fx.fx_counts(spark, sf_dir).withColumnRenamed("n", "count")
    K.write_counts(counts, path, summary=counts.groupBy("sample").agg(F.sum("count").alias("count")).withColumn("status", F.lit("Assigned")))
    return R.read_count_summary(spark, f"{path}.summary")


_MATRIX = ", ".join(f"cast(coalesce(sum(n) filter (where sample = '{s}'), 0) as bigint) as {s}" for s in SAMPLES)


@query("count_matrix_round_trip", oracle=f"select gene_id, {_MATRIX} from fx_counts group by gene_id")
def q_count_matrix(spark, sf_dir):
    """The merged matrix, read back as an information table."""
    path = _folder(spark, "matrix")
    wide = matrix(spark, sf_dir).groupBy("gene_id").pivot("sample", SAMPLES).agg(F.first("count"))
    K.write_count_matrix(wide, path)
    return R.read_info(spark, path).select("gene_id", *[F.col(s).cast("bigint").alias(s) for s in SAMPLES])


@query("strand_summary_round_trip", oracle="""
select sample, cast(sum(n) as bigint) as total, count(*) as genes from fx_counts group by sample""")
def q_strand_summary(spark, sf_dir):
    """K3."""
    path = _folder(spark, "summary.csv")
    K.write_strand_summary(fx.fx_counts(spark, sf_dir).groupBy("sample").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("genes")), path)
    return spark.read.schema("sample string, total bigint, genes bigint").option("header", "true").csv(path)


@query("bed_round_trip", oracle="""
select seqid as chrom, start_pos - 1 as start0, end_pos as "end", gene_name as name, 0 as score, strand from fx_features""")
def q_bed(spark, sf_dir):
    """K6."""
    path = _folder(spark, "bed")
    K.write_bed(A.gff_to_bed(annotation(spark, sf_dir), "Name"), path)
    return spark.read.schema("chrom string, start0 bigint, end bigint, name string, score int, strand string").option("sep", "\t").csv(path)


@query("bedgraph_round_trip", oracle="""
with b as (select sample, ref as chrom, pos, frag_id, cigar, pos_end, nh, row_number() over () as r from fx_alignments where flag % 8 < 4),
blk as (select r, sample, chrom, pos as a, case when cigar = '50M' then pos_end else pos + 24 end as e from b
        union all select r, sample, chrom, pos_end - 24, pos_end from b where cigar <> '50M'),
bins as (select distinct r, sample, chrom, unnest(range((a - 1) // 50, (e - 1) // 50 + 1)) as bin from blk)
select sample, chrom, cast(bin * 50 as bigint) as start0, cast(bin * 50 + 50 as bigint) as "end", cast(count(*) as double) as value
from bins group by all""")
def q_bedgraph(spark, sf_dir):
    """K7: a coverage track per sample."""
    path = _folder(spark, "bedgraph")
    bins = CV.binned_coverage(fx.fx_alignments(spark, sf_dir), bin_size=50)
    K.write_bedgraph(bins.withColumn("value", F.col("count").cast("double")), path)
    return spark.read.schema("chrom string, start0 bigint, end bigint, value double, sample string").option("sep", "\t").csv(path)


@query("de_tables_round_trip", oracle="""
with ranked as (select *, count(*) over (partition by contrast) as m,
       count(*) over (partition by contrast order by pvalue range between unbounded preceding and current row) as rk from fx_de),
res as (select *, least(1.0, min(m * pvalue / rk) over (partition by contrast order by pvalue
          range between current row and unbounded following)) as padj from ranked),
ex as (select *, case when padj <= 0.05 and log2fc > 0 then 'up' when padj <= 0.05 and log2fc < 0 then 'down' else 'none' end as direction from res)
select contrast, t as "table", gene_id from ex, unnest(case when direction = 'none' then ['complete'] else ['complete', direction] end) u(t)""")
def q_de_tables(spark, sf_dir):
    """K9: complete, up and down tables of every contrast."""
    path = _folder(spark, "de")
    K.write_de_tables(D.export_tables(results(spark, sf_dir)), path)
    return spark.read.option("header", "true").option("sep", "\t").csv(path).select("contrast", "table", "gene_id")


@query("design_round_trip", oracle="select label, cond as condition from fx_design")
def q_design(spark, sf_dir):
    """K10 and S7."""
    path = _folder(spark, "design.csv")
    K.write_design(fx.fx_design(spark, sf_dir), path)
    return R.read_design(spark, path)


@query("target_round_trip", oracle="""
select label, concat(label, '_feature.out') as files, cond as condition, batch as replicat from fx_design""")
def q_target(spark, sf_dir):
    """A target table."""
    path, d = _folder(spark, "target.txt"), fx.fx_design(spark, sf_dir)
    K.write_count_matrix(d.select("label", F.concat("label", F.lit("_feature.out")).alias("files"), F.col("cond").alias("condition"),
                                  F.col("batch").alias("replicat")), path)
    return R.read_target(spark, path)


@query("gene_lengths_round_trip", oracle="select gene_id, cast(length as bigint) as length from fx_lengths")
def q_gene_lengths(spark, sf_dir):
    """Gene lengths."""
    path = _folder(spark, "lengths.tsv")
    K.write_count_matrix(fx.fx_lengths(spark, sf_dir), path)
    return R.read_gene_lengths(spark, path)


@query("quant_round_trip", oracle="""
select c.sample, c.gene_id as transcript, cast(l.length as bigint) as length, cast(l.length as double) as eff_length,
  cast(c.n as double) / 2 as tpm, cast(c.n as double) as num_reads from fx_counts c join fx_lengths l on l.gene_id = c.gene_id""")
def q_quant(spark, sf_dir):
    """Quantification tables per sample."""
    path = _folder(spark, "quant")
    q = fx.fx_counts(spark, sf_dir).join(fx.fx_lengths(spark, sf_dir), "gene_id").select(
        "sample", F.col("gene_id").alias("Name"), F.col("length").alias("Length"), F.col("length").cast("double").alias("EffectiveLength"),
        (F.col("n") / 2).alias("TPM"), F.col("n").cast("double").alias("NumReads"))
    q.write.partitionBy("sample").option("sep", "\t").option("header", "true").csv(path)
    return R.read_quant(spark, path)


@query("metric_table_round_trip", oracle="""
with m as (select file_name, metric, max(value) as value from fx_metrics where module = 'fastp' group by all),
names as (select distinct metric from m), files as (select distinct file_name from m)
select f.file_name, 'fastp' as module, n.metric, m.value from files f cross join names n
left join m on m.file_name = f.file_name and m.metric = n.metric""")
def q_metric_table(spark, sf_dir):
    """The first of two places that exists."""
    path = _folder(spark, "metrics.tsv")
    m = fx.fx_metrics(spark, sf_dir).where("module = 'fastp'")
    K.write_count_matrix(m.groupBy("file_name").pivot("metric").agg(F.max("value")), path)
    return R.read_metric_table(spark, [f"{path}-missing", path], module="fastp")


@query("trim_json_round_trip", oracle="""
with s as (select sample, count(*) as total_reads, cast(sum(length(seq)) as bigint) as total_bases,
             round(sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / sum(length(seq)), 6) as gc_content from fx_reads group by sample)
select sample, stage, total_reads, total_bases, cast(0 as bigint) as q20_bases, cast(0 as bigint) as q30_bases, gc_content
from s, (values ('before'), ('after')) v(stage)""")
def q_trim_json(spark, sf_dir):
    """One report per sample."""
    path = _folder(spark, "json")
    n = F.sum(F.length("seq")).cast("bigint")
    gc = F.round(F.sum(F.length("seq") - F.length(F.translate("seq", "GC", ""))) / F.sum(F.length("seq")), 6)
    s = fx.fx_reads(spark, sf_dir, ordinal=False).groupBy("sample").agg(F.count(F.lit(1)).alias("total_reads"), n.alias("total_bases"), gc.alias("gc_content"))
    stage = F.struct("total_reads", "total_bases", F.lit(0).alias("q20_bases"), F.lit(0).alias("q30_bases"), "gc_content")
    s.select("sample", F.struct(stage.alias("before_filtering"), stage.alias("after_filtering")).alias("summary")) \
        .write.partitionBy("sample").json(path)
    return R.read_trim_json(spark, path)


@query("tool_log_round_trip", oracle="""
with s as (select sample, count(*) as n, count(*) filter (where length(seq) = 100) as whole from fx_reads group by sample)
select sample, 'reads processed' as metric, n as count, -1.0::double as percent from s
union all select sample, m, whole, round(whole * 100.0 / n, 2)::double from s,
  (values ('reads with at least one alignment'), ('reads with at least one reported alignment')) v(m)""")
def q_tool_log(spark, sf_dir):
    """The log of an aligner per sample (no percentage: -1)."""
    path = _folder(spark, "logs")
    s = fx.fx_reads(spark, sf_dir, ordinal=False).groupBy("sample").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.length("seq") == 100).alias("whole"))
    share = F.round(F.col("whole") * 100.0 / F.col("n"), 2).cast("string")
    lines = F.explode(F.array(
        F.concat(F.lit("# reads processed: "), F.col("n").cast("string")),
        F.concat(F.lit("# reads with at least one alignment: "), F.col("whole").cast("string"), F.lit(" ("), share, F.lit("%)"))))
    s.select("sample", lines.alias("value")).write.partitionBy("sample").text(path)
    return R.read_tool_log(spark, path).withColumn("percent", F.coalesce("percent", F.lit(-1.0)))

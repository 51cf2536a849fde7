"""Annotation queries (G1-G14) over the parsed fixture GFF and the document contigs."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import annotation as A
from strandline.plans.q_counting import annotation
from strandline.plans.registry import query
from strandline.sources import fixtures as fx


def _flat(df):
    return df.select("seqid", "type", "start", "end", "strand", F.col("attributes")["ID"].alias("gene_id"))


@query("features_of_type", oracle="""
select seqid, type, start_pos as start, end_pos as "end", strand, gene_id from fx_features where type = 'rRNA'""")
def q_features_of_type(spark, sf_dir):
    return _flat(A.features_of_type(annotation(spark, sf_dir), "rRNA"))


@query("custom_features", oracle="""
select seqid, 'custom' as type, start_pos as start, end_pos as "end", strand, gene_id from fx_features
where type in ('gene', 'rRNA')""")
def q_custom_features(spark, sf_dir):
    return _flat(A.custom_features(annotation(spark, sf_dir), "gene,rRNA"))


@query("feature_types", oracle="select distinct type from fx_features")
def q_feature_types(spark, sf_dir):
    return A.feature_types(annotation(spark, sf_dir))


@query("attribute_names", oracle="""
select distinct attribute from (
  select 'ID' as attribute from fx_features where type = 'gene'
  union all select 'Name' from fx_features where type = 'gene'
  union all select 'biotype' from fx_features where type = 'gene' and biotype <> 'ECONOMY') a""")
def q_attribute_names(spark, sf_dir):
    return A.attribute_names(annotation(spark, sf_dir), "gene")


@query("count_type", oracle="select type, count(*) as n from fx_features group by type")
def q_count_type(spark, sf_dir):
    return A.count_type(annotation(spark, sf_dir))


@query("attribute_profile", oracle="""
select 'gene' as type, 'biotype' as attribute, count(*) as n_rows,
  count(case when biotype <> 'ECONOMY' then biotype end) as n_with_attribute,
  count(distinct case when biotype <> 'ECONOMY' then biotype end) as n_distinct,
  count(distinct case when biotype <> 'ECONOMY' then biotype end) < count(case when biotype <> 'ECONOMY' then biotype end) as non_unique
from fx_features where type = 'gene'""")
def q_attribute_profile(spark, sf_dir):
    return A.attribute_profile(annotation(spark, sf_dir), "gene", "biotype")


@query("check_extra_attributes", oracle="""
select 'Name' as attribute, count(*) > 0 as present from fx_features where type = 'gene'
union all select 'gene_biotype', false
union all select 'biotype', count(*) > 0 from fx_features where type = 'gene' and biotype <> 'ECONOMY'""")
def q_check_extra_attributes(spark, sf_dir):
    return A.check_extra_attributes(annotation(spark, sf_dir), "gene", ["Name", "biotype", "gene_biotype"])


@query("check_contaminant_feature", oracle="""
select 'rRNA' as type, count(*) > 0 as present from fx_features where type = 'rRNA'""")
def q_check_contaminant_feature(spark, sf_dir):
    return A.check_contaminant_feature(annotation(spark, sf_dir), "rRNA")


@query("annotation_report", oracle="""
select 'feature_type' as "check", type as value, true as ok from (select distinct type from fx_features) t
union all select 'count_type', concat('gene=', cast(count(*) as varchar)), count(*) > 0 from fx_features where type = 'gene'
union all select 'attribute', 'ID', count(gene_id) > 0 and count(distinct gene_id) = count(gene_id) from fx_features where type = 'gene'
union all select 'extra_attribute', 'Name', count(*) > 0 from fx_features where type = 'gene'
union all select 'extra_attribute', 'gene_biotype', false
union all select 'rrna_type', 'rRNA', count(*) > 0 from fx_features where type = 'rRNA'""")
def q_annotation_report(spark, sf_dir):
    gff = annotation(spark, sf_dir)
    return A.annotation_report(gff, feature_type="gene", attribute="ID", extra=["Name", "gene_biotype"],
                               rrna_type="rRNA")


@query("gff_to_bed", oracle="""
select seqid as chrom, start_pos - 1 as start0, end_pos as "end", gene_name as name, 0 as score, strand from fx_features""")
def q_gff_to_bed(spark, sf_dir):
    return A.gff_to_bed(annotation(spark, sf_dir), "Name")


@query("gtf_with_dummies", oracle="""
select seqid, type, start_pos as start, end_pos as "end", gene_id as id from fx_features
union all select 'myCHR', 'gene', 0, 0, 'dummy' union all select 'myCHR', 'exon', 0, 0, 'dummy'""")
def q_gtf_with_dummies(spark, sf_dir):
    g = A.gtf_with_dummies(annotation(spark, sf_dir))
    return g.select("seqid", "type", "start", "end",
                    F.coalesce(*(F.col("attributes")[k] for k in ("ID", "gene_id", "exon_id"))).alias("id"))


@query("extract_sequences", oracle="""
select concat(c.name, ':', cast(f.start_pos - 1 as varchar), '-', cast(f.end_pos as varchar)) as name,
  substring(c.seq, cast(f.start_pos as integer), cast(f.end_pos - f.start_pos + 1 as integer)) as seq
from fx_ctg_features f join fx_contigs c on c.name = f.seqid where f.type = 'rRNA' and f.end_pos <= c.length""")
def q_extract_sequences(spark, sf_dir):
    """G12 + C2: the rRNA features of the contig annotation as a contaminant FASTA."""
    feats = A.features_of_type(fx.fx_ctg_features(spark, sf_dir), "rRNA")
    return A.extract_sequences(fx.fx_contigs(spark, sf_dir), feats)


@query("contig_lengths", oracle="select name, length from fx_contigs")
def q_contig_lengths(spark, sf_dir):
    return A.contig_lengths(fx.fx_contigs(spark, sf_dir))


@query("subset_by_contig", oracle="""
select * from fx_alignments a where exists (select 1 from fx_alignments b where b.sample = a.sample
  and b.frag_id = a.frag_id and b.ref = 'chr1' and b.flag % 8 < 4)""")
def q_subset_by_contig(spark, sf_dir):
    return A.subset_by_contig(fx.fx_alignments(spark, sf_dir), ["chr1"])


@query("subset_features", oracle="select seqid, type, start_pos as start, end_pos as \"end\", strand from fx_features where seqid in ('chr1', 'chr3')")
def q_subset_features(spark, sf_dir):
    return A.subset_features(annotation(spark, sf_dir), ["chr1", "chr3"]).select("seqid", "type", "start", "end", "strand")


@query("subset_sequences", oracle="select name, seq, length from fx_contigs where name in ('ctg1', 'ctg7', 'ctg100')")
def q_subset_sequences(spark, sf_dir):
    return A.subset_sequences(fx.fx_contigs(spark, sf_dir), ["ctg1", "ctg7", "ctg100"])


@query("unmapped_reads", oracle="""
select sample, cast(frag_id as varchar) as read_id from (select distinct sample, frag_id from fx_alignments) r
where not exists (select 1 from fx_alignments a where a.sample = r.sample and a.frag_id = r.frag_id and a.flag % 8 < 4)""")
def q_unmapped_reads(spark, sf_dir):
    """The reads of which no record is mapped."""
    a = fx.fx_alignments(spark, sf_dir)
    reads = a.select("sample", F.col("frag_id").cast("string").alias("read_id")).distinct()
    return A.split_mapped(reads, a)[1]

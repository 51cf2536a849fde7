"""Feature counting and strand inference queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import counting as C
from strandline.operators import strand as S
from strandline.plans.registry import query
from strandline.sources import fixtures as fx
from strandline.sources.annotation import parse_annotation_lines

SAMPLES = [f"S{i}" for i in range(6)]


def annotation(spark, sf_dir):
    """The fixture annotation, parsed from its GFF text like a file would be."""
    return parse_annotation_lines(fx.fx_gff(spark, sf_dir), column="line")


def exon_features(spark, sf_dir):
    return fx.fx_exons(spark, sf_dir).withColumn("type", F.lit("exon"))


def all_strand_counts(spark, sf_dir):
    return C.count_features_all_strands(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir))


def all_strand_summary(spark, sf_dir):
    return C.assignment_summary(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir))


# ----- oracle building blocks: a naive overlap join written independently in plain SQL -----

_ORACLE_HITS = """
elig as (select * from fx_alignments where flag % 8 < 4 and nh = 1),
blk as (
  select sample, frag_id, ref, case when flag % 32 >= 16 then '-' else '+' end as rs, pos as bs,
         case when cigar = '50M' then pos_end else pos + 24 end as be from elig
  union all
  select sample, frag_id, ref, case when flag % 32 >= 16 then '-' else '+' end as rs, pos_end - 24 as bs, pos_end as be
  from elig where cigar <> '50M'),
genes as (select seqid, start_pos, end_pos, strand, gene_id from fx_features where type = 'gene'),
modes as (select 0 as m union all select 1 as m union all select 2 as m),
hits as (select distinct b.sample, b.frag_id, modes.m, g.gene_id
         from blk b join genes g on b.ref = g.seqid and b.bs <= g.end_pos and g.start_pos <= b.be cross join modes
         where modes.m = 0 or (modes.m = 1 and b.rs = g.strand) or (modes.m = 2 and b.rs <> g.strand)),
per_frag as (select sample, frag_id, m, count(*) as ng, min(gene_id) as gene_id from hits group by sample, frag_id, m),
counts3 as (select sample, cast(m as integer) as strand_mode, gene_id, count(*) as count
            from per_frag where ng = 1 group by sample, m, gene_id)"""

_SUMMARY_TAIL = """
frags as (select distinct sample, frag_id from elig),
per_frag_all as (select f.sample, f.frag_id, modes.m, coalesce(p.ng, 0) as ng
                 from frags f cross join modes left join per_frag p
                 on p.sample = f.sample and p.frag_id = f.frag_id and p.m = modes.m),
summary as (
  select sample, cast(m as integer) as strand_mode,
         case when ng = 0 then 'Unassigned_NoFeatures' when ng = 1 then 'Assigned' else 'Unassigned_Ambiguity' end as status,
         count(*) as count
  from per_frag_all group by all
  union all
  select sample, cast(m as integer) as strand_mode,
         case when flag % 8 >= 4 then 'Unassigned_Unmapped' else 'Unassigned_MultiMapping' end as status, count(*) as count
  from fx_alignments cross join modes where flag % 8 >= 4 or nh > 1 group by all)"""

_RATIO_TAIL = """
ratio as (select sample,
    cast(sum(case when strand_mode = 0 then count else 0 end) as bigint) as n0,
    cast(sum(case when strand_mode = 1 then count else 0 end) as bigint) as n1,
    cast(sum(case when strand_mode = 2 then count else 0 end) as bigint) as n2
  from counts3 group by sample),
classified as (select sample, n0, n1, n2,
    case when n1 + n2 > 0 then cast(n1 as double) / cast(n1 + n2 as double) end as strandness,
    cast(case when n1 + n2 = 0 then -1
              when cast(n1 as double) / (n1 + n2) < 0.15 then 2
              when cast(n1 as double) / (n1 + n2) > 0.85 then 1
              when cast(n1 as double) / (n1 + n2) between 0.35 and 0.65 then 0 else -1 end as integer) as strand
  from ratio),
freq as (select strand, count(*) as n from classified group by strand),
project as (select cast(case when min(strand) = max(strand) then min(strand) else -1 end as integer) as strand,
    cast((select strand from freq order by n desc, strand limit 1) as integer) as most_frequent from freq)"""

_ORACLE_SUMMARY = _ORACLE_HITS + "," + _SUMMARY_TAIL
_ORACLE_RATIO = _ORACLE_HITS + "," + _RATIO_TAIL


@query("count_features_all_strands", oracle=f"with {_ORACLE_HITS} select * from counts3")
def q_count_features_all_strands(spark, sf_dir):
    return all_strand_counts(spark, sf_dir)


@query("count_features", oracle=f"with {_ORACLE_HITS} select sample, gene_id, count from counts3 where strand_mode = 2")
def q_count_features(spark, sf_dir):
    return C.count_features(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir), strand=2)


@query("meta_feature_collapse", oracle="""
with elig as (select * from fx_alignments where flag % 8 < 4 and nh = 1),
blk as (
  select sample, frag_id, ref, pos as bs, case when cigar = '50M' then pos_end else pos + 24 end as be from elig
  union all select sample, frag_id, ref, pos_end - 24 as bs, pos_end as be from elig where cigar <> '50M'),
hits as (select distinct b.sample, b.frag_id, e.gene_id from blk b join fx_exons e
         on b.ref = e.seqid and b.bs <= e.end_pos and e.start_pos <= b.be),
per_frag as (select sample, frag_id, count(*) as ng, min(gene_id) as gene_id from hits group by sample, frag_id)
select sample, gene_id, count(*) as count from per_frag where ng = 1 group by sample, gene_id""")
def q_meta_feature_collapse(spark, sf_dir):
    """exons of a gene share the meta-feature id; a read over two exons of one gene counts once."""
    return C.count_features(fx.fx_alignments(spark, sf_dir), exon_features(spark, sf_dir), strand=0,
                            feature_type="exon", id_column="gene_id")


@query("count_multi_overlap", oracle=f"""
with {_ORACLE_HITS}
select sample, gene_id, count(*) as count from hits where m = 0 group by sample, gene_id""")
def q_count_multi_overlap(spark, sf_dir):
    """-O, every overlapped gene counts."""
    return C.count_multi_overlap(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir), strand=0)


def pair_alignments(spark, sf_dir):
    """fx_pairs as two alignment records per fragment (mate 2 on the opposite strand)."""
    return _mates(fx.fx_pairs(spark, sf_dir), F.lit(0))


def _mates(p, more):
    """Both records of every fragment from one pass over the pairs; ``more`` is added to the flags."""
    rev1 = F.col("strand1") == "-"

    def mate(k, bit, back):
        size = (F.col(f"end{k}") - F.col(f"pos{k}") + 1).cast("string")
        flag = F.lit(1 + bit) + F.when(back, 16).otherwise(0) + F.when(back, 0).otherwise(32) + more
        return F.struct(F.col(f"pos{k}").alias("pos"), F.concat(size, F.lit("M")).alias("cigar"), flag.cast("int").alias("flag"))

    return p.select("sample", "frag_id", "ref", F.inline(F.array(mate(1, 64, rev1), mate(2, 128, ~rev1)))).withColumn("nh", F.lit(1))


@query("count_paired_fragments", oracle="""
with mates as (select sample, frag_id, ref, strand1, pos1 as s, end1 as e from fx_pairs
               union all select sample, frag_id, ref, strand1, pos2 as s, end2 as e from fx_pairs),
hits as (select distinct m.sample, m.frag_id, g.gene_id from mates m join fx_features g
         on g.type = 'gene' and m.ref = g.seqid and m.s <= g.end_pos and g.start_pos <= m.e and m.strand1 <> g.strand),
per_frag as (select sample, frag_id, count(*) as ng, min(gene_id) as gene_id from hits group by sample, frag_id)
select sample, gene_id, count(*) as count from per_frag where ng = 1 group by sample, gene_id""")
def q_count_paired_fragments(spark, sf_dir):
    """-p, a pair counts once as a fragment; mate 2's strand is flipped (reverse-stranded mode here)."""
    return C.count_features(pair_alignments(spark, sf_dir), annotation(spark, sf_dir), strand=2)


@query("extra_attributes", oracle=f"""
with {_ORACLE_HITS}
select c.sample, c.gene_id, c.count, f.gene_name as Name, case when f.biotype = 'ECONOMY' then null else f.biotype end as biotype
from counts3 c join fx_features f on f.gene_id = c.gene_id and f.type = 'gene' where c.strand_mode = 0""")
def q_extra_attributes(spark, sf_dir):
    """counts with the Name and biotype attributes carried along."""
    gff = annotation(spark, sf_dir)
    c = C.count_features(fx.fx_alignments(spark, sf_dir), gff, strand=0)
    return C.extra_attributes(c, gff, attributes=["Name", "biotype"])


@query("assignment_summary", oracle=f"with {_ORACLE_SUMMARY} select * from summary")
def q_assignment_summary(spark, sf_dir):
    return all_strand_summary(spark, sf_dir)


@query("strandness_ratio", oracle=f"with {_ORACLE_RATIO} select sample, n0, n1, n2, strandness from classified")
def q_strandness_ratio(spark, sf_dir):
    return S.strandness_ratio(all_strand_counts(spark, sf_dir))


@query("classify_strand", oracle=f"with {_ORACLE_RATIO} select sample, strandness, strand from classified")
def q_classify_strand(spark, sf_dir):
    return S.classify_strand(S.strandness_ratio(all_strand_counts(spark, sf_dir)), tolerance=0.15) \
        .select("sample", "strandness", "strand")


@query("project_strand", oracle=f"with {_ORACLE_RATIO} select * from project")
def q_project_strand(spark, sf_dir):
    return S.project_strand(S.classify_strand(S.strandness_ratio(all_strand_counts(spark, sf_dir))))


@query("override_strand", oracle=f"with {_ORACLE_RATIO} select cast(0 as integer) as strand, most_frequent from project")
def q_override_strand(spark, sf_dir):
    """the user asks for unstranded (0) — an integer 0 must win over the guess."""
    guess = S.project_strand(S.classify_strand(S.strandness_ratio(all_strand_counts(spark, sf_dir))))
    return S.override_strand(guess, 0)


@query("select_strand", oracle=f"""
with {_ORACLE_RATIO}
select c.sample, c.strand_mode, c.gene_id, c.count from counts3 c join project p on p.strand = -1 or c.strand_mode = p.strand""")
def q_select_strand(spark, sf_dir):
    counts = all_strand_counts(spark, sf_dir)
    project = S.project_strand(S.classify_strand(S.strandness_ratio(counts)))
    return S.select_strand(counts, project)


_PIVOT_COLS = ", ".join(f"cast(coalesce(sum(case when c.sample = 'S{i}' then c.count end), 0) as bigint) as S{i}"
                        for i in range(6))


@query("merge_counts", oracle=f"""
with {_ORACLE_HITS}
select g.gene_id, {_PIVOT_COLS}
from (select distinct gene_id from fx_features where type = 'gene') g
left join (select * from counts3 where strand_mode = 2) c on c.gene_id = g.gene_id group by g.gene_id""")
def q_merge_counts(spark, sf_dir):
    """the chosen strand's counts of all samples as one gene x sample matrix, zeros filled."""
    counts = C.count_features(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir), strand=2)
    genes = annotation(spark, sf_dir).where(F.col("type") == "gene").select(F.col("attributes")["ID"].alias("gene_id"))
    return C.merge_counts(counts, genes, SAMPLES)


@query("annotation_rate", oracle=f"""
with {_ORACLE_HITS}, {_SUMMARY_TAIL}, {_RATIO_TAIL}
select s.sample, round(sum(case when status = 'Assigned' then count else 0 end) * 100.0 / sum(count), 6) as annotation_rate
from summary s join project p on s.strand_mode = p.strand group by s.sample""")
def q_annotation_rate(spark, sf_dir):
    """F16: % assigned per sample in the guessed strand mode."""
    counts = all_strand_counts(spark, sf_dir)
    project = S.project_strand(S.classify_strand(S.strandness_ratio(counts)))
    return S.annotation_rate(all_strand_summary(spark, sf_dir), project)


@query("strand_label", oracle=f"""
with {_ORACLE_RATIO}
select sample, strand, case strand when 0 then 'unstranded' when 1 then 'stranded' when 2 then 'reversely stranded'
  else 'unknown' end as strand_label from classified""")
def q_strand_label(spark, sf_dir):
    c = S.classify_strand(S.strandness_ratio(all_strand_counts(spark, sf_dir))).select("sample", "strand")
    return S.strand_label(c)

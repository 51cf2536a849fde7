"""Coverage (V1-V6, B2), expression QC (N1-N5) and report (M1-M5) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import counting as C
from strandline.operators import coverage as V
from strandline.operators import exprqc as N
from strandline.operators import report as M
from strandline.plans import q_counting, q_reads
from strandline.plans.registry import query
from strandline.session import ensure_checkpoint_dir
from strandline.sources import fixtures as fx

MODULES = ["fastp", "bowtie1", "star"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# ------------------------------------------------------------------ oracle pieces (naive per-base depth)

_BLOCKS = """
mp as (select row_number() over () as rid, * from fx_alignments where flag % 8 < 4),
blk as (select rid, sample, frag_id, ref as chrom, flag, nh, pos as bs, case when cigar = '50M' then pos_end else pos + 24 end as be
        from mp
        union all
        select rid, sample, frag_id, ref, flag, nh, pos_end - 24, pos_end from mp where cigar <> '50M'),
base as (select sample, chrom, p as pos, count(*) as depth from blk, unnest(range(bs, be + 1)) u(p) group by all)"""

_BINS = _BLOCKS + """,
vb as (select distinct sample, chrom, rid, b from blk,
         unnest(range(cast(floor((bs - 1) / 10) as bigint), cast(floor((be - 1) / 10) as bigint) + 1)) u(b)),
bins as (select sample, chrom, b * 10 as start0, (b + 1) * 10 as "end", count(*) as count from vb group by all)"""

_WIN = _BLOCKS + """,
win as (select sample, chrom, cast(floor((pos - 1) / 25) as bigint) as "window", cast(sum(depth) as bigint) as depth_sum,
          max(depth) as max_depth from base group by all)"""


def bins(spark, sf_dir):
    return V.binned_coverage(fx.fx_alignments(spark, sf_dir), bin_size=10)


@query("binned_coverage", oracle=f"with {_BINS} select * from bins")
def q_binned_coverage(spark, sf_dir):
    return bins(spark, sf_dir)


@query("normalize_coverage", oracle=f"""
with {_BINS}, mapped as (select sample, count(*) as n from fx_alignments where flag % 8 < 4 group by sample)
select b.sample, chrom, start0, "end", count, round(count / (n / 1e6), 6) as value
from bins b join mapped m on m.sample = b.sample""")
def q_normalize_coverage(spark, sf_dir):
    return V.normalize_coverage(bins(spark, sf_dir), fx.fx_alignments(spark, sf_dir), method="CPM")


def _normalized(method: str, value: str, **options):
    @query(f"normalize_coverage_{method.lower()}", oracle=f"""
with {_BINS}, mapped as (select sample, count(*) as n from fx_alignments where flag % 8 < 4 group by sample)
select b.sample, chrom, start0, "end", count, round({value}, 6) as value from bins b join mapped m on m.sample = b.sample""")
    def run(spark, sf_dir):
        """V2 with another scale."""
        return V.normalize_coverage(bins(spark, sf_dir), fx.fx_alignments(spark, sf_dir), method=method, **options)
    return run


_normalized("RPKM", "count / (0.01 * n / 1e6)")
_normalized("BPM", "count / 0.01 / (sum(count / 0.01) over (partition by b.sample) / 1e6)")
_normalized("RPGC", "count / (n * 50.0 / 1000000)", effective_genome_size=1_000_000, fragment_length=50)


@query("fragment_options", oracle="""
select sample, frag_id, ref as chrom, case when flag % 32 >= 16 then pos_end - 199 else pos end as frag_start,
  case when flag % 32 >= 16 then pos_end else pos + 199 end as frag_end from fx_alignments where flag % 8 < 4""")
def q_fragment_options(spark, sf_dir):
    """V3: reads extended to 200-base fragments from their 5' end."""
    return V.fragment_options(fx.fx_alignments(spark, sf_dir), extend=200)


@query("windowed_depth", oracle=f"""
with {_WIN}
select sample, chrom, "window", round(depth_sum / 25, 6) as mean_depth, max_depth, depth_sum from win""")
def q_windowed_depth(spark, sf_dir):
    return V.windowed_depth(fx.fx_alignments(spark, sf_dir), window=25)


@query("zoom_levels", oracle=f"""
with {_WIN}
select sample, chrom, cast(l as integer) as level, "window" >> cast(l as integer) as zoom_window,
  round(sum(depth_sum) / (25 * (1 << cast(l as integer))), 6) as mean_depth, max(max_depth) as max_depth
from win, unnest(range(1, 6)) u(l) group by sample, chrom, l, "window" >> cast(l as integer)""")
def q_zoom_levels(spark, sf_dir):
    return V.zoom_levels(V.windowed_depth(fx.fx_alignments(spark, sf_dir), window=25), window=25, levels=5)


@query("compact_track", oracle=f"""
with {_BINS},
s as (select *, case when lag("end") over w = start0 and lag(count) over w = count then 0 else 1 end as st
      from bins window w as (partition by sample, chrom order by start0)),
i as (select *, sum(st) over (partition by sample, chrom order by start0 rows between unbounded preceding and current row) as isl from s)
select sample, chrom, min(start0) as start0, max("end") as "end", min(count) as count from i group by sample, chrom, isl""")
def q_compact_track(spark, sf_dir):
    return V.compact_track(bins(spark, sf_dir), value="count", tile=64)


@query("gene_body_coverage", oracle=f"""
with {_BLOCKS},
pts as (select seqid, cast(k + 1 as integer) as percentile,
          case when strand = '-' then end_pos - floor((end_pos - start_pos) * k / 99)
               else start_pos + floor((end_pos - start_pos) * k / 99) end as p
        from fx_features, unnest(range(0, 100)) u(k))
select b.sample, pts.percentile, cast(sum(b.depth) as bigint) as coverage
from pts join base b on b.chrom = pts.seqid and b.pos = pts.p group by all""")
def q_gene_body_coverage(spark, sf_dir):
    return V.gene_body_coverage(fx.fx_alignments(spark, sf_dir), fx.fx_features(spark, sf_dir))


@query("transcript_body_coverage", oracle=f"""
with {_BLOCKS},
bases as (select seqid, gene_id, strand, unnest(range(start_pos, end_pos + 1)) as p from fx_exons),
ranked as (select *, row_number() over (partition by gene_id order by p) - 1 as i, count(*) over (partition by gene_id) as n from bases),
pts as (select r.seqid, r.p, cast(k + 1 as integer) as percentile from ranked r, unnest(range(0, 100)) u(k)
        where r.i = case when r.strand = '-' then r.n - 1 - floor((r.n - 1) * k / 99) else floor((r.n - 1) * k / 99) end)
select b.sample, pts.percentile, cast(sum(b.depth) as bigint) as coverage
from pts join base b on b.chrom = pts.seqid and b.pos = pts.p group by all""")
def q_transcript_body_coverage(spark, sf_dir):
    """B2 over the exonic bases of each transcript."""
    return V.transcript_body_coverage(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir))


# ------------------------------------------------------------------ N: expression QC

_UNIQ = """
u as (select * from fx_alignments where flag % 8 < 4 and nh = 1),
ub as (select sample, frag_id, ref as chrom, case when flag % 32 >= 16 then '-' else '+' end as rs, pos as bs,
         case when cigar = '50M' then pos_end else pos + 24 end as be from u
       union all select sample, frag_id, ref, case when flag % 32 >= 16 then '-' else '+' end, pos_end - 24, pos_end
       from u where cigar <> '50M'),
eh as (select distinct b.sample, b.frag_id, b.rs, e.gene_id, e.strand from ub b join fx_exons e
       on e.seqid = b.chrom and b.bs <= e.end_pos and e.start_pos <= b.be),
gh as (select b.sample, b.frag_id, max(case when g.type = 'rRNA' then 1 else 0 end) as rrna from ub b join fx_features g
       on g.seqid = b.chrom and b.bs <= g.end_pos and g.start_pos <= b.be group by b.sample, b.frag_id),
pr as (select u.sample, u.frag_id,
         (select count(distinct gene_id) from eh where eh.sample = u.sample and eh.frag_id = u.frag_id) as ng,
         (select max(case when eh.strand = eh.rs then 1 else 0 end) from eh where eh.sample = u.sample and eh.frag_id = u.frag_id) as sense,
         gh.rrna as rrna, (u.flag // 1024) % 2 as dup
       from u left join gh on gh.sample = u.sample and gh.frag_id = u.frag_id),
cls as (select *, case when ng > 1 then 'ambiguous' when ng = 1 then 'exonic' when rrna is not null then 'intronic'
                       else 'intergenic' end as c from pr)"""


@query("read_class_rates", oracle=f"""
with {_UNIQ}
select sample, count(*) as mapped_unique,
  round(count(*) filter (where c = 'exonic') / count(*), 6) as exonic_rate,
  round(count(*) filter (where c = 'intronic') / count(*), 6) as intronic_rate,
  round(count(*) filter (where c = 'intergenic') / count(*), 6) as intergenic_rate,
  round(count(*) filter (where c = 'ambiguous') / count(*), 6) as ambiguous_rate,
  round(cast(coalesce(sum(rrna), 0) as bigint) / count(*), 6) as rrna_rate,
  round(cast(sum(dup) as bigint) / count(*), 6) as duplicate_rate,
  round(count(*) filter (where c = 'exonic' and sense = 1) / count(*) filter (where c = 'exonic'), 6) as end_sense_rate
from cls group by sample""")
def q_read_class_rates(spark, sf_dir):
    return N.read_class_rates(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir), fx.fx_features(spark, sf_dir))


def _counts0(spark, sf_dir):
    return C.count_features(fx.fx_alignments(spark, sf_dir), q_counting.annotation(spark, sf_dir), strand=0)


@query("genes_detected", oracle=f"""
with {q_counting._ORACLE_HITS}
select sample, count(*) filter (where count >= 5) as genes_detected from counts3 where strand_mode = 0 group by sample""")
def q_genes_detected(spark, sf_dir):
    return N.genes_detected(_counts0(spark, sf_dir))


@query("gene_tpm", oracle=f"""
with {q_counting._ORACLE_HITS},
r as (select c.sample, c.gene_id, c.count, c.count / (f.end_pos - f.start_pos + 1) as rate
      from counts3 c join fx_features f on f.gene_id = c.gene_id where c.strand_mode = 0)
select sample, gene_id, count, round(rate / sum(rate) over (partition by sample) * 1e6, 6) as tpm from r""")
def q_gene_tpm(spark, sf_dir):
    lengths = fx.fx_features(spark, sf_dir).select("gene_id", (F.col("end_pos") - F.col("start_pos") + 1).alias("length"))
    return N.gene_tpm(_counts0(spark, sf_dir), lengths)


_READ_EXONS = """
reached as (select *, max(end_pos) over (partition by seqid, gene_id order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as r
            from (select distinct seqid, gene_id, start_pos, end_pos from fx_transcripts) d),
island as (select *, sum(case when r is null or start_pos > r + 1 then 1 else 0 end)
             over (partition by seqid, gene_id order by start_pos, end_pos rows unbounded preceding) as i from reached),
merged as (select seqid, gene_id, min(start_pos) as s, max(end_pos) as e from island group by seqid, gene_id, i),
ex as (select *, concat(gene_id, '_', cast(row_number() over (partition by gene_id order by seqid, s) as varchar)) as exon_id, e - s + 1 as len from merged),
al as (select sample, frag_id, 1 as mate, ref, pos1 as a, end1 as b from fx_pairs union all
       select sample, frag_id, 2, ref, pos2, end2 from fx_pairs),
j as (select al.*, ex.gene_id, exon_id, len, least(b, e) - greatest(a, s) + 1 as n from al join ex on ex.seqid = al.ref and a <= e and s <= b),
one as (select sample, frag_id, mate, sum(n) as total from j group by all having count(distinct gene_id) = 1),
hits as (select j.*, n / total as share from j join one using (sample, frag_id, mate))"""


def _pair_alignments(spark, sf_dir):
    """Both mates of the pairs as alignments."""
    p = fx.fx_pairs(spark, sf_dir)
    return p.select("sample", "frag_id", "ref", F.lit(1).alias("nh"), F.inline(F.array(
        F.struct(F.lit(67).alias("flag"), F.col("pos1").alias("pos"), F.concat((F.col("end1") - F.col("pos1") + 1).cast("string"), F.lit("M")).alias("cigar")),
        F.struct(F.lit(131).alias("flag"), F.col("pos2").alias("pos"), F.concat((F.col("end2") - F.col("pos2") + 1).cast("string"), F.lit("M")).alias("cigar")))))


def _read_exons(spark, sf_dir):
    return N.read_exons(_pair_alignments(spark, sf_dir), fx.fx_transcripts(spark, sf_dir))


@query("exon_tpm", oracle=f"""
with {_READ_EXONS},
r as (select sample, gene_id, exon_id, len, sum(share) as reads, count(distinct frag_id) as fragments from hits group by all)
select sample, gene_id, exon_id, round(reads, 6) as reads, fragments,
  round(reads / len / sum(reads / len) over (partition by sample) * 1e6, 6) as tpm from r""")
def q_exon_tpm(spark, sf_dir):
    """The exon table of pairs over genes with several transcripts."""
    return N.exon_tpm(_read_exons(spark, sf_dir))


@query("gene_table", oracle=f"""
with {_READ_EXONS},
l as (select gene_id, cast(sum(len) as bigint) as len from ex group by gene_id),
r as (select sample, gene_id, count(distinct (frag_id, mate)) as reads, count(distinct frag_id) as fragments from hits group by all)
select sample, r.gene_id, reads, fragments, round(reads / len / sum(reads / len) over (partition by sample) * 1e6, 6) as tpm
from r join l on l.gene_id = r.gene_id""")
def q_gene_table(spark, sf_dir):
    """Reads, fragments and TPM of each gene."""
    return N.gene_table(_read_exons(spark, sf_dir), fx.fx_transcripts(spark, sf_dir))


@query("coverage_stats", oracle=f"""
with {_BLOCKS},
len as (select gene_id, sum(end_pos - start_pos + 1) as l from fx_exons group by gene_id),
d as (select b.sample, e.gene_id, sum(b.depth) as s1, sum(b.depth * b.depth) as s2 from base b join fx_exons e
      on e.seqid = b.chrom and b.pos between e.start_pos and e.end_pos group by all)
select d.sample, d.gene_id, round(s1 / l, 6) as mean_coverage,
  round(sqrt(greatest(s2 / l - (s1 / l) * (s1 / l), 0)), 6) as sd_coverage,
  round(sqrt(greatest(s2 / l - (s1 / l) * (s1 / l), 0)) / (s1 / l), 6) as cv
from d join len on len.gene_id = d.gene_id""")
def q_coverage_stats(spark, sf_dir):
    return N.coverage_stats(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir))


@query("coverage_stats_without_ends", oracle=f"""
with {_BLOCKS},
bases as (select seqid, gene_id, unnest(range(start_pos, end_pos + 1)) as p from fx_exons),
ranked as (select *, row_number() over (partition by gene_id order by p) as i, count(*) over (partition by gene_id) as n from bases),
inner_ as (select * from ranked where i > 70 and i <= n - 70),
len as (select gene_id, count(*) as l from inner_ group by gene_id),
d as (select b.sample, e.gene_id, sum(b.depth) as s1, sum(b.depth * b.depth) as s2 from base b join inner_ e
      on e.seqid = b.chrom and b.pos = e.p group by all)
select d.sample, d.gene_id, round(s1 / l, 6) as mean_coverage,
  round(sqrt(greatest(s2 / l - (s1 / l) * (s1 / l), 0)), 6) as sd_coverage,
  round(sqrt(greatest(s2 / l - (s1 / l) * (s1 / l), 0)) / (s1 / l), 6) as cv
from d join len on len.gene_id = d.gene_id""")
def q_coverage_stats_without_ends(spark, sf_dir):
    """N4 without 70 exonic bases at either end (more than the first exon)."""
    return N.coverage_stats(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir), exclude_ends=70)


@query("end_bias", oracle=f"""
with {_BLOCKS},
w as (select gene_id, seqid, '5' as e, case when strand = '-' then end_pos - 49 else start_pos end as ws from fx_features
      union all
      select gene_id, seqid, '3', case when strand = '-' then start_pos else end_pos - 49 end from fx_features),
s as (select b.sample, w.gene_id, w.e, sum(b.depth) as s from base b join w on w.seqid = b.chrom
      and b.pos between w.ws and w.ws + 49 group by all)
select sample, gene_id, round(sum(case when e = '3' then s end) / sum(case when e = '5' then s end), 6) as end_bias
from s group by sample, gene_id""")
def q_end_bias(spark, sf_dir):
    return N.end_bias(fx.fx_alignments(spark, sf_dir), fx.fx_features(spark, sf_dir), window=50)


# ------------------------------------------------------------------ M: report tables

_CLEAN = ("regexp_replace(regexp_replace(regexp_replace("
          "split_part(split_part(split_part(split_part(split_part(split_part(split_part("
          "file_name, '.gz', 1), '.fastq', 1), '_R1_.cutadapt', 1), '_R2_.cutadapt', 1), '_R2_001', 1), '_R1_001', 1), "
          "'.err', 1), '\\.sorted', '', 'g'), '_S\\d+', '', 'g'), '_bowtie1$', '')")


@query("clean_sample_name", oracle=f"select distinct file_name, {_CLEAN} as sample from fx_metrics")
def q_clean_sample_name(spark, sf_dir):
    m = fx.fx_metrics(spark, sf_dir).select("file_name").distinct()
    return m.select("file_name", M.clean_sample_name("file_name").alias("sample"))


@query("select_metric_files", oracle="""
select distinct concat(module, '/', file_name) as path, cast(length(file_name) * 100000 as bigint) as length
from fx_metrics where length(file_name) * 100000 <= 5000000""")
def q_select_metric_files(spark, sf_dir):
    """M2 over a listing built from the metric table (path = module/file, synthetic byte length)."""
    m = fx.fx_metrics(spark, sf_dir).select(F.concat_ws("/", "module", "file_name").alias("path"),
                                           (F.length("file_name") * 100000).cast("bigint").alias("length")).distinct()
    return M.select_metric_files(m)


def _gs_cols():
    return [(m, p) for m in MODULES for p in PRIORITIES]


def _gs_name(m, p):
    return f"{m}.{p}".replace(".", "_").replace("-", "_").replace(" ", "_")


@query("general_statistics", oracle="select sample, " + ", ".join(
    f"round(avg(case when module = '{m}' and metric = '{p}' then value end), 6) as {_gs_name(m, p)}"
    for m, p in [(m, p) for m in MODULES for p in PRIORITIES]) + f" from (select {_CLEAN} as sample, * from fx_metrics) x group by sample")
def q_general_statistics(spark, sf_dir):
    g = M.general_statistics(fx.fx_metrics(spark, sf_dir), _gs_cols())
    return g.toDF("sample", *[_gs_name(m, p) for m, p in _gs_cols()])


@query("visible_columns", oracle="select " + ", ".join(
    ["sample"] + [_gs_name(m, p) for m in ("star", "bowtie1") for p in PRIORITIES]) + " from (select sample, " + ", ".join(
    f"round(avg(case when module = '{m}' and metric = '{p}' then value end), 6) as {_gs_name(m, p)}"
    for m, p in [(m, p) for m in ("star", "bowtie1") for p in PRIORITIES]) + f" from (select {_CLEAN} as sample, * from fx_metrics) x group by sample) y")
def q_visible_columns(spark, sf_dir):
    """M4: hide the trimming module's columns and show the aligner before the screen."""
    g = q_general_statistics(spark, sf_dir)
    hide = [_gs_name("fastp", p) for p in PRIORITIES]
    order = ["sample"] + [_gs_name("star", p) for p in PRIORITIES] + [_gs_name("bowtie1", p) for p in PRIORITIES]
    return M.visible_columns(g, hide=hide, order=order)


@query("project_summary", oracle=f"""
with {q_reads._SCREEN}, {q_counting._ORACLE_HITS}, {q_counting._SUMMARY_TAIL}, {q_counting._RATIO_TAIL},
per_read as (select sample, frag_id, max(case when flag % 8 < 4 then nh end) as nh from fx_alignments group by sample, frag_id),
mapping as (select sample, count(*) filter (where nh is null) * 100.0 / count(*) as pct_unmapped from per_read group by sample),
ann as (select s.sample, round(sum(case when status = 'Assigned' then count else 0 end) * 100.0 / sum(count), 6) as annotation_rate
        from summary s join project p on s.strand_mode = p.strand group by s.sample),
band as (select floor(avg(reads_aligned_percentage) * 100) / 100 as contamination,
  case when avg(reads_aligned_percentage) is null then 'not computed'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 10 then 'low'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 20 then 'moderately low'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 50 then 'relatively high' else 'very high' end as band
  from rates)
select 'contamination_band' as item, band as value from band
union all select 'contamination_percent', cast(contamination as varchar) from band
union all select 'mean_mapping_rate', cast(round(avg(100 - round(pct_unmapped, 6)), 2) as varchar) from mapping
union all select 'mean_annotation_rate', cast(round(avg(annotation_rate), 2) as varchar) from ann
union all select 'strand_guess', cast(strand as varchar) from project
union all select 'strand_most_frequent', cast(most_frequent as varchar) from project""")
def q_project_summary(spark, sf_dir):
    from strandline.operators import screen as SC
    from strandline.operators import strand as S
    from strandline.operators import alignment as AL

    counts = q_counting.all_strand_counts(spark, sf_dir)
    # rows that several items read: each comes from one pass over the reads
    ensure_checkpoint_dir(spark)
    project = S.project_strand(S.classify_strand(S.strandness_ratio(counts))).checkpoint()
    return M.project_summary(
        contamination=SC.contamination_band(SC.contamination_rate(q_reads._screened(spark, sf_dir))).checkpoint(),
        mapping=AL.mapping_summary(fx.fx_alignments(spark, sf_dir)),
        annotation=S.annotation_rate(q_counting.all_strand_summary(spark, sf_dir), project),
        strand=project)


"""Alignment-table queries: mapping summary, read groups, duplicates (A4-A8) and RSeQC-role QC."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandline.operators import alignment as AL
from strandline.operators import coverage as CV
from strandline.operators import mapping as MP
from strandline.operators import quant as QU
from strandline.operators import regions as RG
from strandline.operators import rseqc as R
from strandline.plans.q_counting import annotation
from strandline.plans.registry import query
from strandline.session import ensure_checkpoint_dir
from strandline.sources import fixtures as fx

_MARKED = """
marked as (select *, row_number() over (
    partition by sample, ref, case when flag % 32 >= 16 then pos_end else pos end, flag % 32 >= 16, flag % 8 >= 4
    order by base_quality_sum desc, frag_id) > 1 and flag % 8 < 4 as duplicate
  from fx_alignments)"""


@query("mapping_summary", oracle="""
with per_read as (select sample, frag_id, max(case when flag % 8 < 4 then nh end) as nh from fx_alignments group by sample, frag_id),
s as (select sample, count(*) as reads, count(*) filter (where nh is null) as unmapped,
        count(*) filter (where nh = 1) as "unique", count(*) filter (where nh > 1) as multiple from per_read group by sample)
select sample, reads, unmapped, "unique", multiple, round(unmapped * 100.0 / reads, 6) as pct_unmapped,
  round("unique" * 100.0 / reads, 6) as pct_unique, round(multiple * 100.0 / reads, 6) as pct_multiple from s""")
def q_mapping_summary(spark, sf_dir):
    return AL.mapping_summary(fx.fx_alignments(spark, sf_dir))


@query("add_read_group", oracle="select sample, frag_id, ref, pos, flag, sample as read_group from fx_alignments")
def q_add_read_group(spark, sf_dir):
    a = AL.add_read_group(fx.fx_alignments(spark, sf_dir))
    return a.select("sample", "frag_id", "ref", "pos", "flag", F.col("tags")["RG"].alias("read_group"))


@query("sorted_order", oracle="""
select ref, count(*) as records, cast(0 as bigint) as out_of_order, cast(0 as bigint) as overlapping_partitions from fx_alignments group by ref""")
def q_sorted_order(spark, sf_dir):
    """A6 with its order: records behind a larger one inside a partition, and partitions that do not lie behind the one before."""
    ensure_checkpoint_dir(spark)
    key = F.struct("ref", "pos", "frag_id", "flag")
    s = AL.sort_by_coordinate(fx.fx_alignments(spark, sf_dir)).select(
        key.alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")).checkpoint()
    before = F.lag("key").over(Window.partitionBy("part").orderBy("row"))
    wrong = s.withColumn("bad", F.coalesce(before > F.col("key"), F.lit(False)).cast("bigint")).groupBy(F.col("key.ref").alias("ref")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("bad").alias("out_of_order"))
    edges = s.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    last = F.lag("hi").over(Window.orderBy("part"))  # one row per partition
    cross = edges.withColumn("bad", F.coalesce(last > F.col("lo"), F.lit(False)).cast("bigint")).agg(F.sum("bad").alias("overlapping_partitions"))
    return wrong.join(F.broadcast(cross)).select("ref", "records", "out_of_order", "overlapping_partitions")


@query("sort_by_coordinate", oracle="select * from fx_alignments")
def q_sort_by_coordinate(spark, sf_dir):
    return AL.sort_by_coordinate(fx.fx_alignments(spark, sf_dir))


@query("mark_duplicates", oracle=f"""
with {_MARKED}
select sample, frag_id, ref, pos, cigar, case when duplicate then flag + 1024 else flag end as flag, duplicate from marked""")
def q_mark_duplicates(spark, sf_dir):
    m = AL.mark_duplicates(fx.fx_alignments(spark, sf_dir))
    return m.select("sample", "frag_id", "ref", "pos", "cigar", "flag", "duplicate")


@query("duplication_metrics", oracle=f"""
with recursive {_MARKED},
base as (select sample, count(*) as examined, count(*) filter (where duplicate) as duplicates
         from marked where flag % 8 < 4 group by sample),
nc as (select sample, cast(examined as double) as n, cast(examined - duplicates as double) as c from base),
bis(sample, it, lo, hi) as (
  select sample, 0, cast(1.0 as double), cast(1.0e9 as double) from nc where c > 0 and n > c
  union all
  select bis.sample, bis.it + 1,
    case when nc.c / (((bis.lo + bis.hi) / 2) * nc.c) - 1 + exp(-nc.n / (((bis.lo + bis.hi) / 2) * nc.c)) > 0
         then (bis.lo + bis.hi) / 2 else bis.lo end,
    case when nc.c / (((bis.lo + bis.hi) / 2) * nc.c) - 1 + exp(-nc.n / (((bis.lo + bis.hi) / 2) * nc.c)) > 0
         then bis.hi else (bis.lo + bis.hi) / 2 end
  from bis join nc on nc.sample = bis.sample where bis.it < 100)
select b.sample, b.examined, b.duplicates, round(b.duplicates / b.examined, 6) as percent_duplication,
  cast(round(nc.c * (bis.lo + bis.hi) / 2) as bigint) as estimated_library_size
from base b join nc on nc.sample = b.sample left join bis on bis.sample = b.sample and bis.it = 100""")
def q_duplication_metrics(spark, sf_dir):
    return AL.duplication_metrics(AL.mark_duplicates(fx.fx_alignments(spark, sf_dir)))


@query("inner_distance", oracle="""
with d as (select sample, pos2 - end1 - 1 as d from fx_pairs)
select sample, cast(case when d >= 50 then 50 when d < -250 then -250 else floor((d + 250) / 5) * 5 - 250 end as bigint) as bin_start,
  cast(case when d < -250 then -250 when d >= 50 then 50 else floor((d + 250) / 5) * 5 - 245 end as bigint) as bin_end,
  count(*) as count
from d group by all""")
def q_inner_distance(spark, sf_dir):
    """B1 with an upper end that some fragments lie beyond."""
    return R.inner_distance(fx.fx_pairs(spark, sf_dir), upper=50)


@query("inner_distance_spliced", oracle="""
with introns as (select distinct seqid as chrom, end_pos + 1 as s, next_start - 1 as e from (
  select seqid, end_pos, lead(start_pos) over (partition by gene_id order by start_pos) as next_start from fx_exons) x
  where next_start is not null),
d as (select p.sample, p.pos2 - p.end1 - 1 - coalesce(c.n, 0) as d
      from (select sample, frag_id, end1, pos2 + 300 as pos2 from fx_pairs) p
      left join (select p.sample, p.frag_id, sum(i.e - i.s + 1) as n
                 from (select sample, frag_id, ref, end1, pos2 + 300 as pos2 from fx_pairs) p join introns i
                 on i.chrom = p.ref and i.s >= p.end1 + 1 and i.e <= p.pos2 - 1 group by p.sample, p.frag_id) c
      on c.sample = p.sample and c.frag_id = p.frag_id)
select sample, cast(case when d >= 250 then 250 when d < -250 then -250 else floor((d + 250) / 5) * 5 - 250 end as bigint) as bin_start,
  cast(case when d < -250 then -250 when d >= 250 then 250 else floor((d + 250) / 5) * 5 - 245 end as bigint) as bin_end,
  count(*) as count
from d group by all""")
def q_inner_distance_spliced(spark, sf_dir):
    """B1 on the transcript: mates 300 bases further apart, introns between them taken out."""
    pairs = fx.fx_pairs(spark, sf_dir).withColumn("pos2", F.col("pos2") + 300)
    return R.inner_distance(R.without_introns(pairs, fx.fx_exons(spark, sf_dir)))


_INTRONS = """
reach as (select seqid, transcript_id, start_pos, max(end_pos) over (partition by seqid, transcript_id order by start_pos, end_pos
            rows between unbounded preceding and 1 preceding) as r from fx_transcripts),
introns as (select distinct seqid as chrom, r + 1 as intron_start, start_pos - 1 as intron_end from reach where start_pos > r + 1)"""


@query("transcript_introns", oracle=f"with {_INTRONS} select chrom, intron_start, intron_end from introns")
def q_transcript_introns(spark, sf_dir):
    """The different introns of all transcripts."""
    return RG.introns(fx.fx_transcripts(spark, sf_dir)).select("chrom", "intron_start", "intron_end").distinct()


@query("inner_distance_transcripts", oracle=f"""
with {_INTRONS},
p as (select sample, frag_id, ref, end1, pos2 + 300 as pos2 from fx_pairs),
inside as (select p.sample, p.frag_id, i.intron_start as s, i.intron_end as e from p join introns i
           on i.chrom = p.ref and i.intron_start >= p.end1 + 1 and i.intron_end <= p.pos2 - 1),
bases as (select sample, frag_id, unnest(range(s, e + 1)) as b from inside),
c as (select sample, frag_id, count(distinct b) as n from bases group by sample, frag_id),
d as (select p.sample, p.pos2 - p.end1 - 1 - coalesce(c.n, 0) as d from p left join c on c.sample = p.sample and c.frag_id = p.frag_id)
select sample, cast(case when d >= 250 then 250 when d < -250 then -250 else floor((d + 250) / 5) * 5 - 250 end as bigint) as bin_start,
  cast(case when d < -250 then -250 when d >= 250 then 250 else floor((d + 250) / 5) * 5 - 245 end as bigint) as bin_end,
  count(*) as count
from d group by all""")
def q_inner_distance_transcripts(spark, sf_dir):
    """B1 with overlapping introns of several transcripts between the mates."""
    pairs = fx.fx_pairs(spark, sf_dir).withColumn("pos2", F.col("pos2") + 300)
    return R.inner_distance(R.without_introns(pairs, fx.fx_transcripts(spark, sf_dir)))


@query("read_duplication", oracle="""
select sample, 'sequence' as method, occurrence, count(*) as unique_reads
from (select sample, seq, count(*) as occurrence from fx_reads group by sample, seq) s group by sample, occurrence
union all
select sample, 'position', occurrence, count(*) from (select sample, ref, pos, cigar, count(*) as occurrence from fx_alignments
  where flag % 8 < 4 group by sample, ref, pos, cigar) p group by sample, occurrence""")
def q_read_duplication(spark, sf_dir):
    return R.read_duplication(fx.fx_reads(spark, sf_dir, ordinal=False), fx.fx_alignments(spark, sf_dir))


_JUNCTIONS = """
introns as (select seqid as chrom, end_pos + 1 as intron_start, next_start - 1 as intron_end from (
  select seqid, end_pos, lead(start_pos) over (partition by gene_id order by start_pos) as next_start from fx_exons) e
  where next_start is not null),
ev as (select sample, frag_id, ref as chrom, pos + 25 as intron_start, pos_end - 25 as intron_end
       from fx_alignments where flag % 8 < 4 and cigar like '%N%'),
cls as (select ev.*, case when exists (select 1 from introns i where i.chrom = ev.chrom and i.intron_start = ev.intron_start)
                        and exists (select 1 from introns i where i.chrom = ev.chrom and i.intron_end = ev.intron_end) then 'known'
                       when exists (select 1 from introns i where i.chrom = ev.chrom and i.intron_start = ev.intron_start)
                         or exists (select 1 from introns i where i.chrom = ev.chrom and i.intron_end = ev.intron_end)
                       then 'partial_novel' else 'complete_novel' end as category from ev)"""


@query("junction_annotation", oracle=f"""
with {_JUNCTIONS}
select sample, 'event' as level, category, count(*) as count from cls group by sample, category
union all
select sample, 'junction', category, count(*) from (select distinct sample, chrom, intron_start, intron_end, category from cls) j
group by sample, category""")
def q_junction_annotation(spark, sf_dir):
    return R.junction_annotation(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir))


@query("junction_saturation", oracle=f"""
with {_JUNCTIONS},
first_seen as (select c.sample, c.chrom, c.intron_start, c.intron_end, c.category, min((c.frag_id * 7919 + 13) % 100) as b
               from cls c group by all),
lv as (select unnest(range(5, 101, 5)) as level)
select sample, cast(level as integer) as level, count(*) as all_junctions, count(*) filter (where category = 'known') as known,
  count(*) filter (where category <> 'known') as novel
from first_seen join lv on b < level group by sample, level""")
def q_junction_saturation(spark, sf_dir):
    return R.junction_saturation(fx.fx_alignments(spark, sf_dir), fx.fx_exons(spark, sf_dir),
                                 bucket=(F.col("frag_id") * 7919 + 13) % 100)


_EVENTS = _INTRONS + """,
ev as (select sample, frag_id, ref as chrom, pos + 25 as intron_start, pos_end - 25 as intron_end
       from fx_alignments where flag % 8 < 4 and cigar like '%N%'),
cls as (select ev.*, case when d.k and a.k then 'known' when d.k or a.k then 'partial_novel' else 'complete_novel' end as category
        from ev left join (select distinct chrom, intron_start, true as k from introns) d using (chrom, intron_start)
        left join (select distinct chrom, intron_end, true as k from introns) a using (chrom, intron_end))"""


@query("junction_annotation_transcripts", oracle=f"""
with {_EVENTS}
select sample, 'event' as level, category, count(*) as count from cls group by sample, category
union all
select sample, 'junction', category, count(*) from (select distinct sample, chrom, intron_start, intron_end, category from cls) j
group by sample, category""")
def q_junction_annotation_transcripts(spark, sf_dir):
    """B4 against several transcripts per gene."""
    return R.junction_annotation(fx.fx_alignments(spark, sf_dir), fx.fx_transcripts(spark, sf_dir))


@query("junction_saturation_transcripts", oracle=f"""
with {_EVENTS},
first_seen as (select c.sample, c.chrom, c.intron_start, c.intron_end, c.category, min((c.frag_id * 7919 + 13) % 100) as b
               from cls c group by all),
lv as (select unnest(range(5, 101, 5)) as level)
select sample, cast(level as integer) as level, count(*) as all_junctions, count(*) filter (where category = 'known') as known,
  count(*) filter (where category <> 'known') as novel
from first_seen join lv on b < level group by sample, level""")
def q_junction_saturation_transcripts(spark, sf_dir):
    """B5 against several transcripts per gene."""
    return R.junction_saturation(fx.fx_alignments(spark, sf_dir), fx.fx_transcripts(spark, sf_dir),
                                 bucket=(F.col("frag_id") * 7919 + 13) % 100)


_UNION = """
reached as (select *, max(end_pos) over (partition by {g} order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as r
            from (select distinct {g}, start_pos, end_pos from {t}) d),
island as (select *, sum(case when r is null or start_pos > r + 1 then 1 else 0 end)
             over (partition by {g} order by start_pos, end_pos rows unbounded preceding) as i from reached),
merged as (select {g}, min(start_pos) as start_pos, max(end_pos) as end_pos from island group by {g}, i)"""


@query("merged_exons", oracle=f"""
with {_UNION.format(g='seqid, gene_id', t='fx_transcripts')} select * from merged""")
def q_merged_exons(spark, sf_dir):
    """The exonic positions of each gene."""
    return RG.interval_union(fx.fx_transcripts(spark, sf_dir), group=["seqid", "gene_id"])


@query("gene_introns", oracle=f"""
with {_UNION.format(g='seqid, gene_id', t='fx_transcripts')},
n as (select *, lead(start_pos) over (partition by seqid, gene_id order by start_pos) as next from merged)
select seqid, gene_id, end_pos + 1 as start_pos, next - 1 as end_pos from n where next is not null""")
def q_gene_introns(spark, sf_dir):
    """The positions of each gene that none of its exons covers."""
    return RG.gene_introns(fx.fx_transcripts(spark, sf_dir))


@query("intergenic_regions", oracle=f"""
with len as (select seqid, max(end_pos) + 1000 as length from fx_transcripts group by seqid),
{_UNION.format(g='seqid', t='fx_transcripts')},
e as (select seqid, start_pos, end_pos from merged union all select seqid, 0, 0 from len union all select seqid, length + 1, length + 1 from len),
n as (select *, lead(start_pos) over (partition by seqid order by start_pos) as next from e)
select seqid, cast(end_pos + 1 as bigint) as start_pos, cast(next - 1 as bigint) as end_pos from n where next > end_pos + 1""")
def q_intergenic_regions(spark, sf_dir):
    """The positions of each contig outside all exons."""
    e = fx.fx_transcripts(spark, sf_dir)
    return RG.intergenic_regions(e, e.groupBy("seqid").agg((F.max("end_pos") + 1000).alias("length")))


@query("infer_experiment", oracle="""
with elig as (select * from fx_alignments where flag % 8 < 4 and nh = 1 and mapq >= 30),
blk as (select sample, frag_id, ref, case when flag % 32 >= 16 then '-' else '+' end as rs, pos as bs,
               case when cigar = '50M' then pos_end else pos + 24 end as be from elig
        union all select sample, frag_id, ref, case when flag % 32 >= 16 then '-' else '+' end, pos_end - 24, pos_end
        from elig where cigar <> '50M'),
per_read as (select b.sample, b.frag_id, max(b.rs) as rs, max(case when g.strand = '+' then 1 else 0 end) as plus,
               max(case when g.strand = '-' then 1 else 0 end) as minus
             from blk b join (select * from fx_features where type = 'gene') g on b.ref = g.seqid and b.bs <= g.end_pos and g.start_pos <= b.be
             group by b.sample, b.frag_id),
s as (select sample, count(*) as reads, count(*) filter (where plus = 1 and minus = 1) as f,
        count(*) filter (where not (plus = 1 and minus = 1) and rs = case when plus = 1 then '+' else '-' end) as same,
        count(*) filter (where not (plus = 1 and minus = 1) and rs <> case when plus = 1 then '+' else '-' end) as opp
      from per_read group by sample)
select sample, reads, round(f / reads, 6) as fraction_failed, round(same / reads, 6) as fraction_same,
  round(opp / reads, 6) as fraction_opposite from s""")
def q_infer_experiment(spark, sf_dir):
    return R.infer_experiment(fx.fx_alignments(spark, sf_dir), annotation(spark, sf_dir))


@query("alignment_stats", oracle="""
select sample, count(*) as total_records, count(*) filter (where (flag // 512) % 2 = 1) as qc_failed,
  count(*) filter (where (flag // 1024) % 2 = 1) as duplicates, count(*) filter (where (flag // 256) % 2 = 1) as non_primary,
  count(*) filter (where flag % 8 >= 4) as unmapped,
  count(*) filter (where flag % 8 < 4 and mapq < 30) as mapq_low,
  count(*) filter (where flag % 8 < 4 and mapq >= 30) as mapq_high,
  count(*) filter (where flag % 8 < 4 and mapq >= 30 and flag % 32 < 16) as forward,
  count(*) filter (where flag % 8 < 4 and mapq >= 30 and flag % 32 >= 16) as reverse,
  count(*) filter (where flag % 8 < 4 and mapq >= 30 and cigar like '%N%') as splice_reads,
  count(*) filter (where flag % 8 < 4 and mapq >= 30 and cigar not like '%N%') as non_splice_reads,
  count(*) filter (where flag % 8 < 4 and mapq >= 30 and (flag // 2) % 2 = 1) as proper_pairs
from fx_alignments group by sample""")
def q_alignment_stats(spark, sf_dir):
    return R.alignment_stats(fx.fx_alignments(spark, sf_dir))


@query("read_gc", oracle="""
select sample, round((length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) * 100.0 / length(seq), 2) as gc_percent,
  count(*) as reads from fx_reads where length(seq) > 0 group by all""")
def q_read_gc(spark, sf_dir):
    return R.read_gc(fx.fx_reads(spark, sf_dir, ordinal=False))


@query("clipping_profile", oracle="""
with c as (select sample, cast(mapq % 7 as integer) as lead, cast(frag_id % 5 as integer) as trail from fx_alignments where flag % 8 < 4),
p as (select sample, unnest(range(0, lead)) as position from c
      union all select sample, unnest(range(lead + 50, lead + 50 + trail)) from c)
select sample, cast(position as integer) as position, count(*) as clipped from p group by all""")
def q_clipping_profile(spark, sf_dir):
    """B9 over the fixture alignments with soft clips of 0-6 bases before and 0-4 after 50 aligned ones."""
    lead, trail = F.col("mapq") % 7, F.col("frag_id") % 5
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise(F.lit(""))
    return R.clipping_profile(fx.fx_alignments(spark, sf_dir).withColumn(
        "cigar", F.concat(clip(lead), F.lit("50M"), clip(trail))))


def sam_alignments(spark, sf_dir, *, hits: bool = True):
    """The fixture alignments written as SAM lines and parsed back, with or without NH tags."""
    from strandline.sources.readers import parse_sam_lines

    a = fx.fx_alignments(spark, sf_dir)
    fields = [F.col("frag_id").cast("string"), F.col("flag").cast("string"), F.col("ref"), F.col("pos").cast("string"),
              F.col("mapq").cast("string"), F.col("cigar"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"),
              F.lit("II5")]
    if hits:
        fields.append(F.concat(F.lit("NH:i:"), F.col("nh").cast("string")))
    return parse_sam_lines(a.select("sample", F.concat_ws("\t", *fields).alias("value")), sample=F.col("sample"))


@query("mapping_summary_without_nh", oracle="""
with per_read as (select sample, frag_id, max(case when flag % 8 < 4 then 1 end) as nh from fx_alignments group by sample, frag_id),
s as (select sample, count(*) as reads, count(*) filter (where nh is null) as unmapped,
        count(*) filter (where nh = 1) as "unique", count(*) filter (where nh > 1) as multiple from per_read group by sample)
select sample, reads, unmapped, "unique", multiple, round(unmapped * 100.0 / reads, 6) as pct_unmapped,
  round("unique" * 100.0 / reads, 6) as pct_unique, round(multiple * 100.0 / reads, 6) as pct_multiple from s""")
def q_mapping_summary_without_nh(spark, sf_dir):
    """A4 on parsed SAM text of an aligner that writes no NH tags."""
    return AL.mapping_summary(sam_alignments(spark, sf_dir, hits=False))


@query("fragments_from_sam", oracle="""
select sample, cast(frag_id as varchar) as frag_id, ref as chrom,
  case when flag % 32 >= 16 then pos_end - 199 else pos end as frag_start,
  case when flag % 32 >= 16 then pos_end else pos + 199 end as frag_end
from fx_alignments where flag % 8 < 4""")
def q_fragments_from_sam(spark, sf_dir):
    """V3 on parsed SAM text: reads extended to 200 bases."""
    return CV.fragment_options(sam_alignments(spark, sf_dir), extend=200)


_PAIRS = """
pr as (select *, case when pos2 - end1 - 1 <= 60 then 'concordant' else 'discordant' end as kind from fx_pairs)"""


def paired_alignments(spark, sf_dir):
    """Two records per fixture pair, proper where the gap is at most 60 bases."""
    from strandline.plans.q_counting import _mates

    p = fx.fx_pairs(spark, sf_dir).where(F.col("sample").isNotNull() & F.col("frag_id").isNotNull())
    return _mates(p, F.when(F.col("pos2") - F.col("end1") - 1 <= 60, 2).otherwise(0))


@query("pair_mapping_summary", oracle=f"""
with {_PAIRS},
s as (select sample, count(distinct frag_id) as fragments, 0::bigint as unmapped, 0::bigint as one_mate,
  count(*) filter (where kind = 'discordant') as discordant, count(*) filter (where kind = 'concordant') as concordant
  from pr group by sample)
select *, round(unmapped * 100.0 / fragments, 6) as pct_unmapped, round(one_mate * 100.0 / fragments, 6) as pct_one_mate,
  round(discordant * 100.0 / fragments, 6) as pct_discordant, round(concordant * 100.0 / fragments, 6) as pct_concordant from s""")
def q_pair_mapping_summary(spark, sf_dir):
    return AL.pair_mapping_summary(paired_alignments(spark, sf_dir))


@query("mark_duplicate_pairs", oracle="""
with f as (select sample, frag_id, cast(row_number() over (partition by sample, ref, pos1, pos2, strand1 order by frag_id) > 1 as boolean) as dup
           from fx_pairs)
select sample, frag_id, dup as duplicate, cast(unnest([1, 2]) as integer) as mate from f""")
def q_mark_duplicate_pairs(spark, sf_dir):
    """A7 on pairs: both mates of a fragment share its fate (equal qualities, so the smallest fragment stays)."""
    m = AL.mark_duplicates(paired_alignments(spark, sf_dir))
    return m.select("sample", "frag_id", "duplicate", F.when(F.col("flag").bitwiseAND(F.lit(64)) != 0, 1).otherwise(2).alias("mate"))


@query("infer_experiment_pairs", oracle="""
with g as (select * from fx_features where type = 'gene'),
blk as (select sample, frag_id, ref, strand1, pos1 as bs, end1 as be from fx_pairs
        union all select sample, frag_id, ref, strand1, pos2, end2 from fx_pairs),
per as (select b.sample, b.frag_id, max(b.strand1) as rs, max(case when g.strand = '+' then 1 else 0 end) as plus,
          max(case when g.strand = '-' then 1 else 0 end) as minus
        from blk b join g on b.ref = g.seqid and b.bs <= g.end_pos and g.start_pos <= b.be group by b.sample, b.frag_id),
s as (select sample, count(*) as reads, count(*) filter (where plus = 1 and minus = 1) as f,
        count(*) filter (where not (plus = 1 and minus = 1) and rs = case when plus = 1 then '+' else '-' end) as same,
        count(*) filter (where not (plus = 1 and minus = 1) and rs <> case when plus = 1 then '+' else '-' end) as opp
      from per group by sample)
select sample, reads, round(f / reads, 6) as fraction_failed, round(same / reads, 6) as fraction_same,
  round(opp / reads, 6) as fraction_opposite from s""")
def q_infer_experiment_pairs(spark, sf_dir):
    """B6 on pairs: a fragment has the strand of its first mate."""
    return R.infer_experiment(paired_alignments(spark, sf_dir).withColumn("mapq", F.lit(60)), annotation(spark, sf_dir))


@query("transcripts_to_features", oracle="""
select c.sample, f.biotype as feature, round(sum(cast(c.n as double)), 6) as num_reads
from fx_counts c join fx_features f on f.gene_id = c.gene_id
where f.biotype <> 'ECONOMY' group by c.sample, f.biotype""")
def q_transcripts_to_features(spark, sf_dir):
    """A3: per-transcript estimates (here the count table) summed per biotype attribute."""
    quant = fx.fx_counts(spark, sf_dir).select("sample", F.col("gene_id").alias("transcript"),
                                               F.col("n").cast("double").alias("num_reads"))
    return R.transcripts_to_features(quant, annotation(spark, sf_dir), attribute="biotype")


@query("map_reads_ungapped")
def q_map_reads_ungapped(spark, sf_dir):
    """A1: every read mapped to the small contaminant reference (seed-and-verify, 5 % mismatches; the
    survey re-aims A1 at small references).  No SQL oracle: the brute-force comparison lives in
    tests/test_units.py (test_ungapped_mapping_equals_brute_force)."""
    from strandline.operators.align import map_reads_ungapped

    ref = fx.fx_contaminants(spark, sf_dir).select(F.concat(F.lit("c"), F.col("item_id").cast("string")).alias("name"),
                                                   "seq")
    return map_reads_ungapped(fx.fx_reads(spark, sf_dir, ordinal=False), ref)


@query("map_reads_contigs")
def q_map_reads_contigs(spark, sf_dir):
    """A1: reads of 20 bases or more (what trimming leaves) mapped to all document contigs.  No SQL oracle: compared with
    brute force in tests/test_mapping.py."""
    reads = fx.fx_reads(spark, sf_dir, ordinal=False).where(F.length("seq") >= 20)
    return MP.map_reads(reads, fx.fx_contigs(spark, sf_dir).select("name", "seq"))


def _transcripts(spark, sf_dir):
    return fx.fx_contaminants(spark, sf_dir).select(F.concat(F.lit("t,"), F.col("item_id").cast("string")).alias("name"), "seq")


@query("quantify_transcripts")
def q_quantify_transcripts(spark, sf_dir):
    """A2: reads pseudo-aligned to the benchmark passages as transcripts, EM over equivalence classes.
    Iterative: no SQL oracle; the EM is checked on planted cases in tests/test_quant.py."""
    return QU.quantify_transcripts(fx.fx_reads(spark, sf_dir, ordinal=False), _transcripts(spark, sf_dir))


@query("quantify_pairs")
def q_quantify_pairs(spark, sf_dir):
    """A2 on pairs: library type and fragment lengths from the pairs themselves."""
    return QU.quantify_transcripts(fx.fx_mates(spark, sf_dir), _transcripts(spark, sf_dir))


# every 31-mer of both strands of the transcripts against every 31-mer of the reads
_MAPPED = """
tx as (select concat('t,', cast(item_id as varchar)) as name, seq from fx_contaminants),
strands as (select name, '+' as strand, seq from tx union all select name, '-', reverse(translate(seq, 'ACGT', 'TGCA')) from tx),
idx as (select name, strand, substring(seq, cast(p + 1 as integer), 31) as kmer
        from (select *, unnest(range(0, length(seq) - 30)) as p from strands where length(seq) >= 31) x),
rk as (select sample, read_id, i, substring(seq, cast(i + 1 as integer), 31) as kmer
       from (select *, unnest(range(0, length(seq) - 30)) as i from fx_reads where length(seq) >= 31) x),
hits as (select distinct sample, read_id, i, name, strand from rk join idx using (kmer) where kmer not like '%N%'),
m as (select sample, read_id, count(distinct i) as m from hits group by all),
compat as (select h.sample, h.read_id, h.name, h.strand from hits h join m using (sample, read_id)
           group by h.sample, h.read_id, h.name, h.strand, m.m having count(*) = m.m),
one as (select sample, read_id, min(strand) as s from compat group by all having min(strand) = max(strand)),
lib as (select sample, count(*) filter (where s = '+') as forward, count(*) filter (where s = '-') as reverse from one group by sample),
types as (select *, case when forward >= 0.7 * (forward + reverse) then 'SF' when reverse >= 0.7 * (forward + reverse) then 'SR' else 'U' end
          as library_type from lib),
good as (select c.* from compat c join types t using (sample) where t.library_type = 'U' or (t.library_type = 'SF') = (c.strand = '+'))"""


@query("library_types", oracle=f"with {_MAPPED} select sample, forward, reverse, library_type from types")
def q_library_types(spark, sf_dir):
    """A2: the library type of each sample."""
    return QU.library_types(QU.mapped_fragments(fx.fx_reads(spark, sf_dir, ordinal=False), _transcripts(spark, sf_dir)), paired=False)


@query("equivalence_classes", oracle=f"""
with {_MAPPED},
ec as (select sample, read_id, string_agg(distinct name, '|' order by name) as transcripts from good group by all)
select sample, transcripts, count(*) as reads from ec group by all""")
def q_equivalence_classes(spark, sf_dir):
    """A2: reads by their set of compatible transcripts."""
    tx = _transcripts(spark, sf_dir)
    frags = QU.mapped_fragments(fx.fx_reads(spark, sf_dir, ordinal=False), tx).checkpoint()
    ecs = QU.equivalence_classes(QU.strand_compatible(frags, QU.library_types(frags, paired=False)))
    ecs = ecs.withColumn("_ec", F.monotonically_increasing_id()).checkpoint()
    names = tx.select(F.xxhash64("name").alias("tx"), "name")
    return ecs.select("sample", "_ec", "count", F.explode("ec").alias("tx")).join(names, "tx").groupBy("sample", "_ec", "count").agg(
        F.array_join(F.sort_array(F.collect_list("name")), "|").alias("transcripts")).select(
        "sample", "transcripts", F.col("count").alias("reads"))


@query("mapping_rates", oracle=f"""
with {_MAPPED},
r as (select x.sample, x.read_id, length(x.seq) >= 31 as enough, c.read_id is not null as hit, g.read_id is not null as good from fx_reads x
      left join (select distinct sample, read_id from compat) c on c.sample = x.sample and c.read_id = x.read_id
      left join (select distinct sample, read_id from good) g on g.sample = x.sample and g.read_id = x.read_id)
select r.sample, count(*) as reads, count(*) filter (where not enough) as short, count(*) filter (where enough and not hit) as unmapped,
  count(*) filter (where hit and not good) as other_strand, count(*) filter (where good) as mapped, any_value(t.library_type) as library_type
from r left join types t on t.sample = r.sample group by r.sample""")
def q_mapping_rates(spark, sf_dir):
    """A2: where every read went."""
    reads = fx.fx_reads(spark, sf_dir, ordinal=False)
    frags = QU.mapped_fragments(reads, _transcripts(spark, sf_dir)).checkpoint()
    return QU.mapping_rates(reads, frags, QU.library_types(frags, paired=False))

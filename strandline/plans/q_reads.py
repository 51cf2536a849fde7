"""Read-side queries: QC (Q1-Q11), trimming and filtering (T1-T13), contaminant screen."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import adapters as AD
from strandline.operators import readqc as Q
from strandline.operators import screen as SC
from strandline.operators import trim as T
from strandline.plans.registry import query
from strandline.sources import fixtures as fx

ADAPTER = "AGATCGGAAGAGC"  # TruSeq 3' adapter used by the trimming queries

# ---------------------------------------------------------------- oracle pieces (DuckDB)

_BASES = """
bases as (select sample, read_id, seq, qual, cast(i + 1 as integer) as position,
                 substring(seq, cast(i + 1 as integer), 1) as base,
                 ascii(substring(qual, cast(i + 1 as integer), 1)) - 33 as q
          from (select *, unnest(range(0, length(seq))) as i from fx_reads) x)"""

_PBQ = _BASES + """,
qh as (select sample, position, q, count(*) as n from bases group by all),
qc as (select *, sum(n) over (partition by sample, position order by q rows between unbounded preceding and current row) as cum,
              sum(n) over (partition by sample, position) as tot from qh),
pbq as (select sample, position, round(sum(q * n) / sum(n), 6) as mean,
  min(case when cum >= greatest(1, floor(tot * 10 / 100)) then q end) as p10,
  min(case when cum >= greatest(1, floor(tot * 25 / 100)) then q end) as q1,
  min(case when cum >= greatest(1, floor(tot * 50 / 100)) then q end) as median,
  min(case when cum >= greatest(1, floor(tot * 75 / 100)) then q end) as q3,
  min(case when cum >= greatest(1, floor(tot * 90 / 100)) then q end) as p90
  from qc group by sample, position)"""

_PBN_TAIL = """
pbn as (select sample, position, round(count(*) filter (where base = 'N') * 100.0 / count(*), 6) as pct_n
        from bases group by sample, position)"""
_PBN = _BASES + "," + _PBN_TAIL

_OVER = """
per_seq as (select sample, seq, count(*) as count from fx_reads group by sample, seq),
totals as (select sample, count(*) as total from fx_reads group by sample),
over as (select p.sample, p.seq, p.count, round(p.count * 100.0 / t.total, 6) as percentage
         from per_seq p join totals t on t.sample = p.sample where p.count > t.total * 0.001)"""

# 3'->5' sliding window (4 bases, mean 20): keep up to the end of the last passing window
_CUT_TAIL = _BASES + """,
win as (select sample, read_id, position, length(seq) as len,
          sum(q) over (partition by sample, read_id order by position rows between current row and 3 following) as wsum,
          count(*) over (partition by sample, read_id order by position rows between current row and 3 following) as wn
        from bases),
keep_end as (select sample, read_id, max(case when wn = least(4, len) and wsum >= least(4, len) * 20
                                              then position - 1 + wn end) as kept
             from win group by sample, read_id),
cut as (select r.sample, r.ordinal, r.read_id, substring(r.seq, 1, cast(coalesce(k.kept, 0) as integer)) as seq,
               substring(r.qual, 1, cast(coalesce(k.kept, 0) as integer)) as qual
        from fx_reads r left join keep_end k on k.sample = r.sample and k.read_id = r.read_id)"""

_QUALS = "list_transform(string_split({q}, ''), lambda c: ascii(c) - 33)"


def _fastp_pass(alias: str) -> str:
    """DuckDB predicate: qualified-base filter (Q15, 40 %), N limit 5, minimum length 20."""
    q = _QUALS.format(q=f"{alias}.qual")
    return (f"(length({alias}.seq) >= 20 and length({alias}.seq) - length(replace({alias}.seq, 'N', '')) <= 5 "
            f"and len(list_filter({q}, lambda x: x < 15)) * 100 <= length({alias}.seq) * 40)")


def reads(spark, sf_dir):
    return fx.fx_reads(spark, sf_dir)


def plain_reads(spark, sf_dir):
    """The reads without their ordinal, for operators that do not need it."""
    return fx.fx_reads(spark, sf_dir, ordinal=False)


# ---------------------------------------------------------------- Q: read QC


@query("per_base_quality", oracle=f"with {_PBQ} select * from pbq")
def q_per_base_quality(spark, sf_dir):
    return Q.per_base_quality(plain_reads(spark, sf_dir))


@query("per_read_quality", oracle=f"""
select sample, cast(floor(list_sum({_QUALS.format(q='qual')}) / length(qual)) as integer) as mean_quality,
  count(*) as reads from fx_reads where length(qual) > 0 group by all""")
def q_per_read_quality(spark, sf_dir):
    return Q.per_read_quality(plain_reads(spark, sf_dir))


@query("per_base_content", oracle=f"""
with {_BASES},
r as (select sample, position, count(*) filter (where base = 'A') as a, count(*) filter (where base = 'C') as c,
        count(*) filter (where base = 'G') as g, count(*) filter (where base = 'T') as t,
        count(*) filter (where base in ('A', 'C', 'G', 'T')) as n from bases group by sample, position)
select sample, position, round(a * 100.0 / n, 6) as pct_A, round(c * 100.0 / n, 6) as pct_C,
  round(g * 100.0 / n, 6) as pct_G, round(t * 100.0 / n, 6) as pct_T from r where n > 0""")
def q_per_base_content(spark, sf_dir):
    return Q.per_base_content(plain_reads(spark, sf_dir))


@query("gc_distribution", oracle="""
with g as (select sample, length(seq) - length(replace(replace(replace(replace(seq, 'G', ''), 'C', ''), 'g', ''), 'c', '')) as gc,
             length(seq) - length(regexp_replace(seq, '[ACGTacgt]', '', 'g')) as acgt from fx_reads)
select sample, cast(round(gc * 100.0 / acgt) as integer) as gc_percent, count(*) as reads from g where acgt > 0 group by all""")
def q_gc_distribution(spark, sf_dir):
    return Q.gc_distribution(plain_reads(spark, sf_dir))


@query("per_base_n", oracle=f"with {_PBN} select * from pbn")
def q_per_base_n(spark, sf_dir):
    return Q.per_base_n(plain_reads(spark, sf_dir))


@query("length_distribution", oracle="""
select sample, cast(length(seq) as integer) as length, count(*) as reads from fx_reads group by all""")
def q_length_distribution(spark, sf_dir):
    return Q.length_distribution(plain_reads(spark, sf_dir))


@query("duplication_levels", oracle="""
with c as (select sample, seq, count(*) as copies from fx_reads group by sample, seq)
select sample, case when copies >= 10000 then '>10k' when copies >= 5000 then '>5k' when copies >= 1000 then '>1k'
  when copies >= 500 then '>500' when copies >= 100 then '>100' when copies >= 50 then '>50' when copies >= 10 then '>10'
  else cast(copies as varchar) end as level, count(*) as sequences, cast(sum(copies) as bigint) as reads
from c group by all""")
def q_duplication_levels(spark, sf_dir):
    return Q.duplication_levels(plain_reads(spark, sf_dir))


@query("overrepresented_sequences", oracle=f"with {_OVER} select * from over")
def q_overrepresented_sequences(spark, sf_dir):
    return Q.overrepresented_sequences(plain_reads(spark, sf_dir))


_ADAPTER_ROWS = " union all ".join(f"select '{n.replace(chr(39), chr(39) * 2)}' as adapter, '{s}' as aseq"
                                   for n, s in Q.ADAPTERS)


@query("adapter_content", oracle=f"""
with ad as ({_ADAPTER_ROWS}),
first as (select r.sample, ad.adapter, cast(instr(r.seq, ad.aseq) as integer) as position, count(*) as n
          from fx_reads r cross join ad where instr(r.seq, ad.aseq) > 0 group by all),
tot as (select sample, count(*) as total, max(length(seq)) as len from fx_reads group by sample),
grid as (select t.sample, t.total, ad.adapter, cast(p as integer) as position
         from tot t cross join ad cross join unnest(range(1, t.len + 1)) u(p))
select g.sample, g.adapter, g.position,
  round(sum(coalesce(f.n, 0)) over (partition by g.sample, g.adapter order by g.position
        rows between unbounded preceding and current row) * 100.0 / g.total, 6) as pct_reads
from grid g left join first f on f.sample = g.sample and f.adapter = g.adapter and f.position = g.position""")
def q_adapter_content(spark, sf_dir):
    return Q.adapter_content(plain_reads(spark, sf_dir))


@query("basic_stats", oracle="""
select sample, count(*) as total_sequences, cast(min(length(seq)) as integer) as min_length,
  cast(max(length(seq)) as integer) as max_length,
  round(sum(length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) * 100.0
        / sum(length(seq) - length(regexp_replace(seq, '[ACGTacgt]', '', 'g'))), 6) as pct_gc
from fx_reads group by sample""")
def q_basic_stats(spark, sf_dir):
    return Q.basic_stats(plain_reads(spark, sf_dir))


_STATUS = f"""
{_PBQ}, {_PBN_TAIL}, {_OVER},
m1 as (select sample, 'per_base_sequence_quality' as module,
         case when min(q1) < 5 or min(median) < 20 then 'fail' when min(q1) < 10 or min(median) < 25 then 'warn'
              else 'pass' end as status from pbq group by sample),
m2 as (select sample, 'per_base_n_content' as module,
         case when max(pct_n) > 20 then 'fail' when max(pct_n) > 5 then 'warn' else 'pass' end as status
       from pbn group by sample),
m3 as (select sample, 'sequence_length_distribution' as module,
         case when min(length(seq)) = 0 then 'fail' when min(length(seq)) <> max(length(seq)) then 'warn'
              else 'pass' end as status from fx_reads group by sample),
m4 as (select s.sample, 'overrepresented_sequences' as module,
         case when max(o.percentage) > 1 then 'fail' when max(o.percentage) > 0.1 then 'warn' else 'pass' end as status
       from (select distinct sample from fx_reads) s left join over o on o.sample = s.sample group by s.sample),
mq as (select sample, cast(floor(list_sum({_QUALS.format(q='qual')}) / length(qual)) as integer) as q, count(*) as n
       from fx_reads where length(qual) > 0 group by all),
m5 as (select sample, 'per_sequence_quality_scores' as module, case when arg_min(q, (-n, q)) < 20 then 'fail'
         when arg_min(q, (-n, q)) < 27 then 'warn' else 'pass' end as status from mq group by sample),
pct as (select sample, position, count(*) filter (where base = 'A') * 100.0 / count(*) as a,
          count(*) filter (where base = 'C') * 100.0 / count(*) as c, count(*) filter (where base = 'G') * 100.0 / count(*) as g,
          count(*) filter (where base = 'T') * 100.0 / count(*) as t from bases where base in ('A', 'C', 'G', 'T')
        group by sample, position),
m6 as (select sample, 'per_base_sequence_content' as module, case when max(greatest(abs(a - t), abs(g - c))) > 20 then 'fail'
         when max(greatest(abs(a - t), abs(g - c))) > 10 then 'warn' else 'pass' end as status from pct group by sample),
m7 as (select sample, 'sequence_duplication_levels' as module,
         case when 100 - count(distinct seq) * 100.0 / count(*) > 50 then 'fail'
              when 100 - count(distinct seq) * 100.0 / count(*) > 20 then 'warn' else 'pass' end as status
       from fx_reads group by sample),
adp as (select r.sample, ad.adapter, count(*) filter (where instr(r.seq, ad.aseq) > 0) * 100.0 / count(*) as pct
        from fx_reads r cross join ({_ADAPTER_ROWS}) ad group by all),
m8 as (select sample, 'adapter_content' as module, case when max(pct) > 10 then 'fail' when max(pct) > 5 then 'warn'
         else 'pass' end as status from adp group by sample),
status as (select * from m1 union all select * from m2 union all select * from m3 union all select * from m4
           union all select * from m5 union all select * from m6 union all select * from m7 union all select * from m8)"""


@query("qc_status", oracle=f"with {_STATUS} select * from status")
def q_qc_status(spark, sf_dir):
    return Q.qc_status(plain_reads(spark, sf_dir))


@query("percent_fails", oracle=f"""
with {_STATUS}
select sample, round(count(*) filter (where status = 'fail') * 100.0 / count(*), 6) as percent_fails from status group by sample""")
def q_percent_fails(spark, sf_dir):
    return Q.percent_fails(Q.qc_status(plain_reads(spark, sf_dir)))


_MATES = "mates as (select *, cast(cast(split_part(read_id, '_', 2) as integer) % 2 + 1 as integer) as mate from fx_reads)"


def mate_reads(spark, sf_dir):
    """The reads as pairs: even chunks of a text are first mates, odd ones second mates."""
    return plain_reads(spark, sf_dir).withColumn("mate", F.substring_index("read_id", "_", -1).cast("int") % 2 + 1)


@query("basic_stats_by_mate", oracle=f"""
with {_MATES}
select sample, mate, count(*) as total_sequences, cast(min(length(seq)) as integer) as min_length,
  cast(max(length(seq)) as integer) as max_length,
  round(sum(length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) * 100.0
        / sum(length(seq) - length(regexp_replace(seq, '[ACGTacgt]', '', 'g'))), 6) as pct_gc
from mates group by sample, mate""")
def q_basic_stats_by_mate(spark, sf_dir):
    return Q.basic_stats(mate_reads(spark, sf_dir))


@query("length_distribution_by_mate", oracle=f"""
with {_MATES} select sample, mate, cast(length(seq) as integer) as length, count(*) as reads from mates group by all""")
def q_length_distribution_by_mate(spark, sf_dir):
    return Q.length_distribution(mate_reads(spark, sf_dir))


@query("per_read_quality_by_mate", oracle=f"""
with {_MATES}
select sample, mate, cast(floor(list_sum({_QUALS.format(q='qual')}) / length(qual)) as integer) as mean_quality,
  count(*) as reads from mates where length(qual) > 0 group by all""")
def q_per_read_quality_by_mate(spark, sf_dir):
    return Q.per_read_quality(mate_reads(spark, sf_dir))


@query("overrepresented_by_mate", oracle=f"""
with {_MATES},
per_seq as (select sample, mate, seq, count(*) as count from mates group by all),
totals as (select sample, mate, count(*) as total from mates group by all)
select p.sample, p.mate, p.seq, p.count, round(p.count * 100.0 / t.total, 6) as percentage
from per_seq p join totals t on t.sample = p.sample and t.mate = p.mate where p.count > t.total * 0.001""")
def q_overrepresented_by_mate(spark, sf_dir):
    return Q.overrepresented_sequences(mate_reads(spark, sf_dir))


_ANY_ADAPTER = "ACGTAC"


def _adapter_cut(mode: str) -> str:
    """DuckDB: [first, last) base kept by exact matching of a 6-base adapter anywhere (6 bases allow no mismatch)."""
    end = f"case when instr(seq, '{_ANY_ADAPTER}') > 0 then instr(seq, '{_ANY_ADAPTER}') - 1 else length(seq) end"
    r = "substring(seq, 1, cast(e as integer))"
    last = f"length({r}) - instr(reverse({r}), reverse('{_ANY_ADAPTER}')) + 1"
    start = f"case when instr({r}, '{_ANY_ADAPTER}') > 0 then {last} else 0 end"
    return (f"(select *, {start if mode in 'gb' else '0'} as s from "
            f"(select *, {end if mode in 'ab' else 'length(seq)'} as e from fx_reads) x)")


def _adapter_query(mode: str):
    @query(f"trim_adapter_{mode}", oracle=f"""
select sample, read_id, substring(seq, cast(s + 1 as integer), cast(e - s as integer)) as seq,
  substring(qual, cast(s + 1 as integer), cast(e - s as integer)) as qual from {_adapter_cut(mode)} y""")
    def run(spark, sf_dir):
        return T.trim_adapter(plain_reads(spark, sf_dir), _ANY_ADAPTER, mode=mode)
    return run


for _mode in ("g", "b"):
    _adapter_query(_mode)


@query("trim_reads_with_adapter", oracle=f"""
with {_BASES},
sfx as (select sample, read_id, position, sum(15 - q) over (partition by sample, read_id order by position desc) as s from bases),
neg as (select sample, read_id, max(position) filter (where s < 0) as stop from sfx group by sample, read_id),
best as (select f.sample, f.read_id, arg_max(f.position, (f.s, f.position)) as p, max(f.s) as m
         from sfx f join neg n on n.sample = f.sample and n.read_id = f.read_id where f.position > coalesce(n.stop, 0)
         group by f.sample, f.read_id),
q1 as (select r.sample, r.read_id, substring(r.seq, 1, cast(case when b.m > 0 then b.p - 1 else length(r.seq) end as integer)) as seq,
         substring(r.qual, 1, cast(case when b.m > 0 then b.p - 1 else length(r.seq) end as integer)) as qual
       from fx_reads r left join best b on b.sample = r.sample and b.read_id = r.read_id),
a1 as (select sample, read_id, case when instr(seq, '{_ANY_ADAPTER}') > 0 then instr(seq, '{_ANY_ADAPTER}') - 1 else length(seq) end as n,
         seq, qual from q1),
a2 as (select sample, read_id, substring(seq, 1, cast(n as integer)) as seq, substring(qual, 1, cast(n as integer)) as qual from a1),
n1 as (select *, length(regexp_extract(seq, '^N*', 0)) as lead, length(regexp_extract(seq, 'N*$', 0)) as trail from a2),
n2 as (select *, case when lead = length(seq) then 0 else length(seq) - lead - trail end as n from n1),
n3 as (select sample, read_id, case when n > 0 then substring(seq, cast(lead + 1 as integer), cast(n as integer)) else '' end as seq,
         case when n > 0 then substring(qual, cast(lead + 1 as integer), cast(n as integer)) else '' end as qual from n2)
select * from n3 where length(seq) >= 20""")
def q_trim_reads_with_adapter(spark, sf_dir):
    """T9 in the order of the adapter tool: quality 15, adapter, Ns, length 20."""
    return T.trim_reads(plain_reads(spark, sf_dir), adapter=_ANY_ADAPTER, quality_cutoff=15, disable_quality_filtering=True)


# ---------------------------------------------------------------- T: trimming and filtering


@query("trim_adapter", oracle=f"""
with c as (select *, coalesce(list_min(list_filter(range(0, length(seq) + 1), lambda i:
      length(seq) - i >= 6 and
      list_sum(list_transform(range(0, least({len(ADAPTER)}, length(seq) - i)), lambda j:
        case when substring(seq, cast(i + j + 1 as integer), 1) = substring('{ADAPTER}', cast(j + 1 as integer), 1)
             then 0 else 1 end)) <= floor(least({len(ADAPTER)}, length(seq) - i) * 0.1))), length(seq)) as cut
    from fx_reads)
select sample, ordinal, read_id, substring(seq, 1, cast(cut as integer)) as seq,
  substring(qual, 1, cast(cut as integer)) as qual from c""")
def q_trim_adapter(spark, sf_dir):
    return T.trim_adapter(reads(spark, sf_dir), ADAPTER, mode="a")


@query("trim_n", oracle="""
with c as (select *, length(regexp_extract(seq, '^N*', 0)) as lead, length(regexp_extract(seq, 'N*$', 0)) as trail
           from fx_reads),
k as (select *, case when lead = length(seq) then 0 else length(seq) - lead - trail end as n from c)
select sample, ordinal, read_id, case when n > 0 then substring(seq, cast(lead + 1 as integer), cast(n as integer)) else '' end as seq,
  case when n > 0 then substring(qual, cast(lead + 1 as integer), cast(n as integer)) else '' end as qual from k""")
def q_trim_n(spark, sf_dir):
    return T.trim_n(reads(spark, sf_dir))


@query("quality_trim_3p", oracle=f"""
with {_BASES},
s as (select sample, read_id, position, length(seq) as len,
        sum(30 - q) over (partition by sample, read_id order by position desc rows between unbounded preceding and current row) as suf
      from bases),
stop as (select sample, read_id, max(case when suf < 0 then position end) as stop_pos from s group by sample, read_id),
best as (select s.sample, s.read_id, arg_max(s.position - 1, s.suf * 1000000 + s.position) as cut_at, max(s.suf) as best_suf
         from s join stop on stop.sample = s.sample and stop.read_id = s.read_id
         where s.position > coalesce(stop.stop_pos, 0) and s.suf > 0 group by s.sample, s.read_id),
k as (select r.*, coalesce(b.cut_at, length(r.seq)) as kept from fx_reads r
      left join best b on b.sample = r.sample and b.read_id = r.read_id)
select sample, ordinal, read_id, case when kept > 0 then substring(seq, 1, cast(kept as integer)) else '' end as seq,
  case when kept > 0 then substring(qual, 1, cast(kept as integer)) else '' end as qual from k""")
def q_quality_trim_3p(spark, sf_dir):
    return T.quality_trim_3p(reads(spark, sf_dir), 30)


@query("min_length", oracle="select * from fx_reads where length(seq) >= 20")
def q_min_length(spark, sf_dir):
    return T.min_length(reads(spark, sf_dir), 20)


@query("cut_tail", oracle=f"with {_CUT_TAIL} select * from cut")
def q_cut_tail(spark, sf_dir):
    return T.cut_tail(reads(spark, sf_dir), 4, 20)


@query("qualified_filter", oracle=f"""
select * from fx_reads r where len(list_filter({_QUALS.format(q='r.qual')}, lambda x: x < 15)) * 100 <= length(r.seq) * 40""")
def q_qualified_filter(spark, sf_dir):
    return T.qualified_filter(reads(spark, sf_dir), 15, 40)


@query("n_base_limit", oracle="select * from fx_reads where length(seq) - length(replace(replace(seq, 'N', ''), 'n', '')) <= 5")
def q_n_base_limit(spark, sf_dir):
    return T.n_base_limit(reads(spark, sf_dir), 5)


@query("mean_quality_filter", oracle=f"""
select * from fx_reads r where list_sum({_QUALS.format(q='r.qual')}) >= length(r.qual) * 20""")
def q_mean_quality_filter(spark, sf_dir):
    return T.mean_quality_filter(reads(spark, sf_dir), 20)


@query("trim_reads", oracle=f"""
with {_CUT_TAIL}
select * from cut c where {_fastp_pass('c')}""")
def q_trim_reads(spark, sf_dir):
    """The reference's fastp set-up — cut_tail, quality filtering on, adapters off, minimum length 20."""
    return T.trim_reads(reads(spark, sf_dir), adapter=None, trim_ns=False, quality_cutoff=0, cut_tail_window=4,
                        cut_tail_mean=20, minimum_length=20, disable_adapter_trimming=True)


def _mates(spark, sf_dir):
    r = reads(spark, sf_dir)
    doc = F.regexp_extract("read_id", r"^d([0-9]+)_([0-9]+)$", 1)
    k = F.regexp_extract("read_id", r"^d([0-9]+)_([0-9]+)$", 2).cast("int")
    r = r.withColumn("pair_id", F.concat(F.lit("d"), doc, F.lit("_p"), F.floor(k / 2).cast("string")))
    return r.where(k % 2 == 0), r.where(k % 2 == 1)


@query("pair_filter", oracle=f"""
with m as (select *, concat('d', regexp_extract(read_id, '^d([0-9]+)_([0-9]+)$', 1), '_p',
                     cast(cast(regexp_extract(read_id, '^d([0-9]+)_([0-9]+)$', 2) as integer) // 2 as varchar)) as pair_id,
                  cast(regexp_extract(read_id, '^d([0-9]+)_([0-9]+)$', 2) as integer) % 2 as mate from fx_reads)
select a.sample, a.pair_id, a.seq as seq1, a.qual as qual1, b.seq as seq2, b.qual as qual2
from m a join m b on a.sample = b.sample and a.pair_id = b.pair_id and a.mate = 0 and b.mate = 1
where {_fastp_pass('a')} and {_fastp_pass('b')}""")
def q_pair_filter(spark, sf_dir):
    """Consecutive chunks of a text as mate 1 / mate 2; a pair survives only when both pass."""
    m1, m2 = _mates(spark, sf_dir)
    keep = lambda df: T.min_length(T.n_base_limit(T.qualified_filter(df)), 20)
    return T.pair_filter(m1, m2, keep, key=["sample", "pair_id"])


@query("trim_summary", oracle=f"""
with {_CUT_TAIL},
after as (select * from cut c where {_fastp_pass('c')}),
both_ as (select 'before' as stage, * from fx_reads union all select 'after', * from after)
select sample, count(*) as reads, cast(sum(length(seq)) as bigint) as bases,
  cast(sum(len(list_filter({_QUALS.format(q='qual')}, lambda x: x >= 20))) as bigint) as q20_bases,
  cast(sum(len(list_filter({_QUALS.format(q='qual')}, lambda x: x >= 30))) as bigint) as q30_bases,
  cast(sum(length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) as bigint) as gc_bases, stage
from both_ group by sample, stage""")
def q_trim_summary(spark, sf_dir):
    r = plain_reads(spark, sf_dir)
    after = T.trim_reads(r, adapter=None, trim_ns=False, quality_cutoff=0, cut_tail_window=4, cut_tail_mean=20,
                         minimum_length=20, disable_adapter_trimming=True)
    return T.trim_summary(r, after)


@query("duplication_share", oracle="""
select sample, count(*) as reads, round(100 - count(distinct seq) * 100.0 / count(*), 6) as duplication_percent
from fx_reads group by sample""")
def q_duplication_share(spark, sf_dir):
    return T.duplication_share(plain_reads(spark, sf_dir))


@query("trimming_off", oracle="select * from fx_reads")
def q_trimming_off(spark, sf_dir):
    return T.trimming_off(reads(spark, sf_dir))


# ---------------------------------------------------------------- C: contaminant screen

_SCREEN = """
reads1 as (select * from fx_reads),
ref as (select concat('c', cast(item_id as varchar)) as name, '+' as strand, upper(seq) as rseq from fx_contaminants
        union all
        select concat('c', cast(item_id as varchar)), '-', reverse(translate(upper(seq), 'ACGTNacgtn', 'TGCANtgcan'))
        from fx_contaminants),
pieces as (select r.sample, r.read_id, r.seq, r.qual, case when length(r.seq) >= 27 then 9 else 6 end as l, k.k
           from reads1 r cross join (select 0 as k union all select 1 union all select 2) k where length(r.seq) >= 18),
idx as (select name, strand, rseq, l.l, p as pos0, substring(rseq, cast(p + 1 as integer), l.l) as piece
        from ref cross join (select 6 as l union all select 9) l cross join unnest(range(0, length(rseq) - l.l + 1)) u(p)),
cand as (select distinct p.sample, p.read_id, p.seq, p.qual, i.name, i.strand, i.rseq, i.pos0 - p.k * p.l as start0
         from pieces p join idx i on i.l = p.l and i.piece = substring(p.seq, cast(p.k * p.l + 1 as integer), p.l)),
verified as (select sample, read_id from cand
  where start0 >= 0 and start0 + length(seq) <= length(rseq)
    and list_sum(list_transform(range(0, least(28, length(seq))), lambda j:
          case when substring(seq, cast(j + 1 as integer), 1) <> substring(rseq, cast(start0 + j + 1 as integer), 1) then 1 else 0 end)) <= 2
    and list_sum(list_transform(range(0, length(seq)), lambda j:
          case when substring(seq, cast(j + 1 as integer), 1) <> substring(rseq, cast(start0 + j + 1 as integer), 1)
               then ascii(substring(qual, cast(j + 1 as integer), 1)) - 33 else 0 end)) <= 70),
screened as (select r.sample, r.read_id, length(r.seq) >= 18 as screened,
                    exists (select 1 from verified v where v.sample = r.sample and v.read_id = r.read_id) as aligned
             from reads1 r),
rates as (select sample, count(*) as reads, count(*) filter (where aligned) as aligned,
            count(*) filter (where not screened) as not_screened,
            round(count(*) filter (where aligned) * 100.0 / count(*), 6) as reads_aligned_percentage
          from screened group by sample)"""


def _screened(spark, sf_dir):
    ref = fx.fx_contaminants(spark, sf_dir).select(F.concat(F.lit("c"), F.col("item_id").cast("string")).alias("name"),
                                                   "seq")
    return SC.screen_contaminants(plain_reads(spark, sf_dir), ref)


@query("first_reads", oracle="select * from fx_reads where ordinal < 500")
def q_first_reads(spark, sf_dir):
    """The operator is the prefix itself; 500 reads per sample are fewer than any sample has."""
    return SC.first_reads(reads(spark, sf_dir), 500)


@query("screen_contaminants", oracle=f"with {_SCREEN} select * from screened")
def q_screen_contaminants(spark, sf_dir):
    return _screened(spark, sf_dir)


@query("contamination_rate", oracle=f"with {_SCREEN} select * from rates")
def q_contamination_rate(spark, sf_dir):
    return SC.contamination_rate(_screened(spark, sf_dir))


@query("contamination_band", oracle=f"""
with {_SCREEN}
select floor(avg(reads_aligned_percentage) * 100) / 100 as contamination,
  case when avg(reads_aligned_percentage) is null then 'not computed'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 10 then 'low'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 20 then 'moderately low'
       when floor(avg(reads_aligned_percentage) * 100) / 100 < 50 then 'relatively high' else 'very high' end as band
from rates""")
def q_contamination_band(spark, sf_dir):
    return SC.contamination_band(SC.contamination_rate(_screened(spark, sf_dir)))


@query("detect_adapters", oracle="""
with c as (select sample, substring(seq, length(seq) - 11, 12) as kmer, count(*) as count from fx_reads
           where length(seq) >= 12 group by all),
r as (select *, row_number() over (partition by sample order by count desc, kmer) as rank from c)
select sample, kmer, count, cast(rank as integer) as rank from r where rank <= 5""")
def q_detect_adapters(spark, sf_dir):
    return T.detect_adapters(reads(spark, sf_dir), k=12, top=5)


@query("contaminant_reference", oracle="""
select concat(f.seqid, ':', cast(f.start_pos - 1 as varchar), '-', cast(f.end_pos as varchar)) as name,
  substring(c.seq, cast(f.start_pos as integer), cast(f.end_pos - f.start_pos + 1 as integer)) as seq
from fx_ctg_features f join fx_contigs c on c.name = f.seqid where f.type = 'rRNA' and f.end_pos <= c.length""")
def q_contaminant_reference(spark, sf_dir):
    """The rRNA features cut from the contigs."""
    return SC.contaminant_reference(contigs=fx.fx_contigs(spark, sf_dir), features=fx.fx_ctg_features(spark, sf_dir),
                                    feature_type="rRNA")


# ---------------------------------------------------------------- T: gapped adapters, mates

# settings of the gapped queries: two adapters for mate 1, one for mate 2
_FWD = [("universal", "AGATCGGAAGAGC"), ("tail", "CACACGTCTGAAC")]
_REV = [("universal", "AGATCGGAAGAGC")]


def _gapped_sql(mode: str) -> str:
    """Every alignment of a whole adapter, or of its first 6 or more bases with the read's end, by edit distance."""
    adapters = ", ".join(f"({m}, {k}, '{n}', '{a}')" for m, s in ((1, _FWD), (2, _REV)) for k, (n, a) in enumerate(s))
    sides = {"a": "(0)", "g": "(1)", "b": "(0), (1)"}[mode]
    return f"""
with ad(mate, k, name, a) as (values {adapters}), sides(side) as (values {sides}),
r as (select sample, read_id, mate, seq, qual, length(seq) as n, side, case when side = 0 then seq else reverse(seq) end as t
      from fx_mate_reads, sides),
d as (select distinct mate, side, t, n from r),
q as (select d.*, ad.k, ad.name, case when side = 0 then a else reverse(a) end as a from d join ad using (mate)),
whole as (select *, length(a) as i, unnest(range(0, n)) as s, [-1, 0, 1] as extra from q),
part as (select *, n - i - x as s from (select *, unnest(range(6, length(a))) as i from q) y, (values (-1), (0), (1)) e(x)),
c as (select mate, side, t, k, name, i, s, levenshtein(a, substring(t, cast(s + 1 as integer), cast(i + x as integer))) as err
      from (select * exclude (extra), unnest(extra) as x from whole) w where s + i + x <= n
      union all
      select mate, side, t, k, name, i, s, levenshtein(substring(a, 1, cast(i as integer)), substring(t, cast(s + 1 as integer))) as err
      from part where s >= 0),
best as (select mate, side, t, arg_min(struct_pack(m := i - err, err := err, s := s, name := name), (err - i, err, s, k)) as h
         from c where err <= cast(floor(i * 0.1 + 1e-9) as integer) group by mate, side, t),
got as (select r.*, h, row_number() over (partition by sample, read_id, r.mate order by coalesce(-h.m, 999), coalesce(h.err, 999), r.side) as o
        from r left join best b on b.mate = r.mate and b.side = r.side and b.t = r.t),
f as (select *, case when h is null or side = 0 then 0 else n - h.s end as first, case when h is null or side = 1 then n else h.s end as last
      from got where o = 1)
select sample, read_id, mate, substring(seq, cast(first + 1 as integer), cast(last - first as integer)) as seq,
  substring(qual, cast(first + 1 as integer), cast(last - first as integer)) as qual, h.name as adapter, cast(coalesce(h.err, 0) as integer) as adapter_errors from f"""


def _gapped_query(mode: str):
    @query(f"trim_adapters_{mode}", oracle=_gapped_sql(mode))
    def run(spark, sf_dir):
        """T1 with gaps, sets of adapters and both mates."""
        return AD.trim_adapters(fx.fx_mate_reads(spark, sf_dir), _FWD, _REV, mode=mode)
    return run


for _mode in ("a", "g", "b"):
    _gapped_query(_mode)


@query("adapter_summary", oracle=f"""
with t as ({_gapped_sql('a')})
select t.sample, t.adapter, count(*) as reads, cast(sum(length(r.seq) - length(t.seq)) as bigint) as bases_removed
from t join fx_mate_reads r on r.sample = t.sample and r.read_id = t.read_id and r.mate = t.mate
where t.adapter is not null group by all""")
def q_adapter_summary(spark, sf_dir):
    r = fx.fx_mate_reads(spark, sf_dir)
    return AD.adapter_summary(r, AD.trim_adapters(r, _FWD, _REV, mode="a"))


_OVERLAP = """
p as (select *, length(seq1) as n1, length(seq2) as n2, reverse(translate(seq2, 'ACGT', 'TGCA')) as back from fx_mates),
shift as (select *, greatest(0, l - n2) as lo, least(n1, l) as hi from (select *, unnest(range(30, n1 + n2 - 29)) as l from p) x),
miss as (select sample, pair_id, l, hi - lo as overlap,
           hamming(substring(seq1, cast(lo + 1 as integer), cast(hi - lo as integer)),
                   substring(back, cast(lo - l + n2 + 1 as integer), cast(hi - lo as integer))) as m from shift),
best as (select sample, pair_id, arg_min(struct_pack(l := l, overlap := overlap, m := m), (2 * m - overlap, l)) as h from miss
         where m <= least(5, floor(overlap * 0.2)) group by sample, pair_id),
o as (select p.*, cast(h.l as integer) as insert_length, cast(h.overlap as integer) as overlap, cast(h.m as integer) as mismatches
      from p left join best b using (sample, pair_id))"""


@query("mate_overlap", oracle=f"""
with {_OVERLAP} select sample, pair_id, coalesce(insert_length, 0) as insert_length, coalesce(overlap, 0) as overlap, coalesce(mismatches, 0) as mismatches from o""")
def q_mate_overlap(spark, sf_dir):
    """The insert of every pair from the overlap of its mates (0: none)."""
    o = AD.mate_overlap(fx.fx_mates(spark, sf_dir))
    return o.select("sample", "pair_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("insert_length", "overlap", "mismatches")])


@query("trim_by_overlap", oracle=f"""
with {_OVERLAP} select sample, pair_id, coalesce(insert_length, 0) as insert_length,
  case when insert_length < n1 then substring(seq1, 1, insert_length) else seq1 end as seq1,
  case when insert_length < n1 then substring(qual1, 1, insert_length) else qual1 end as qual1,
  case when insert_length < n2 then substring(seq2, 1, insert_length) else seq2 end as seq2,
  case when insert_length < n2 then substring(qual2, 1, insert_length) else qual2 end as qual2 from o""")
def q_trim_by_overlap(spark, sf_dir):
    return AD.trim_by_overlap(fx.fx_mates(spark, sf_dir)).withColumn("insert_length", F.coalesce("insert_length", F.lit(0)))


@query("paired_adapters", oracle=f"""
with {_OVERLAP},
tails as (select sample, 1 as mate, substring(seq1, insert_length + 1) as t from o where insert_length < n1
          union all select sample, 2, substring(seq2, insert_length + 1) from o where insert_length < n2),
b as (select sample, mate, i as position, substring(t, cast(i + 1 as integer), 1) as base, count(*) as n
      from (select *, unnest(range(0, length(t))) as i from tails) x group by all),
cols as (select sample, mate, position, cast(sum(n) as bigint) as reads, arg_min(base, (-n, base)) as base, max(n) as top from b group by all),
g as (select *, bool_and(reads >= 10 and top > 0.5 * reads) over (partition by sample, mate order by position) as good from cols)
select sample, mate, coalesce(string_agg(base, '' order by position) filter (where good), '') as adapter,
  max(reads) filter (where position = 0) as reads from g group by sample, mate""")
def q_paired_adapters(spark, sf_dir):
    """The adapters that stick out past the inserts."""
    return AD.paired_adapters(fx.fx_mates(spark, sf_dir))

"""Differential-expression queries (D1-D38) over fx_counts, fx_design, fx_lengths and fx_de."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import dge as D
from strandline.plans.registry import query
from strandline.sources import fixtures as fx

SAMPLES = [f"S{i}" for i in range(6)]


def matrix(spark, sf_dir):
    return D.load_count_matrix(fx.fx_counts(spark, sf_dir), SAMPLES)


def factors(spark, sf_dir):
    return D.size_factors(matrix(spark, sf_dir), len(SAMPLES))


def normalized(spark, sf_dir):
    return D.normalized_counts(matrix(spark, sf_dir), factors(spark, sf_dir))


def results(spark, sf_dir):
    return D.adjust_p(fx.fx_de(spark, sf_dir), method="BH")


def log_normalized(spark, sf_dir):
    return normalized(spark, sf_dir).withColumn("log2_norm", F.log2(F.col("normalized") + 1))


# ------------------------------------------------------------------ oracle pieces

_MATRIX = """
g as (select distinct gene_id from fx_counts),
m as (select g.gene_id, d.label as sample, cast(coalesce(c.n, 0) as bigint) as count
      from g cross join fx_design d left join fx_counts c on c.gene_id = g.gene_id and c.sample = d.label)"""

_SF = _MATRIX + """,
lgm as (select gene_id, avg(ln(count)) as lgm from m group by gene_id having min(count) > 0 and count(*) = 6),
sf as (select m.sample, exp(quantile_cont(ln(m.count) - lgm.lgm, 0.5)) as size_factor
       from m join lgm on lgm.gene_id = m.gene_id group by m.sample),
nm as (select m.sample, m.gene_id, m.count, m.count / sf.size_factor as normalized,
         avg(m.count / sf.size_factor) over (partition by m.gene_id) as base_mean
       from m join sf on sf.sample = m.sample)"""

_RES = """
ranked as (select *, count(*) over (partition by contrast) as m,
             count(*) over (partition by contrast order by pvalue range between unbounded preceding and current row) as rk
           from fx_de),
res as (select contrast, gene_id, base_mean, log2fc, pvalue,
          least(1.0, min(m * pvalue / rk) over (partition by contrast order by pvalue
                range between current row and unbounded following)) as padj from ranked),
ex as (select *, case when padj <= 0.05 and log2fc > 0 then 'up' when padj <= 0.05 and log2fc < 0 then 'down'
                      else 'none' end as direction from res)"""


@query("load_count_matrix", oracle=f"with {_MATRIX} select * from m")
def q_load_count_matrix(spark, sf_dir):
    return matrix(spark, sf_dir)


@query("check_sample_order", oracle="""
select cast(cast(substring(label, 2) as integer) as integer) as position, label as count_sample,
  label as target_sample, true as ok from fx_design""")
def q_check_sample_order(spark, sf_dir):
    return D.check_sample_order(matrix(spark, sf_dir), fx.fx_design(spark, sf_dir), SAMPLES)


@query("check_ids", oracle="""
select gene_id, 'info' as missing_from from (select distinct gene_id from fx_counts) c
  where gene_id not in (select gene_id from fx_lengths)
union all
select gene_id, 'counts' from (select distinct gene_id from fx_lengths) l
  where gene_id not in (select gene_id from fx_counts)""")
def q_check_ids(spark, sf_dir):
    return D.check_ids(matrix(spark, sf_dir), fx.fx_lengths(spark, sf_dir))


@query("library_sizes", oracle=f"with {_MATRIX} select sample, cast(sum(count) as bigint) as library_size from m group by sample")
def q_library_sizes(spark, sf_dir):
    return D.library_sizes(matrix(spark, sf_dir))


@query("null_features", oracle=f"""
with {_MATRIX}
select sample, count(*) filter (where count = 0) as null_features from m group by sample
union all
select null, count(*) filter (where mx = 0) from (select gene_id, max(count) as mx from m group by gene_id) z""")
def q_null_features(spark, sf_dir):
    return D.null_features(matrix(spark, sf_dir))


@query("count_density", oracle=f"""
with {_MATRIX}
select sample, cast(floor(log2(count + 1) / 0.5) as integer) as bin, count(*) as features,
  cast(cast(floor(log2(count + 1) / 0.5) as integer) * 0.5 as double) as bin_start from m group by all""")
def q_count_density(spark, sf_dir):
    return D.count_density(matrix(spark, sf_dir))


@query("majority_sequences", oracle=f"""
with {_MATRIX}
select sample, first(gene_id order by count desc, gene_id) as gene_id, max(count) as count,
  round(max(count) * 100.0 / sum(count), 6) as percentage from m group by sample""")
def q_majority_sequences(spark, sf_dir):
    return D.majority_sequences(matrix(spark, sf_dir))


@query("pairwise_sere", oracle=f"""
with {_MATRIX},
lib as (select sample, sum(count) as l from m group by sample),
pairs as (select a.sample as sample_a, b.sample as sample_b, cast(a.count as double) as oa, cast(b.count as double) as ob,
            cast(la.l as double) as la, cast(lb.l as double) as lb
          from m a join m b on a.gene_id = b.gene_id and a.sample < b.sample
          join lib la on la.sample = a.sample join lib lb on lb.sample = b.sample)
select sample_a, sample_b,
  round(sqrt(sum(case when oa + ob > 0 then (oa - la * (oa + ob) / (la + lb)) ** 2 / (la * (oa + ob) / (la + lb))
                                        + (ob - lb * (oa + ob) / (la + lb)) ** 2 / (lb * (oa + ob) / (la + lb)) end)
             / sum(case when oa + ob > 0 then 1 else 0 end)), 6) as sere
from pairs group by sample_a, sample_b""")
def q_pairwise_sere(spark, sf_dir):
    return D.pairwise_sere(matrix(spark, sf_dir), SAMPLES)


@query("pairwise_points", oracle=f"""
with {_MATRIX}
select a.sample as sample_a, b.sample as sample_b, cast(floor(log2(a.count + 1) / 0.5) as integer) as bin_a,
  cast(floor(log2(b.count + 1) / 0.5) as integer) as bin_b, count(*) as genes
from m a join m b on a.gene_id = b.gene_id and a.sample < b.sample group by all""")
def q_pairwise_points(spark, sf_dir):
    return D.pairwise_points(matrix(spark, sf_dir), SAMPLES)


@query("design_matrix", oracle="""
select label, 'Intercept' as coefficient, 1.0::double as value from fx_design
union all select label, 'batchb2', case when batch = 'b2' then 1.0 else 0.0 end::double from fx_design
union all select label, 'condKO', case when cond = 'KO' then 1.0 else 0.0 end::double from fx_design
union all select label, 'batchb2:condKO', case when batch = 'b2' and cond = 'KO' then 1.0 else 0.0 end::double from fx_design""")
def q_design_matrix(spark, sf_dir):
    """~ batch + cond + batch:cond with WT as the reference condition (the GLM script's layout)."""
    return D.design_matrix(fx.fx_design(spark, sf_dir), factors=["batch", "cond"],
                           reference={"batch": "b1", "cond": "WT"}, interaction=True)


@query("overall_sere", oracle=f"""
with {_MATRIX},
l as (select sample, sum(count)::double as lib from m group by sample), a as (select sum(count)::double as total from m),
t as (select gene_id, sum(count)::double as g from m group by gene_id having sum(count) > 0),
chi as (select m.gene_id, sum((m.count - t.g * l.lib / a.total) ** 2 / (t.g * l.lib / a.total)) as chi
        from m join l on l.sample = m.sample join t on t.gene_id = m.gene_id cross join a group by m.gene_id)
select count(*) as genes, round(sqrt(sum(chi) / (count(*) * 5)), 6) as sere from chi""")
def q_overall_sere(spark, sf_dir):
    return D.overall_sere(matrix(spark, sf_dir), SAMPLES)


_RATIOS = _MATRIX + """,
gm as (select gene_id, avg(ln(count)) as lgm from m group by gene_id having min(count) > 0),
lr as (select m.sample, m.gene_id, ln(m.count) - gm.lgm as r from m join gm on gm.gene_id = m.gene_id)"""


@query("size_factors_shorth", oracle=f"""
with {_RATIOS},
o as (select sample, r, row_number() over (partition by sample order by r, gene_id) as i,
        greatest(1, round(count(*) over (partition by sample) / 2)) as h from lr),
w as (select o.sample, o.i, o.h, e.r - o.r as width from o join o e on e.sample = o.sample and e.i = o.i + o.h),
s as (select sample, arg_min(i, (width, i)) as i, min(h) as h from w group by sample)
select o.sample, round(exp(avg(o.r)), 4) as size_factor
from o join s on s.sample = o.sample and o.i >= s.i and o.i < s.i + s.h group by o.sample""")
def q_size_factors_shorth(spark, sf_dir):
    """D11 with the shorth; four digits, since sums of logarithms differ in the last places."""
    return D.size_factors(matrix(spark, sf_dir), len(SAMPLES), location="shorth").select(
        "sample", F.round("size_factor", 4).alias("size_factor"))


@query("ratio_histogram", oracle=f"""
with {_RATIOS}
select sample, cast(floor((r / ln(2.0) + 0.0001) / 0.25) as integer) as bin, count(*) as genes from lr group by all""")
def q_ratio_histogram(spark, sf_dir):
    """D12; the bins are shifted by 0.0001 so that rounding does not move ratios off their edges."""
    return D.ratio_histogram(matrix(spark, sf_dir), len(SAMPLES), shift=0.0001)


@query("size_factors", oracle=f"with {_SF} select sample, round(size_factor, 6) as size_factor from sf")
def q_size_factors(spark, sf_dir):
    return factors(spark, sf_dir).select("sample", F.round("size_factor", 6).alias("size_factor"))


@query("size_factor_diag", oracle=f"""
with {_SF}
select sf.sample, round(size_factor, 6) as size_factor, cast(sum(m.count) as bigint) as library_size,
  round(sum(m.count) / size_factor, 6) as library_per_factor
from sf join m on m.sample = sf.sample group by sf.sample, sf.size_factor""")
def q_size_factor_diag(spark, sf_dir):
    return D.size_factor_diag(matrix(spark, sf_dir), factors(spark, sf_dir))


@query("normalized_counts", oracle=f"""
with {_SF}
select sample, gene_id, count, round(normalized, 6) as normalized, round(base_mean, 6) as base_mean from nm""")
def q_normalized_counts(spark, sf_dir):
    n = normalized(spark, sf_dir)
    return n.select("sample", "gene_id", "count", F.round("normalized", 6).alias("normalized"),
                    F.round("base_mean", 6).alias("base_mean"))


@query("box_stats", oracle=f"""
with {_MATRIX}
select sample, round(quantile_cont(log2(count + 1), 0.0), 6) as min, round(quantile_cont(log2(count + 1), 0.25), 6) as q1,
  round(quantile_cont(log2(count + 1), 0.5), 6) as median, round(quantile_cont(log2(count + 1), 0.75), 6) as q3,
  round(quantile_cont(log2(count + 1), 1.0), 6) as max from m group by sample""")
def q_box_stats(spark, sf_dir):
    return D.box_stats(matrix(spark, sf_dir), "count")


@query("sample_distances", oracle=f"""
with {_SF}
select a.sample as sample_a, b.sample as sample_b,
  round(sqrt(sum((log2(a.normalized + 1) - log2(b.normalized + 1)) ** 2)), 6) as distance
from nm a join nm b on a.gene_id = b.gene_id and a.sample < b.sample group by all""")
def q_sample_distances(spark, sf_dir):
    return D.sample_distances(log_normalized(spark, sf_dir), SAMPLES, "log2_norm")


@query("adjust_p", oracle=f"with {_RES} select * from res")
def q_adjust_p(spark, sf_dir):
    return results(spark, sf_dir)


@query("adjust_p_by", oracle="""
with ranked as (select *, count(*) over (partition by contrast) as m,
             count(*) over (partition by contrast order by pvalue range between unbounded preceding and current row) as rk
           from fx_de),
h as (select contrast, sum(1.0 / i) as cm from (select distinct contrast, m from ranked) r, unnest(range(1, m + 1)) u(i)
      group by contrast)
select r.contrast, r.gene_id, r.base_mean, r.log2fc, r.pvalue,
  round(least(1.0, h.cm * min(m * pvalue / rk) over (partition by r.contrast order by pvalue
        range between current row and unbounded following)), 9) as padj
from ranked r join h on h.contrast = r.contrast""")
def q_adjust_p_by(spark, sf_dir):
    """D25, Benjamini-Yekutieli variant."""
    r = D.adjust_p(fx.fx_de(spark, sf_dir), method="BY")
    return r.withColumn("padj", F.round("padj", 9))


@query("export_tables", oracle=f"with {_RES} select * from ex")
def q_export_tables(spark, sf_dir):
    return D.export_tables(results(spark, sf_dir))


@query("n_diff_total", oracle=f"""
with {_RES}
select contrast, count(*) filter (where direction = 'up') as up, count(*) filter (where direction = 'down') as down,
  count(*) filter (where direction <> 'none') as total from ex group by contrast""")
def q_n_diff_total(spark, sf_dir):
    return D.n_diff_total(D.export_tables(results(spark, sf_dir)))


_THRESH = " union all ".join(f"select cast({t} as double) as threshold" for t in D.FDR_THRESHOLDS)


@query("n_diff_by_threshold", oracle=f"""
with {_RES}, t as ({_THRESH})
select c.contrast, t.threshold, cast((select count(*) from res r where r.contrast = c.contrast and r.padj <= t.threshold) as bigint) as genes
from (select distinct contrast from res) c cross join t""")
def q_n_diff_by_threshold(spark, sf_dir):
    return D.n_diff_by_threshold(results(spark, sf_dir))


@query("length_normalized", oracle=f"""
with {_SF}
select nm.sample, nm.gene_id, round(nm.normalized * 1000.0 / l.length, 6) as per_kb
from nm join fx_lengths l on l.gene_id = nm.gene_id""")
def q_length_normalized(spark, sf_dir):
    return D.length_normalized(normalized(spark, sf_dir), fx.fx_lengths(spark, sf_dir))


@query("gene_length_effect", oracle=f"""
with {_RES}
select contrast, cast(floor(log2(l.length)) as integer) as log2_length_bin, count(*) as genes,
  count(*) filter (where padj <= 0.05) as de_genes, round(avg(log2(base_mean + 1)), 6) as mean_log2_base_mean
from res join fx_lengths l on l.gene_id = res.gene_id group by all""")
def q_gene_length_effect(spark, sf_dir):
    return D.gene_length_effect(results(spark, sf_dir), fx.fx_lengths(spark, sf_dir))


@query("logfc_distribution", oracle="""
select contrast, cast(floor(log2fc / 0.5) as integer) as bin, count(*) as genes,
  cast(cast(floor(log2fc / 0.5) as integer) * 0.5 as double) as bin_start from fx_de group by all""")
def q_logfc_distribution(spark, sf_dir):
    return D.logfc_distribution(fx.fx_de(spark, sf_dir))


@query("pvalue_histogram", oracle="""
select contrast, cast(least(floor(pvalue * 20), 19) as integer) as bin, count(*) as genes
from fx_de where pvalue is not null group by all""")
def q_pvalue_histogram(spark, sf_dir):
    return D.pvalue_histogram(fx.fx_de(spark, sf_dir))


@query("ma_points", oracle=f"""
with {_RES}
select contrast, gene_id, round(log10(base_mean + 1), 6) as log10_base_mean, log2fc,
  coalesce(padj <= 0.05, false) as significant from res""")
def q_ma_points(spark, sf_dir):
    return D.ma_points(results(spark, sf_dir))


@query("volcano_points", oracle=f"""
with {_RES}
select contrast, gene_id, log2fc, round(-log10(padj), 6) as neg_log10_padj, coalesce(padj <= 0.05, false) as significant
from res""")
def q_volcano_points(spark, sf_dir):
    return D.volcano_points(results(spark, sf_dir))


@query("venn_counts", oracle=f"""
with {_RES}
select contrasts, count(*) as genes from (
  select gene_id, array_to_string(list_sort(list_distinct(list(contrast))), '&') as contrasts
  from ex where direction <> 'none' group by gene_id) s group by contrasts""")
def q_venn_counts(spark, sf_dir):
    return D.venn_counts(D.export_tables(results(spark, sf_dir)))


@query("heatmap_matrix", oracle=f"""
with {_SF}, {_RES},
x as (select gene_id, sample, log2(normalized + 1) as v from nm
      where gene_id in (select gene_id from ex where direction <> 'none'))
select gene_id, sample, round(v - avg(v) over (partition by gene_id), 6) as centred from x""")
def q_heatmap_matrix(spark, sf_dir):
    de = D.export_tables(results(spark, sf_dir)).where(F.col("direction") != "none")
    return D.heatmap_matrix(log_normalized(spark, sf_dir), de, "log2_norm")


@query("expression_profile", oracle=f"""
with {_SF}, {_RES}
select nm.gene_id, nm.sample, d.cond, round(log2(nm.normalized + 1), 6) as log2_normalized
from nm join fx_design d on d.label = nm.sample
where nm.gene_id in (select gene_id from ex where direction = 'up' and contrast = 'click')""")
def q_expression_profile(spark, sf_dir):
    """Profiles of the genes found up in the 'click' comparison."""
    chosen = D.export_tables(results(spark, sf_dir)).where((F.col("direction") == "up") & (F.col("contrast") == "click"))
    return D.expression_profile(normalized(spark, sf_dir), fx.fx_design(spark, sf_dir), chosen)


@query("slim_results", oracle=f"with {_RES} select contrast, gene_id, base_mean, log2fc, padj from res")
def q_slim_results(spark, sf_dir):
    return D.slim_results(results(spark, sf_dir))


@query("guess_design", oracle="""
select distinct sample as label, regexp_replace(sample, '[_.-]?(rep)?[0-9]+$', '') as condition from fx_counts""")
def q_guess_design(spark, sf_dir):
    return D.guess_design(fx.fx_counts(spark, sf_dir).select("sample").distinct())


@query("target_table", oracle="""
select distinct sample as label, concat(sample, '_feature.out') as files, sample as condition, 'X' as replicat
from fx_counts""")
def q_target_table(spark, sf_dir):
    files = fx.fx_counts(spark, sf_dir).select(F.concat(F.col("sample"), F.lit("_feature.out")).alias("file")).distinct()
    return D.target_table(files)

"""Per-gene model queries (D14, D15, D17, D19, D20, D23, D24).  Iterative fits: no SQL oracle; they
are checked against planted truth in tests/test_model.py and by row counts here."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import dge as D
from strandline.operators import model as MD
from strandline.plans.q_dge import SAMPLES, factors, matrix, normalized
from strandline.plans.registry import query
from strandline.sources import fixtures as fx

COEFFICIENTS = ["Intercept", "condKO"]


def design_long(spark, sf_dir):
    return D.design_matrix(fx.fx_design(spark, sf_dir), factors=["cond"], reference={"cond": "WT"},
                           levels={"cond": ["KO", "WT"]})


def disp(spark, sf_dir, fit="parametric"):
    return MD.dispersions(matrix(spark, sf_dir), factors(spark, sf_dir), design_long(spark, sf_dir), SAMPLES,
                          COEFFICIENTS, fit=fit)


def wald(spark, sf_dir, d=None):
    d = d if d is not None else disp(spark, sf_dir)
    return MD.wald_test(matrix(spark, sf_dir), factors(spark, sf_dir), design_long(spark, sf_dir), d, SAMPLES,
                        COEFFICIENTS, coefficient="condKO", contrast="KO_vs_WT")


@query("dispersions")
def q_dispersions(spark, sf_dir):
    return disp(spark, sf_dir)


@query("dispersion_diag")
def q_dispersion_diag(spark, sf_dir):
    """Trend points and the histogram of log residuals (gene-wise over trend)."""
    d = disp(spark, sf_dir)
    r = F.log(F.col("disp_gene_wise")) - F.log(F.col("disp_trend"))
    return d.groupBy(F.floor(r / 0.5).cast("int").alias("log_residual_bin")).agg(F.count(F.lit(1)).alias("genes"))


@query("dispersion_trend")
def q_dispersion_trend(spark, sf_dir):
    """The points of the trend plot: gene-wise, fitted and final dispersion against the mean."""
    return disp(spark, sf_dir).select("gene_id", "base_mean", "disp_gene_wise", "disp_trend", "dispersion", "disp_outlier",
                                      "trend_kind")


@query("filter_table")
def q_filter_table(spark, sf_dir):
    res = MD.cooks_outliers(wald(spark, sf_dir), len(SAMPLES), len(COEFFICIENTS)).checkpoint()
    return MD.filter_table(res, alpha=0.1)


@query("filter_curve")
def q_filter_curve(spark, sf_dir):
    """The filter table with its smoothed curve and the chosen threshold."""
    return MD.filter_curve(q_filter_table(spark, sf_dir))


@query("dispersions_local")
def q_dispersions_local(spark, sf_dir):
    """D14 with a local trend."""
    return disp(spark, sf_dir, "local")


@query("transform_counts_local")
def q_transform_counts_local(spark, sf_dir):
    """VST by integration over the local trend."""
    return MD.transform_counts(normalized(spark, sf_dir), disp(spark, sf_dir, "local").checkpoint())


@query("rlog")
def q_rlog(spark, sf_dir):
    """Regularised log."""
    return MD.rlog(matrix(spark, sf_dir), factors(spark, sf_dir), disp(spark, sf_dir).checkpoint(), SAMPLES)


@query("rlog_pca")
def q_rlog_pca(spark, sf_dir):
    """D19 over the regularised log."""
    return MD.sample_pca(q_rlog(spark, sf_dir), SAMPLES, "rlog")


@query("wald_test")
def q_wald_test(spark, sf_dir):
    return wald(spark, sf_dir)


@query("cooks_outliers")
def q_cooks_outliers(spark, sf_dir):
    return MD.cooks_outliers(wald(spark, sf_dir), len(SAMPLES), len(COEFFICIENTS))


@query("independent_filtering")
def q_independent_filtering(spark, sf_dir):
    res = MD.cooks_outliers(wald(spark, sf_dir), len(SAMPLES), len(COEFFICIENTS))
    return MD.independent_filtering(res, alpha=0.1)


@query("transform_counts")
def q_transform_counts(spark, sf_dir):
    return MD.transform_counts(normalized(spark, sf_dir), disp(spark, sf_dir))


@query("sample_pca")
def q_sample_pca(spark, sf_dir):
    return MD.sample_pca(MD.transform_counts(normalized(spark, sf_dir), disp(spark, sf_dir)), SAMPLES, "vst")


@query("all_pairs_contrasts")
def q_all_pairs_contrasts(spark, sf_dir):
    """Three groups of two samples, every pair of groups from one model."""
    design = fx.fx_design(spark, sf_dir).select("label", F.concat(F.lit("g"), F.floor(
        F.substring("label", 2, 9).cast("int") / 2).cast("string")).alias("grp"))
    coefficients = ["Intercept", "grpg1", "grpg2"]
    dl = D.design_matrix(design, factors=["grp"], reference={"grp": "g0"}, levels={"grp": ["g0", "g1", "g2"]})
    counts, sf = matrix(spark, sf_dir), factors(spark, sf_dir)
    d = MD.dispersions(counts, sf, dl, SAMPLES, coefficients)
    return MD.all_pairs_contrasts(counts, sf, design, d, SAMPLES, factor="grp", reference="g0")


GLM_COEFFICIENTS = ["Intercept", "batchb2", "condKO", "batchb2:condKO"]


@query("numeric_contrasts")
def q_numeric_contrasts(spark, sf_dir):
    """GLM ~ batch + cond + batch:cond; the KO effect within batch b2 (condKO + batchb2:condKO)."""
    dl = D.design_matrix(fx.fx_design(spark, sf_dir), factors=["batch", "cond"], reference={"batch": "b1", "cond": "WT"},
                         levels={"batch": ["b1", "b2"], "cond": ["KO", "WT"]}, interaction=True)
    counts, sf = matrix(spark, sf_dir), factors(spark, sf_dir)
    d = MD.dispersions(counts, sf, dl, SAMPLES, GLM_COEFFICIENTS)
    return MD.numeric_contrast(counts, sf, dl, d, SAMPLES, GLM_COEFFICIENTS, contrast=[0, 0, 1, 1],
                               name="KO_vs_WT_in_b2")

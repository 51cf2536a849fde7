"""Per-gene negative-binomial model (D14, D17, D19-D24) on Spark.

Genes are independent, so each step is a ``mapInPandas`` over Arrow batches of
gene rows (one row = one gene's count vector), hash-partitioned by gene; the
numpy kernels fit a whole batch at once.  Only per-sample scalars (size
factors, the design matrix: samples x coefficients), model-wide scalars (the
trend coefficients, prior variances, one F quantile) and grids of fixed size (the
cells of the local trend, the bins of the log ratios, the filter thresholds) pass
through the driver; nothing that grows with genes or reads does.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import nbglm as K
from strandline.functions.smoothing import local_quadratic, lowess
from strandline.operators.dge import adjust_p, contrasts, design_matrix, gene_vectors
from strandline.session import ensure_checkpoint_dir

TREND_MIN_DISP = 100 * K.MIN_DISP
COOKS_QUANTILE = 0.99
FILTER_STEPS = 50  # thresholds of the filter table
FILTER_TOP = 0.95
TREND_CELLS = 4096  # cells of the mean axis from which the local trend is fitted
RATIO_BINS = 1024  # bins per log2 unit of the log ratios that set the prior of rlog


def _design(design_long: DataFrame, samples: list[str], coefficients: list[str]) -> np.ndarray:
    rows = {(r["label"], r["coefficient"]): r["value"] for r in design_long.collect()}  # samples x coefficients
    return np.array([[rows.get((s, c), 0.0) for c in coefficients] for s in samples], dtype=float)


def _size_factors(factors: DataFrame, samples: list[str]) -> np.ndarray:
    sf = {r["sample"]: r["size_factor"] for r in factors.collect()}  # one value per sample
    return np.array([sf[s] for s in samples], dtype=float)


def _batches(it):
    for pdf in it:
        if len(pdf):
            yield pdf, np.stack(pdf["v"].to_numpy()).astype(float)


def dispersions(counts: DataFrame, factors: DataFrame, design_long: DataFrame, samples: list[str],
                coefficients: list[str], *, fit: str = "parametric") -> DataFrame:
    """Gene-wise (Cox-Reid) dispersions, a fitted trend (``parametric`` a1/mu + a0 via a gamma
    GLM with identity link, ``local`` regression, or ``mean``), the prior variance, and MAP shrinkage; genes more than
    two prior standard deviations above the trend keep their gene-wise value (outliers).  ``trend_a0`` and
    ``trend_a1`` are null for a local trend."""
    from pyspark.errors import IllegalArgumentException
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    if fit not in ("parametric", "local", "mean"):
        raise ValueError(f"fit must be 'parametric', 'local' or 'mean', not {fit!r}")
    X = _design(design_long, samples, coefficients)
    s = _size_factors(factors, samples)
    vec = gene_vectors(counts, samples).where(F.aggregate("v", F.lit(0.0), lambda a, x: a + x) > 0)

    def gene_wise(it):
        for pdf, Y in _batches(it):
            disp, mu = K.gene_wise_dispersion(Y, s, X)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "v": pdf["v"], "base_mean": (Y / s).mean(axis=1),
                                "disp_gene_wise": disp, "mu": list(mu)})

    gw = vec.mapInPandas(gene_wise, "gene_id string, v array<double>, base_mean double, disp_gene_wise double, "
                                     "mu array<double>")
    ensure_checkpoint_dir(gw.sparkSession)
    gw = gw.checkpoint()  # cut lineage: the trend fit below runs several jobs over it

    a0, a1 = None, None
    if fit == "parametric":
        use = gw.where(F.col("disp_gene_wise") > TREND_MIN_DISP).select(
            (1.0 / F.col("base_mean")).alias("inv_mean"), F.col("disp_gene_wise").alias("label"))
        use = use.persist()  # two numbers per gene: every step of every fit reads them, not the counts
        coefs = (0.1, 1.0)
        for _ in range(10):
            data = use.where((F.col("label") / (coefs[0] + coefs[1] * F.col("inv_mean")) > 1e-4)
                             & (F.col("label") / (coefs[0] + coefs[1] * F.col("inv_mean")) < 15))
            data = VectorAssembler(inputCols=["inv_mean"], outputCol="features").transform(data)
            try:
                m = GeneralizedLinearRegression(family="gamma", link="identity", maxIter=50).fit(data)
            except IllegalArgumentException:  # the fit left the family's range: fall back to the mean trend
                break
            new = (float(m.intercept), float(m.coefficients[0]))
            if new[0] <= 0 or new[1] < 0:
                break
            done = max(abs(math.log(new[i] / coefs[i])) if coefs[i] > 0 else 1 for i in range(2)) < 1e-6
            coefs = new
            a0, a1 = coefs
            if done:
                break
        use.unpersist()
    curve = local_trend(gw) if fit == "local" else None
    trend_kind = "local" if curve else "mean" if a0 is None else "parametric"
    if a0 is None and curve is None:
        mean_disp = gw.where(F.col("disp_gene_wise") > TREND_MIN_DISP).agg(F.avg("disp_gene_wise")).first()[0]
        a0, a1 = float(mean_disp or 0.1), 0.0
    trend = F.exp(_on_curve(*curve)(F.log("base_mean"))) if curve else F.lit(a0) + F.lit(a1) / F.col("base_mean")
    gw = gw.withColumn("disp_trend", trend)

    m_samples, p = X.shape
    resid = gw.where(F.col("disp_gene_wise") > TREND_MIN_DISP).select(
        (F.log("disp_gene_wise") - F.log("disp_trend")).alias("r"))
    med = resid.agg(F.percentile("r", 0.5)).first()[0] or 0.0
    mad = resid.agg(F.percentile(F.abs(F.col("r") - F.lit(med)), 0.5)).first()[0] or 0.0
    var_log = (1.4826 * mad) ** 2
    df_resid = max(m_samples - p, 1)
    prior_var = max(var_log - float(K.trigamma(np.array([df_resid / 2.0]))[0]), 0.25)

    def shrink(it):
        for pdf in it:
            if not len(pdf):
                continue
            Y = np.stack(pdf["v"].to_numpy()).astype(float)
            mu = np.stack(pdf["mu"].to_numpy()).astype(float)
            log_trend = np.log(pdf["disp_trend"].to_numpy())
            disp_map = K.map_dispersion(Y, mu, X, log_trend, prior_var)
            outlier = np.log(pdf["disp_gene_wise"].to_numpy()) > log_trend + 2 * math.sqrt(prior_var)
            final = np.where(outlier, pdf["disp_gene_wise"].to_numpy(), disp_map)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "base_mean": pdf["base_mean"],
                                "disp_gene_wise": pdf["disp_gene_wise"], "disp_trend": pdf["disp_trend"],
                                "disp_map": disp_map, "dispersion": final, "disp_outlier": outlier})

    out = gw.mapInPandas(shrink, "gene_id string, base_mean double, disp_gene_wise double, disp_trend double, "
                                 "disp_map double, dispersion double, disp_outlier boolean")
    return out.withColumn("trend_a0", F.lit(a0).cast("double")).withColumn("trend_a1", F.lit(a1).cast("double")) \
              .withColumn("prior_var", F.lit(prior_var)).withColumn("trend_kind", F.lit(trend_kind))


def local_trend(gene_wise: DataFrame, *, cells: int = TREND_CELLS) -> tuple[list[float], list[float]] | None:
    """D14 ``local``: log dispersion over log mean by weighted local quadratic regression (weights: the means; the
    nearest 70 % of the genes).  The genes are summed into ``cells`` cells of equal width with their moments, which
    is all that the driver sees; returns the occupied cells' log means and fitted log dispersions, None without genes."""
    use = gene_wise.where(F.col("disp_gene_wise") > TREND_MIN_DISP).select(
        F.log("base_mean").alias("x"), F.log("disp_gene_wise").alias("y"), F.col("base_mean").alias("w"))
    lo, hi = use.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return None
    width = (hi - lo) / cells or 1.0
    cell = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(cells - 1))
    d = F.col("x") - (F.lit(lo) + (F.col("c") + 0.5) * F.lit(width))
    sums = use.withColumn("c", cell).withColumn("d", d).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("w") * F.pow("d", F.lit(k))).alias(f"x{k}") for k in range(5)],
        *[F.sum(F.col("w") * F.col("y") * F.pow("d", F.lit(k))).alias(f"y{k}") for k in range(3)]).toPandas().sort_values("c")
    centre = lo + (sums["c"].to_numpy(float) + 0.5) * width
    moments = sums[[f"x{k}" for k in range(5)]].to_numpy(float)
    at = centre + moments[:, 1] / moments[:, 0]
    fitted = local_quadratic(at, centre, sums["n"].to_numpy(float), moments, sums[[f"y{k}" for k in range(3)]].to_numpy(float))
    return at.tolist(), fitted.tolist()


def _on_curve(x: list[float], y: list[float]):
    """Linear interpolation in a curve of fixed size; its ends hold outside."""
    @F.pandas_udf("double")
    def value(at: pd.Series) -> pd.Series:
        return pd.Series(np.interp(at.to_numpy(), x, y))
    return value


def wald_test(counts: DataFrame, factors: DataFrame, design_long: DataFrame, disp: DataFrame, samples: list[str],
              coefficients: list[str], *, coefficient: str, contrast: str | None = None) -> DataFrame:
    """D20 + D23 inputs: NB GLM per gene, Wald statistic of one coefficient, two-sided normal p-value,
    and each gene's largest Cook's distance."""
    X = _design(design_long, samples, coefficients)
    s = _size_factors(factors, samples)
    k = coefficients.index(coefficient)
    vec = gene_vectors(counts, samples).join(disp.select("gene_id", "base_mean", "dispersion"), "gene_id")

    def fit(it):
        for pdf, Y in _batches(it):
            alpha = pdf["dispersion"].to_numpy()
            beta, se, stat, pval, mu, cov = K.wald(Y, s, X, alpha)
            cooks = K.cooks_distance(Y, mu, X, alpha, cov).max(axis=1)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "base_mean": pdf["base_mean"],
                                "log2fc": beta[:, k] / math.log(2), "lfc_se": se[:, k] / math.log(2),
                                "stat": stat[:, k], "pvalue": pval[:, k], "max_cooks": cooks})

    out = vec.mapInPandas(fit, "gene_id string, base_mean double, log2fc double, lfc_se double, stat double, "
                               "pvalue double, max_cooks double")
    return out.withColumn("contrast", F.lit(contrast or coefficient))


def cooks_outliers(results: DataFrame, n_samples: int, n_coefficients: int, *, cutoff: float | None = None) -> DataFrame:
    """P-value set to null where the largest Cook's distance exceeds the cutoff
    (default: the 0.99 quantile of F(p, m - p); ``math.inf`` switches the check off)."""
    if cutoff is None:
        cutoff = K.f_quantile(COOKS_QUANTILE, n_coefficients, n_samples - n_coefficients)
    out = results.withColumn("outlier", F.col("max_cooks") > F.lit(cutoff))
    return out.withColumn("pvalue", F.when(F.col("outlier"), F.lit(None).cast("double")).otherwise(F.col("pvalue")))


def filter_thetas(results: DataFrame, *, steps: int = FILTER_STEPS, top: float = FILTER_TOP) -> list[float]:
    """Evenly spaced quantiles from the share of genes with mean zero up to ``top`` (or 1 if that is more)."""
    zero = results.agg(F.avg((F.col("base_mean") == 0).cast("double"))).first()[0] or 0.0
    return np.linspace(zero, top if zero < top else 1.0, steps).tolist()


def filter_table(results: DataFrame, *, alpha: float = 0.1, thetas: list[float] | None = None) -> DataFrame:
    """(contrast, theta, cutoff, rejections): BH rejections at ``alpha`` among the genes whose baseMean reaches
    the theta quantile."""
    thetas = filter_thetas(results) if thetas is None else thetas
    cut = results.groupBy("contrast").agg(F.percentile("base_mean", F.array(*[F.lit(t) for t in thetas])).alias("_q"))
    grid = cut.select("contrast", F.posexplode("_q").alias("_t", "_cutoff"))
    x = results.where(F.col("pvalue").isNotNull()).join(F.broadcast(grid), "contrast") \
        .where(F.col("base_mean") >= F.col("_cutoff"))
    x = x.withColumn("_grp", F.concat_ws("#", F.col("contrast"), F.col("_t").cast("string")))
    adj = adjust_p(x.select("_grp", "gene_id", "pvalue"), group="_grp")
    rej = adj.groupBy("_grp").agg(F.count_if(F.col("padj") <= alpha).alias("_rej"))
    names = grid.withColumn("_grp", F.concat_ws("#", F.col("contrast"), F.col("_t").cast("string")))
    theta = F.array(*[F.lit(float(t)) for t in thetas])[F.col("_t")]
    return names.join(rej, "_grp", "left").select(  # one row per contrast and theta
        "contrast", theta.alias("theta"), F.col("_cutoff").alias("cutoff"), F.coalesce("_rej", F.lit(0)).alias("rejections"))


def chosen_theta(theta: np.ndarray, rejections: np.ndarray) -> tuple[int, np.ndarray]:
    """Index of the filter threshold, and the smoothed rejection curve.

    The first theta whose rejections come within one residual standard deviation of the curve's maximum; the first of
    all when no more than ten genes are ever rejected or none comes that close."""
    n = np.asarray(rejections, float)
    fitted = lowess(theta, n)
    some = n > 0
    spread = math.sqrt(np.mean((n[some] - fitted[some]) ** 2)) if some.any() else 0.0
    above = np.flatnonzero(n > fitted.max() - spread) if n.max() > 10 else np.empty(0, int)
    return (int(above[0]) if len(above) else 0), fitted


def filter_curve(table: DataFrame) -> DataFrame:
    """The filter table with the smoothed curve and the chosen row of each contrast (a group is its thetas)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("theta", kind="stable", ignore_index=True)
        at, fitted = chosen_theta(pdf["theta"].to_numpy(), pdf["rejections"].to_numpy())
        return pdf.assign(smoothed=fitted, chosen=np.arange(len(pdf)) == at)

    return table.groupBy("contrast").applyInPandas(
        run, "contrast string, theta double, cutoff double, rejections long, smoothed double, chosen boolean")


def independent_filtering(results: DataFrame, *, alpha: float = 0.1, thetas: list[float] | None = None) -> DataFrame:
    """Choose the baseMean cutoff from the smoothed curve of BH rejections at ``alpha`` (``filter_curve``); genes below
    it get padj = null.  Returns the results with ``padj`` and ``filter_threshold``."""
    ensure_checkpoint_dir(results.sparkSession)
    results = results.checkpoint()  # the fit behind it is read several times below
    best = filter_curve(filter_table(results, alpha=alpha, thetas=thetas)).where("chosen") \
        .select("contrast", F.col("cutoff").alias("filter_threshold"))
    kept = results.join(F.broadcast(best), "contrast")  # one row per contrast
    passing = kept.where((F.col("base_mean") >= F.col("filter_threshold")))
    padj = adjust_p(passing.select("contrast", "gene_id", "pvalue"), group="contrast").select("contrast", "gene_id", "padj")
    return kept.join(padj, ["contrast", "gene_id"], "left")


def transform_counts(normalized: DataFrame, disp: DataFrame) -> DataFrame:
    """D17 (VST): the variance-stabilising transform, closed for the parametric trend a0 + a1/mu.

    For a local trend it is the integral of 1 / sqrt(variance) over the means, summed on a fixed grid and scaled to
    agree with log2 between two high quantiles of the genes' means."""
    if disp.select("trend_kind").first()[0] == "local":
        return _integrated_vst(normalized, disp)
    a = disp.select(F.col("trend_a0").alias("_a0"), F.col("trend_a1").alias("_a1")).limit(1).withColumn("_one", F.lit(1))
    q = F.col("normalized")
    vst = F.log2((1 + F.col("_a1") + 2 * F.col("_a0") * q
                  + 2 * F.sqrt(F.col("_a0") * q * (1 + F.col("_a1") + F.col("_a0") * q))) / (4 * F.col("_a0")))
    # the one-row trend is attached by a broadcast equi-join on a constant key
    return normalized.withColumn("_one", F.lit(1)).join(F.broadcast(a), "_one").select("sample", "gene_id",
                                                                                       vst.alias("vst"))


def _integrated_vst(normalized: DataFrame, disp: DataFrame, *, steps: int = 1000, cells: int = TREND_CELLS) -> DataFrame:
    x = F.log("base_mean")
    lo, hi = disp.agg(F.min(x), F.max(x)).first()
    width = (hi - lo) / cells or 1.0
    trend = disp.groupBy(F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(cells - 1)).alias("c")).agg(
        F.avg(x).alias("x"), F.avg(F.log("disp_trend")).alias("y")).orderBy("x").toPandas()  # at most ``cells`` rows
    top, q95, q999 = normalized.agg(F.max("normalized"), F.percentile("base_mean", 0.95), F.percentile("base_mean", 0.999)).first()
    factor = normalized.where("normalized > 0").groupBy("sample").agg(F.avg(F.col("normalized") / F.col("count")).alias("i"))
    noise = factor.agg(F.avg("i")).first()[0]  # mean of the samples' 1 / size factor
    grid = np.sinh(np.linspace(0, math.asinh(top), steps))[1:]
    variance = np.exp(np.interp(np.log(grid), trend["x"], trend["y"])) * grid ** 2 + noise * grid
    slope = 1 / np.sqrt(variance)
    at = np.arcsinh((grid[1:] + grid[:-1]) / 2)
    area = np.cumsum(np.diff(grid) * (slope[1:] + slope[:-1]) / 2)
    value = _between(at.tolist(), area.tolist())
    a, b = (float(np.interp(math.asinh(q), at, area)) for q in (q95, q999))
    eta = (math.log2(q999) - math.log2(q95)) / (b - a) if b > a else 1.0
    shift = math.log2(q95) - eta * a
    return normalized.select("sample", "gene_id", (F.lit(eta) * value(F.asinh("normalized")) + F.lit(shift)).alias("vst"))


def _between(x: list[float], y: list[float]):
    """Linear interpolation; straight on at both ends."""
    @F.pandas_udf("double")
    def value(at: pd.Series) -> pd.Series:
        v = at.to_numpy()
        k = np.clip(np.searchsorted(x, v) - 1, 0, len(x) - 2)
        a, b = np.asarray(x), np.asarray(y)
        return pd.Series(b[k] + (v - a[k]) * (b[k + 1] - b[k]) / (a[k + 1] - a[k]))
    return value


def ratio_prior(counts: DataFrame, factors: DataFrame, disp: DataFrame, samples: list[str], *, tail: float = 0.05) -> float:
    """Variance (log2 scale) of the samples' effects: the normal whose upper ``tail`` agrees with that of the observed
    |log2 ratios| to the gene's mean, each weighted by 1 / (1 / mean + dispersion).  The ratios are summed into bins
    of 1 / ``RATIO_BINS``; a bin's upper end counts."""
    s = F.array(*[F.lit(float(v)) for v in _size_factors(factors, samples)])
    vec = gene_vectors(counts, samples).join(disp.select("gene_id", "base_mean", "disp_trend"), "gene_id")
    ratio = F.explode(F.transform("v", lambda y, j: F.abs(F.log2(y / s[j] + 0.5) - F.log2(F.col("base_mean") + 0.5))))
    weight = (1 / (1 / F.col("base_mean") + F.col("disp_trend"))).alias("w")
    bins = vec.select(weight, ratio.alias("r")).groupBy(F.ceil(F.col("r") * RATIO_BINS).alias("b")).agg(F.sum("w").alias("w"))
    got = bins.toPandas().sort_values("b")  # log2 ratios of counts: a few ten thousand bins at most
    if not len(got):
        return 1.0
    share = got["w"].cumsum().to_numpy() / got["w"].sum()
    width = float(got["b"].iloc[int(np.searchsorted(share, 1 - tail))]) / RATIO_BINS
    return max((width / NormalDist().inv_cdf(1 - tail / 2)) ** 2, 1e-6)


def rlog(counts: DataFrame, factors: DataFrame, disp: DataFrame, samples: list[str], *,
         prior_var: float | None = None) -> DataFrame:
    """D17 (rlog): (sample, gene_id, rlog), log2 of the fitted means over size factors, where each gene has a mean and one
    effect per sample, shrunk towards it by a normal prior (``ratio_prior``).  Counts with little information move to the
    gene's mean, high counts stay at their log2.  Dispersions are those of the trend.  Genes without counts are 0."""
    s = _size_factors(factors, samples)
    var = ratio_prior(counts, factors, disp, samples) if prior_var is None else prior_var
    ridge = 1 / (var * math.log(2) ** 2)
    vec = gene_vectors(counts, samples).join(disp.select("gene_id", "disp_trend"), "gene_id", "left")

    def fit(it):
        for pdf, Y in _batches(it):
            out, some = np.zeros_like(Y), Y.sum(axis=1) > 0
            if some.any():
                b0, b = K.sample_effects(Y[some], s, pdf["disp_trend"].to_numpy(float)[some], ridge)
                out[some] = (b0[:, None] + b) / math.log(2)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "r": list(out)})

    names = F.array(*[F.lit(x) for x in samples])
    fitted = vec.mapInPandas(fit, "gene_id string, r array<double>")
    return fitted.select("gene_id", F.posexplode("r").alias("_j", "rlog")).select(
        names[F.col("_j")].alias("sample"), "gene_id", "rlog")


def sample_pca(values: DataFrame, samples: list[str], column: str = "vst", *, ntop: int = 500) -> DataFrame:
    """PCA of samples on the ``ntop`` most variable genes (top-k is the feature).  The S x S Gram
    matrix of gene-centred values is summed on the cluster; its eigen-decomposition (S x S) is local."""
    vec = gene_vectors(values, samples, column)
    n = len(samples)
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) / n - mean * mean
    top = vec.select("gene_id", "v", var.alias("_var")).orderBy(F.desc("_var"), "gene_id").limit(ntop)
    c = top.select(F.transform("v", lambda x: x - F.aggregate("v", F.lit(0.0), lambda a, y: a + y) / n).alias("c"))
    cells = F.expr(f"flatten(transform(sequence(0, {n - 1}), i -> transform(sequence(i, {n - 1}), "
                   "j -> struct(i as i, j as j, c[i] * c[j] as x))))")
    g = c.select(F.explode(cells).alias("_c")).groupBy("_c.i", "_c.j").agg(F.sum("_c.x").alias("x"))
    gram = np.zeros((n, n))
    for r in g.collect():  # n(n+1)/2 numbers
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["x"]
    lam, U = np.linalg.eigh(gram)
    order = np.argsort(lam)[::-1]
    lam, U = np.maximum(lam[order], 0), U[:, order]
    U = U * np.where(U[np.abs(U).argmax(axis=0), range(n)] < 0, -1, 1)
    scores = U * np.sqrt(lam)
    share = lam / lam.sum() if lam.sum() > 0 else lam
    rows = [(samples[i], float(scores[i, 0]), float(scores[i, 1] if n > 1 else 0.0), float(share[0]),
             float(share[1] if n > 1 else 0.0)) for i in range(n)]
    return values.sparkSession.createDataFrame(rows, "sample string, PC1 double, PC2 double, var_PC1 double, var_PC2 double")


def all_pairs_contrasts(counts: DataFrame, factors: DataFrame, design: DataFrame, disp: DataFrame, samples: list[str], *,
                        factor: str, reference: str, all_pairs: bool = True) -> DataFrame:
    """One Wald table per pair of levels of ``factor`` (or per level against ``reference``), from one model with
    treatment coding: test minus reference is the difference of their coefficients."""
    levels = sorted(r[0] for r in design.select(factor).distinct().collect())
    if reference not in levels:
        raise ValueError(f"reference {reference!r} is not among the levels {levels}")
    coefficients = ["Intercept", *(f"{factor}{lv}" for lv in levels if lv != reference)]
    long = design_matrix(design, factors=[factor], reference={factor: reference}, levels={factor: levels})
    out = None
    for test, ref in contrasts(levels, reference=reference, all_pairs=all_pairs):
        weights = [float(c == f"{factor}{test}") - float(c == f"{factor}{ref}") for c in coefficients]
        one = numeric_contrast(counts, factors, long, disp, samples, coefficients, contrast=weights,
                               name=f"{test}_vs_{ref}")
        out = one if out is None else out.unionByName(one)
    return out


def check_contrasts(contrast: list[float], coefficients: list[str]) -> None:
    """D22 check: a numeric contrast needs one weight per model coefficient."""
    if len(contrast) != len(coefficients):
        raise ValueError(f"contrast has {len(contrast)} weights for {len(coefficients)} coefficients: {coefficients}")


def numeric_contrast(counts: DataFrame, factors: DataFrame, design_long: DataFrame, disp: DataFrame,
                     samples: list[str], coefficients: list[str], *, contrast: list[float], name: str) -> DataFrame:
    """Per gene log2 fold change c.beta / ln 2, se = sqrt(c Sigma c^T), Wald statistic and p-value."""
    check_contrasts(contrast, coefficients)
    X = _design(design_long, samples, coefficients)
    s = _size_factors(factors, samples)
    c = np.asarray(contrast, dtype=float)
    vec = gene_vectors(counts, samples).join(disp.select("gene_id", "base_mean", "dispersion"), "gene_id")

    def fit(it):
        for pdf, Y in _batches(it):
            beta, _, _, _, _, cov = K.wald(Y, s, X, pdf["dispersion"].to_numpy())
            est = beta @ c
            se = np.sqrt(np.maximum(np.einsum("p,gpq,q->g", c, cov, c), 0))
            stat = est / np.where(se > 0, se, np.nan)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "base_mean": pdf["base_mean"],
                                "log2fc": est / math.log(2), "lfc_se": se / math.log(2), "stat": stat,
                                "pvalue": K.erfc(np.abs(stat) / math.sqrt(2))})

    out = vec.mapInPandas(fit, "gene_id string, base_mean double, log2fc double, lfc_se double, stat double, "
                               "pvalue double")
    return out.withColumn("contrast", F.lit(name))

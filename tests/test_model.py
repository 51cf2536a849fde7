"""Planted-truth checks for the per-gene negative-binomial model (no SQL oracle exists for it)."""

import numpy as np
from pyspark.sql import functions as F

from strandline.functions import nbglm as K
from strandline.operators import dge as D
from strandline.operators import model as MD

SAMPLES = [f"S{i}" for i in range(6)]


def _simulate(spark, genes=300, alpha=0.1, de_every=10, lfc=2.0, seed=3):
    rng = np.random.default_rng(seed)
    sf = np.array([0.8, 1.0, 1.2, 0.9, 1.1, 1.0])
    ko = np.array([0, 0, 0, 1, 1, 1])
    base = rng.uniform(50, 2000, genes)
    eff = np.where(np.arange(genes) % de_every == 0, lfc * np.log(2), 0.0)
    mu = base[:, None] * sf[None, :] * np.exp(eff[:, None] * ko[None, :])
    r = 1 / alpha
    y = rng.negative_binomial(r, r / (r + mu))
    rows = [(SAMPLES[j], f"g{i}", int(y[i, j])) for i in range(genes) for j in range(6)]
    counts = spark.createDataFrame(rows, "sample string, gene_id string, count long")
    design = spark.createDataFrame([(s, "WT" if i < 3 else "KO") for i, s in enumerate(SAMPLES)],
                                   "label string, cond string")
    return counts, design, eff != 0


def test_numeric_helpers():
    import math
    x = np.array([0.3, 1.0, 4.5, 30.0])
    assert np.allclose(K.lgamma(x), [math.lgamma(v) for v in x], atol=1e-10)
    assert abs(K.trigamma(np.array([1.0]))[0] - math.pi ** 2 / 6) < 1e-8
    assert abs(K.f_quantile(0.99, 2, 4) - 18.0) < 1e-6


def test_dispersion_and_wald_recover_planted_truth(spark):
    counts, design, is_de = _simulate(spark)
    factors = D.size_factors(counts, len(SAMPLES))
    dl = D.design_matrix(design, factors=["cond"], reference={"cond": "WT"}, levels={"cond": ["KO", "WT"]})
    disp = MD.dispersions(counts, factors, dl, SAMPLES, ["Intercept", "condKO"])
    d = disp.select(F.percentile("dispersion", 0.5).alias("m")).first().m
    assert 0.05 < d < 0.2  # planted 0.1
    res = MD.wald_test(counts, factors, dl, disp, SAMPLES, ["Intercept", "condKO"], coefficient="condKO")
    r = {row.gene_id: (row.pvalue, row.log2fc) for row in res.collect()}
    de = [r[f"g{i}"] for i in range(len(is_de)) if is_de[i]]
    null = [r[f"g{i}"] for i in range(len(is_de)) if not is_de[i]]
    assert np.mean([p < 0.01 for p, _ in de]) > 0.8
    assert np.mean([p < 0.01 for p, _ in null]) < 0.05
    assert abs(np.median([lfc for _, lfc in de]) - 2.0) < 0.3
    filtered = MD.independent_filtering(MD.cooks_outliers(res, 6, 2), alpha=0.1)
    assert filtered.where(F.col("padj") <= 0.1).count() >= 0.8 * sum(is_de)
    vst = MD.transform_counts(D.normalized_counts(counts, factors), disp)
    pca = {row.sample: row.PC1 for row in MD.sample_pca(vst, SAMPLES, "vst", ntop=100).collect()}
    wt, ko = [pca[s] for s in SAMPLES[:3]], [pca[s] for s in SAMPLES[3:]]
    assert max(wt) < min(ko) or max(ko) < min(wt)  # PC1 separates the conditions


def test_numeric_contrast_matches_coefficient_test(spark):
    import pytest

    counts, design, _ = _simulate(spark, genes=80, seed=5)
    factors = D.size_factors(counts, len(SAMPLES))
    dl = D.design_matrix(design, factors=["cond"], reference={"cond": "WT"}, levels={"cond": ["KO", "WT"]})
    coefs = ["Intercept", "condKO"]
    disp = MD.dispersions(counts, factors, dl, SAMPLES, coefs).cache()
    a = {r.gene_id: r.pvalue for r in MD.wald_test(counts, factors, dl, disp, SAMPLES, coefs,
                                                    coefficient="condKO").collect()}
    b = {r.gene_id: r.pvalue for r in MD.numeric_contrast(counts, factors, dl, disp, SAMPLES, coefs,
                                                           contrast=[0, 1], name="x").collect()}
    assert a.keys() == b.keys() and all(abs(a[g] - b[g]) < 1e-9 for g in a)
    with pytest.raises(ValueError):
        MD.check_contrasts([1, 0, 0], coefs)

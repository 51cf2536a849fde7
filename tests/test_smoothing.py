"""Regularised log, local trend and smoothed filtering: values against plain loops and planted truth."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from strandline.functions import nbglm as K
from strandline.functions import smoothing as SM
from strandline.operators import dge as D
from strandline.operators import model as MD
from test_model import SAMPLES, _simulate


def plain_lowess(x, y, share=0.2, rounds=3):
    n = len(x)
    near = max(2, int(share * n + 1e-7))
    trust, fit = [1.0] * n, list(y)
    for left in range(rounds, -1, -1):
        fit = []
        for i in range(n):
            h = sorted(abs(x[j] - x[i]) for j in range(n))[near - 1]
            w = []
            for j in range(n):
                d = abs(x[j] - x[i])
                w.append(trust[j] * (1.0 if d <= 0.001 * h else 0.0 if d > 0.999 * h else (1 - (d / h) ** 3) ** 3))
            t = sum(w)
            w = [v / t for v in w]
            m = sum(a * b for a, b in zip(w, x))
            s = sum(a * (b - m) ** 2 for a, b in zip(w, x))
            fit.append(sum(a * c * (1 + (x[i] - m) * (b - m) / s) for a, b, c in zip(w, x, y))
                       if math.sqrt(s) > 0.001 * (x[-1] - x[0]) else sum(a * c for a, c in zip(w, y)))
        off = [abs(a - b) for a, b in zip(y, fit)]
        scale = 6 * float(np.median(off))
        if not left or not scale:
            break
        trust = [1.0 if o <= 0.001 * scale else 0.0 if o >= 0.999 * scale else (1 - (o / scale) ** 2) ** 2 for o in off]
    return fit


@pytest.mark.parametrize("seed", range(4))
def test_lowess_equals_loops(seed):
    rng = np.random.default_rng(seed)
    x = np.linspace(0, 0.95, 50) if seed % 2 else np.sort(rng.uniform(0, 1, 40))
    y = np.sin(3 * x) * 100 + rng.normal(0, 4, len(x))
    y[7] += 300  # an outlier, which loses its weight
    assert np.allclose(SM.lowess(x, y), plain_lowess(x.tolist(), y.tolist()), atol=1e-6)


def plain_choice(theta, n):
    if max(n) <= 10:
        return 0
    fit = plain_lowess(list(theta), list(map(float, n)))
    rest = [(a - b) ** 2 for a, b in zip(n, fit) if a > 0]
    level = max(fit) - math.sqrt(sum(rest) / len(rest))
    return next((i for i, v in enumerate(n) if v > level), 0)


def test_chosen_threshold_on_planted_curves():
    theta = np.linspace(0, 0.95, 50)
    rng = np.random.default_rng(1)
    curves = [np.round(500 * np.exp(-((theta - c) / 0.3) ** 2) + rng.normal(0, 6, 50)).astype(int).clip(0) for c in (0.1, 0.4, 0.8)]
    spike = 300 + rng.integers(-4, 5, 50)
    spike[33] = 340  # a lone peak: the raw maximum would take it
    curves += [spike, np.zeros(50, int), np.full(50, 10), np.arange(50), np.arange(50)[::-1] * 3]
    for n in curves:
        assert MD.chosen_theta(theta, n)[0] == plain_choice(theta, n)
    assert MD.chosen_theta(theta, spike)[0] != 33 and MD.chosen_theta(theta, curves[4])[0] == 0


def test_filtering_uses_the_smoothed_curve(spark):
    rng = np.random.default_rng(7)
    rows = [("a", f"g{i}", float(m), float(p)) for i, (m, p) in enumerate(
        zip(rng.uniform(0, 100, 800), np.where(rng.random(800) < 0.3, rng.random(800) * 1e-3, rng.random(800))))]
    rows = [(c, g, m, p * (1 if m > 30 else 50) if p * 50 < 1 else p) for c, g, m, p in rows] + [("b", "x", 0.0, 0.5), ("b", "y", 3.0, None)]
    df = spark.createDataFrame(rows, "contrast string, gene_id string, base_mean double, pvalue double")
    curve = MD.filter_curve(MD.filter_table(df)).collect()
    result = MD.independent_filtering(df).collect()
    assert len(curve) == 2 * MD.FILTER_STEPS
    for c in ("a", "b"):
        own = sorted((r for r in curve if r["contrast"] == c), key=lambda r: r["theta"])
        at = plain_choice([r["theta"] for r in own], [r["rejections"] for r in own])
        assert [r["chosen"] for r in own] == [i == at for i in range(len(own))]
        got = {r["filter_threshold"] for r in result if r["contrast"] == c}
        assert got == {own[at]["cutoff"]}
    kept = [r for r in result if r["contrast"] == "a"]
    assert all((r["padj"] is None) == (r["base_mean"] < r["filter_threshold"]) for r in kept)
    zeros = df.withColumn("base_mean", F.when(F.col("base_mean") < 30, 0.0).otherwise(F.col("base_mean")))
    share = zeros.agg(F.avg((F.col("base_mean") == 0).cast("int"))).first()[0]
    assert MD.filter_thetas(zeros)[0] == share and MD.filter_thetas(zeros)[-1] == 0.95


def plain_local(x, y, w, at, share=0.7):
    out = []
    for x0 in at:
        d = np.abs(x - x0)
        h = np.sort(d)[int(share * len(x)) - 1]
        k = w * np.where(d < h, (1 - (d / h) ** 3) ** 3, 0)
        a = np.stack([np.ones_like(x), x - x0, (x - x0) ** 2], axis=1) * np.sqrt(k)[:, None]
        out.append(np.linalg.lstsq(a, y * np.sqrt(k), rcond=None)[0][0])
    return np.array(out)


def test_local_trend_equals_a_plain_local_fit(spark):
    d = entry.queries()["dispersions_local"](spark, SF_SMALL).toPandas()
    assert set(d["trend_kind"]) == {"local"} and d["trend_a0"].isna().all()
    use = d[d["disp_gene_wise"] > MD.TREND_MIN_DISP]
    x, y, w = np.log(use["base_mean"].to_numpy()), np.log(use["disp_gene_wise"].to_numpy()), use["base_mean"].to_numpy()
    want = plain_local(x, y, w, x)
    assert np.abs(np.log(use["disp_trend"].to_numpy()) - want).max() < 1e-3
    # one gene per cell: no approximation is left
    at = np.linspace(0, 10, 120)
    v = np.sin(at) + at / 5
    weight = np.linspace(1, 3, 120)
    got = SM.local_quadratic(at, at + 0.01, np.ones(120), weight[:, None] * (-0.01) ** np.arange(5), (weight * v)[:, None] * (-0.01) ** np.arange(3))
    assert np.allclose(got, plain_local(at, v, weight, at), atol=1e-9)


def test_local_trend_follows_a_planted_bend(spark):
    rng = np.random.default_rng(2)
    mean = np.exp(rng.uniform(1, 9, 3000))
    true = np.where(np.log(mean) < 5, -1.0 - 0.5 * (np.log(mean) - 1), -3.0 + 0.3 * (np.log(mean) - 5))  # no a0 + a1 / mean
    gw = spark.createDataFrame([(float(m), float(np.exp(t + e))) for m, t, e in zip(mean, true, rng.normal(0, 0.1, 3000))],
                               "base_mean double, disp_gene_wise double")
    x, y = MD.local_trend(gw)
    far = np.abs(np.array(x) - 5) > 1.5
    low = np.array(x) < 5
    assert abs((np.array(y) - np.interp(x, np.sort(np.log(mean)), true[np.argsort(mean)]))[far & ~low]).max() < 0.15
    assert MD.local_trend(gw.where("false")) is None
    one = MD.local_trend(gw.limit(1))
    assert len(one[0]) == 1 and math.isfinite(one[1][0])


def test_sample_effects_maximise_the_penalised_likelihood():
    rng = np.random.default_rng(5)
    s = np.array([0.5, 1.0, 2.0, 1.3])
    y = rng.poisson(rng.uniform(0, 60, (200, 1)) * s * rng.uniform(0.2, 3, (200, 4))).astype(float)
    y[0] = [0, 0, 0, 1]
    y[1] = [100_000, 0, 0, 0]
    y = y[y.sum(axis=1) > 0]
    alpha, ridge = rng.uniform(0.001, 2, len(y)), 3.0
    b0, b = K.sample_effects(y, s, alpha, ridge)
    mu = s * np.exp(b0[:, None] + b)
    g = (y - mu) / (1 + alpha[:, None] * mu)  # gradient of the likelihood by sample
    assert np.abs(g - ridge * b).max() < 1e-4 and np.abs(g.sum(axis=1)).max() < 1e-4
    assert np.abs(b.sum(axis=1)).max() < 1e-4  # the effects centre on the gene's mean
    flat = K.sample_effects(y, s, alpha, 1e9)[1]
    assert np.abs(flat).max() < 1e-5


def test_rlog_shrinks_low_counts_and_keeps_high_ones(spark):
    counts, _, _ = _simulate(spark, genes=200, alpha=0.01, seed=9)
    rng = np.random.default_rng(3)
    low = [(s, f"low{i}", int(rng.poisson(1.0))) for i in range(100) for s in SAMPLES]
    counts = counts.unionByName(spark.createDataFrame(low + [(s, "none", 0) for s in SAMPLES], counts.schema))
    factors = D.size_factors(counts.where("gene_id like 'g%'"), len(SAMPLES))
    disp = D.normalized_counts(counts, factors).where("base_mean > 0").select(
        "gene_id", "base_mean", F.lit(0.01).alias("disp_trend")).distinct()
    r = MD.rlog(counts, factors, disp, SAMPLES).toPandas().set_index(["gene_id", "sample"])["rlog"]
    n = D.normalized_counts(counts, factors).toPandas().set_index(["gene_id", "sample"])["normalized"]
    assert len(r) == len(n) == 301 * 6
    assert (r["none"] == 0).all()
    high = [g for g in n.index.get_level_values(0).unique() if n[g].mean() > 200]
    assert max(abs(r[g][s] - math.log2(n[g][s] + 0.5)) for g in high for s in SAMPLES) < 0.25
    lows = [f"low{i}" for i in range(100) if n[f"low{i}"].sum() > 0]
    spread = [np.log2(n[g] + 0.5).std() for g in lows]
    assert np.median([r[g].std() for g in lows]) < 0.35 * np.median(spread)
    wide = MD.rlog(counts, factors, disp, SAMPLES, prior_var=25.0).toPandas().set_index(["gene_id", "sample"])["rlog"]
    assert np.median([wide[g].std() for g in lows]) > np.median([r[g].std() for g in lows])


def test_prior_width_of_planted_ratios(spark):
    rng = np.random.default_rng(8)
    sd, genes = 0.7, 4000
    y = np.round(20_000 * 2 ** rng.normal(0, sd, (genes, 6)))
    counts = spark.createDataFrame([(SAMPLES[j], f"g{i}", int(y[i, j])) for i in range(genes) for j in range(6)],
                                   "sample string, gene_id string, count long")
    factors = spark.createDataFrame([(s, 1.0) for s in SAMPLES], "sample string, size_factor double")
    disp = spark.createDataFrame([(f"g{i}", float(y[i].mean()), 0.1) for i in range(genes)],
                                 "gene_id string, base_mean double, disp_trend double")
    got = math.sqrt(MD.ratio_prior(counts, factors, disp, SAMPLES))
    x = np.abs(np.log2(y + 0.5) - np.log2(y.mean(axis=1) + 0.5)[:, None]).ravel()
    assert abs(got - np.quantile(x, 0.95) / 1.959964) < 2 / MD.RATIO_BINS


def test_integrated_vst_agrees_with_the_closed_form(spark):
    counts, design, _ = _simulate(spark, genes=400, seed=4)
    factors = D.size_factors(counts, len(SAMPLES))
    dl = D.design_matrix(design, factors=["cond"], reference={"cond": "WT"}, levels={"cond": ["KO", "WT"]})
    disp = MD.dispersions(counts, factors, dl, SAMPLES, ["Intercept", "condKO"], fit="local").checkpoint()
    norm = D.normalized_counts(counts, factors)
    v = MD.transform_counts(norm, disp).toPandas().merge(norm.toPandas(), on=["sample", "gene_id"])
    high = v[v["normalized"] > 2000]
    assert np.corrcoef(v["vst"], np.log2(v["normalized"] + 1))[0, 1] > 0.98
    assert (high["vst"] - np.log2(high["normalized"])).abs().max() < 0.3  # log2 at high counts
    o = v.sort_values("normalized")
    assert (np.diff(o["vst"]) >= -1e-9).all()

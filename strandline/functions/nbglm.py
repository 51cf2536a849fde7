"""Vectorised numpy kernels for negative-binomial GLMs, run inside Arrow batches of genes.

Everything works on a batch of G genes at once: counts Y (G x S), size
factors s (S), design X (S x p).  No SciPy: log-gamma (Lanczos), digamma and
trigamma (asymptotic series with recurrence), the normal tail (erfc) and the F
distribution (regularised incomplete beta by continued fraction) are written
out from their textbook definitions.
"""

from __future__ import annotations

import math

import numpy as np

# Lanczos approximation coefficients (g = 7, n = 9).
_LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
            -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
            1.5056327351493116e-7]
MIN_DISP = 1e-8
MAX_ITER = 50
LOG_ALPHA_GRID = np.linspace(math.log(MIN_DISP), math.log(10.0), 60)


def lgamma(x):
    """log Gamma(x) for x > 0, elementwise."""
    x = np.asarray(x, dtype=float)
    small = x < 0.5
    z = np.where(small, 1.0 - x, x) - 1.0
    a = np.full_like(z, _LANCZOS[0])
    t = z + 7.5
    for i in range(1, 9):
        a = a + _LANCZOS[i] / (z + i)
    big = 0.5 * math.log(2 * math.pi) + (z + 0.5) * np.log(t) - t + np.log(a)
    if small.any():
        big[small] = np.log(math.pi / np.abs(np.sin(math.pi * x[small]))) - big[small]
    return big


def trigamma(x):
    """psi'(x) for x > 0: recurrence up to x >= 6, then the asymptotic series."""
    x = np.asarray(x, dtype=float).copy()
    acc = np.zeros_like(x)
    while (x < 6).any():
        m = x < 6
        acc = acc + np.where(m, 1.0 / (x * x), 0.0)
        x = np.where(m, x + 1, x)
    inv = 1.0 / x
    inv2 = inv * inv
    return acc + inv + inv2 / 2 + inv * inv2 * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 / 30)))


def erfc(x):
    return np.vectorize(math.erfc, otypes=[float])(x)


def nb_loglik(y, mu, alpha, factorial=None):
    """Elementwise NB log-likelihood with dispersion alpha (variance mu + alpha mu^2); ``factorial``: lgamma(y + 1)."""
    r = 1.0 / alpha
    factorial = lgamma(y + 1.0) if factorial is None else factorial
    return (lgamma(y + r) - lgamma(r) - factorial + r * np.log(r / (r + mu)) + y * np.log(mu / (r + mu) + 1e-300))


def irls(y, s, X, alpha, beta0=None, ridge=1e-6, max_iter=MAX_ITER, tol=1e-8):
    """Fit log(mu_ij) = log(s_j) + X_j . beta_i for every gene i.  Returns beta (G x p), mu, XtWX (G x p x p)."""
    G, S = y.shape
    p = X.shape[1]
    alpha = np.broadcast_to(np.asarray(alpha, dtype=float).reshape(-1, 1), (G, 1))
    if beta0 is None:
        beta = np.zeros((G, p))
        beta[:, 0] = np.log(np.maximum(y / s, 0.1).mean(axis=1))
    else:
        beta = beta0.copy()
    lam = ridge * np.eye(p)
    for _ in range(max_iter):
        eta = np.clip(beta @ X.T, -30, 30)
        mu = s * np.exp(eta)
        w = mu / (1.0 + alpha * mu)
        z = eta + (y - mu) / np.maximum(mu, 1e-10)
        xtwx = np.einsum("gs,sp,sq->gpq", w, X, X) + lam
        xtwz = np.einsum("gs,sp,gs->gp", w, X, z)
        new = np.linalg.solve(xtwx, xtwz[..., None])[..., 0]
        done = np.max(np.abs(new - beta)) < tol
        beta = new
        if done:
            break
    eta = np.clip(beta @ X.T, -30, 30)
    mu = s * np.exp(eta)
    w = mu / (1.0 + alpha * mu)
    xtwx = np.einsum("gs,sp,sq->gpq", w, X, X) + lam
    return beta, mu, xtwx


def sample_effects(y, s, alpha, ridge, max_iter=200, tol=1e-8):
    """log(mu_ij) = log(s_j) + b0_i + b_ij with one effect per sample and the penalty ridge / 2 * sum_j b_ij^2.

    Fisher scoring; eliminating the effects leaves a weighted mean for b0, so a step costs one pass over the
    samples.  A step that lowers a gene's penalised likelihood is halved.  Returns b0 (G), b (G x S)."""
    alpha = np.asarray(alpha, dtype=float).reshape(-1, 1)
    b0 = np.log(np.maximum((y / s).mean(axis=1), 1e-8))[:, None]
    b = np.zeros_like(y, dtype=float)

    def value(b0, b):
        return nb_loglik(y, s * np.exp(np.clip(b0 + b, -30, 30)), alpha).sum(axis=1) - ridge / 2 * (b * b).sum(axis=1)

    now = value(b0, b)
    for _ in range(max_iter):
        eta = np.clip(b0 + b, -30, 30)
        mu = s * np.exp(eta)
        w = mu / (1.0 + alpha * mu)
        z = eta + (y - mu) / np.maximum(mu, 1e-10)
        u = w * ridge / (w + ridge)
        n0 = (u * z).sum(axis=1, keepdims=True) / u.sum(axis=1, keepdims=True)
        step0, step = n0 - b0, w * (z - n0) / (w + ridge) - b
        t = np.ones((len(y), 1))
        for _ in range(30):
            new = value(b0 + t * step0, b + t * step)
            worse = new < now - 1e-12 * np.abs(now)
            if not worse.any():
                break
            t[worse] /= 2
        b0, b, now = b0 + t * step0, b + t * step, new
        if max(np.abs(t * step0).max(), np.abs(t * step).max()) < tol:
            break
    return b0[:, 0], b


def cr_profile(y, mu, X, log_alpha):
    """Cox-Reid adjusted profile log-likelihood (G x A).  ``log_alpha`` is a shared grid (A,) or
    per-gene candidates (G x A); every column is evaluated for all genes at once."""
    la = np.asarray(log_alpha, dtype=float)
    if la.ndim == 1:
        la = np.broadcast_to(la[None, :], (y.shape[0], la.shape[0]))
    out = np.empty(la.shape)
    factorial = lgamma(y + 1.0)
    for k in range(la.shape[1]):
        a = np.exp(la[:, k])[:, None]
        w = mu / (1.0 + a * mu)
        xtwx = np.einsum("gs,sp,sq->gpq", w, X, X)
        _, logdet = np.linalg.slogdet(xtwx)
        out[:, k] = nb_loglik(y, mu, a, factorial).sum(axis=1) - 0.5 * logdet
    return out


def _refine(score, best, grid):
    """Evaluate a finer per-gene grid of +-1 step around each gene's best grid point."""
    step = grid[1] - grid[0]
    cand = best[:, None] + np.linspace(-step, step, 21)[None, :]
    return cand[np.arange(len(best)), score(cand).argmax(axis=1)]


def gene_wise_dispersion(y, s, X):
    """Method-of-moments start, IRLS means, then the CR-adjusted profile maximised on a grid + refinement."""
    q = y / s
    m = q.mean(axis=1)
    v = q.var(axis=1, ddof=1) if y.shape[1] > 1 else np.zeros_like(m)
    a0 = np.maximum((v - m * np.mean(1.0 / s)) / np.maximum(m, 1e-8) ** 2, MIN_DISP)
    _, mu, _ = irls(y, s, X, a0)
    score = lambda la: cr_profile(y, mu, X, la)
    best = LOG_ALPHA_GRID[score(LOG_ALPHA_GRID).argmax(axis=1)]
    return np.exp(_refine(score, best, LOG_ALPHA_GRID)), mu


def map_dispersion(y, mu, X, log_trend, prior_var):
    """Maximum a posteriori dispersion with a normal prior on log alpha around the trend."""
    def score(la):
        la2 = np.broadcast_to(la, (y.shape[0], la.shape[-1])) if np.ndim(la) == 1 else la
        return cr_profile(y, mu, X, la2) - (la2 - log_trend[:, None]) ** 2 / (2 * prior_var)
    best = LOG_ALPHA_GRID[score(LOG_ALPHA_GRID).argmax(axis=1)]
    return np.exp(_refine(score, best, LOG_ALPHA_GRID))


def wald(y, s, X, alpha):
    """Per-gene coefficients, standard errors, Wald statistics and two-sided normal p-values."""
    beta, mu, xtwx = irls(y, s, X, alpha)
    cov = np.linalg.inv(xtwx)
    se = np.sqrt(np.maximum(np.einsum("gpp->gp", cov), 0))
    stat = beta / np.where(se > 0, se, np.nan)
    pval = erfc(np.abs(stat) / math.sqrt(2))
    return beta, se, stat, pval, mu, cov


def cooks_distance(y, mu, X, alpha, cov):
    """Cook's distance of every sample for every gene (G x S)."""
    p = X.shape[1]
    a = np.asarray(alpha).reshape(-1, 1)
    w = mu / (1.0 + a * mu)
    h = np.einsum("sp,gpq,sq->gs", X, cov, X) * w
    pearson2 = (y - mu) ** 2 / (mu + a * mu * mu)
    return pearson2 / p * h / np.maximum((1 - h) ** 2, 1e-12)


def _betacf(a, b, x, iters=300, eps=1e-15):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def f_cdf(f: float, d1: float, d2: float) -> float:
    return betainc(d1 / 2, d2 / 2, d1 * f / (d1 * f + d2))


def f_quantile(q: float, d1: float, d2: float) -> float:
    lo, hi = 0.0, 1.0
    while f_cdf(hi, d1, d2) < q:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if f_cdf(mid, d1, d2) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2

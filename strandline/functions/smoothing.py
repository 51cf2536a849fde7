"""Local regression on small tables: a robust running line, and a weighted local quadratic over cell moments."""

from __future__ import annotations

import numpy as np


def _tricube(d: np.ndarray, h: np.ndarray) -> np.ndarray:
    u = np.minimum(d / np.where(h > 0, h, 1.0), 1.0)
    return np.where(h > 0, (1 - u ** 3) ** 3, (d == 0).astype(float))


def lowess(x: np.ndarray, y: np.ndarray, share: float = 0.2, robust_rounds: int = 3) -> np.ndarray:
    """Robust locally weighted line at each of the sorted ``x``: tricube weights over the nearest ``share`` of the
    points, then bisquare weights from the residuals, ``robust_rounds`` times."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    n = len(x)
    if n < 3:
        return y.copy()
    near = min(n, max(2, int(share * n + 1e-7)))
    far = np.abs(x[:, None] - x[None, :])
    h = np.sort(far, axis=1)[:, near - 1][:, None]
    kernel = _tricube(np.where(far <= 0.001 * h, 0.0, far), np.broadcast_to(h, far.shape))
    kernel[far > 0.999 * h] = 0.0
    np.fill_diagonal(kernel, 1.0)
    trust, span = np.ones(n), x[-1] - x[0]
    fit = y.copy()
    for left in range(robust_rounds, -1, -1):
        w = kernel * trust[None, :]
        total = w.sum(axis=1)
        w = np.divide(w, total[:, None], out=np.zeros_like(w), where=total[:, None] > 0)
        mean = w @ x
        spread = (w * (x[None, :] - mean[:, None]) ** 2).sum(axis=1)
        flat = np.sqrt(spread) <= 0.001 * span
        slope = np.where(flat, 0.0, (x - mean) / np.where(flat, 1.0, spread))
        value = (w * (1 + slope[:, None] * (x[None, :] - mean[:, None]))) @ y
        fit = np.where(total > 0, value, y)
        if not left:
            break
        off = np.abs(y - fit)
        scale = 6 * np.median(off)
        if scale < 1e-7 * off.mean() or not scale:
            break
        u = off / scale
        trust = np.where(u <= 0.001, 1.0, np.where(u >= 0.999, 0.0, (1 - np.minimum(u, 1) ** 2) ** 2))
    return fit


def local_quadratic(at: np.ndarray, centre: np.ndarray, n: np.ndarray, x_moments: np.ndarray, y_moments: np.ndarray,
                    share: float = 0.7) -> np.ndarray:
    """Weighted local quadratic regression at each of ``at`` from moments of cells.

    Cell ``c`` has ``n`` points, the moments ``sum(w * (x - centre)^k)`` for k = 0..4 and ``sum(w * y * (x - centre)^k)`` for
    k = 0..2.  The bandwidth at a position reaches the nearest ``share`` of all points; tricube weights are taken at
    the cells' mean x, so cells of one point (or of equal points) are exact."""
    mean = centre + x_moments[:, 1] / x_moments[:, 0]
    wanted = max(1.0, np.floor(share * n.sum()))
    out = np.empty(len(at))
    for lo in range(0, len(at), 256):
        x0 = at[lo:lo + 256, None]
        far = np.abs(mean[None, :] - x0)
        order = np.argsort(far, axis=1, kind="stable")
        reach = np.cumsum(n[order], axis=1) >= wanted
        h = np.take_along_axis(far, np.take_along_axis(order, reach.argmax(axis=1)[:, None], axis=1), axis=1)
        k = _tricube(far, np.broadcast_to(h, far.shape))
        scale = np.where(h > 0, h, 1.0)
        d = (centre[None, :] - x0) / scale
        m = x_moments[None, :, :] / scale[:, :, None] ** np.arange(5)
        t = y_moments[None, :, :] / scale[:, :, None] ** np.arange(3)

        def about(parts, power):  # sum of w * ((x - x0) / h)^power, or with y, from moments about the centres
            binom = [1, power, power * (power - 1) // 2, power * (power - 1) * (power - 2) // 6, 1]
            return sum(binom[j] * d ** (power - j) * parts[:, :, j] for j in range(power + 1))

        s = [(k * about(m, p)).sum(axis=1) for p in range(5)]
        r = np.stack([(k * about(t, p)).sum(axis=1) for p in range(3)], axis=1)
        a = np.stack([np.stack([s[i + j] for j in range(3)], axis=1) for i in range(3)], axis=1)
        out[lo:lo + 256] = np.einsum("gij,gj->gi", np.linalg.pinv(a, hermitian=True), r)[:, 0]
    return out

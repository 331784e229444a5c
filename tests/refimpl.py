"""Plain NumPy versions of the filters, written from their definitions (test oracle)."""

import numpy as np


def moving_average(x, window=5, head="expanding"):
    x = np.asarray(x, dtype=float)
    n = len(x)
    if n < window:
        return x.copy()
    h = window // 2
    out = np.empty(n)
    for i in range(n):
        lo, hi = max(0, i - h), min(n - 1, i + h)
        if head == "as_reference":
            if i < h:
                out[i] = x[: 2 * i + h + 1].sum() / (h + i + 1)
            elif i >= n - h:
                out[i] = x[i - h:].sum() / (h + n - i)
            else:
                out[i] = x[i - h: i + h + 1].sum() / window
        else:
            out[i] = x[lo: hi + 1].mean()
    return out


def median(x, kernel=5):
    x = np.asarray(x, dtype=float)
    k = kernel if kernel % 2 else kernel + 1
    n = len(x)
    if n < k:
        return x.copy()
    h = k // 2
    p = np.concatenate([np.zeros(h), x, np.zeros(h)])
    return np.array([np.median(p[i: i + k]) for i in range(n)])


def savgol(x, window=11, polyorder=3):
    x = np.asarray(x, dtype=float)
    if window <= polyorder:
        window = polyorder + 1 + polyorder % 2
    elif window % 2 == 0:
        window += 1
    n = len(x)
    if n < window:
        return x.copy()
    h = window // 2
    out = np.empty(n)
    t = np.arange(window, dtype=float)
    for i in range(n):
        lo = min(max(i - h, 0), n - window)
        c = np.polyfit(t, x[lo: lo + window], polyorder)
        out[i] = np.polyval(c, i - lo)
    return out


def gaussian(x, sigma=2.0, truncate=4.0):
    x = np.asarray(x, dtype=float)
    r = int(truncate * sigma + 0.5)
    d = np.arange(-r, r + 1)
    w = np.exp(-0.5 * (d / sigma) ** 2)
    w /= w.sum()
    n = len(x)
    out = np.empty(n)
    for i in range(n):
        acc = 0.0
        for dd, ww in zip(d, w):
            j = i + dd
            while j < 0 or j >= n:  # half-sample reflection, repeated for short series
                j = -j - 1 if j < 0 else 2 * n - 1 - j
            acc += ww * x[j]
        out[i] = acc
    return out


def kalman(x, q=1e-5, r=0.1):
    x = np.asarray(x, dtype=float)
    out = np.empty(len(x))
    xh, p = x[0], 1.0
    out[0] = xh
    for i in range(1, len(x)):
        pm = p + q
        k = pm / (pm + r)
        xh = xh + k * (x[i] - xh)
        p = (1 - k) * pm
        out[i] = xh
    return out


REF = {
    "none": lambda x: np.asarray(x, dtype=float),
    "moving_average": moving_average,
    "median": median,
    "savitzky_golay": savgol,
    "gaussian": gaussian,
    "kalman": kalman,
}

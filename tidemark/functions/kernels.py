"""Small driver-side coefficient tables for the filters.

Each table depends only on the filter parameters (never on the data) and is at
most a few thousand numbers; they are embedded in plans as literals.
"""

from __future__ import annotations

import functools
import math

import numpy as np


def savgol_params(window: int, polyorder: int) -> tuple[int, int]:
    """Parameter repair: too-small windows grow past the order, even windows grow by one."""
    window, polyorder = int(window), int(polyorder)
    if window <= polyorder:
        window = polyorder + 1 + (polyorder % 2)
    elif window % 2 == 0:
        window += 1
    return window, polyorder


@functools.lru_cache(maxsize=64)
def savgol_hat(window: int, polyorder: int) -> tuple[tuple[float, ...], ...]:
    """Hat matrix ``H = A pinv(A)`` of a degree-``polyorder`` least-squares fit on ``window`` points.

    Row ``r`` maps the ``window`` values to the fitted value at position ``r``:
    the middle row gives interior Savitzky-Golay weights, the other rows give the
    polynomial-interpolated edges.
    """
    pos = np.arange(window, dtype=np.float64) - (window // 2)
    a = np.vander(pos, polyorder + 1, increasing=True)
    hat = a @ np.linalg.pinv(a)
    return tuple(tuple(float(v) for v in row) for row in hat)


def gaussian_radius(sigma: float, truncate: float = 4.0) -> int:
    return int(truncate * float(sigma) + 0.5)


@functools.lru_cache(maxsize=64)
def gaussian_weights(sigma: float, truncate: float = 4.0) -> tuple[float, ...]:
    """Normalised weights ``exp(-d^2 / (2 sigma^2))`` for ``d`` in ``[-radius, radius]``."""
    radius = gaussian_radius(sigma, truncate)
    d = np.arange(-radius, radius + 1, dtype=np.float64)
    w = np.exp(-0.5 / (float(sigma) ** 2) * d * d)
    w /= w.sum()
    return tuple(float(v) for v in w)


KEEP_FLOOR = 1e-16  # share of the old state that a step keeps at least: a reset, to double precision


@functools.lru_cache(maxsize=64)
def kalman_riccati(process_variance: float, measurement_variance: float) -> tuple[float, float, float, float]:
    """Closed form of the scalar random-walk filter's error variance.

    One step maps the variance ``p`` to ``r (p + q) / (p + q + r)``, a Moebius map with
    fixed points ``p+ >= 0 >= p-``. In the coordinate ``u = (p - p+) / (p - p-)`` a step is a
    multiplication, so ``p_i = p- + (p+ - p-) / (1 - u_0 rate**i)``. Returns ``(p-, span,
    u_0, log rate)`` for the start ``p_0 = 1``; needs ``q > 0`` and ``r > 0``. Where the fixed
    points nearly meet, ``1 - u_0`` is ``span / (1 - p-)``: use that for ``log u_0``.
    """
    q, r = float(process_variance), float(measurement_variance)
    span = math.sqrt(q * q + 4.0 * q * r)
    low, high = (-q - span) / 2.0, (-q + span) / 2.0
    return low, span, (1.0 - high) / (1.0 - low), math.log1p(max(-span / (r - low), KEEP_FLOOR - 1.0))


def kalman_gain(step: int, process_variance: float, measurement_variance: float) -> float:
    """Gain of step ``step >= 1`` (the Column form is in the Kalman operator)."""
    q, r = float(process_variance), float(measurement_variance)
    if r == 0:
        return 1.0
    if q == 0:
        return 1.0 / (r + step)
    low, span, u0, log_rate = kalman_riccati(q, r)
    grown = -math.expm1(math.log1p(-span / (1.0 - low)) + (step - 1) * log_rate) if u0 > 0 else 1.0 - u0 * math.exp((step - 1) * log_rate)
    p = low + span / grown + q
    return p / (p + r)


def kalman_block_rows(process_variance: float, measurement_variance: float, limit: int = 512, max_mass: float = 600.0) -> int:
    """Largest power-of-two block (<= limit) whose summed ``|log(1 - k)|`` stays below ``max_mass``.

    Keeps ``exp(-sum log(1 - k))`` inside double range for the in-block closed form. The
    gains are monotone in the step, so the worst block is the first or a settled one.
    """
    first = [-kalman_log_keep(kalman_gain(i, process_variance, measurement_variance)) for i in range(1, limit + 1)]
    settled = -kalman_log_keep(kalman_gain(1 << 40, process_variance, measurement_variance))
    size = limit
    while size > 1 and max(sum(first[:size]), size * settled) > max_mass:
        size //= 2
    return size


def kalman_log_keep(k: float) -> float:
    """``log(1 - k)``, floored so that a gain of 1 (a reset to the measurement) is finite."""
    return math.log(max(1.0 - k, KEEP_FLOOR)) if k > 0.5 else math.log1p(-k)


def median_kernel(kernel_size: int) -> int:
    k = int(kernel_size)
    return k if k % 2 == 1 else k + 1

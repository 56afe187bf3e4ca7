"""Tail probabilities of the chi-square and Student t distributions as column functions.

Tails are computed directly, never as one minus a distribution function, and in log space, so a
tiny p keeps its digits. They run on result rows, so per-segment tests are computed on executors: each function works on whole
arrays, and rows leave an iteration when their series has converged.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300
ROUNDING = 3e-16
STEPS = 20_000  # a series that has not converged by then gives no value
LARGE = 10_000.0  # from here on the expansion for large shapes is exact to rounding
# Taylor coefficients of the first two correction terms of that expansion, near the mean.
NEAR_FIRST = (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835)
NEAR_SECOND = (-1 / 540, -1 / 288, 1 / 378, -77 / 77760)
# Coefficients of Stirling's series of log gamma, in powers of 1 / z^2.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156, -3617 / 122400)
LAST_STEP = 1e-9  # of Newton's method, whose next one would be of the order of its square
SHIFT = 10  # log gamma is taken this far up, where the series is exact to rounding

Rule = Callable[..., np.ndarray]


def log_gamma(z: np.ndarray) -> np.ndarray:
    """log Gamma(z) for z > 0."""
    up = z + SHIFT
    square = 1 / (up * up)
    series = np.zeros_like(up)
    for c in reversed(STIRLING):
        series = series * square + c
    product = np.ones_like(z)
    lost = np.zeros_like(z)
    for k in range(SHIFT):
        # of a large z the factors are summed as logarithms, for their product might overflow
        product, lost = np.where(z < 1e20, product * (z + k), product), np.where(z < 1e20, lost, lost + np.log(z + k))
    return (up - 0.5) * np.log(up) - up + 0.5 * math.log(2 * math.pi) + series / up - np.log(product) - lost


def _iterated(arguments: tuple[np.ndarray, ...], start: Callable, step: Callable) -> np.ndarray:
    """Iterate rows side by side: ``start`` gives their states, ``step`` new states, the values so far and which rows are done.

    Rows that are not done after ``STEPS`` steps have no value.
    """
    out = np.full(len(arguments[0]), np.nan)
    rows = np.arange(len(out))
    state = start(*arguments)
    for k in range(1, STEPS):
        if not len(rows):
            break
        state, value, done = step(k, state, *arguments)
        if done.any():
            out[rows[done]] = value[done]
            left = ~done
            rows, arguments, state = rows[left], tuple(a[left] for a in arguments), tuple(s[left] for s in state)
    return out


def _away_from_zero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) > TINY, x, TINY)


def _gamma_series(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    def step(k, state, a, x):
        term = state[0] * x / (a + k)
        total = state[1] + term
        return (term, total), total, term < total * ROUNDING

    return _iterated((a, x), lambda a, x: (1 / a, 1 / a), step)


def _gamma_fraction(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    # modified Lentz evaluation of the continued fraction
    def start(a, x):
        d = 1 / _away_from_zero(x + 1 - a)
        return np.full(len(a), 1 / TINY), d, d

    def step(k, state, a, x):
        c, d, h = state
        part, b = -k * (k - a), x + 1 - a + 2 * k
        d = 1 / _away_from_zero(part * d + b)
        c = _away_from_zero(b + part / c)
        change = c * d
        return (c, d, h * change), h * change, np.abs(change - 1) < ROUNDING

    return _iterated((a, x), start, step)


def _chosen(rules: list[tuple[np.ndarray, Rule]], *arguments: np.ndarray) -> np.ndarray:
    """Each row by the first rule whose mask has it."""
    out = np.full(len(arguments[0]), np.nan)
    free = np.ones(len(out), bool)
    for mask, rule in rules:
        rows = np.flatnonzero(mask & free)
        free[rows] = False
        if len(rows):
            out[rows] = rule(*(a[rows] for a in arguments))
    return out


def _log_one_minus(log_part: np.ndarray) -> np.ndarray:
    return np.where(log_part < 0, np.log1p(-np.exp(np.minimum(log_part, 0.0))), -np.inf)


def log_gamma_tail(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """log Q(a, x), the regularised upper incomplete gamma function."""

    def scale(a, x):
        return a * np.log(x) - x - log_gamma(a)

    return _chosen(
        [
            (x <= 0, lambda a, x: np.zeros(len(a))),
            (a > LARGE, _log_gamma_tail_uniform),
            (x < a + 1, lambda a, x: _log_one_minus(scale(a, x) + np.log(_gamma_series(a, x)))),
            (np.ones(len(a), bool), lambda a, x: scale(a, x) + np.log(_gamma_fraction(a, x))),
        ],
        a,
        x,
    )


def _log_erfc(z: np.ndarray) -> np.ndarray:
    """log erfc(z), for z >= 0."""
    return log_gamma_tail(np.full(len(z), 0.5), z * z)


def _log_gamma_tail_uniform(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """log Q(a, x) by the uniform expansion for large ``a``: a normal tail and its correction, whose next term is of
    the order of 1 / a^2."""
    mu = (x - a) / a
    near = mu * mu * (1 / 2 - mu * (1 / 3 - mu * (1 / 4 - mu * (1 / 5 - mu / 6))))
    half_square = np.where(np.abs(mu) < 1e-3, near, mu - np.log1p(mu))
    eta = np.copysign(np.sqrt(2 * half_square), mu)
    close = np.abs(eta) < 0.03
    far_eta, far_mu = np.where(close, 1.0, eta), np.where(close, 1.0, mu)
    first = np.where(close, sum(c * eta**k for k, c in enumerate(NEAR_FIRST)), 1 / far_mu - 1 / far_eta)
    second = np.where(
        close, sum(c * eta**k for k, c in enumerate(NEAR_SECOND)), 1 / far_eta**3 - 1 / far_mu**3 - 1 / far_mu**2 - 1 / (12 * far_mu)
    )
    correction = (first + second / a) / np.sqrt(2 * math.pi * a)
    z = eta * np.sqrt(a / 2)
    log_erfc = _log_erfc(np.abs(z))
    above = -z * z + np.log(np.maximum(0.5 * np.exp(log_erfc + z * z) + correction, TINY))
    half = np.where(z >= 0, 0.5 * np.exp(log_erfc), 1 - 0.5 * np.exp(log_erfc))
    below = np.log(np.clip(half + np.exp(-z * z) * correction, TINY, 1.0))
    return np.where(z >= 0, above, below)


def log_beta_lower(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log I_x(a, b), the regularised incomplete beta function; ``y`` is ``1 - x``, given exactly."""

    def scale(a, b, x, y):
        log_x = np.where(y < 0.5, np.log1p(-np.minimum(y, 0.5)), np.log(x))
        log_y = np.where(x < 0.5, np.log1p(-np.minimum(x, 0.5)), np.log(y))
        return _log_gamma_ratio(a, b) - log_gamma(b) + a * log_x + b * log_y

    def upper(a, b, x, y):
        other = np.exp(scale(a, b, x, y)) * _beta_fraction(b, a, y) / b
        return np.where(other < 1, np.log1p(-np.minimum(other, 1 - 1e-16)), -np.inf)

    return _chosen(
        [
            (x <= 0, lambda a, b, x, y: np.full(len(a), -np.inf)),
            (y <= 0, lambda a, b, x, y: np.zeros(len(a))),
            (x < (a + 1) / (a + b + 2), lambda a, b, x, y: scale(a, b, x, y) + np.log(_beta_fraction(a, b, x) / a)),
            (np.ones(len(a), bool), upper),
        ],
        a,
        b,
        x,
        y,
    )


def _log_gamma_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log Gamma(a + b) - log Gamma(a), without the cancellation of two huge terms."""
    return np.where((a < 1000) | (b != 0.5), log_gamma(a + b) - log_gamma(a), 0.5 * np.log(a) - 1 / (8 * a) + 1 / (192 * a**3))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    def start(a, b, x):
        d = 1 / _away_from_zero(1 - (a + b) * x / (a + 1))
        return np.ones(len(a)), d, d

    def step(m, state, a, b, x):
        c, d, h = state
        for part in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / _away_from_zero(1 + part * d)
            c = _away_from_zero(1 + part / c)
            h = h * c * d
        return (c, d, h), h, np.abs(c * d - 1) < ROUNDING

    return _iterated((a, b, x), start, step)


def log_chi2_tails(x: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """log P(X > x) for chi-square variables."""
    return log_gamma_tail(dof / 2, x / 2)


def log_t_tails(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """log P(|T| > |t|) for Student t variables."""
    square = t * t
    # of many degrees t is normal up to terms of 1/dof**2, and the fraction would cancel
    normal = lambda s, d: log_chi2_tails(d * np.log1p(s / d) * (1 - 1 / (4 * d)) ** 2, np.ones(len(d)))
    beta = lambda s, d: log_beta_lower(d / 2, np.full(len(d), 0.5), d / (d + s), s / (d + s))
    return _chosen([(dof > 1e7, normal), (np.ones(len(dof), bool), beta)], square, dof)


def t_quantiles_upper(tail: float, dof: np.ndarray) -> np.ndarray:
    """The t with ``P(T > t) = tail`` for each number of degrees, for a tail below one half.

    Newton steps for the logarithm of the tail as a function of log t, in which it is concave: from the
    first step on they come closer from one side.
    """
    target = math.log(2 * tail)
    u = np.full(len(dof), math.log(max(normal_quantile(1 - tail), 1e-3)))
    log_front = np.where(dof > 1e7, -0.5 * math.log(2 * math.pi), _log_gamma_ratio(dof / 2, np.full(len(dof), 0.5)) - 0.5 * np.log(dof * math.pi))
    for _ in range(100):
        t = np.exp(u)
        tails = log_t_tails(t, dof)
        density = log_front - (dof + 1) / 2 * np.log1p(t * t / dof)
        step = (tails - target) / np.exp(np.log(2.0) + density + u - tails)
        u = u + np.clip(step, -5.0, 5.0)
        if not (np.abs(step) > LAST_STEP).any():
            break
    return np.exp(u)


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def log_chi2_tail(x: float, dof: float) -> float:
    return float(log_chi2_tails(np.array([float(x)]), np.array([float(dof)]))[0])


def log_t_two_sided(t: float, dof: float) -> float:
    return float(log_t_tails(np.array([float(t)]), np.array([float(dof)]))[0])


def t_quantile_upper(tail: float, dof: float) -> float:
    return float(t_quantiles_upper(tail, np.array([float(dof)]))[0])


def _rows(rule: Rule, *series: pd.Series) -> np.ndarray:
    """``rule`` over the rows whose inputs are all finite and whose last one, the degrees of freedom, is positive."""
    arrays = [s.to_numpy(float, na_value=np.nan) for s in series]
    good = np.logical_and.reduce([np.isfinite(a) for a in arrays]) & (np.nan_to_num(arrays[-1]) > 0)
    out = np.full(len(good), np.nan)
    if good.any():
        with np.errstate(all="ignore"):
            out[good] = rule(*(a[good] for a in arrays))
    return out


def _nullable(values: np.ndarray) -> pd.Series:
    return pd.Series(values).astype("object").where(~np.isnan(values), None)


def _test(rule: Rule, statistic: Column, dof: Column) -> Column:
    @F.pandas_udf("log10_p double, p double")
    def run(x: pd.Series, k: pd.Series) -> pd.DataFrame:
        logs = _rows(rule, x, k)
        return pd.DataFrame({"log10_p": _nullable(logs / math.log(10)), "p": _nullable(np.exp(logs))})

    return run(statistic.cast("double"), dof.cast("double"))


def chi2_test(statistic: Column, dof: Column) -> Column:
    """A struct of ``log10_p`` and ``p``, of one evaluation of the tail."""
    return _test(log_chi2_tails, statistic, dof)


def t_test(t: Column, dof: Column, alpha: float) -> Column:
    """A struct of ``log10_p``, ``p`` and ``critical``, the half-width of a ``1 - alpha`` interval in standard errors."""

    @F.pandas_udf("log10_p double, p double, critical double")
    def run(x: pd.Series, k: pd.Series) -> pd.DataFrame:
        logs = _rows(log_t_tails, x, k)

        def critical(dof: np.ndarray) -> np.ndarray:
            some, place = np.unique(dof, return_inverse=True)
            return t_quantiles_upper(alpha / 2, some)[place]

        return pd.DataFrame({"log10_p": _nullable(logs / math.log(10)), "p": _nullable(np.exp(logs)), "critical": _nullable(_rows(critical, k))})

    return run(t.cast("double"), dof.cast("double"))


def chi2_log10_p(statistic: Column, dof: Column) -> Column:
    return chi2_test(statistic, dof)["log10_p"]


def chi2_p(statistic: Column, dof: Column) -> Column:
    return chi2_test(statistic, dof)["p"]


def t_log10_p(t: Column, dof: Column) -> Column:
    return t_test(t, dof, 0.05)["log10_p"]


def t_p(t: Column, dof: Column) -> Column:
    return t_test(t, dof, 0.05)["p"]


def t_critical(dof: Column, alpha: float) -> Column:
    """The half-width of a ``1 - alpha`` interval, in standard errors."""
    return t_test(F.lit(0.0), dof, alpha)["critical"]

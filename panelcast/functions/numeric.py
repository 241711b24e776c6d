"""Numeric expressions: guarded ratios, power transform, normal distribution."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the power used for the price series in the published workflow.
BOX_COX_LAMBDA = 0.40136288976843615

# Abramowitz & Stegun 26.2.17, normal distribution function.
CDF_P = 0.2316419
CDF_B = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]

# Wichura (1988), algorithm AS 241 (PPND7), inverse normal.
PPND_A = [3.3871327179e0, 5.0434271938e1, 1.5929113202e2, 5.9109374720e1]
PPND_B = [1.0, 1.7895169469e1, 7.8757757664e1, 6.7187563600e1]
PPND_C = [1.4234372777e0, 2.7568153900e0, 1.3067284816e0, 1.7023821103e-1]
PPND_D = [1.0, 7.3700164250e-1, 1.2021132975e-1]
PPND_E = [6.6579051150e0, 3.0812263860e0, 4.2868294337e-1, 1.7337203997e-2]
PPND_F = [1.0, 2.4197894225e-1, 1.2258202635e-2]
PPND_SPLIT1 = 0.425
PPND_SPLIT2 = 5.0
PPND_CONST1 = 0.180625
PPND_CONST2 = 1.6


def safe_ratio(a: Column, b: Column) -> Column:
    """NULL instead of an error or infinity when the divisor is zero."""
    return F.try_divide(a, b)


def box_cox(v: Column, lam: float = BOX_COX_LAMBDA) -> Column:
    """NULL for values that are not positive."""
    out = F.log(v) if lam == 0 else (F.pow(v, F.lit(lam)) - 1) / lam
    return F.when(v > 0, out)


def inv_box_cox(v: Column, lam: float = BOX_COX_LAMBDA) -> Column:
    if lam == 0:
        return F.exp(v)
    base = v * lam + 1
    return F.when(base > 0, F.pow(base, F.lit(1 / lam)))


def _horner(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + c
    return out


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, absolute error below 1e-7."""
    a = F.abs(z)
    t = 1 / (1 + CDF_P * a)
    tail = F.exp(-a * a / 2) / 2.5066282746310002 * _horner([0.0, *CDF_B], t)
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, about 7 digits."""
    q = p - 0.5
    r1 = PPND_CONST1 - q * q
    middle = q * _horner(PPND_A, r1) / _horner(PPND_B, r1)
    r = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1 - p)))
    near = _horner(PPND_C, r - PPND_CONST2) / _horner(PPND_D, r - PPND_CONST2)
    far = _horner(PPND_E, r - PPND_SPLIT2) / _horner(PPND_F, r - PPND_SPLIT2)
    outer = F.when(r <= PPND_SPLIT2, near).otherwise(far)
    signed = F.when(q < 0, -outer).otherwise(outer)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= PPND_SPLIT1, middle).otherwise(signed))

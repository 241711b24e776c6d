"""Least squares per series in one aggregate pass.

Every product sum is an ordinary ``sum``, so Spark adds up inside the tasks
before the shuffle and a hot series costs no more than any other.  What is left
is one row per series with a small matrix; numpy solves it inside the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Groups whose matrices a task holds at a time.
HELD_GROUPS = 2_000
FIT = "beta array<double>, se array<double>, t array<double>, sse double"


def solve_gram(gram: np.ndarray, moments: np.ndarray, yy: float, n: float, ridge: np.ndarray | None = None):
    """Coefficients, standard errors, t values and error sum from the normal equations; columns of zeros take no part."""
    scale = np.sqrt(np.diag(gram))
    k = int((scale > 0).sum())
    scale[scale == 0] = 1.0
    a = gram / np.outer(scale, scale)
    if ridge is not None:
        a = a + np.diag(ridge / scale**2)
    if n < k and ridge is None:
        return None
    inverse = np.linalg.pinv(a, hermitian=True, rcond=1e-12)
    beta = inverse @ (moments / scale) / scale
    sse = max(float(yy - 2 * beta @ moments + beta @ gram @ beta), 0.0)
    dof = n - k
    if dof > 0:
        se = np.sqrt(sse / dof * np.diag(inverse)) / scale
        with np.errstate(divide="ignore", invalid="ignore"):
            t = beta / se
    else:
        se = np.full(len(scale), np.nan)
        t = np.full(len(scale), np.nan)
    return beta, se, t, sse


def _unpack(upper: np.ndarray, k: int) -> np.ndarray:
    gram = np.zeros((k, k))
    gram[np.triu_indices(k)] = upper
    return gram + np.triu(gram, 1).T


def _solver(k: int, intercept: bool, ridge: Sequence[float] | None):
    @F.pandas_udf(FIT)
    def solve(upper: pd.Series, moments: pd.Series, yy: pd.Series, n: pd.Series, shift: pd.Series) -> pd.DataFrame:
        rows = []
        for u, m, y2, count, s in zip(upper, moments, yy, n, shift):
            r = np.asarray(ridge, dtype=float) if ridge is not None else None
            got = solve_gram(_unpack(np.asarray(u, dtype=float), k), np.asarray(m, dtype=float), y2, count, r)
            if got is None:
                rows.append((None, None, None, None))
                continue
            beta, se, t, sse = got
            if intercept:
                # Regressors and target were shifted by rough centres; put the level back.
                s = np.asarray(s, dtype=float)
                beta = beta.copy()
                beta[0] += s[-1] - beta[1:] @ s[:-1]
            rows.append((beta.tolist(), se.tolist(), t.tolist(), sse))
        return pd.DataFrame(rows, columns=["beta", "se", "t", "sse"])

    return solve


def gram_sums(
    df: DataFrame, xs: Sequence[str], y: str, *, keys: Sequence[str] = ("series_id",), intercept: bool = True
) -> DataFrame:
    """One row per group with the product sums of a regression, added up inside the tasks first.

    With a constant the sums are those of columns centred by their group mean
    (built-in covariances), which keeps them well scaled.
    """
    names = [*xs, y]
    zs = [f"`{c}`" for c in names]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    k = len(xs)

    def cross(a: str, b: str) -> str:
        return f"covar_pop({a}, {b}) * count(1)" if intercept else f"sum({a} * {b})"

    inner = [cross(zs[i], zs[j]) for i in range(k) for j in range(i, k)]
    upper = (["cast(count(1) AS double)", *["0.0D"] * k] if intercept else []) + inner
    moments = (["0.0D"] if intercept else []) + [cross(z, zs[-1]) for z in zs[:-1]]
    shift = ", ".join(f"avg({z})" for z in zs) if intercept else "0.0D"
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"array({', '.join(upper)})").alias("_upper"),
        F.expr(f"array({', '.join(moments)})").alias("_moments"),
        F.expr(cross(zs[-1], zs[-1])).alias("_yy"),
        F.expr(f"array({shift})").alias("_shift"),
    )


def vector_sums(rows: DataFrame, k: int, *, keys: Sequence[str] = ("series_id",), fixed: int = 0, limit: str | None = None) -> DataFrame:
    """:func:`gram_sums` (with a constant) of many columns in one array ``z``: ``k`` regressors, then the target.

    Hundreds of aggregates would be one huge plan, so tasks add up matrices.  A task keeps count, means and centred
    products of each group it meets and gives them back at its end, or when it holds ``HELD_GROUPS``; so a group comes
    together from one small row per task.  Of the regressors behind the first ``fixed`` only as many take part as the
    column ``limit`` says, the others are zero.  Rows that lack a value taking part are left out.
    """
    rows = rows.select(*keys, (F.lit(k - fixed) if limit is None else F.col(limit)).cast("int").alias("_limit"), "z")
    keys = list(keys)
    head = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)

    def joined(a, b):
        if a is None:
            return b
        (n, m, c), (n2, m2, c2) = a, b
        d = m2 - m
        return n + n2, m + d * (n2 / (n + n2)), c + c2 + np.outer(d, d) * (n * n2 / (n + n2))

    def flat(held: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(held), columns=keys)
        return out.assign(n=[int(s[0]) for s in held.values()], mean=[s[1] for s in held.values()], cross=[s[2].ravel() for s in held.values()])

    def parts(batches):
        held: dict = {}
        for pdf in batches:
            z = np.array(pdf["z"].tolist(), dtype=float).reshape(len(pdf), k + 1)
            place = np.arange(k + 1) - fixed + 1
            out = (place > pdf["_limit"].to_numpy()[:, None]) & (np.arange(k + 1) < k)
            z[out] = 0.0
            whole = ~np.isnan(z).any(axis=1)
            pdf, z = pdf[whole], z[whole]
            for key, at in pdf.groupby(keys, dropna=False, sort=False).indices.items():
                own = z[at]
                mean = own.mean(axis=0)
                key = key if isinstance(key, tuple) else (key,)
                held[key] = joined(held.get(key), (len(own), mean, (own - mean).T @ (own - mean)))
            if len(held) >= HELD_GROUPS:
                yield flat(held)
                held = {}
        if held:
            yield flat(held)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for n, mean, cross in zip(pdf["n"], pdf["mean"], pdf["cross"]):
            total = joined(total, (n, np.asarray(mean), np.asarray(cross).reshape(k + 1, k + 1)))
        n, mean, cross = total
        upper = np.concatenate([[float(n)], np.zeros(k), cross[:k, :k][np.triu_indices(k)]])
        made = {"n": int(n), "_upper": [upper], "_moments": [np.concatenate([[0.0], cross[:k, k]])], "_yy": float(cross[k, k]), "_shift": [mean]}
        return pdf[keys].iloc[:1].reset_index(drop=True).assign(**made)

    small = rows.mapInPandas(parts, f"{head}, n bigint, mean array<double>, cross array<double>")
    return small.groupBy(*keys).applyInPandas(merged, f"{head}, n bigint, _upper array<double>, _moments array<double>, _yy double, _shift array<double>")


def ols_fit(
    df: DataFrame,
    xs: Sequence[str],
    y: str,
    *,
    keys: Sequence[str] = ("series_id",),
    intercept: bool = True,
    ridge: Sequence[float] | None = None,
) -> DataFrame:
    """Per group: ``n``, ``beta`` (constant first if asked), ``se``, ``t``, ``sse``.

    Rows with a NULL in any column are left out.  Fewer rows than coefficients
    give NULLs.  With a constant, ``se`` and ``t`` of the constant refer to the
    centred model.
    """
    return solved(gram_sums(df, xs, y, keys=keys, intercept=intercept), len(xs), keys=keys, intercept=intercept, ridge=ridge)


def solved(sums: DataFrame, k: int, *, keys: Sequence[str] = ("series_id",), intercept: bool = True, ridge: Sequence[float] | None = None) -> DataFrame:
    """The regression of product sums: ``n``, ``beta``, ``se``, ``t``, ``sse`` per group."""
    solve = _solver(k + int(intercept), intercept, ridge)
    fit = solve("_upper", "_moments", "_yy", F.col("n").cast("double"), "_shift")
    return sums.withColumn("_fit", fit).select(*keys, "n", "_fit.beta", "_fit.se", "_fit.t", "_fit.sse")


def best_nested(sums: DataFrame, least: int, k: int) -> DataFrame:
    """Add ``extra``: how many regressors behind the first ``least`` give the least AIC; ``_limit`` bounds it.

    All are fitted from the product sums of the largest regression (the constant counts among the first).  NULL if none
    can be fitted.
    """

    @F.pandas_udf("int")
    def choose(upper: pd.Series, moments: pd.Series, yy: pd.Series, n: pd.Series, limit: pd.Series) -> pd.Series:
        out = []
        for u, m, y2, count, most in zip(upper, moments, yy, n, limit):
            gram, mom = _unpack(np.asarray(u, dtype=float), k), np.asarray(m, dtype=float)
            aic = []
            for extra in range(int(most) + 1):
                size = least + extra
                got = solve_gram(gram[:size, :size], mom[:size], y2, count)
                if got is not None and got[3] > 0:
                    aic.append((count * np.log(got[3] / count) + 2 * size, extra))
            out.append(min(aic)[1] if aic else None)
        return pd.Series(out, dtype="Int32")

    return sums.withColumn("extra", choose("_upper", "_moments", "_yy", F.col("n").cast("double"), "_limit"))


def linear_predictor(beta: Column, xs: Sequence[str], intercept: bool = True) -> Column:
    """beta' x as a column expression."""
    out = beta[0] if intercept else F.lit(0.0)
    for i, x in enumerate(xs):
        out = out + beta[i + int(intercept)] * F.col(x)
    return out

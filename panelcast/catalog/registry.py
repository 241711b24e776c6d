"""Registration of queries and the rounding both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelcast.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PLACES: dict[str, int] = {}

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to ``digits`` places (the last bits of a sum depend on its order), integers to bigint."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            # Adding zero turns -0.0 into 0.0.
            out.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a callable (spark, folder) -> DataFrame and, if given, its SQL twin."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(prepare(spark), sf_dir), digits)

        run.__name__ = name
        QUERIES[name] = run
        PLACES[name] = digits
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap

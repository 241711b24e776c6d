"""Exact quantiles per group for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def bounded_quantiles(value: Column, probs: Sequence[float]) -> Column:
    """Linear-interpolated quantiles as an array; for groups with a known bound.

    ``percentile`` keeps the distinct values of a group in memory, so use it
    where the group is at most one value per grid step or per past day.
    """
    return F.percentile(value, F.array(*[F.lit(float(p)) for p in probs]))


def value_place(v: Column) -> Column:
    """A bigint in the order of the values: sign, binary exponent and 28 bits of the fraction.

    Equal steps of it are equal relative steps of the value, so one outlier does not crowd the others together.
    """
    a = F.abs(v)
    exponent = F.floor(F.log2(a))
    # The logarithm may round up just below a power of two; the fraction is kept inside 0..1 then.
    fraction = F.greatest(F.least(a / F.pow(F.lit(2.0), exponent) - 1, F.lit(1 - 2.0**-30)), F.lit(0.0))
    place = (exponent + 1100) * F.lit(1 << 28) + F.floor(fraction * F.lit(float(1 << 28))) + 1
    place = F.when(a == 0, 0).when(a == float("inf"), F.lit(1 << 42)).otherwise(place).cast("bigint")
    return F.when(v < 0, -place).otherwise(place)


def _counted_bins(rows: DataFrame, keys: Sequence[str], bin_: str) -> DataFrame:
    """Rows per bin, with ``_base``, how many rows of the group are in lower bins (on top of the group's own base)."""
    before = Window.partitionBy(*keys).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, bin_).agg(F.sum("_c").alias("_bc"), F.max("_below").alias("_below"))
    return counts.withColumn("_base", F.col("_below") + F.coalesce(F.sum("_bc").over(before), F.lit(0)))


def ordered_counts(freq: DataFrame, keys: Sequence[str], wanted: Sequence[float] | None = None) -> DataFrame:
    """Add ``n`` (rows of the group) and ``_start`` (rows with a smaller value) to distinct values ``_v`` with counts ``_c``.

    Two levels of bins come first, so nothing but the values of one narrow bin is sorted together, however many
    rows the group has and however unevenly its values lie.  ``wanted`` (shares of n - 1) keeps only the bins that
    hold the order statistics next to them.
    """
    keys = list(keys)
    fine = 1 << 16
    rows = freq.withColumn("_p", value_place(F.col("_v"))).withColumn("_below", F.lit(0).cast("bigint"))
    rows = rows.withColumns({"_b1": F.floor(F.col("_p") / fine), "_b2": F.pmod(F.col("_p"), F.lit(fine))}).drop("_p")

    def held() -> Column:
        if wanted is None:
            return F.lit(True)
        out = F.lit(False)
        for share in wanted:
            place = (F.col("n") - 1) * F.lit(float(share))
            out = out | ((F.ceil(place) >= F.col("_base")) & (F.floor(place) < F.col("_base") + F.col("_bc")))
        return out

    total = F.sum("_bc").over(Window.partitionBy(*keys))
    first = _counted_bins(rows, keys, "_b1").withColumn("n", total).where(held())
    rows = rows.drop("_below").join(first.select(*keys, "_b1", "n", F.col("_base").alias("_below")), [*keys, "_b1"])
    sizes = rows.groupBy(*keys, "_b1", "_b2").agg(F.max("n").alias("n"))
    second = _counted_bins(rows, [*keys, "_b1"], "_b2").join(sizes, [*keys, "_b1", "_b2"]).where(held())
    rows = rows.drop("_below").join(second.select(*keys, "_b1", "_b2", "_base"), [*keys, "_b1", "_b2"])
    inside = Window.partitionBy(*keys, "_b1", "_b2").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("_c").over(inside), F.lit(0))
    return rows.withColumn("_start", start).select(*keys, "_v", "_c", "n", "_start")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``_v, _c``: the distinct known values of each group and how often they occur."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(
    df: DataFrame, probs: Sequence[float], *, keys: Sequence[str] = ("series_id",), value: str = "value"
) -> DataFrame:
    """One row per group: ``n`` and ``q``, the array of quantiles in the order of ``probs``.

    Equal values are counted first; bins find the wanted order statistics, and only those bins are sorted, each on
    its own.
    """
    keys = list(keys)
    ordered = ordered_counts(value_counts(df, keys, value), keys, probs)
    places = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_c"))

    picks = []
    for j, place in enumerate(places):
        picks.append(F.max(F.when(holds(F.floor(place)), F.col("_v"))).alias(f"_a{j}"))
        picks.append(F.max(F.when(holds(F.ceil(place)), F.col("_v"))).alias(f"_b{j}"))
    found = ordered.groupBy(*keys, "n").agg(*picks)
    q = [
        F.col(f"_a{j}") + (F.col(f"_b{j}") - F.col(f"_a{j}")) * (place - F.floor(place))
        for j, place in enumerate(places)
    ]
    return found.select(*keys, "n", F.array(*q).alias("q"))


#: Copies of a value that one row of the intermediate table stands for.
COPIES = 4_096


def ranked_values(df: DataFrame, *, keys: Sequence[str] = ("series_id",), value: str = "value") -> DataFrame:
    """``n, i, value``: every known value of a group with its rank 1..n; equal values take consecutive ranks.

    The ranks of equal values follow from their count, so even one value in most rows is never sorted.
    """
    keys = list(keys)
    ordered = ordered_counts(value_counts(df, keys, value), keys)
    parts = ordered.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / COPIES))))
    before = F.col("_part") * COPIES
    copies = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES), F.col("_c") - before))
    rows = parts.withColumn("_k", F.explode(copies))
    return rows.select(*keys, "n", (F.col("_start") + before + F.col("_k")).cast("bigint").alias("i"), F.col("_v").alias("value"))

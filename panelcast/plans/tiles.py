"""Windows over long series without putting one series into one task.

``PARTITION BY series_id`` sends a whole series to one task, so a series that
holds a third of the data would stall the job.  The helpers here cut a series
into tiles and shuffle on ``(series, tile)``:

* :func:`over_tiles` - window functions of finite reach.  Rows near a tile's
  edge are copied into the neighbour (the halo) and dropped afterwards.
  :func:`lag_steps` and :func:`lead_steps` inside it don't reach over gaps.
* :func:`positions`, :func:`previous_row` - row number and previous row of an
  irregular panel.  Small per-tile summaries carry what crosses an edge.
* :func:`attach` - bring a one-row-per-series table to every row, joining on
  ``(series, tile)`` so that the join is not skewed either.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelcast.plans.grid import DAY, Step, grid_index

TILE_ROWS = 65_536

Keys = Sequence[str]


def over_tiles(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    *,
    step: Step | None = None,
    index: str | None = None,
    back: int = 0,
    ahead: int = 0,
    keys: Keys = ("series_id",),
    ts: str = "ts",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``ahead`` rows on.

    The panel must be regular on ``step`` (see ``regularize``), or ``index``
    names a column with the row number of each row in its series.  One shuffle.
    """
    size = max(tile_rows, 2 * (back + ahead), 1)
    i = F.col(index) if index else grid_index(F.col(ts), step)
    t = df.withColumn("_i", i)
    first = F.floor((F.col("_i") - ahead) / size)
    last = F.floor((F.col("_i") + back) / size)
    t = t.withColumn("_home", F.floor(F.col("_i") / size))
    if back or ahead:
        t = t.withColumn("_tile", F.explode(F.sequence(first, last)))
    else:
        t = t.withColumn("_tile", F.col("_home"))
    w = Window.partitionBy(*keys, "_tile").orderBy("_i")
    t = t.select("*", *[c.alias(n) for n, c in columns(w).items()])
    return t.where(F.col("_tile") == F.col("_home")).drop("_i", "_home", "_tile")


def lag_steps(c: Column | str, k: int, w: WindowSpec) -> Column:
    """Inside :func:`over_tiles`: the value exactly ``k`` steps before, NULL if that step is missing.

    ``F.lag`` counts rows; over a gap it would give a value of longer ago.
    """
    if k == 0:
        return F.col(c) if isinstance(c, str) else c
    return F.when(F.lag("_i", k).over(w) == F.col("_i") - k, F.lag(c, k).over(w))


def lead_steps(c: Column | str, k: int, w: WindowSpec) -> Column:
    """As :func:`lag_steps`, ``k`` steps after."""
    if k == 0:
        return F.col(c) if isinstance(c, str) else c
    return F.when(F.lead("_i", k).over(w) == F.col("_i") + k, F.lead(c, k).over(w))


def time_tile(df: DataFrame, tile_seconds: int = DAY, ts: str = "ts") -> DataFrame:
    return df.withColumn("_tile", grid_index(F.col(ts), tile_seconds))


def row_tile(df: DataFrame, step: Step, tile_rows: int = TILE_ROWS, ts: str = "ts") -> DataFrame:
    return df.withColumn("_tile", F.floor(grid_index(F.col(ts), step) / tile_rows))


def _tiled_once(df: DataFrame, keys: Keys, ts: str, tile_seconds: int) -> DataFrame:
    """Rows dealt by (series, tile).  The rows and their per-tile summary read this one shuffle, and the source once.

    Rows without series or time belong to no tile; the join of both would leave them out as well.
    """
    t = time_tile(df, tile_seconds, ts)
    for c in (*keys, "_tile"):
        t = t.where(F.col(c).isNotNull())
    return t.repartition(*keys, "_tile")


def _tile_summary(t: DataFrame, keys: Keys, *aggregates: Column) -> DataFrame:
    """One row per tile of :func:`_tiled_once`.

    It counts every column too, so that none is pruned and the shuffle stays the same as that of the rows.
    """
    others = [c for c in t.columns if c not in (*keys, "_tile")]
    counts = {f"_n{i}": F.count(F.col(c)) for i, c in enumerate(others)}
    out = t.groupBy(*keys, "_tile").agg(*aggregates, *[c.alias(n) for n, c in counts.items()])
    return out.where(" AND ".join(f"{n} >= 0" for n in counts)).drop(*counts)


def positions(
    df: DataFrame, *, keys: Keys = ("series_id",), ts: str = "ts", tile_seconds: int = DAY
) -> DataFrame:
    """Add ``pos`` (1-based row number by time) and ``n`` (rows of the series)."""
    t = _tiled_once(df, keys, ts, tile_seconds)
    counts = _tile_summary(t, keys, F.count(F.lit(1)).alias("_rows"))
    series = Window.partitionBy(*keys)
    before = series.orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_tile",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(series).alias("n"),
    )
    inside = Window.partitionBy(*keys, "_tile").orderBy(ts)
    return (
        t.join(offsets, [*keys, "_tile"])
        .withColumn("pos", F.col("_offset") + F.row_number().over(inside))
        .drop("_tile", "_offset")
    )


def regular_positions(df: DataFrame, step: Step, *, keys: Keys = ("series_id",), ts: str = "ts") -> DataFrame:
    """``pos`` and ``n`` of a regular panel: arithmetic on the grid index, one shuffle, no join."""
    series = Window.partitionBy(*keys)
    t = df.withColumn("_i", grid_index(F.col(ts), step))
    first, last = F.min("_i").over(series), F.max("_i").over(series)
    return t.withColumns({"pos": F.col("_i") - first + 1, "n": last - first + 1}).drop("_i")


def previous_row(
    df: DataFrame, names: Sequence[str], *, keys: Keys = ("series_id",), ts: str = "ts", tile_seconds: int = DAY
) -> DataFrame:
    """Add ``prev_<name>``: the value in the row before, also across tile edges."""
    t = _tiled_once(df, keys, ts, tile_seconds)
    tails = _tile_summary(t, keys, *[F.max_by(n, ts).alias(f"_v_{n}") for n in names])
    order = Window.partitionBy(*keys).orderBy("_tile")
    carried = tails.select(*keys, "_tile", *[F.lag(f"_v_{n}").over(order).alias(f"_v_{n}") for n in names])
    inside = Window.partitionBy(*keys, "_tile").orderBy(ts)
    t = t.join(carried, [*keys, "_tile"]).withColumn("_rn", F.row_number().over(inside))
    for n in names:
        edge = F.col(f"_v_{n}")
        t = t.withColumn(f"prev_{n}", F.when(F.col("_rn") == 1, edge).otherwise(F.lag(n).over(inside)))
    return t.drop("_tile", "_rn", *[f"_v_{n}" for n in names])


def attach(
    df: DataFrame,
    per_series: DataFrame,
    *,
    keys: Keys = ("series_id",),
    how: str = "inner",
    source: DataFrame | None = None,
) -> DataFrame:
    """Join a one-row-per-series table to a frame that carries ``_tile``.

    ``source`` is a cheaper frame with the same tiles, to list them from.
    """
    tiles = (df if source is None else source).select(*keys, "_tile").distinct()
    return df.join(tiles.join(per_series, list(keys)), [*keys, "_tile"], how)


def join_series(df: DataFrame, per_series: DataFrame, *, keys: Keys = ("series_id",), how: str = "inner") -> DataFrame:
    """Join a one-row-per-series table to a regular panel.

    A regular series has at most one row per step.  So either there are few
    series, and adaptive execution broadcasts the small table it has measured,
    or there are many and none of them is large: a shuffle on the key is even.
    """
    return df.join(per_series, list(keys), how)


def merge_tables(tables: Sequence[DataFrame], *, keys: Keys = ("series_id",)) -> DataFrame:
    """Put one-row-per-series tables side by side: one union and one aggregate instead of a chain of joins."""
    names = list(dict.fromkeys(c for t in tables for c in t.columns if c not in keys))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def running_sum(
    df: DataFrame,
    column: str,
    out: str,
    *,
    step: Step,
    keys: Keys = ("series_id",),
    ts: str = "ts",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Add the running total of ``column``: in-tile totals plus the total of earlier tiles."""
    t = row_tile(df, step, tile_rows, ts)
    totals = t.groupBy(*keys, "_tile").agg(F.sum(column).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_tile", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_tile").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("_offset") + F.coalesce(F.sum(column).over(inside), F.lit(0))
    return t.join(offsets, [*keys, "_tile"]).withColumn(out, total).drop("_tile", "_offset")


def runs(
    df: DataFrame, state: Column, *, step: Step, keys: Keys = ("series_id",), ts: str = "ts", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Add ``run``: the number of the stretch of equal ``state`` a row belongs to.

    A run may cross any number of tiles; group by the keys and ``run`` to measure it.
    """
    marked = df.withColumn("_state", state)
    same = F.lag("_state")

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {"_start": F.when(same.over(w).eqNullSafe(F.col("_state")), 0).otherwise(1)}

    starts = over_tiles(marked, columns, step=step, back=1, keys=keys, ts=ts, tile_rows=tile_rows)
    return running_sum(starts, "_start", "run", step=step, keys=keys, ts=ts, tile_rows=tile_rows).drop(
        "_state", "_start"
    )

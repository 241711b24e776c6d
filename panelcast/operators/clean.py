"""Selection, cleaning and shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.calendar import time_features as calendar_columns
from panelcast.plans.grid import Step, grid_index, grid_time, seconds_between
from panelcast.plans.tiles import TILE_ROWS, positions, previous_row, regular_positions, row_tile
from panelcast.schema import require_columns

CELL_AGGREGATES = {
    "sum": lambda v, ts: F.sum(v),
    "mean": lambda v, ts: F.avg(v),
    "last": lambda v, ts: F.max_by(v, ts),
}


def to_cells(df: DataFrame, step: Step, agg: str = "sum", *, seen: bool = False) -> DataFrame:
    """Aggregate an irregular panel into grid cells; partial sums before the shuffle.

    ``seen`` adds ``_seen``, the last time in the cell.
    """
    made = [CELL_AGGREGATES[agg](F.col("value"), F.col("ts")).alias("value")]
    if seen:
        made.append(F.max("ts").alias("_seen"))
    return df.groupBy("series_id", grid_index(F.col("ts"), step).alias("_cell")).agg(*made)


def regularize(
    df: DataFrame,
    step: Step,
    *,
    agg: str = "sum",
    span: str = "series",
    start: str | None = None,
    end: str | None = None,
    fill: float | None = None,
    drop_partial: bool = False,
    resolution: float = 1.0,
) -> DataFrame:
    """Reindex to a fixed grid; absent steps become rows with NULL (or ``fill``).

    ``span`` is ``series`` (each from its own first to last cell) or ``panel``
    (all from the panel's first to last cell); ``start`` and ``end`` override
    it.  ``drop_partial`` leaves out the panel's last cell unless it has ended:
    the last time seen in it is ``resolution`` seconds or less from its end (a
    day for dates).  Afterwards a series has at most one row per step, whatever
    number of raw rows it had; operators that read lags need this first.  Rows
    without series or time belong nowhere and are left out.
    """
    require_columns(df, "series_id", "ts", "value")
    if span not in ("series", "panel"):
        raise ValueError("span is 'series' or 'panel'")
    # Spans come from the cells.  Every branch reads all columns of a cell, and the filters that the join below would
    # add to its side are on all of them, so the plan has one scan and one shuffle of raw rows, which the others reuse.
    placed = F.col("series_id").isNotNull() & grid_index(F.col("ts"), step).isNotNull()
    cells = to_cells(df.where(placed), step, agg, seen=True)
    spans = cells.groupBy("series_id").agg(
        F.min("_cell").alias("_lo"), F.max("_cell").alias("_hi"), F.max("_seen").alias("_seen"), F.count("value").alias("_known")
    ).where("_known >= 0 AND _seen IS NOT NULL")
    if span == "panel" or drop_partial:
        # One row, whatever the data.
        bounds = spans.agg(F.min("_lo").alias("_first"), F.max("_hi").alias("_last"), F.max("_seen").alias("_latest"))
        spans = spans.crossJoin(F.broadcast(bounds))
        if drop_partial:
            ended = seconds_between(grid_time(F.col("_last") + 1, step), F.col("_latest")) <= resolution
            whole = F.when(ended, F.col("_last")).otherwise(F.col("_last") - 1)
            spans = spans.withColumns({"_last": whole, "_hi": F.least("_hi", whole)})
        if span == "panel":
            spans = spans.withColumns({"_lo": F.col("_first"), "_hi": F.col("_last")})
    if start is not None:
        spans = spans.withColumn("_lo", grid_index(F.lit(start).cast("timestamp_ntz"), step))
    if end is not None:
        spans = spans.withColumn("_hi", grid_index(F.lit(end).cast("timestamp_ntz"), step))

    grid = spans.where("_lo <= _hi").select("series_id", F.explode(F.sequence("_lo", "_hi")).alias("_cell"))
    value = F.col("value") if fill is None else F.coalesce("value", F.lit(float(fill)))
    return grid.join(cells.where("_seen IS NOT NULL"), ["series_id", "_cell"], "left").select(
        "series_id", grid_time(F.col("_cell"), step).alias("ts"), value.alias("value")
    )


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count and percentage of missing entries."""
    names = list(columns or df.columns)
    rows = F.count(F.lit(1))
    packed = []
    for n in names:
        gone = F.count_if(F.col(n).isNull())
        pct = F.try_divide(gone * 100.0, rows)
        packed.append(F.struct(F.lit(n).alias("column"), gone.alias("n_missing"), pct.alias("missing_pct")))
    return df.agg(F.array(*packed).alias("_m")).select(F.inline("_m"))


def negative_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("value") < 0).alias("n_negative"))


def _neighbours(df: DataFrame, step: Step, tile_rows: int) -> DataFrame:
    """Add ``_prev`` and ``_next``: nearest known (ts, value) at or before / after each row.

    A tile's first and last known points travel through the small tile table, so
    a gap may be longer than a tile.
    """
    known_ts = F.when(F.col("value").isNotNull(), F.col("ts"))
    t = row_tile(df, step, tile_rows).withColumn("_at", known_ts)
    tiles = t.groupBy("series_id", "_tile").agg(
        F.min("_at").alias("_head_ts"),
        F.min_by("value", "_at").alias("_head_value"),
        F.max("_at").alias("_tail_ts"),
        F.max_by("value", "_at").alias("_tail_value"),
    )

    def point(at: str, value: str) -> Column:
        return F.when(F.col(at).isNotNull(), F.struct(F.col(at).alias("ts"), F.col(value).alias("value")))

    tiles = tiles.withColumns(
        {"_head": point("_head_ts", "_head_value"), "_tail": point("_tail_ts", "_tail_value")}
    )
    t = t.withColumn("_known", point("_at", "value"))
    order = Window.partitionBy("series_id").orderBy("_tile")
    edges = tiles.select(
        "series_id",
        "_tile",
        F.last("_tail", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_head", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    inside = Window.partitionBy("series_id", "_tile").orderBy("ts")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    onward = inside.rowsBetween(0, Window.unboundedFollowing)
    return t.join(edges, ["series_id", "_tile"]).select(
        *df.columns,
        F.coalesce(F.last("_known", ignorenulls=True).over(upto), F.col("_before")).alias("_prev"),
        F.coalesce(F.first("_known", ignorenulls=True).over(onward), F.col("_after")).alias("_next"),
    )


def interpolate_time(df: DataFrame, step: Step, *, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Fill gaps on a straight line in elapsed time.

    A gap at the end takes the last known value; a gap at the start stays NULL.
    """
    n = _neighbours(df, step, tile_rows)
    weight = F.try_divide(
        seconds_between(F.col("ts"), F.col("_prev.ts")), seconds_between(F.col("_next.ts"), F.col("_prev.ts"))
    )
    line = F.col("_prev.value") + (F.col("_next.value") - F.col("_prev.value")) * weight
    filled = F.coalesce(F.col("value"), line, F.col("_prev.value"))
    return n.withColumn("value", filled).drop("_prev", "_next")


def ffill_bfill(df: DataFrame, step: Step, *, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Last known value; before the first known value, the first one."""
    n = _neighbours(df, step, tile_rows)
    return n.withColumn("value", F.coalesce("value", "_prev.value", "_next.value")).drop("_prev", "_next")


def coerce_numeric(df: DataFrame, value: str = "value") -> DataFrame:
    """Text that is no number becomes NULL and is dropped, as are NaN and NULL."""
    number = F.expr(f"try_cast(`{value}` AS double)")
    return df.withColumn(value, number).where(F.col(value).isNotNull() & ~F.isnan(value))


def last_window(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Rows of the last ``weeks`` weeks of each series, limits included.

    The last time of each series comes from a partial aggregate, and with it
    the days of the window; joining on days keeps a hot series spread over tasks.
    """
    days = df.withColumn("_tile", F.to_date("ts"))
    last = df.groupBy("series_id").agg(F.max("ts").alias("_last"))
    cut = last.select("series_id", "_last", (F.col("_last") - F.expr(f"INTERVAL {int(weeks) * 7} DAYS")).alias("_from"))
    window = F.sequence(F.to_date("_from"), F.to_date("_last"))
    keys = cut.where(F.col("_last").isNotNull()).select("series_id", "_from", F.explode(window).alias("_tile"))
    return days.join(keys, ["series_id", "_tile"]).where(F.col("ts") >= F.col("_from")).select(*df.columns)


def _numbered(df: DataFrame, step: Step | None) -> DataFrame:
    return positions(df) if step is None else regular_positions(df, step)


def split_fraction(df: DataFrame, val_fraction: float = 0.2, *, step: Step | None = None) -> DataFrame:
    """Add ``part``: the first int(n * (1 - f)) rows of a series are ``train``, the rest ``validation``.

    Give ``step`` for a regular panel, which needs no counting.
    """
    cut = F.floor(F.col("n") * F.lit(1 - val_fraction))
    part = F.when(F.col("pos") <= cut, "train").otherwise("validation")
    return _numbered(df, step).withColumn("part", part).drop("pos", "n")


def split_last(df: DataFrame, n_test: int, *, step: Step | None = None) -> DataFrame:
    """Add ``part``: the last ``n_test`` rows of a series are ``test``."""
    part = F.when(F.col("pos") > F.col("n") - n_test, "test").otherwise("train")
    return _numbered(df, step).withColumn("part", part).drop("pos", "n")


def profile(df: DataFrame, category: str | None = None) -> DataFrame:
    """One row: counts and time range of the whole panel."""
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("series_id").alias("n_series"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.count_if(F.col("value") < 0).alias("n_negative"),
    ]
    if category:
        aggs.append(F.count_distinct(category).alias("n_categories"))
    return df.agg(*aggs)


def gap_check(df: DataFrame, step_seconds: float) -> DataFrame:
    """One row per series: number of gaps longer than a step, the longest one, steps missing."""
    before = previous_row(df.select("series_id", "ts", F.col("ts").alias("_ts")), ["_ts"])
    width = seconds_between(F.col("ts"), F.col("prev__ts"))
    gap = width > step_seconds
    return (
        before.groupBy("series_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(gap).alias("n_gaps"),
            F.max(F.when(gap, width)).alias("longest_gap_seconds"),
            F.coalesce(F.sum(F.when(gap, F.ceil(width / step_seconds) - 1)), F.lit(0)).alias("n_missing_steps"),
        )
    )


def filter_quality(df: DataFrame, max_flag: int = 0) -> DataFrame:
    """Keep rows whose flag (0 good, 1 estimated, 2 missing) is at most ``max_flag``."""
    return df.where(F.col("quality_flag") <= max_flag)


def time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("ts")))


def sort_series(df: DataFrame) -> DataFrame:
    """By series, then time.  A total sort: for final output only."""
    return df.orderBy("series_id", "ts")


def flag_values(df: DataFrame, *, lo: float, hi: float, hours: tuple[int, int] = (0, 23)) -> DataFrame:
    """Boolean columns for the usual selections on a value and its hour."""
    v = F.col("value")
    return df.withColumns(
        {
            "is_positive": v > 0,
            "is_zero": v == 0,
            "is_outside": (v < lo) | (v > hi),
            "in_hours": F.hour("ts").between(*hours),
        }
    )

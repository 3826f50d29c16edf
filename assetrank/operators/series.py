"""Series helpers: grouping (G1, G2), aggregates (T1-T3) and the per-row
time-series operators (T4-T10), all skew-safe (see ``scan.py``).

Each function takes a DataFrame and a :class:`Series` (key + order) and
returns a DataFrame. The operators T4-T7, T9, T10, G2 and I2 work on a
:class:`scan.BlockPlan`: make it once with :func:`scan.plan_blocks` (which runs
jobs and writes the laid-out rows) and pass it on; without one each call makes its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.functions.indicators import ident, pct_change_sql, signed_log_sql
from assetrank.functions.indicators import true_price as _true_price
from assetrank.functions.indicators import true_range as _true_range
from assetrank.operators.scan import (
    BlockPlan,
    Series,
    finish,
    plan_blocks,
    sliding_window,
    with_ewm,
    with_expanding,
    with_positions,
    with_previous,
    with_running_sum,
    with_sliding_rows,
    with_window_parts,
)


def group_prices(df: DataFrame, s: Series) -> DataFrame:
    """Per series: row count, first and last order value (G1). Partial aggregate."""
    first = s.order[0]
    return df.groupBy(*s.key).agg(
        F.count(F.lit(1)).alias("n"), F.min(first).alias("first_" + first), F.max(first).alias("last_" + first)
    )


def order_within(df: DataFrame, s: Series, out: str = "rn", plan: BlockPlan | None = None) -> DataFrame:
    """1-based row number along each series (G2), without one task per series."""
    return with_positions(df, s, plan).withColumnRenamed("_pos", out)


def series_aggregates(df: DataFrame, s: Series, col: str) -> DataFrame:
    """Sum (T1), mean (T2) and population deviation (T3) per series.

    Spark gives null for an empty input where the list helpers give 0 / NaN;
    a group here is never empty.
    """
    x = F.col(col)
    return df.groupBy(*s.key).agg(
        F.count(x).alias("n"), F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")
    )


def cum_sum(df: DataFrame, s: Series, col: str, out: str = "cum_sum", plan: BlockPlan | None = None) -> DataFrame:
    """Running sum along each series (T4)."""
    return with_running_sum(df, s, col, out, plan)


def ewm(
    df: DataFrame, s: Series, col: str, span: int, out: str = "ewm", plan: BlockPlan | None = None
) -> DataFrame:
    """Exponential average, alpha = 2 / (1 + span), seeded with the first value (T5)."""
    return with_ewm(df, s, col, float(span), out, plan)


def diff(df: DataFrame, s: Series, col: str, out: str = "diff", plan: BlockPlan | None = None) -> DataFrame:
    """x - previous x; the first element of a series gives 0."""
    p = with_previous(df, s, [col], plan)
    prev = F.coalesce(F.col(f"prev_{col}"), F.col(col))
    return p.withColumn(out, F.col(col) - prev).drop(f"prev_{col}")


def true_range(
    df: DataFrame,
    s: Series,
    high: str = "high",
    low: str = "low",
    close: str = "close",
    out: str = "true_range",
    plan: BlockPlan | None = None,
) -> DataFrame:
    """max(|low - prev close|, high - low, |high - prev close|) (T6); the first
    row of a series uses its own close."""
    p = with_previous(df, s, [close], plan)
    prev = F.coalesce(F.col(f"prev_{close}"), F.col(close))
    return p.withColumn(out, _true_range(high, low, prev)).drop(f"prev_{close}")


def true_price(df: DataFrame, high: str = "high", low: str = "low", close: str = "close", out: str = "true_price") -> DataFrame:
    """Typical price (high + low + close) / 3."""
    return df.withColumn(out, _true_price(high, low, close))


def volatility(df: DataFrame, s: Series, col: str = "close", plan: BlockPlan | None = None) -> DataFrame:
    """Whole-series volatility (I2): n, and the population deviation of the
    signed-log one-step returns, 0 under two points.

    Steps need the previous value (blocked lag); the deviation is a partial
    aggregate, so a hot series is combined map-side.
    """
    p = with_previous(df, s, [col], plan)
    prev = ident(f"prev_{col}")
    p = p.withColumn("_r", F.expr(f"CASE WHEN {prev} IS NOT NULL THEN {pct_change_sql(ident(col), prev)} END"))
    p = p.withColumn("_step", F.expr(signed_log_sql("_r")))
    g = p.groupBy(*s.key).agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("_step").alias("_sd"))
    return g.select(*s.key, "n", F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("_sd")).alias("vol"))


def sliding_agg(df: DataFrame, s: Series, col: str, size: int, plan: BlockPlan | None = None) -> DataFrame:
    """Complete windows of ``size`` consecutive rows (T9, aggregate form).

    One row per window, at the window's last row, with the window's sum,
    mean, population deviation, minimum and maximum and ``win_end``, the window's
    last position. A series shorter than ``size`` gives no windows. The cost of a
    row does not depend on ``size``, see :func:`scan.with_window_parts`.
    """
    parts = with_window_parts(df, s, col, size, plan)
    n, total = F.col("_early.n") + F.col("_late.n"), F.coalesce("_early.sum", F.lit(0.0)) + F.coalesce("_late.sum", F.lit(0.0))
    off = F.col("_late.mean") - F.col("_early.mean")
    # squares around the joint mean: those of both parts, and what the parts' means are apart
    both = F.col("_early.n") * F.col("_early.var") + F.col("_late.n") * F.col("_late.var") + off * off * F.col("_early.n") * F.col("_late.n") / n
    squares = F.when(F.col("_early.n") == 0, F.col("_late.n") * F.col("_late.var")).when(F.col("_late.n") == 0, F.col("_early.n") * F.col("_early.var")).otherwise(both)
    some = F.when(n > 0, F.lit(1.0))
    return finish(
        parts, df, s, F.col("_pos").alias("win_end"),
        (some * total).alias("win_sum"),
        (some * total / n).alias("win_mean"),
        F.when(n > 0, F.sqrt(F.greatest(squares, F.lit(0.0)) / n)).alias("win_std"),
        F.least("_early.min", "_late.min").alias("win_min"),
        F.greatest("_early.max", "_late.max").alias("win_max"),
    )


def sliding_list(df: DataFrame, s: Series, col: str, size: int, plan: BlockPlan | None = None) -> DataFrame:
    """Complete windows of ``size`` consecutive values as arrays (T9, list form).

    Output is ``size`` times the input; each array is bounded by ``size``.
    """
    rows = with_sliding_rows(df, s, size, plan)
    w = sliding_window(s, size)
    out = rows.withColumns({"win_n": F.count(F.lit(1)).over(w), "window": F.collect_list(col).over(w)})
    out = out.where(F.col("_own") & (F.col("win_n") == size))
    return finish(out, df, s, F.col("_pos").alias("win_end"), "window")


def expanding_agg(
    df: DataFrame, s: Series, col: str, plan: BlockPlan | None = None, inclusive: bool = False
) -> DataFrame:
    """Expanding windows (T10, aggregate form).

    Reference semantics (``inclusive=False``): the window at each row holds
    the rows strictly before it, starting with an empty window, and the
    series' last row yields no window. ``inclusive=True`` is the ordinary
    running window including the row, for every row. Columns: exp_n, exp_sum,
    exp_mean, exp_std (population); empty windows give n = 0 and nulls.
    """
    e = with_expanding(df, s, col, plan, inclusive=inclusive)
    if not inclusive:
        e = e.where(~F.col("_last"))
    return e.drop("_last")


__all__ = [
    "Series",
    "plan_blocks",
    "group_prices",
    "order_within",
    "series_aggregates",
    "cum_sum",
    "ewm",
    "diff",
    "true_range",
    "true_price",
    "volatility",
    "sliding_agg",
    "sliding_list",
    "expanding_agg",
]

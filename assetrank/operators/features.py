"""Per-asset features over a trailing window: G3, G4, I1, I2.

The trailing window is cut by a histogram before any row moves: counts per
(ticker, day), summed from the newest day on, give the day on which a ticker has
its ``n`` rows; older rows go at the scan. The cuts of the tickers with the most rows
are broadcast, ``HEAVIEST`` of them at most, whatever the table's size; a ticker
beyond those holds less than one row in ``HEAVIEST`` and needs no cut. What is left
passes one ``row_number`` per ticker (date desc, tie-break desc): ``n`` rows and the
rest of one day for a hot ticker. Everything after is one window pass and
one partial aggregate on that bounded set. A table that Spark estimates below
``HISTOGRAM_BYTES`` would fit one task as a whole, so there the counting is left out;
the rows are the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from assetrank.functions.dates import date_literal
from assetrank.functions.indicators import ident, pct_change_sql, signed_log_sql


def _desc_over(key: Sequence[str], date_col: str, tiebreak: Sequence[str]) -> str:
    """SQL window clause: per ticker, newest first."""
    order = ", ".join(f"{ident(c)} DESC" for c in (date_col, *tiebreak))
    return f"OVER (PARTITION BY {', '.join(ident(k) for k in key)} ORDER BY {order})"


def filter_end_date(prices: DataFrame, end_date, date_col: str = "date", year_partition: str | None = None) -> DataFrame:
    """Keep prices on or before the cutoff day, inclusive (F2); reaches the scan.

    A timestamp column keeps all of the cutoff day. ``year_partition`` names a
    partition column that holds the year of the date, as the table that the
    streaming ingestion writes has one: partitions past the cutoff are then
    never listed or read. A column is never taken for it by its name alone.
    """
    end = date_literal(end_date)
    dated = isinstance(prices.schema[date_col].dataType, (DateType, StringType))
    out = prices.where(F.col(date_col) <= end) if dated else prices.where(F.col(date_col) < F.date_add(end, 1))
    if year_partition is not None:
        out = out.where(F.col(year_partition) <= F.year(end))
    return out


#: Tickers whose cut is broadcast: key, day and count, a few MB whatever the table's size.
HEAVIEST = 65_536
#: From this estimated size of the prices on the histogram is made.
HISTOGRAM_BYTES = 1 << 30


def trailing_n(
    prices: DataFrame,
    n: int,
    *,
    tiebreak: Sequence[str],
    key: Sequence[str] = ("ticker",),
    date_col: str = "date",
    rn_col: str = "rn",
    histogram: bool | None = None,
) -> DataFrame:
    """Last ``n`` prices per ticker (G3); ``rn`` = 1 is the newest.

    Rows before a heavy ticker's cut (:func:`newest_days`) are dropped before the
    one exchange by ticker, for any ``n``. Up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark also limits every map
    task to ``n`` rows per ticker. ``histogram`` (default: by Spark's size estimate)
    decides cost only.
    """
    if histogram is None:
        histogram = int(str(prices._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= HISTOGRAM_BYTES
    some = newest_days(prices, n, key=key, date_col=date_col) if histogram else prices
    rn = F.expr(f"row_number() {_desc_over(key, date_col, tiebreak)}")
    return some.withColumn(rn_col, rn).where(F.expr(f"{ident(rn_col)} <= {int(n)}"))


def newest_days(prices: DataFrame, n: int, *, key: Sequence[str], date_col: str, heaviest: int = HEAVIEST) -> DataFrame:
    """``prices`` without the days before each heavy ticker's cut, the newest day by
    which the ticker has ``n`` rows.

    Counting reads key and date only, and is summed map-side. The running count is a
    window over a ticker's days, so its rows are as many as the days of the history.
    """
    day = f"to_date({ident(date_col)})"
    keys = [ident(k) for k in key]
    days = prices.groupBy(*key, F.expr(day).alias("_day")).agg(F.expr("count(1)").alias("_rows"))
    so_far = F.expr(f"sum(_rows) OVER (PARTITION BY {', '.join(keys)} ORDER BY _day DESC)")
    cuts = days.withColumn("_so_far", so_far).groupBy(*key)
    cuts = cuts.agg(F.expr(f"max(CASE WHEN _so_far >= {int(n)} THEN _day END)").alias("_cut"), F.expr("sum(_rows)").alias("_all"))
    # a ticker with a few windows of rows gains nothing by a cut
    cuts = cuts.where(f"_cut IS NOT NULL AND _all > {4 * int(n)}").orderBy(F.expr("_all DESC")).limit(heaviest)
    cuts = cuts.selectExpr(*[f"{k} AS _cut_key{i}" for i, k in enumerate(keys)], "_cut")
    same = F.expr(" AND ".join(f"{k} <=> _cut_key{i}" for i, k in enumerate(keys)))
    kept = prices.join(F.broadcast(cuts), same, "left").where(F.expr(f"_cut IS NULL OR {day} >= _cut"))
    return kept.select(*prices.columns)


def step_returns(
    trailing: DataFrame,
    *,
    tiebreak: Sequence[str],
    key: Sequence[str] = ("ticker",),
    date_col: str = "date",
    price_col: str = "close",
) -> DataFrame:
    """Signed-log one-step returns inside an already trailing-cut window (I2 steps).

    The older neighbour is ``lead`` on the descending order; the oldest kept
    row gets null and drops out of the deviation, so a price outside the
    window never leaks in.
    """
    t = trailing.withColumn("_prev", F.expr(f"lead({ident(price_col)}) {_desc_over(key, date_col, tiebreak)}"))
    t = t.withColumn("_r", F.expr(pct_change_sql(ident(price_col), "_prev")))
    return t.withColumn("step", F.expr(signed_log_sql("_r"))).drop("_prev", "_r")


def asset_features(
    prices: DataFrame,
    *,
    tiebreak: Sequence[str],
    window: int = 251,
    return_days: int = 5,
    key: Sequence[str] = ("ticker",),
    date_col: str = "date",
    price_col: str = "close",
    min_history: int | None = None,
) -> DataFrame:
    """Per ticker: n, ret (I1) and vol (I2) over its newest ``window`` prices.

    ret = (c[0] - c[k]) / c[k] with c[0] the newest close, 0 when fewer than
    k + 1 prices; vol = population deviation of the signed-log step returns,
    0 when fewer than 2 prices. ``min_history`` (default: ``window``) drops
    tickers with a shorter history (F3); pass 0 to keep all. More than ``window``
    is counted over the whole history, before the cut.
    """
    if return_days < 0 or window < 1:
        raise ValueError("window must be >= 1 and return_days >= 0")
    rn = "_rn"
    t = trailing_n(prices, window, key=key, date_col=date_col, tiebreak=tiebreak, rn_col=rn)
    t = step_returns(t, key=key, date_col=date_col, tiebreak=tiebreak, price_col=price_col)
    c = ident(price_col)
    f = t.groupBy(*key).agg(
        F.expr("count(1)").alias("n"),
        F.expr("stddev_pop(step)").alias("_sd"),
        F.expr(f"max(CASE WHEN {rn} = 1 THEN {c} END)").alias("_c0"),
        F.expr(f"max(CASE WHEN {rn} = {int(return_days) + 1} THEN {c} END)").alias("_ck"),
    )
    ret = f"CASE WHEN n < {int(return_days) + 1} THEN 0.0D ELSE {pct_change_sql('_c0', '_ck')} END AS ret"
    vol = "CASE WHEN n < 2 THEN 0.0D ELSE _sd END AS vol"
    f = f.selectExpr(*[ident(k) for k in key], "n", ret, vol)
    need = window if min_history is None else min_history
    if need > window:
        # null keys are a ticker of their own, as in the aggregate above
        long = filter_min_history(prices, need, key=key).select(*(F.col(c).alias(f"_long_{c}") for c in key))
        same = [F.col(c).eqNullSafe(F.col(f"_long_{c}")) for c in key]
        return f.join(long, same, "left_semi")
    return f.where(F.expr(f"n >= {int(need)}")) if need > 0 else f


def filter_min_history(
    prices: DataFrame, n: int, *, key: Sequence[str] = ("ticker",)
) -> DataFrame:
    """Tickers with at least ``n`` prices (F3), with their count; partial aggregate."""
    return prices.groupBy(*key).agg(F.count(F.lit(1)).alias("n_prices")).where(F.col("n_prices") >= n)


def returns_k(
    series: DataFrame,
    k: int,
    *,
    order: Sequence[str],
    key: Sequence[str] = ("ticker",),
    value_col: str = "close",
) -> DataFrame:
    """Return over ``k`` steps at the end of each series (I1), 0 if under k + 1 points.
    ``order`` is the date and the tie-break columns.

    Only the newest k + 1 rows per key are needed, which Spark limits per map
    task before the shuffle.
    """
    t = trailing_n(series, k + 1, key=key, date_col=order[0], tiebreak=tuple(order[1:]), rn_col="_rn")
    v = ident(value_col)
    g = t.groupBy(*key).agg(
        F.expr("count(1)").alias("_n"),
        F.expr(f"max(CASE WHEN _rn = 1 THEN {v} END)").alias("_c0"),
        F.expr(f"max(CASE WHEN _rn = {int(k) + 1} THEN {v} END)").alias("_ck"),
    )
    ret = f"CASE WHEN _n < {int(k) + 1} THEN 0.0D ELSE {pct_change_sql('_c0', '_ck')} END AS ret"
    return g.selectExpr(*[ident(x) for x in key], ret)


__all__ = [
    "filter_end_date",
    "trailing_n",
    "step_returns",
    "asset_features",
    "filter_min_history",
    "returns_k",
]

"""The flagship query (E1): rank investments by recent return."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from assetrank.config import Defaults
from assetrank.operators.features import asset_features, filter_end_date
from assetrank.operators.ranking import (
    ASSET_COLUMNS,
    assemble_assets,
    filter_pe_ratio,
    filter_volatility,
    join_features_assets,
    top_k,
)

_D = Defaults()


def rank_investments(
    prices: DataFrame,
    assets: DataFrame,
    *,
    tiebreak: Sequence[str],
    end_date=_D.end_date,
    volatility_ceiling: float = _D.volatility_ceiling,
    pe_threshold: float = _D.pe_threshold,
    window: int = _D.window,
    return_days: int = _D.return_days,
    k: int = _D.k,
    price_col: str = "close",
    min_history: int | None = None,
    year_partition: str | None = None,
) -> DataFrame:
    """Top ``k`` assets by ``return_days`` return, as one lazy plan.

    prices: ticker, date, close (+ tie-break columns); assets: ticker, name,
    industry, sector, pe. Output: rank, ticker, name, industry, sector, ret,
    vol, pe. No action is triggered.

    Plan shape: the date cutoff and the P/E filter reach their scans; the
    price side passes a trailing-window limit by (ticker, salt), then by
    ticker; features are a partial aggregate; the join sees one row per asset
    on both sides; the top-k is a per-partition take-ordered.
    """
    p = filter_end_date(prices, end_date, year_partition=year_partition)
    p = p.select(*dict.fromkeys(("ticker", "date", price_col, *tiebreak)))
    feats = asset_features(
        p, window=window, return_days=return_days, date_col="date", tiebreak=tiebreak, price_col=price_col, min_history=min_history
    )
    feats = filter_volatility(feats, volatility_ceiling)
    meta = filter_pe_ratio(assets.select("ticker", "name", "industry", "sector", "pe"), pe_threshold)
    rows = assemble_assets(join_features_assets(feats, meta))
    return top_k(rows, k).select("rank", *ASSET_COLUMNS)

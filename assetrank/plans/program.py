"""The reference program end to end: files in, padded ranking out.

Prices come from headerless CSV (S1), are null-filtered (F1) and parsed
(P1), unparsable rows dropped; asset metadata comes from JSON (S2, P2). The
ranking (E1) is padded to ``k`` slots (K3) and can be written as the text
report (R1, S4). The settings the reference reads from its environment or
constants (C1) are arguments here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetrank.config import Defaults, shared_dir
from assetrank.operators.ranking import pad_ranking
from assetrank.operators.report import ranking_report, write_report
from assetrank.plans.rank import rank_investments
from assetrank.sources.assets import project_assets, scan_assets_json
from assetrank.sources.prices import load_prices, scan_prices_csv

_D = Defaults()

# CSV rows carry no line ids: order equal dates by every numeric field, so
# only rows that are equal in all fields can tie, and those give the same
# features whichever comes first.
CSV_TIEBREAK = ("close", "open", "high", "low", "adj_close", "volume")


def rank_from_files(
    spark: SparkSession,
    prices_path: str,
    assets_path: str,
    *,
    end_date=_D.end_date,
    volatility_ceiling: float = _D.volatility_ceiling,
    pe_threshold: float = _D.pe_threshold,
    k: int = _D.k,
    window: int = _D.window,
    return_days: int = _D.return_days,
    price_col: str = "close",
    min_history: int | None = None,
    assets_multi_line: bool = True,
) -> DataFrame:
    """Padded top-``k`` ranking from a price CSV and an asset JSON file."""
    prices = load_prices(scan_prices_csv(spark, prices_path))
    assets = project_assets(scan_assets_json(spark, assets_path, multi_line=assets_multi_line))
    ranked = rank_investments(
        prices,
        assets,
        end_date=end_date,
        volatility_ceiling=volatility_ceiling,
        pe_threshold=pe_threshold,
        k=k,
        window=window,
        return_days=return_days,
        price_col=price_col,
        min_history=min_history,
        tiebreak=CSV_TIEBREAK,
    )
    return pad_ranking(spark, ranked, k)


def run_program(spark: SparkSession, prices_path: str, assets_path: str, results_dir: str, **kw) -> DataFrame:
    """Rank, write the text report under ``results_dir`` and return the ranking.

    The ranking is computed once: its ``k`` rows are written to the shared folder, and the
    report and the returned DataFrame read them.
    """
    padded = rank_from_files(spark, prices_path, assets_path, **kw)
    path = shared_dir(spark, "ranking")
    padded.write.parquet(path)
    ranked = spark.read.schema(padded.schema).parquet(path)
    write_report(ranking_report(ranked), results_dir)
    return ranked.orderBy("rank")

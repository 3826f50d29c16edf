"""Filters, join and ranking: F4, F5, J1, P6, K1, K2, K3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetrank.functions.indicators import double_sql, ident

ASSET_COLUMNS = ("ticker", "name", "industry", "sector", "ret", "vol", "pe")


def filter_volatility(features: DataFrame, ceiling: float, vol_col: str = "vol") -> DataFrame:
    """Keep vol strictly below the ceiling (F4). NaN orders above every number
    in Spark, so a NaN volatility fails the test, as in the reference."""
    return features.where(F.expr(f"{ident(vol_col)} < {double_sql(ceiling)}"))


def filter_pe_ratio(assets: DataFrame, threshold: float, pe_col: str = "pe") -> DataFrame:
    """Keep P/E present, non-zero and strictly below the threshold.

    Zero stands for "missing" in the reference; negative ratios pass. Applied
    to the metadata side, so it is evaluated before the join and reaches the
    metadata scan.
    """
    pe = ident(pe_col)
    return assets.where(F.expr(f"{pe} IS NOT NULL AND {pe} <> 0 AND {pe} < {double_sql(threshold)}"))


def join_features_assets(features: DataFrame, assets: DataFrame, key: Sequence[str] = ("ticker",)) -> DataFrame:
    """Inner equi-join on the ticker.

    Both sides hold one row per asset. No hint is forced: Spark broadcasts the
    metadata side when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks with runtime sizes,
    and beyond that it is a shuffle join on the key. Duplicate symbols
    multiply rows, each with its own P/E.
    """
    return features.join(assets, list(key), "inner")


def assemble_assets(joined: DataFrame, nested: bool = False) -> DataFrame:
    """Result rows ticker, name, industry, sector and features.

    Flat columns by default; ``nested=True`` adds the reference's
    ``features`` struct (ret, vol, pe).
    """
    cols = list(ASSET_COLUMNS)
    if nested:
        cols.append("named_struct('ret', ret, 'vol', vol, 'pe', pe) AS features")
    return joined.selectExpr(*cols)


def top_k(df: DataFrame, k: int, by: str = "ret", tiebreak: Sequence[str] = ("ticker",), descending: bool = True) -> DataFrame:
    """Best ``k`` rows by ``by`` with a deterministic tie-break, numbered 1..k.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each partition
    keeps its own k best, only those reach one task. The rank is then numbered
    over at most k rows.
    """
    order = ", ".join([f"{ident(by)} {'DESC' if descending else 'ASC'}", *[f"{ident(c)} ASC" for c in tiebreak]])
    limited = df.orderBy(F.desc(by) if descending else F.asc(by), *[F.asc(c) for c in tiebreak]).limit(k)
    return limited.withColumn("rank", F.expr(f"CAST(row_number() OVER (ORDER BY {order}) AS BIGINT)"))


def top_k_returns(df: DataFrame, k: int = 5) -> DataFrame:
    """Highest returns first (K1)."""
    return top_k(df, k, "ret", descending=True)


def bottom_k_returns(df: DataFrame, k: int = 5) -> DataFrame:
    """The assets' natural order, lowest return first (K2)."""
    return top_k(df, k, "ret", descending=False)


def pad_ranking(spark: SparkSession, ranked: DataFrame, k: int = 5) -> DataFrame:
    """Exactly ``k`` slots numbered 1..k; empty slots are all-null rows (K3).

    Rows of ``ranked`` beyond rank k are cut off first, so a top-k result leaves at
    most k rows on both sides; how to join them is left to Spark.
    """
    slots = spark.range(1, k + 1).select(F.col("id").alias("rank"))
    return slots.join(ranked.where(F.col("rank") <= k), "rank", "left")

"""Views of the driver's test tables in the shapes the pipeline expects.

``prices`` and ``assets`` follow the reference's inputs; ``bars`` and
``ticks`` give open/high/low/close bars and raw series for the helpers. All
are lazy projections or aggregates of the given tables, so their work grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Columns that make (ticker, date) unique in lineitem; the order tie-break.
PRICE_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
TICK_TIEBREAK = ("event_id",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, date, close plus the tie-break columns, one row per lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_suppkey AS ticker",
        "CAST(l_shipdate AS DATE) AS date",
        "try_divide(l_extendedprice, l_quantity) AS close",
        *PRICE_TIEBREAK,
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, name, industry, sector, pe from supplier, nation and region.

    nation and region are fixed-size dimension tables (25 and 5 rows), so
    broadcasting them is bounded whatever the scale factor.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        s.join(F.broadcast(n.withColumnRenamed("n_nationkey", "s_nationkey")), "s_nationkey")
        .join(F.broadcast(r.withColumnRenamed("r_regionkey", "n_regionkey")), "n_regionkey")
        .selectExpr(
            "s_suppkey AS ticker",
            "s_name AS name",
            "n_name AS industry",
            "r_name AS sector",
            "s_acctbal / 200.0D AS pe",
        )
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly open/high/low/close bars per event type.

    Grouping by (type, hour) is a partial aggregate, so a hot event type is
    combined map-side before the shuffle.
    """
    ev = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    return (
        ev.groupBy(F.col("event_type").alias("ticker"), F.date_trunc("hour", "ts").alias("ts"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .withColumn("adj_close", F.col("close"))
        .withColumn("date", F.col("ts").cast("date"))
    )


def ticks(spark: SparkSession, sf_dir: str, by: str = "event_type") -> DataFrame:
    """Raw series: ticker (event type or user), ts, event_id, x = value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col(by).alias("ticker"), "ts", "event_id", F.col("value").alias("x"))


def _money(x):
    """Price text with two decimals from whole cents: floor(x * 100).

    Built from integer arithmetic so every engine renders the same text
    (``%.2f`` formatting differs between the JVM and C on near-ties).
    """
    cents = F.floor(x * F.lit(100.0)).cast("bigint")
    return F.concat(
        F.floor(cents / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"),
    )


def price_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as the reference's headerless price rows: eight text fields.

    Date is written ``y-m-d`` without zero padding; prices with two decimals.
    Two derived defects exercise cleaning: line 7 has a blank open, and a
    returned line 6 carries the unparsable close ``x``.
    """
    li = table(spark, sf_dir, "lineitem")
    px = F.try_divide("l_extendedprice", "l_quantity")
    disc, tax = F.col("l_discount"), F.col("l_tax")
    return li.select(
        F.concat_ws("-", F.year("l_shipdate"), F.month("l_shipdate"), F.dayofmonth("l_shipdate")).alias("date"),
        F.when(F.col("l_linenumber") != 7, _money(px * (1 - disc))).alias("open"),
        _money(px * (1 + tax)).alias("high"),
        _money(px * (1 - disc - tax)).alias("low"),
        F.when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), F.lit("x"))
        .otherwise(_money(px))
        .alias("close"),
        _money(px * (1 - disc)).alias("adj_close"),
        F.col("l_quantity").cast("bigint").cast("string").alias("volume"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("ticker"),
    )


def asset_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """assets as the reference's JSON records (symbol, name, ..., P/E)."""
    a = assets(spark, sf_dir)
    return a.select(
        F.concat(F.lit("T"), F.col("ticker").cast("string")).alias("symbol"),
        F.concat(F.lit("ISIN"), F.col("ticker").cast("string")).alias("isin"),
        F.lit(None).cast("string").alias("figi"),
        "name",
        F.lit(None).cast("string").alias("description"),
        "industry",
        "sector",
        F.col("pe").alias("price_earning_ratio"),
        F.lit(None).cast("double").alias("growth"),
    )

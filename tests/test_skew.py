"""A key holding a third of all rows is spread over many tasks."""

import datetime as dt

from pyspark.sql import functions as F

from assetrank.operators import features as feat
from assetrank.operators import series as S
from assetrank.operators.scan import KEY, Series, plan_blocks


def test_hot_key_spreads_over_partitions(spark):
    t0 = dt.datetime(2024, 1, 1)
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("ticker"),
        (F.lit(t0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("double"))).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("seq"),
        (F.col("id") % 11).cast("double").alias("x"),
    )
    s = Series.of("ticker", ("ts", "seq"))
    plan = plan_blocks(rows, s, block_rows=500)
    blocked = plan.rows.repartition(16, KEY, "_tb")
    hot = blocked.where(F.col(KEY)["ticker"] == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    # the hot key's 10,000 rows are in about 20 blocks hashed over the partitions
    assert len(hot) >= 8
    assert max(r["count"] for r in hot) < 0.4 * n / 3
    # and the operator result is still exact
    out = S.cum_sum(rows, s, "x", plan=plan).where("ticker = 'hot'").agg(F.max("cum_sum")).first()[0]
    assert out == rows.where("ticker = 'hot'").agg(F.sum("x")).first()[0]


def test_hot_ticker_in_the_trailing_window(spark):
    """One ticker in 64 map tasks, a window beyond Spark's own limit for limiting map tasks:
    what reaches the exchange is the window and the rest of one day."""
    n, window = 64_000, 1500
    day = F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 5000).cast("int"))
    hot = spark.range(0, n, 1, 64).select(F.lit("hot").alias("ticker"), day.alias("date"), F.col("id").alias("seq"), F.lit(1.0).alias("close"))
    nothing = F.when(F.col("id") % 2 == 0, F.lit(None).cast("string")).otherwise("few")
    rest = spark.range(n, n + 3000).select(nothing.alias("ticker"), day.alias("date"), F.col("id").alias("seq"), F.lit(1.0).alias("close"))
    rows = hot.union(rest)
    out = feat.trailing_n(rows, window, tiebreak=("seq",), histogram=True)
    assert sorted(r.seq for r in out.where("ticker = 'hot'").collect()) == sorted(r.seq for r in hot.orderBy(F.desc("date"), F.desc("seq")).limit(window).collect())
    plain = feat.trailing_n(rows, window, tiebreak=("seq",), histogram=False)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    kept = feat.newest_days(rows, window, key=("ticker",), date_col="date")
    assert kept.where("ticker = 'hot'").count() <= window + 13  # a day has 12 or 13 rows
    assert kept.where("ticker is null or ticker = 'few'").count() == 3000
    # only so many cuts are broadcast; the others' rows come whole
    assert feat.newest_days(rows, window, key=("ticker",), date_col="date", heaviest=0).count() == rows.count()


def test_cut_by_day_of_timestamps_and_nulls(spark):
    t0 = dt.datetime(2020, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=k), k) for k in range(400)] + [("a", None, 1000 + k) for k in range(5)] + [("b", None, k) for k in range(300)]
    df = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, seq long")
    for n in (1, 3, 24, 50, 2000):
        got, want = (sorted(map(str, feat.trailing_n(df, n, tiebreak=("seq",), histogram=h).collect())) for h in (True, False))
        assert got == want
    assert feat.newest_days(df, 50, key=("ticker",), date_col="date").where("ticker = 'a'").count() <= 50 + 24

"""Stored layouts: reopened, appended to, and equal to a full rebuild."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from assetrank.operators import layout as lay
from assetrank.operators import series as S
from assetrank.operators.scan import Series
from assetrank.sources import files

SERIES = Series.of("ticker", ("ts", "seq"))
T0 = dt.datetime(2024, 1, 1)


def rows(spark, first, last):
    """Three uneven series and a null key; hour by hour, with nulls and repeated times."""
    hour = F.col("id")
    key = F.when(hour % 3 == 0, "hot").when(hour % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), (hour % 5).cast("string")))
    ts = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.floor(hour / 2).cast("int"))
    x = F.when(hour % 11 != 0, (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).cast("double"))
    return spark.range(first, last).select(key.alias("ticker"), ts.alias("ts"), hour.alias("seq"), x.alias("x"), (x + 1).alias("high"), (x - 1).alias("low"))


OPERATORS = {
    "order": lambda d, p: S.order_within(d, SERIES, plan=p).select("ticker", "seq", F.col("rn").cast("double").alias("y")),
    "cum_sum": lambda d, p: S.cum_sum(d, SERIES, "x", out="y", plan=p).select("ticker", "seq", "y"),
    "ewm": lambda d, p: S.ewm(d, SERIES, "x", 9, out="y", plan=p).select("ticker", "seq", "y"),
    "diff": lambda d, p: S.diff(d, SERIES, "x", out="y", plan=p).select("ticker", "seq", "y"),
    "expanding": lambda d, p: S.expanding_agg(d, SERIES, "x", plan=p, inclusive=True).select("ticker", "seq", F.col("exp_std").alias("y")),
}


def values(df):
    return {(r.ticker, r.seq): r.y for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) <= 1e-9 * max(1, abs(b[k]))), (k, a[k], b[k])


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """1,000 rows, then two appends."""
    path = str(tmp_path_factory.mktemp("layout") / "prices")
    plan = lay.store_layout(rows(spark, 0, 1000), SERIES, path, block_rows=120)
    first = OPERATORS["ewm"](plan.source, plan)
    first.collect()
    plan = lay.append_layout(plan, rows(spark, 1000, 1300), block_rows=120)
    return lay.append_layout(plan, rows(spark, 1300, 1340).withColumn("more", F.lit(1)), block_rows=120)


@pytest.mark.parametrize("name", OPERATORS)
def test_appended_days_equal_a_full_rebuild(spark, grown, name):
    everything = rows(spark, 0, 1340)
    want = values(OPERATORS[name](everything, None))
    close(values(OPERATORS[name](grown.source, grown)), want)
    # the newest rows alone go on from the kept states
    newest = grown.newest()
    got = values(OPERATORS[name](newest.source, newest))
    assert len(got) == 40
    close(got, {k: v for k, v in want.items() if k[1] >= 1300})


def test_newest_reads_no_earlier_rows(spark, grown):
    newest = grown.newest()
    S.cum_sum(newest.source, SERIES, "x", plan=newest).collect()
    text = S.cum_sum(newest.source, SERIES, "x", plan=newest)._jdf.queryExecution().executedPlan().toString()
    assert "generation-2" in text and "generation-0-" in text  # the states of the first
    for old in ("generation-0", "generation-1"):
        name = next(g["name"] for g in grown.generations if g["name"].startswith(old))
        assert f"{name}/rows" not in text
    with pytest.raises(ValueError, match="sliding"):
        S.sliding_agg(newest.source, SERIES, "x", 3, plan=newest)


def test_reopening_writes_nothing(spark, grown):
    def files_below(path):
        return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)

    S.cum_sum(grown.source, SERIES, "x", plan=grown).collect()
    before = files_below(grown.path)
    again = lay.open_layout(spark.newSession(), grown.path)  # a second session
    assert values(OPERATORS["cum_sum"](again.source, again)) == values(OPERATORS["cum_sum"](grown.source, grown))
    assert S.sliding_agg(again.source, SERIES, "x", 20, plan=again).count() > 0
    assert files_below(grown.path) == before
    plan = S.cum_sum(again.source, SERIES, "x", plan=again)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_sliding_over_generations(spark, grown):
    want = {(r.ticker, r.seq): r.win_sum for r in S.sliding_agg(rows(spark, 0, 1340), SERIES, "x", 50).collect()}
    close({(r.ticker, r.seq): r.win_sum for r in S.sliding_agg(grown.source, SERIES, "x", 50, plan=grown).collect()}, want)


def test_late_rows_races_and_compaction(spark, grown, tmp_dir):
    with pytest.raises(ValueError, match="keys have rows before"):
        lay.append_layout(grown, rows(spark, 500, 520))
    with pytest.raises(ValueError, match="already"):
        lay.store_layout(rows(spark, 0, 10), SERIES, grown.path)
    with pytest.raises(ValueError, match="no layout"):
        lay.open_layout(spark, f"{tmp_dir}/nothing")
    # an append that another one overtook is never read
    count = len(grown.generations)
    with pytest.raises(RuntimeError, match="first"):
        lay._add(rows(spark, 2000, 2010), SERIES, grown.path, list(grown.generations[:-1]), None)
    assert len(lay.open_layout(spark, grown.path).generations) == count
    small = lay.compact_layout(grown, f"{tmp_dir}/compact", block_rows=400)
    assert len(small.generations) == 1 and small.source.count() == 1340
    close(values(OPERATORS["ewm"](small.source, small)), values(OPERATORS["ewm"](grown.source, grown)))


def test_empty_generations(spark, tmp_dir):
    plan = lay.store_layout(rows(spark, 0, 0), SERIES, f"{tmp_dir}/empty")
    assert plan.source.count() == 0
    plan = lay.append_layout(plan, rows(spark, 0, 30))
    plan = lay.append_layout(plan, rows(spark, 30, 30))
    close(values(OPERATORS["cum_sum"](plan.source, plan)), values(OPERATORS["cum_sum"](rows(spark, 0, 30), None)))
    assert files.names(spark, f"{tmp_dir}/empty")[-1] == "manifest-00000002"

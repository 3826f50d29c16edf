"""Edge cases for the decisions Q1-Q12 and the ranking pipeline on hand-made rows."""

import datetime as dt
import os
import math

import pytest

from pyspark.sql import functions as F

from assetrank.operators import features as feat
from assetrank.operators import ranking as rk
from assetrank.operators import report as rep
from assetrank.plans.program import run_program
from assetrank.plans.rank import rank_investments
from assetrank.sources import assets as asrc
from assetrank.sources import prices as psrc

D0 = dt.date(2019, 1, 1)


def series_rows(ticker, closes, start=D0, extra=()):
    rows = [(ticker, start + dt.timedelta(days=i), float(c), 0) for i, c in enumerate(closes)]
    return rows + list(extra)


def prices_df(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, close double, seq int")


def walk(n, step=1.01, start=100.0):
    out, c = [], start
    for i in range(n):
        out.append(c)
        c = c * (step if i % 2 == 0 else 1 / step * 1.001)
    return out


def features(spark, rows, **kw):
    df = prices_df(spark, rows)
    return {r.ticker: r for r in feat.asset_features(df, tiebreak=("seq",), **kw).collect()}


def test_history_length_250_251_252(spark):
    rows = series_rows("A", walk(250)) + series_rows("B", walk(251)) + series_rows("C", walk(252))
    f = features(spark, rows)
    assert set(f) == {"B", "C"}
    assert all(r.n == 251 for r in f.values())


def test_trailing_window_excludes_older_price(spark):
    # the 252nd-newest price must not leak into the oldest return
    closes = walk(251)
    a = features(spark, series_rows("A", closes))["A"]
    b = features(spark, series_rows("B", [1e6] + closes))["B"]
    assert a.vol == pytest.approx(b.vol, rel=1e-12)
    assert a.ret == pytest.approx(b.ret, rel=1e-12)


def test_zero_return_counts_as_zero(spark):
    import listref as L

    closes = walk(251)
    closes[100] = closes[99]  # flat step
    f = features(spark, series_rows("A", closes))["A"]
    assert f.vol == pytest.approx(L.volatility(closes), rel=1e-12)


def test_zero_previous_close_gives_nan_and_is_dropped(spark):
    closes = walk(251)
    closes[50] = 0.0
    f = features(spark, series_rows("A", closes))["A"]
    assert math.isnan(f.vol)
    assert rk.filter_volatility(prices_df(spark, []).sparkSession.createDataFrame([("A", f.vol)], "ticker string, vol double"), 4.0).count() == 0


def test_returns_and_short_series(spark):
    import listref as L

    closes = walk(300)
    f = features(spark, series_rows("A", closes))["A"]
    assert f.ret == pytest.approx(L.returns(5, closes[-251:]), rel=1e-12)
    short = features(spark, series_rows("S", [1.0, 2.0, 3.0]), window=251, min_history=0)["S"]
    assert short.ret == 0.0  # fewer than k + 1 prices
    one = features(spark, series_rows("O", [5.0]), window=251, min_history=0)["O"]
    assert one.vol == 0.0  # fewer than 2 prices


def test_cutoff_is_inclusive(spark):
    rows = series_rows("A", walk(260), start=dt.date(2020, 1, 1))
    df = prices_df(spark, rows)
    last = rows[-1][1]
    kept = feat.filter_end_date(df, last.isoformat()).count()
    assert kept == 260
    assert feat.filter_end_date(df, (last - dt.timedelta(days=1)).isoformat()).count() == 259


def test_duplicate_dates_use_tiebreak(spark):
    closes = walk(251)
    rows = series_rows("A", closes)
    # same date twice: the tie-break column decides the order
    d = rows[-1][1]
    rows[-1] = ("A", d, closes[-1], 2)
    rows.append(("A", d, 123.0, 1))
    f = features(spark, rows)["A"]
    assert f.n == 251
    # newest (seq 2) first, so the 123.0 row is second newest
    t = feat.trailing_n(prices_df(spark, rows), 2, tiebreak=("seq",)).orderBy("rn").collect()
    assert [r.close for r in t] == [closes[-1], 123.0]


def assets_df(spark, rows):
    return spark.createDataFrame(rows, "ticker string, name string, industry string, sector string, pe double")


def test_pe_filter_rules(spark):
    a = assets_df(
        spark,
        [("N", "n", "i", "s", None), ("Z", "z", "i", "s", 0.0), ("M", "m", "i", "s", -3.0),
         ("E", "e", "i", "s", 25.0), ("L", "l", "i", "s", 24.99), ("H", "h", "i", "s", float("nan"))],
    )
    kept = sorted(r.ticker for r in rk.filter_pe_ratio(a, 25).collect())
    assert kept == ["L", "M"]


def test_volatility_ceiling_is_strict(spark):
    f = spark.createDataFrame([("A", 4.0), ("B", 3.999), ("C", float("nan"))], "ticker string, vol double")
    assert [r.ticker for r in rk.filter_volatility(f, 4.0).collect()] == ["B"]


def test_ranking_ties_padding_and_duplicates(spark):
    rows = []
    for t in "ABCD":
        rows += series_rows(t, walk(251))  # identical series: equal returns
    p = prices_df(spark, rows)
    a = assets_df(
        spark,
        [("A", "a", "i", "s", 10.0), ("B", "b", "i", "s", 10.0), ("B", "b2", "i", "s", 12.0),
         ("C", "c", "i", "s", 30.0), ("D", "d", "i", "s", 0.0)],
    )
    r = rank_investments(p, a, end_date="2030-01-01", volatility_ceiling=100.0, pe_threshold=25, tiebreak=("seq",))
    got = [(x.rank, x.ticker, x.name) for x in r.orderBy("rank").collect()]
    # duplicate symbol B joins twice (each row its own P/E); C (P/E 30) and D (P/E 0) are out
    assert [g[1] for g in got] == ["A", "B", "B"]
    assert sorted(x.pe for x in r.where("ticker = 'B'").collect()) == [10.0, 12.0]
    padded = rk.pad_ranking(spark, r, 5).orderBy("rank").collect()
    assert [x.rank for x in padded] == [1, 2, 3, 4, 5]
    assert padded[3].ticker is None and padded[4].ticker is None
    none = rank_investments(p, a, end_date="2030-01-01", volatility_ceiling=0.0, tiebreak=("seq",))
    assert none.count() == 0
    assert rk.pad_ranking(spark, none, 5).where("ticker is null").count() == 5


def test_bottom_k_is_ascending(spark):
    f = spark.createDataFrame([("A", 0.3), ("B", -0.1), ("C", 0.2)], "ticker string, ret double")
    assert [r.ticker for r in rk.bottom_k_returns(f, 2).orderBy("rank").collect()] == ["B", "C"]
    assert [r.ticker for r in rk.top_k_returns(f, 2).orderBy("rank").collect()] == ["A", "C"]


def test_csv_scan_parse_and_rejects(spark, tmp_dir):
    text = "\n".join(
        [
            "1999-1-8,1.0,2.0,0.5,1.5,1.5,100,AAA",  # one-digit month and day
            "1999-01-09,1.0,2.0,0.5,1.6,1.6,100,AAA,extra",  # ninth column ignored
            "1999-01-10,,2.0,0.5,1.7,1.7,100,AAA",  # blank field
            "1999-01-11,1.0,2.0",  # short row
            "bad,1.0,2.0,0.5,1.8,1.8,100,AAA",  # unparsable date
            "1999-01-12,1.0,2.0,0.5,x,1.9,100,AAA",  # unparsable close
            "1999-01-13T05,1.0,2.0,0.5,1.9,1.9,100,AAA",  # not a plain date
            "1999-01-14,1.0,2.0,0.5,NaN,1.9,100,AAA",  # NaN parses
        ]
    )
    path = f"{tmp_dir}/prices.csv"
    with open(path, "w") as fh:
        fh.write(text + "\n")
    raw = psrc.scan_prices_csv(spark, path)
    assert raw.count() == 8
    assert psrc.filter_null_prices(raw).count() == 6
    typed = psrc.parse_prices(raw).collect()
    assert typed[0].date == dt.date(1999, 1, 8) and typed[0].close == 1.5
    clean = psrc.load_prices(raw).collect()
    assert [r.date.day for r in clean] == [8, 9, 14]
    assert psrc.rejected_prices(raw).count() == 5


def test_json_assets_schema(spark, tmp_dir):
    doc = """[
      {"symbol": "A", "name": "Alpha", "industry": "I", "sector": "S", "price_earning_ratio": 8},
      {"symbol": "B", "name": "Beta", "price_earning_ratio": "n/a", "growth": 1.5},
      {"symbol": "C", "name": "Gamma", "sector": null, "price_earning_ratio": 12.5, "extra": {"x": 1}}
    ]"""
    path = f"{tmp_dir}/assets.json"
    with open(path, "w") as fh:
        fh.write(doc)
    raw = asrc.scan_assets_json(spark, path, multi_line=True)
    got = {r.symbol: r for r in raw.collect()}
    assert got["A"].price_earning_ratio == 8.0
    assert got["B"].price_earning_ratio is None and got["B"].name == "Beta"
    assert got["C"].sector is None and got["C"].growth is None
    proj = {r.ticker: r for r in asrc.project_assets(raw, zero_missing_pe=True).collect()}
    assert proj["B"].pe == 0.0 and proj["A"].growth == 0.0
    assert asrc.preview_first(asrc.project_assets(raw)).collect()[0].ticker == "A"


def test_london_midnight(spark):
    from assetrank.functions import dates

    df = spark.createDataFrame([("2020-04-01",), ("2020-01-01",), ("2020-4-1",), ("2020-02-30",), ("junk",)], "d string")
    out = df.select(
        F.date_format(dates.utc_wall_time_from_string("d"), "yyyy-MM-dd HH:mm:ss").alias("w"),
        dates.instant_from_string("d").alias("i"),
    ).collect()
    assert [r.w for r in out] == ["2020-03-31 23:00:00", "2020-01-01 00:00:00", "2020-03-31 23:00:00", None, None]
    # session time zone is UTC in the tests: the instant prints as UTC wall time
    assert out[0].i == dt.datetime(2020, 3, 31, 23, 0)


def test_report_text(spark):
    ranked = spark.createDataFrame(
        [(1, "T1", "Alpha", "Tech", "EU", 0.5, 1.25, 1e-5)],
        "rank bigint, ticker string, name string, industry string, sector string, ret double, vol double, pe double",
    )
    padded = rk.pad_ranking(spark, ranked, 2)
    text = {r.rank: r.text for r in rep.ranking_report(padded).collect()}
    assert text[1] == (
        "Rank 1: Alpha (T1)\n  - Industry: Tech\n  - Sector: EU\n  - Returns: 0.5\n"
        "  - Volatility: 1.25\n  - P/E Ratio: 1.0E-5\n"
    )
    assert text[2] == "Rank 2: NULL\n"


def test_write_report_roundtrip(spark, tmp_dir):
    ranked = spark.createDataFrame(
        [(1, "T1", None, "Tech", "EU", 0.5, 1.25, 3.0)],
        "rank bigint, ticker string, name string, industry string, sector string, ret double, vol double, pe double",
    )
    report = rep.ranking_report(rk.pad_ranking(spark, ranked, 2))
    os.makedirs(f"{tmp_dir}/report")
    with open(f"{tmp_dir}/report/keep.txt", "w") as fh:
        fh.write("mine")
    for _ in range(2):  # the second run replaces the report only
        rep.write_report(report, f"{tmp_dir}/report")
    assert sorted(os.listdir(f"{tmp_dir}/report")) == ["SPARK.DONE", "keep.txt"]
    whole = rep.read_report(spark, f"{tmp_dir}/report").collect()[0].value
    assert whole == (
        "Rank 1: null (T1)\n  - Industry: Tech\n  - Sector: EU\n  - Returns: 0.5\n"
        "  - Volatility: 1.25\n  - P/E Ratio: 3.0\n\nRank 2: NULL\n\n"
    )


def test_price_to_text(spark):
    df = spark.createDataFrame(
        [(dt.date(1999, 1, 8), 1.0, 2.5, 0.5, 1.5, 1.5, 100.0, "AAA")],
        "date date, open double, high double, low double, close double, adj_close double, volume double, ticker string",
    )
    assert rep.price_to_text(df).collect()[0].text == "8/1/1999 1.0 2.5 0.5 1.5 1.5 100.0 AAA"


def test_program_from_files(spark, tmp_dir):
    """The whole reference flow: CSV prices + multi-line JSON assets -> report file."""
    from assetrank.plans.program import run_program

    lines = []
    for t, step in (("AAA", 1.01), ("BBB", 1.02), ("CCC", 1.03)):
        closes = walk(260, step=step)
        for i, c in enumerate(closes):
            d = D0 + dt.timedelta(days=i)
            lines.append(f"{d.year}-{d.month}-{d.day},{c},{c},{c},{c},{c},100,{t}")
    lines.append("2019-1-2,,1,1,1,1,1,AAA")  # dropped by the null filter
    lines.append("2019-1-3,1,1,1,x,1,1,AAA")  # dropped as unparsable
    with open(f"{tmp_dir}/prices.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/assets.json", "w") as fh:
        fh.write(
            '[{"symbol": "AAA", "name": "A Co", "industry": "I1", "sector": "S1", "price_earning_ratio": 10},\n'
            ' {"symbol": "BBB", "name": "B Co", "industry": "I2", "sector": "S2", "price_earning_ratio": 30.5},\n'
            ' {"symbol": "CCC", "name": "C Co", "industry": "I3", "sector": "S3", "price_earning_ratio": 12.5}]'
        )
    padded = run_program(
        spark, f"{tmp_dir}/prices.csv", f"{tmp_dir}/assets.json", f"{tmp_dir}/results", end_date="2030-01-01",
        volatility_ceiling=100.0, k=5,
    )
    got = [(r.rank, r.ticker) for r in padded.orderBy("rank").collect()]
    # BBB fails the P/E threshold; two filled slots, three empty
    assert [g[1] for g in got[:2]] == ["CCC", "AAA"] and all(g[1] is None for g in got[2:])
    report = rep.read_report(spark, f"{tmp_dir}/results").collect()[0].value
    assert report.startswith("Rank 1: C Co (CCC)\n  - Industry: I3\n") and report.endswith("Rank 5: NULL\n\n")


def test_trailing_window_beyond_group_limit(spark):
    """A window larger than Spark's WindowGroupLimit threshold gives the same result."""
    rows = series_rows("A", walk(40)) + series_rows("B", walk(7))
    df = prices_df(spark, rows)
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    try:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
        t = feat.trailing_n(df, 30, tiebreak=("seq",))
        big = {(r.ticker, r.rn): r.close for r in t.collect()}
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    small = {(r.ticker, r.rn): r.close for r in feat.trailing_n(df, 30, tiebreak=("seq",)).collect()}
    assert big == small and len(big) == 37


def test_print_report(spark, capsys):
    ranked = spark.createDataFrame(
        [(1, "T1", "Alpha", "Tech", "EU", 0.5, 1.25, 2.0)],
        "rank bigint, ticker string, name string, industry string, sector string, ret double, vol double, pe double",
    )
    text = rep.print_report(rk.pad_ranking(spark, ranked, 2))
    assert capsys.readouterr().out == text
    assert text.endswith("  - P/E Ratio: 2.0\n\nRank 2: NULL\n\n")


def test_cutoff_needs_no_year_column(spark):
    """An unrelated ``year`` column drops nothing; a year partition is used when named."""
    rows = [("A", dt.date(1999, 6, 1), 2005), ("A", dt.date(1999, 6, 2), None), ("A", dt.date(2001, 1, 1), 1990)]
    df = spark.createDataFrame(rows, "ticker string, date date, year int")
    assert feat.filter_end_date(df, "2000-01-01").count() == 2
    assert feat.filter_end_date(df, "2000-01-01", year_partition="year").count() == 0


def test_cutoff_day_is_inclusive_for_timestamps(spark):
    rows = [(dt.datetime(2020, 4, 1, h),) for h in (0, 9, 23)] + [(dt.datetime(2020, 4, 2),)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"date {kind}")
        assert feat.filter_end_date(df, "2020-04-01").count() == 3


def test_history_longer_than_the_window(spark):
    df = prices_df(spark, series_rows("A", walk(60)) + series_rows("B", walk(39)))
    out = feat.asset_features(df, tiebreak=("seq",), window=25, min_history=40).collect()
    assert [(r.ticker, r.n) for r in out] == [("A", 25)]


def test_tiebreak_is_required(spark):
    df = prices_df(spark, series_rows("A", walk(5)))
    for call in (lambda: feat.trailing_n(df, 2), lambda: feat.asset_features(df), lambda: feat.returns_k(df, 1), lambda: rank_investments(df, df)):
        with pytest.raises(TypeError):
            call()


def test_padding_cuts_what_is_beyond_k(spark):
    ranked = spark.range(1, 100).selectExpr("id AS rank", "'T' AS ticker")
    assert [r["rank"] for r in rk.pad_ranking(spark, ranked, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_shared_dir_needs_a_shared_folder():
    from assetrank.config import shared_dir

    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared_dir(Session, "x")


def test_file_program_takes_all_settings(spark, tmp_dir):
    from assetrank.plans.program import rank_from_files

    lines = [f"{(D0 + dt.timedelta(days=i)).isoformat()},{c},{c},{c},{c},{2 * c},100,AAA" for i, c in enumerate(walk(40))]
    with open(f"{tmp_dir}/prices.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/assets.json", "w") as fh:
        fh.write('[{"symbol": "AAA", "name": "A", "industry": "I", "sector": "S", "price_earning_ratio": 10}]')
    settings = {"end_date": "2030-01-01", "volatility_ceiling": 100.0, "k": 1}
    paths = (f"{tmp_dir}/prices.csv", f"{tmp_dir}/assets.json")
    assert rank_from_files(spark, *paths, **settings).first().ticker is None  # too short a history
    got = rank_from_files(spark, *paths, window=20, return_days=2, price_col="adj_close", min_history=30, **settings).first()
    assert got.ticker == "AAA" and got.ret == pytest.approx(walk(40)[-1] / walk(40)[-3] - 1)


def test_rejects_tell_reason_and_file(spark, tmp_dir):
    good = "2020-01-02,1,2,3,4,5,6,AAA"
    lines = {
        "a.csv": [good, "2020-1-2,1,2,3,4,5,6,AAA,more,fields", "bad,1,2,3,4,5,6,AAA", "2020-01-02,1,,3,4,5,6,AAA", "2020-01-02,1,2", ""],
        "b.csv": ["2020-01-02,1,2,3,x,5,6,AAA", "2020-01-02,1,2,3,4,5,6,", '2020-01-02,1,2,3,4,5,6,"A', 'B"', good],
    }
    os.makedirs(f"{tmp_dir}/csv")
    for name, text in lines.items():
        with open(f"{tmp_dir}/csv/{name}", "w") as f:
            f.write("\n".join(text) + "\n")
    found = psrc.explain_rejects(spark, f"{tmp_dir}/csv").collect()
    got = sorted((os.path.basename(r.file), r.reason, r.line) for r in found)
    assert ("a.csv", "unparsable date", None) in got and ("a.csv", "empty high", None) in got
    assert ("a.csv", "wrong number of fields", "2020-01-02,1,2") in got
    assert ("b.csv", "unparsable close", None) in got and ("b.csv", "empty ticker", None) in got
    assert [r for r in got if r[0] == "b.csv" and r[1] == "wrong number of fields"]
    # what is told here is what cleaning drops, no more
    raw = psrc.scan_prices_csv(spark, f"{tmp_dir}/csv")
    assert len(found) + psrc.load_prices(raw).count() == raw.count()
    # a quoted line break is one field
    whole = psrc.explain_rejects(spark, f"{tmp_dir}/csv", multi_line=True)
    assert whole.where("file LIKE '%b.csv'").count() == 2


def test_program_runs_once_and_reports_a_file(spark, tmp_dir):
    """The report is one file that appears whole; the returned ranking reads what was ranked."""
    rows = [(f"2020-{1 + d // 28}-{1 + d % 28}", *["1"] * 3, str(10 + (d * 7) % 5), "1", "1", "T1") for d in range(300 // 28 * 28)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in psrc.RAW_COLUMNS)).write.csv(f"{tmp_dir}/prices")
    spark.createDataFrame([("T1", "One", "I", "S", 3.0)], "symbol string, name string, industry string, sector string, price_earning_ratio double").write.json(f"{tmp_dir}/assets")
    os.makedirs(f"{tmp_dir}/out")
    with open(f"{tmp_dir}/out/SPARK.DONE", "w") as f:
        f.write("old")
    ranked = run_program(spark, f"{tmp_dir}/prices", f"{tmp_dir}/assets", f"{tmp_dir}/out", end_date="2021-01-01", window=20, min_history=20, volatility_ceiling=100.0, assets_multi_line=False)
    with open(f"{tmp_dir}/out/SPARK.DONE") as f:
        assert f.read().startswith("Rank 1: One (T1)\n")
    assert sorted(n for n in os.listdir(f"{tmp_dir}/out") if not n.endswith(".crc")) == ["SPARK.DONE"]
    assert [r.ticker for r in ranked.collect()] == ["T1", None, None, None, None]
    assert "/prices" not in ranked._jdf.queryExecution().executedPlan().toString()

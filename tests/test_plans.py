"""Physical plan checks: the plans that should survive a 1000x scale-up."""

import re


from assetrank.operators import features as feat
from assetrank.operators import series as S
from assetrank.operators.scan import plan_blocks
from assetrank.plans import catalog as C
from assetrank.sources import fixtures as fx
from tests_plan_util import plan_text as plan

SF = "/root/testdata/sf0.01"


def exchanges(text):
    return re.findall(r"Arguments: (hashpartitioning\([^\]]*?\)|rangepartitioning\([^\]]*?\)|SinglePartition)", text)


def test_flagship_plan(spark):
    p = plan(C._ranking(spark, SF))
    # the price rows meet once, by ticker, with a limit on both sides of the exchange
    ex = sorted(e for e in exchanges(p) if e.startswith("hashpartitioning"))
    assert len(ex) == 1 and re.match(r"hashpartitioning\(ticker#\d+L?, \d+\)", ex[0]), ex
    assert len(re.findall(r"\n\(\d+\) WindowGroupLimit", p)) == 2 and "Partial" in p and "Final" in p
    # cutoff reaches the scan; only the needed lineitem columns are read
    assert "LessThan(l_shipdate,2000-01-02" in p
    li = re.search(r"ReadSchema: (struct<l_[^>]*>)", p).group(1)
    assert "l_comment" not in li and "l_discount" not in li and "l_returnflag" not in li
    # P/E filter on the supplier scan side, before the join
    assert re.search(r"Filter.*\n.*\n.*Condition : .*s_acctbal", p)
    assert "BroadcastHashJoin" in p
    for slow in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert slow not in p
    assert "TakeOrderedAndProject" in p


def test_trailing_window_is_cut_before_the_exchange(spark):
    """Any n: counts per (ticker, day) give a broadcast of a fixed number of cuts, which
    filters the rows before the one exchange by ticker."""
    prices = feat.filter_end_date(fx.prices(spark, SF), C.END)
    for n in (251, 5000):
        p = plan(feat.trailing_n(prices, n, tiebreak=C.ORD, histogram=True))
        assert re.search(r"TakeOrderedAndProject.*\n(?:.*\n)*?Arguments: 65536, ", p)
        assert "_salt" not in p
        tree = p[: p.index("\n(1) ")]
        # from the top: window, limits, sort, the rows' exchange, then the cut below it
        order = [re.search(r"[A-Z]\w+", line).group() for line in tree.splitlines()[2:] if re.search(r"[A-Z]\w+", line)]
        assert order.index("Window") < order.index("Exchange") < order.index("BroadcastHashJoin"), order
        # the histogram reads key and day only
        assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_blocked_scan_shuffles_by_key_and_block(spark):
    t = fx.ticks(spark, SF)
    df = S.cum_sum(t, C.TICK_SERIES, "x")
    p = plan(df)
    ex = exchanges(p)
    # the row-level exchange is by (series key, block); per-key exchanges only see block summaries
    assert any(re.match(r"hashpartitioning\(_k#\d+, _tb#\d+L?, \d+\)", e) for e in ex), ex
    assert not any(re.match(r"hashpartitioning\(ticker#\d+, \d+\)", e) for e in ex), ex
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_ewm_has_no_rounds(spark):
    """The same plan whatever the lengths: windows over rows, over stretches and over blocks, the rows exchanged by (key, block)."""
    t = fx.ticks(spark, SF)
    few, many = (S.ewm(t, C.TICK_SERIES, "x", 12, plan=plan_blocks(t, C.TICK_SERIES, rows)) for rows in (10_000, 50))
    count = lambda df: len(re.findall(r"\n\(\d+\) Window", plan(df)))
    assert count(few) == count(many) <= 20
    assert not any(re.match(r"hashpartitioning\(ticker#\d+, \d+\)", e) for e in exchanges(plan(many)))


def test_sliding_cost_does_not_depend_on_the_size(spark):
    """Frames are running ones or one fixed row away; none goes over the window again."""
    t = fx.ticks(spark, SF)
    p = plan(S.sliding_agg(t, C.TICK_SERIES, "x", 500))
    frames = re.findall(r"specifiedwindowframe\(RowFrame, ([^,]+), ([^)]+)\)", p)
    assert frames and all(a == "unboundedpreceding$()" or a == b for a, b in frames), set(frames)


def test_no_python_udf_anywhere(spark):
    for name in ("ewm", "sliding_agg", "expanding_agg", "volatility", "order_within_ticker"):
        p = plan(C.QUERIES[name](spark, SF))
        for slow in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert slow not in p, (name, slow)


def test_operators_read_the_laid_out_rows_only(spark):
    """One layout serves all operators: they scan its files, never the input again, and sort no rows for an aggregate."""
    t = fx.ticks(spark, SF)
    blocks = plan_blocks(t, C.TICK_SERIES)
    for op in (S.order_within, lambda *a, **k: S.cum_sum(*a, "x", **k), lambda *a, **k: S.diff(*a, "x", **k)):
        p = plan(op(t, C.TICK_SERIES, plan=blocks))
        assert "events.parquet" not in p and "SortAggregate" not in p
        assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*/blocks-", p)) <= 2


def test_sliding_rows_are_exchanged_once(spark):
    t = fx.ticks(spark, SF)
    df = S.sliding_agg(t, C.TICK_SERIES, "x", 20)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    rows = re.findall(r"\+- Exchange hashpartitioning\(_k#\d+, _tb#\d+L?, \d+\)", final)
    assert len(rows) == 1, final

"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the driver's tables (or files Spark writes from them) in
full. Parameters are the fixture values: cutoff 2000-01-01, volatility
ceiling 1.3, P/E threshold 25, window 251, 5-day returns, top 5. Doubles are
rounded to 6 places on both sides so the engines' last-bit differences do
not matter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from assetrank.config import shared_dir
from assetrank.functions.dates import instant_from_string, instant_from_ymd
from assetrank.functions.indicators import ident
from assetrank.operators import features as feat
from assetrank.operators import ranking as rk
from assetrank.operators import report as rep
from assetrank.operators import series as ser
from assetrank.operators.layout import StoredPlan, append_layout, open_layout, store_layout
from assetrank.operators.scan import Series
from assetrank.plans.program import rank_from_files
from assetrank.plans.rank import rank_investments
from assetrank.sources import assets as asrc
from assetrank.sources import files
from assetrank.sources import fixtures as fx
from assetrank.sources import prices as psrc
from assetrank.streaming.prices import ingest_prices

END = "2000-01-01"
CEILING = 1.3
PE_MAX = 25.0
WINDOW = 251
DAYS = 5
K = 5
PAD_K = 15
EWM_SPAN = 12
SLIDE = 20
LIST_SLIDE = 5
USER_RETURN_DAYS = 60

ORD = fx.PRICE_TIEBREAK
PRICE_SERIES = Series(("ticker",), ("date", *ORD))
TICK_SERIES = Series(("ticker",), ("ts", "event_id"))
BAR_SERIES = Series(("ticker",), ("ts",))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _fix_rounding(sql.strip())
        return fn

    return register


def round6(c):
    """Round half up to 6 places with IEEE arithmetic only.

    ``F.round`` rounds the decimal text of a double, DuckDB the binary value,
    so exact ties (a price divided by 32) differ. floor(x * 1e6 + 0.5) / 1e6
    gives the same double in both engines; NaN, infinities and huge values
    pass through.
    """
    y = c * F.lit(1e6) + F.lit(0.5)
    return F.when(F.isnan(y) | (F.abs(y) >= F.lit(1e15)), c).otherwise(F.floor(y).cast("double") / F.lit(1e6))


def _round6_sql(c: str) -> str:
    y = f"({c} * 1e6D + 0.5D)"
    return f"CASE WHEN isnan({y}) OR abs({y}) >= 1e15D THEN {c} ELSE CAST(floor({y}) AS DOUBLE) / 1e6D END"


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (the oracle does the same)."""
    cols = []
    for f in df.schema:
        q = ident(f.name)
        cols.append(f"{_round6_sql(q)} AS {q}" if isinstance(f.dataType, DoubleType) else q)
    return df.selectExpr(*cols)


def _sql_round6(expr: str) -> str:
    y = f"(({expr}) * 1e6 + 0.5)"
    return f"(case when isnan({y}) or abs({y}) >= 1e15 then ({expr}) else floor({y}) / 1e6 end)"


def _fix_rounding(sql: str) -> str:
    """Rewrite every ``round(expr, 6)`` into the engine-independent form."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + 6 : k]
        if inner.rstrip().endswith(", 6"):
            out.append(sql[i:j] + _sql_round6(_fix_rounding(inner.rstrip()[:-3])))
        else:
            out.append(sql[i : k + 1])
        i = k + 1


def _bar_text(c: str = "ts"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("bar")


# --------------------------------------------------------------------------
# SQL building blocks (DuckDB)
# --------------------------------------------------------------------------

_ORD_DESC = "date desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_quantity desc"
_ORD_ASC = "date, l_orderkey, l_linenumber, l_partkey, l_quantity"

PRICES = """prices as (
  select l_suppkey as ticker, cast(l_shipdate as date) as date, l_extendedprice / l_quantity as close,
         l_orderkey, l_linenumber, l_partkey, l_quantity
  from lineitem)"""

ASSETS = """assets as (
  select s_suppkey as ticker, s_name as name, n_name as industry, r_name as sector, s_acctbal / 200.0 as pe
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def _jdiv(num: str, den: str) -> str:
    """IEEE double division written out (x/0 is +-inf or NaN)."""
    return (
        f"(case when {den} <> 0 then ({num}) / ({den}) when ({num}) > 0 then 'inf'::double "
        f"when ({num}) < 0 then '-inf'::double when ({num}) is not null and ({den}) is not null then 'nan'::double end)"
    )


def _slog(r: str) -> str:
    return f"(case when isnan({r}) then {r} when {r} > 0 then ln({r}) when {r} < 0 then -ln(-{r}) else {r} end)"


def _features_sql(source: str, order_desc: str) -> str:
    """The features CTE chain over ``source`` (ticker, date, close, ...)."""
    return f"""fp as (select * from {source} where date <= date '{END}'),
fx as (
  select ticker, close, row_number() over w as rn, lead(close) over w as prev from fp
  window w as (partition by ticker order by {order_desc})),
fy as (
  select ticker, rn, close, case when rn < {WINDOW} then {_jdiv('close - prev', 'prev')} end as r
  from fx where rn <= {WINDOW}),
fz as (select *, {_slog('r')} as s from fy),
fg as (
  select ticker, count(*) as n, stddev_pop(s) as sd,
         max(close) filter (where rn = 1) as c0, max(close) filter (where rn = {DAYS + 1}) as ck
  from fz group by ticker),
features as (
  select ticker, n,
         case when n < {DAYS + 1} then 0.0 else {_jdiv('c0 - ck', 'ck')} end as ret,
         case when n < 2 then 0.0 else sd end as vol
  from fg where n >= {WINDOW})"""


FEATURES = _features_sql("prices", _ORD_DESC)


def _money(x: str) -> str:
    cents = f"cast(floor({x} * 100.0) as bigint)"
    return f"(cast({cents} // 100 as varchar) || '.' || lpad(cast((({cents} % 100) + 100) % 100 as varchar), 2, '0'))"


PRICE_TEXT = f"""price_text as (
  select strftime(cast(l_shipdate as date), '%Y-%-m-%-d') as date,
         case when l_linenumber <> 7 then {_money('px * (1 - l_discount)')} end as open,
         {_money('px * (1 + l_tax)')} as high,
         {_money('px * (1 - l_discount - l_tax)')} as low,
         case when l_linenumber = 6 and l_returnflag = 'R' then 'x' else {_money('px')} end as close,
         {_money('px * (1 - l_discount)')} as adj_close,
         cast(cast(l_quantity as bigint) as varchar) as volume,
         'T' || cast(l_suppkey as varchar) as ticker
  from (select *, l_extendedprice / l_quantity as px from lineitem))"""

PARSED = """parsed as (
  select ticker,
         case when regexp_full_match(trim(date), '\\d{4}-\\d{1,2}-\\d{1,2}') then try_cast(trim(date) as date) end as date,
         try_cast(open as double) as open, try_cast(high as double) as high, try_cast(low as double) as low,
         try_cast(close as double) as close, try_cast(adj_close as double) as adj_close,
         try_cast(volume as double) as volume
  from price_text)"""

BARS = """bars as (
  select event_type as ticker, date_trunc('hour', ts) as ts,
         arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low,
         arg_max(value, (ts, event_id)) as close, cast(count(*) as double) as volume
  from events group by event_type, date_trunc('hour', ts))"""

BAR_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S') as bar"

ASSET_RECORDS = """records as (
  select 'T' || cast(ticker as varchar) as symbol, 'ISIN' || cast(ticker as varchar) as isin,
         cast(null as varchar) as figi, name, cast(null as varchar) as description, industry, sector,
         pe as price_earning_ratio, cast(null as double) as growth
  from assets)"""

RANKED = f"""ranked as (
  select cast(row_number() over (order by ret desc, f.ticker) as bigint) as rank, f.ticker, name, industry, sector,
         ret, vol, pe
  from features f join assets a on f.ticker = a.ticker
  where vol < {CEILING} and pe is not null and pe <> 0 and pe < {PE_MAX}
  qualify rank <= {PAD_K}),
slots as (select cast(range as bigint) as rank from range(1, {PAD_K + 1})),
padded as (select s.rank, ticker, name, industry, sector, ret, vol, pe from slots s left join ranked r on s.rank = r.rank)"""


def _num6(c: str) -> str:
    return f"coalesce(printf('%.6f', round({c}, 6)), 'null')"


REPORT = f"""report as (
  select rank, case when ticker is null then 'Rank ' || cast(rank as varchar) || ': NULL' || chr(10)
    else 'Rank ' || cast(rank as varchar) || ': ' || coalesce(name, 'null') || ' (' || cast(ticker as varchar) || ')' || chr(10)
      || '  - Industry: ' || coalesce(industry, 'null') || chr(10)
      || '  - Sector: ' || coalesce(sector, 'null') || chr(10)
      || '  - Returns: ' || {_num6('ret')} || chr(10)
      || '  - Volatility: ' || {_num6('vol')} || chr(10)
      || '  - P/E Ratio: ' || {_num6('pe')} || chr(10) end as text
  from padded)"""


# --------------------------------------------------------------------------
# Sources, parsing, filters
# --------------------------------------------------------------------------


_WRITTEN: dict[tuple[str, str, str, int], str] = {}


def _written(spark: SparkSession, sf_dir: str, kind: str, source: str, write) -> str:
    """Write a text copy of a table once per application and state of the table.

    The CSV and JSON sources are tested on files Spark writes from the given
    tables; the CSV queries share one copy instead of writing the whole
    lineitem table each. A table that changed is copied anew.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, files.changed(spark, f"{sf_dir}/{source}.parquet"))
    path = _WRITTEN.get(key)
    if path is None or files.changed(spark, path) is None:
        path = shared_dir(spark, kind)
        write(path)
        _WRITTEN[key] = path
    return path


def _price_csv_path(spark: SparkSession, sf_dir: str) -> str:
    return _written(spark, sf_dir, "prices_csv", "lineitem", lambda p: psrc.write_prices_csv(fx.price_text(spark, sf_dir), p))


def _assets_json_path(spark: SparkSession, sf_dir: str) -> str:
    return _written(spark, sf_dir, "assets_json", "supplier", lambda p: asrc.write_assets_json(fx.asset_records(spark, sf_dir), p))


def _layout(spark: SparkSession, sf_dir: str, kind: str, source: str, df: DataFrame, s: Series) -> StoredPlan:
    """The stored layout of a series: the first query that needs it writes it, the others reopen it."""
    return open_layout(spark, _written(spark, sf_dir, f"layout_{kind}", source, lambda p: store_layout(df, s, p)))


def _ticks_layout(spark, sf_dir, by="event_type"):
    return _layout(spark, sf_dir, f"ticks_{by}", "events", fx.ticks(spark, sf_dir, by=by), TICK_SERIES)


def _bars_layout(spark, sf_dir):
    return _layout(spark, sf_dir, "bars", "events", fx.bars(spark, sf_dir), BAR_SERIES)


def _written_price_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return psrc.scan_prices_csv(spark, _price_csv_path(spark, sf_dir))


@query("scan_prices_csv", f"with {PRICE_TEXT} select * from price_text")
def q_scan_prices_csv(spark, sf_dir):
    return _written_price_csv(spark, sf_dir)


@query(
    "filter_null_prices",
    f"""with {PRICE_TEXT} select * from price_text
    where date is not null and open is not null and high is not null and low is not null and close is not null
      and adj_close is not null and volume is not null and ticker is not null""",
)
def q_filter_null_prices(spark, sf_dir):
    return psrc.filter_null_prices(fx.price_text(spark, sf_dir))


@query(
    "parse_prices",
    f"""with {PRICE_TEXT}, {PARSED}
    select ticker, date, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low,
           round(close, 6) as close, round(adj_close, 6) as adj_close, round(volume, 6) as volume from parsed""",
)
def q_parse_prices(spark, sf_dir):
    return r6(psrc.parse_prices(fx.price_text(spark, sf_dir)))


@query(
    "parse_rejects",
    f"""with {PRICE_TEXT}
    select * from price_text where not (
      ticker is not null and regexp_full_match(trim(coalesce(date, '')), '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
      and try_cast(trim(date) as date) is not null
      and try_cast(open as double) is not null and try_cast(high as double) is not null
      and try_cast(low as double) is not null and try_cast(close as double) is not null
      and try_cast(adj_close as double) is not null and try_cast(volume as double) is not null)""",
)
def q_parse_rejects(spark, sf_dir):
    return psrc.rejected_prices(fx.price_text(spark, sf_dir))


@query(
    "parse_rejects_from_files",
    f"""with {PRICE_TEXT}
    select *, case when open is null then 'empty open' else 'unparsable close' end as reason, true as from_csv
    from price_text where open is null or try_cast(close as double) is null""",
)
def q_parse_rejects_from_files(spark, sf_dir):
    """Rejected lines of the price files with reason and origin."""
    found = psrc.explain_rejects(spark, _price_csv_path(spark, sf_dir))
    return found.select(*psrc.RAW_COLUMNS, "reason", F.col("file").endswith(".csv").alias("from_csv"))


def _written_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asrc.scan_assets_json(spark, _assets_json_path(spark, sf_dir), multi_line=False)


@query(
    "scan_assets_json",
    f"""with {ASSETS}, {ASSET_RECORDS}
    select symbol, isin, figi, name, description, industry, sector,
           round(price_earning_ratio, 6) as price_earning_ratio, growth from records""",
)
def q_scan_assets_json(spark, sf_dir):
    return r6(_written_assets(spark, sf_dir))


_RECORDS_SQL = f"""with {ASSETS}, {ASSET_RECORDS}
    select symbol, isin, figi, name, description, industry, sector,
           round(price_earning_ratio, 6) as price_earning_ratio, growth from records"""


def _documents_path(spark, sf_dir):
    return _written(spark, sf_dir, "assets_json_documents", "supplier", lambda p: asrc.write_assets_documents(fx.asset_records(spark, sf_dir), p))


@query("scan_assets_json_documents", _RECORDS_SQL)
def q_scan_assets_json_documents(spark, sf_dir):
    """The multi-line form: every file is one JSON array over many lines."""
    return r6(asrc.scan_assets_json(spark, _documents_path(spark, sf_dir), multi_line=True))


@query("scan_assets_json_split", _RECORDS_SQL)
def q_scan_assets_json_split(spark, sf_dir):
    """The same files cut into records by many tasks."""
    return r6(asrc.scan_assets_json(spark, _documents_path(spark, sf_dir), multi_line="split"))


@query(
    "project_assets",
    f"""with {ASSETS}, {ASSET_RECORDS}
    select symbol as ticker, isin, figi, name, description, industry, sector,
           round(coalesce(price_earning_ratio, 0.0), 6) as pe, coalesce(growth, 0.0) as growth from records""",
)
def q_project_assets(spark, sf_dir):
    return r6(asrc.project_assets(fx.asset_records(spark, sf_dir), zero_missing_pe=True))


@query(
    "preview_first",
    f"""with {ASSETS}, {ASSET_RECORDS}
    select symbol as ticker, isin, figi, name, description, industry, sector,
           round(price_earning_ratio, 6) as pe, growth from records order by symbol limit 1""",
)
def q_preview_first(spark, sf_dir):
    return r6(asrc.preview_first(asrc.project_assets(_written_assets(spark, sf_dir))))


@query(
    "filter_end_date",
    f"""with {PRICES} select ticker, date, round(close, 6) as close, l_orderkey, l_linenumber, l_partkey, l_quantity
    from prices where date <= date '{END}'""",
)
def q_filter_end_date(spark, sf_dir):
    return r6(feat.filter_end_date(fx.prices(spark, sf_dir), END))


@query(
    "filter_min_history",
    f"""with {PRICES} select ticker, count(*) as n_prices from prices where date <= date '{END}'
    group by ticker having count(*) >= {WINDOW}""",
)
def q_filter_min_history(spark, sf_dir):
    return feat.filter_min_history(feat.filter_end_date(fx.prices(spark, sf_dir), END), WINDOW)


def _features(spark, sf_dir):
    p = feat.filter_end_date(fx.prices(spark, sf_dir), END)
    return feat.asset_features(p, window=WINDOW, return_days=DAYS, tiebreak=ORD)


def _assets(spark, sf_dir):
    return fx.assets(spark, sf_dir)


@query(
    "asset_features",
    f"with {PRICES}, {FEATURES} select ticker, n, round(ret, 6) as ret, round(vol, 6) as vol from features",
)
def q_asset_features(spark, sf_dir):
    return r6(_features(spark, sf_dir))


@query(
    "filter_volatility",
    f"""with {PRICES}, {FEATURES} select ticker, n, round(ret, 6) as ret, round(vol, 6) as vol
    from features where vol < {CEILING}""",
)
def q_filter_volatility(spark, sf_dir):
    return r6(rk.filter_volatility(_features(spark, sf_dir), CEILING))


@query(
    "filter_pe_ratio",
    f"""with {ASSETS} select ticker, name, industry, sector, round(pe, 6) as pe from assets
    where pe is not null and pe <> 0 and pe < {PE_MAX}""",
)
def q_filter_pe_ratio(spark, sf_dir):
    return r6(rk.filter_pe_ratio(_assets(spark, sf_dir), PE_MAX))


@query(
    "join_features_assets",
    f"""with {PRICES}, {ASSETS}, {FEATURES}
    select f.ticker, n, round(ret, 6) as ret, round(vol, 6) as vol, name, industry, sector, round(pe, 6) as pe
    from features f join assets a on f.ticker = a.ticker where vol < {CEILING}""",
)
def q_join_features_assets(spark, sf_dir):
    f = rk.filter_volatility(_features(spark, sf_dir), CEILING)
    return r6(rk.join_features_assets(f, _assets(spark, sf_dir)))


@query(
    "assemble_assets",
    f"""with {PRICES}, {ASSETS}, {FEATURES}
    select f.ticker, name, industry, sector, round(ret, 6) as ret, round(vol, 6) as vol, round(pe, 6) as pe
    from features f join assets a on f.ticker = a.ticker
    where vol < {CEILING} and pe is not null and pe <> 0 and pe < {PE_MAX}""",
)
def q_assemble_assets(spark, sf_dir):
    f = rk.filter_volatility(_features(spark, sf_dir), CEILING)
    a = rk.filter_pe_ratio(_assets(spark, sf_dir), PE_MAX)
    return r6(rk.assemble_assets(rk.join_features_assets(f, a)))


@query(
    "top_k_returns",
    f"""with {PRICES}, {FEATURES}
    select ticker, n, round(ret, 6) as ret, round(vol, 6) as vol,
           cast(row_number() over (order by ret desc, ticker) as bigint) as rank
    from features order by ret desc, ticker limit {K}""",
)
def q_top_k_returns(spark, sf_dir):
    return r6(rk.top_k_returns(_features(spark, sf_dir), K))


@query(
    "bottom_k_returns",
    f"""with {PRICES}, {FEATURES}
    select ticker, n, round(ret, 6) as ret, round(vol, 6) as vol,
           cast(row_number() over (order by ret asc, ticker) as bigint) as rank
    from features order by ret asc, ticker limit {K}""",
)
def q_bottom_k_returns(spark, sf_dir):
    return r6(rk.bottom_k_returns(_features(spark, sf_dir), K))


def _ranking(spark, sf_dir, k=K):
    return rank_investments(
        fx.prices(spark, sf_dir),
        _assets(spark, sf_dir),
        end_date=END,
        volatility_ceiling=CEILING,
        pe_threshold=PE_MAX,
        window=WINDOW,
        return_days=DAYS,
        k=k,
        tiebreak=ORD,
    )


@query(
    "rank_investments",
    f"""with {PRICES}, {ASSETS}, {FEATURES}
    select cast(row_number() over (order by ret desc, f.ticker) as bigint) as rank, f.ticker, name, industry, sector,
           round(ret, 6) as ret, round(vol, 6) as vol, round(pe, 6) as pe
    from features f join assets a on f.ticker = a.ticker
    where vol < {CEILING} and pe is not null and pe <> 0 and pe < {PE_MAX}
    order by ret desc, f.ticker limit {K}""",
)
def q_rank_investments(spark, sf_dir):
    return r6(_ranking(spark, sf_dir))


def _padded(spark, sf_dir):
    return rk.pad_ranking(spark, _ranking(spark, sf_dir, PAD_K), PAD_K)


@query(
    "pad_ranking",
    f"""with {PRICES}, {ASSETS}, {FEATURES}, {RANKED}
    select rank, ticker, name, industry, sector, round(ret, 6) as ret, round(vol, 6) as vol, round(pe, 6) as pe
    from padded""",
)
def q_pad_ranking(spark, sf_dir):
    return r6(_padded(spark, sf_dir))


@query("ranking_report", f"with {PRICES}, {ASSETS}, {FEATURES}, {RANKED}, {REPORT} select rank, text from report")
def q_ranking_report(spark, sf_dir):
    return rep.ranking_report(_padded(spark, sf_dir), digits=6)


@query(
    "write_report",
    f"""with {PRICES}, {ASSETS}, {FEATURES}, {RANKED}, {REPORT}
    select string_agg(text, chr(10) order by rank) || chr(10) as value from report""",
)
def q_write_report(spark, sf_dir):
    path = shared_dir(spark, "report")
    rep.write_report(rep.ranking_report(_padded(spark, sf_dir), digits=6), path)
    return rep.read_report(spark, path).select("value")


# --------------------------------------------------------------------------
# Grouping and ordering
# --------------------------------------------------------------------------


@query(
    "group_prices",
    f"with {PRICES} select ticker, count(*) as n, min(date) as first_date, max(date) as last_date from prices group by ticker",
)
def q_group_prices(spark, sf_dir):
    return ser.group_prices(fx.prices(spark, sf_dir), PRICE_SERIES)


@query(
    "order_within_ticker",
    f"""with {PRICES} select ticker, date, l_orderkey, l_linenumber, l_partkey, l_quantity,
    cast(row_number() over (partition by ticker order by {_ORD_ASC}) as bigint) as rn from prices""",
)
def q_order_within_ticker(spark, sf_dir):
    p = _layout(spark, sf_dir, "prices", "lineitem", fx.prices(spark, sf_dir), PRICE_SERIES)
    return ser.order_within(p.source, PRICE_SERIES, plan=p).drop("close")


@query(
    "trailing_n",
    f"""with {PRICES} select * from (
      select ticker, date, round(close, 6) as close, l_orderkey, l_linenumber, l_partkey, l_quantity,
             cast(row_number() over (partition by ticker order by {_ORD_DESC}) as bigint) as rn
      from prices where date <= date '{END}') where rn <= {WINDOW}""",
)
def q_trailing_n(spark, sf_dir):
    p = feat.filter_end_date(fx.prices(spark, sf_dir), END)
    t = feat.trailing_n(p, WINDOW, tiebreak=ORD)
    return r6(t.withColumn("rn", F.col("rn").cast("bigint")))


# --------------------------------------------------------------------------
# Indicators on raw series
# --------------------------------------------------------------------------

USER_TICKS = """ut as (select user_id as ticker, ts, event_id, value as x from events)"""
TYPE_TICKS = """tt as (select event_type as ticker, ts, event_id, value as x from events)"""


@query(
    "returns_k",
    f"""with {USER_TICKS},
    r as (select ticker, x, row_number() over (partition by ticker order by ts desc, event_id desc) as rn from ut),
    g as (select ticker, count(*) filter (where rn <= {USER_RETURN_DAYS + 1}) as n,
                 max(x) filter (where rn = 1) as c0, max(x) filter (where rn = {USER_RETURN_DAYS + 1}) as ck
          from r group by ticker)
    select ticker, round(case when n < {USER_RETURN_DAYS + 1} then 0.0 else {_jdiv('c0 - ck', 'ck')} end, 6) as ret
    from g""",
)
def q_returns_k(spark, sf_dir):
    t = fx.ticks(spark, sf_dir, by="user_id")
    return r6(feat.returns_k(t, USER_RETURN_DAYS, order=("ts", "event_id"), value_col="x"))


@query(
    "volatility",
    f"""with {USER_TICKS},
    p as (select ticker, x, lag(x) over (partition by ticker order by ts, event_id) as prev from ut),
    s as (select ticker, {_slog(_jdiv('x - prev', 'prev'))} as step from p),
    g as (select ticker, count(*) as n, stddev_pop(step) as sd from s group by ticker)
    select ticker, n, round(case when n < 2 then 0.0 else sd end, 6) as vol from g""",
)
def q_volatility(spark, sf_dir):
    t = _ticks_layout(spark, sf_dir, by="user_id")
    return r6(ser.volatility(t.source, TICK_SERIES, "x", plan=t))


def _type_aggs(spark, sf_dir):
    return ser.series_aggregates(fx.ticks(spark, sf_dir), TICK_SERIES, "x")


@query("series_sum", f"with {TYPE_TICKS} select ticker, round(sum(x), 6) as sum from tt group by ticker")
def q_series_sum(spark, sf_dir):
    return r6(_type_aggs(spark, sf_dir).select("ticker", "sum"))


@query("series_mean", f"with {TYPE_TICKS} select ticker, round(avg(x), 6) as mean from tt group by ticker")
def q_series_mean(spark, sf_dir):
    return r6(_type_aggs(spark, sf_dir).select("ticker", "mean"))


@query("series_std", f"with {TYPE_TICKS} select ticker, round(stddev_pop(x), 6) as std from tt group by ticker")
def q_series_std(spark, sf_dir):
    return r6(_type_aggs(spark, sf_dir).select("ticker", "std"))


@query(
    "cum_sum",
    f"""with {TYPE_TICKS} select ticker, event_id, round(x, 6) as x,
    round(sum(x) over (partition by ticker order by ts, event_id rows between unbounded preceding and current row), 6)
      as cum_sum from tt""",
)
def q_cum_sum(spark, sf_dir):
    t = _ticks_layout(spark, sf_dir)
    return r6(ser.cum_sum(t.source, TICK_SERIES, "x", plan=t).select("ticker", "event_id", "x", "cum_sum"))


@query(
    "ewm",
    f"""with {TYPE_TICKS} select ticker, event_id, round(list_reduce(
      list(x) over (partition by ticker order by ts, event_id rows between unbounded preceding and current row),
      lambda a, v: a + (2.0::double / {EWM_SPAN + 1}.0::double) * (v - a)), 6) as ewm from tt""",
)
def q_ewm(spark, sf_dir):
    t = _ticks_layout(spark, sf_dir)
    return r6(ser.ewm(t.source, TICK_SERIES, "x", EWM_SPAN, plan=t).select("ticker", "event_id", "ewm"))


@query(
    "appended_day",
    f"""with {TYPE_TICKS}, s as (
      select ticker, ts, event_id,
        sum(x) over (partition by ticker order by ts, event_id rows between unbounded preceding and current row) as cum_sum,
        list_reduce(list(x) over (partition by ticker order by ts, event_id rows between unbounded preceding and current row),
          lambda a, v: a + (2.0::double / {EWM_SPAN + 1}.0::double) * (v - a)) as ewm from tt)
    select ticker, event_id, round(cum_sum, 6) as cum_sum, round(ewm, 6) as ewm from s
    where date_trunc('day', ts) = (select date_trunc('day', max(ts)) from tt)""",
)
def q_appended_day(spark, sf_dir):
    """The last day's ticks appended to a stored layout of the days before; only they are computed."""
    t = fx.ticks(spark, sf_dir)
    last = t.agg(F.date_trunc("day", F.max("ts"))).first()[0]
    before = store_layout(t.where(F.col("ts") < F.lit(last)), TICK_SERIES, shared_dir(spark, "layout_ticks"))
    day = append_layout(before, t.where(F.col("ts") >= F.lit(last))).newest()
    sums = ser.cum_sum(day.source, TICK_SERIES, "x", plan=day).select("ticker", "event_id", "cum_sum")
    means = ser.ewm(day.source, TICK_SERIES, "x", EWM_SPAN, plan=day).select("ticker", "event_id", "ewm")
    return r6(sums.join(means, ["ticker", "event_id"]))


@query(
    "diff",
    f"""with {TYPE_TICKS} select ticker, event_id,
    round(x - coalesce(lag(x) over (partition by ticker order by ts, event_id), x), 6) as diff from tt""",
)
def q_diff(spark, sf_dir):
    t = _ticks_layout(spark, sf_dir)
    return r6(ser.diff(t.source, TICK_SERIES, "x", plan=t).select("ticker", "event_id", "diff"))


@query(
    "true_range",
    f"""with {BARS}, p as (select *, coalesce(lag(close) over (partition by ticker order by ts), close) as pc from bars)
    select ticker, {BAR_TEXT}, round(greatest(abs(low - pc), high - low, abs(high - pc)), 6) as true_range from p""",
)
def q_true_range(spark, sf_dir):
    b = _bars_layout(spark, sf_dir)
    return r6(ser.true_range(b.source, BAR_SERIES, plan=b).select("ticker", _bar_text(), "true_range"))


@query("true_price", f"with {BARS} select ticker, {BAR_TEXT}, round((high + low + close) / 3.0, 6) as true_price from bars")
def q_true_price(spark, sf_dir):
    b = fx.bars(spark, sf_dir)
    return r6(ser.true_price(b).select("ticker", _bar_text(), "true_price"))


@query(
    "sliding_agg",
    f"""with {BARS}, w as (
      select ticker, ts, count(*) over f as n, sum(close) over f as win_sum, avg(close) over f as win_mean,
             stddev_pop(close) over f as win_std from bars
      window f as (partition by ticker order by ts rows between {SLIDE - 1} preceding and current row))
    select ticker, {BAR_TEXT}, round(win_sum, 6) as win_sum, round(win_mean, 6) as win_mean,
           round(win_std, 6) as win_std from w where n = {SLIDE}""",
)
def q_sliding_agg(spark, sf_dir):
    b = _bars_layout(spark, sf_dir)
    s = ser.sliding_agg(b.source, BAR_SERIES, "close", SLIDE, plan=b)
    return r6(s.select("ticker", _bar_text(), "win_sum", "win_mean", "win_std"))


@query(
    "sliding_list",
    f"""with {USER_TICKS}, w as (
      select ticker, event_id, list(x) over f as l from ut
      window f as (partition by ticker order by ts, event_id rows between {LIST_SLIDE - 1} preceding and current row))
    select ticker, event_id, array_to_string(list_transform(l, lambda v: printf('%.6f', round(v, 6))), ',') as window
    from w where len(l) = {LIST_SLIDE}""",
)
def q_sliding_list(spark, sf_dir):
    t = _ticks_layout(spark, sf_dir, by="user_id")
    s = ser.sliding_list(t.source, TICK_SERIES, "x", LIST_SLIDE, plan=t)
    text = F.concat_ws(",", F.transform("window", lambda v: F.format_string("%.6f", round6(v))))
    return s.select("ticker", "event_id", text.alias("window"))


@query(
    "expanding_agg",
    f"""with {BARS}, w as (
      select ticker, ts, count(close) over f as exp_n, sum(close) over f as exp_sum, avg(close) over f as exp_mean,
             stddev_pop(close) over f as exp_std, lead(ts) over (partition by ticker order by ts) as nxt from bars
      window f as (partition by ticker order by ts rows between unbounded preceding and 1 preceding))
    select ticker, {BAR_TEXT}, exp_n, round(exp_sum, 6) as exp_sum, round(round(exp_sum, 6) / exp_n, 6) as exp_mean,
           round(exp_std, 6) as exp_std from w where nxt is not null""",
)
def q_expanding_agg(spark, sf_dir):
    # the mean is shown as (sum to 6 places) / n: sums of 2-decimal prices over
    # 32 rows land exactly on a 6-place tie, where one ulp decides the rounding
    b = _bars_layout(spark, sf_dir)
    e = ser.expanding_agg(b.source, BAR_SERIES, "close", plan=b)
    shown = round6(round6(F.col("exp_sum")) / F.col("exp_n")).alias("exp_mean")
    return r6(e.select("ticker", _bar_text(), "exp_n", "exp_sum", shown, "exp_std"))


# --------------------------------------------------------------------------
# Dates and text
# --------------------------------------------------------------------------


def _utc_text(instant):
    """An instant as UTC wall-clock text, whatever the session's time zone."""
    seconds = F.unix_seconds(instant).cast("decimal(18,6)")
    wall = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.date_format(wall, "yyyy-MM-dd HH:mm:ss")


@query(
    "instant_from_ymd",
    """select distinct cast(l_shipdate as date) as date,
      strftime(timezone('UTC', timezone('Europe/London', cast(cast(l_shipdate as date) as timestamp))),
               '%Y-%m-%d %H:%M:%S') as london_midnight_utc
    from lineitem""",
)
def q_instant_from_ymd(spark, sf_dir):
    d = fx.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    instant = instant_from_ymd(F.year("date"), F.month("date"), F.dayofmonth("date"))
    return d.select("date", _utc_text(instant).alias("london_midnight_utc"))


@query(
    "instant_from_string",
    f"""with {PRICE_TEXT} select distinct date as date_text,
      strftime(timezone('UTC', timezone('Europe/London', cast(try_cast(date as date) as timestamp))),
               '%Y-%m-%d %H:%M:%S') as london_midnight_utc
    from price_text""",
)
def q_instant_from_string(spark, sf_dir):
    d = fx.price_text(spark, sf_dir).select(F.col("date").alias("date_text")).distinct()
    return d.select("date_text", _utc_text(instant_from_string("date_text")).alias("london_midnight_utc"))


@query(
    "price_to_text",
    f"""with {BARS} select ticker, {BAR_TEXT},
      cast(day(ts) as varchar) || '/' || cast(month(ts) as varchar) || '/' || cast(year(ts) as varchar) || ' '
      || cast(open as varchar) || ' ' || cast(high as varchar) || ' ' || cast(low as varchar) || ' '
      || cast(close as varchar) || ' ' || cast(close as varchar) || ' ' || cast(volume as varchar) || ' ' || ticker
      as text from bars""",
)
def q_price_to_text(spark, sf_dir):
    b = fx.bars(spark, sf_dir)
    return rep.price_to_text(b).select("ticker", _bar_text(), "text")


# --------------------------------------------------------------------------
# The whole program from files
# --------------------------------------------------------------------------

_CSV_ORD_DESC = "date desc, close desc, open desc, high desc, low desc, adj_close desc, volume desc"


@query(
    "rank_from_files",
    f"""with {PRICE_TEXT}, {PARSED},
    clean as (select * from parsed where ticker is not null and date is not null and open is not null
              and high is not null and low is not null and close is not null and adj_close is not null
              and volume is not null),
    {_features_sql("clean", _CSV_ORD_DESC)},
    {ASSETS}, {ASSET_RECORDS},
    ranked as (
      select cast(row_number() over (order by ret desc, f.ticker) as bigint) as rank, f.ticker, name, industry,
             sector, ret, vol, price_earning_ratio as pe
      from features f join records r on f.ticker = r.symbol
      where vol < {CEILING} and price_earning_ratio is not null and price_earning_ratio <> 0
        and price_earning_ratio < {PE_MAX}
      qualify rank <= {K}),
    slots as (select cast(range as bigint) as rank from range(1, {K + 1}))
    select s.rank, ticker, name, industry, sector, round(ret, 6) as ret, round(vol, 6) as vol, round(pe, 6) as pe
    from slots s left join ranked r on s.rank = r.rank""",
)
def q_rank_from_files(spark, sf_dir):
    prices_path = _price_csv_path(spark, sf_dir)
    assets_path = _assets_json_path(spark, sf_dir)
    padded = rank_from_files(
        spark, prices_path, assets_path, end_date=END, volatility_ceiling=CEILING, pe_threshold=PE_MAX, k=K,
        assets_multi_line=False,
    )
    return r6(padded)


@query(
    "stream_prices",
    f"""with {PRICE_TEXT}, {PARSED}
    select ticker, date, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low,
           round(close, 6) as close, round(adj_close, 6) as adj_close, round(volume, 6) as volume
    from parsed where ticker is not null and date is not null and open is not null and high is not null
      and low is not null and close is not null and adj_close is not null and volume is not null""",
)
def q_stream_prices(spark, sf_dir):
    """Price CSV files ingested by Structured Streaming (availableNow), read back."""
    base = shared_dir(spark, "stream")
    src, out, chk = _price_csv_path(spark, sf_dir), f"{base}/out", f"{base}/checkpoint"
    ingest_prices(spark, src, out, chk).awaitTermination()
    return r6(spark.read.parquet(out).drop("year"))

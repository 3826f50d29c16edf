"""Per-row indicator expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def true_price(high: Column | str, low: Column | str, close: Column | str) -> Column:
    """Typical price (high + low + close) / 3."""
    return (_col(high) + _col(low) + _col(close)) / F.lit(3.0)


def true_range(high: Column | str, low: Column | str, prev_close: Column | str) -> Column:
    """max(|low - prev|, high - low, |high - prev|) (T6); caller supplies prev."""
    h, lo, p = _col(high), _col(low), _col(prev_close)
    return F.greatest(F.abs(lo - p), h - lo, F.abs(h - p))


# SQL text: building one ``F.expr`` costs a few py4j round trips, where
# composing Column objects costs several per operator.


def ident(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def double_sql(x: float) -> str:
    """A double literal in SQL text, infinities and NaN included."""
    x = float(x)
    if x != x:
        return "double('NaN')"
    if x in (float("inf"), float("-inf")):
        return "double('Infinity')" if x > 0 else "double('-Infinity')"
    return f"{x!r}D"


def java_divide_sql(num: str, den: str) -> str:
    """IEEE division as the JVM does it on doubles: x/0 is +-Infinity or NaN.

    Spark's ANSI ``/`` raises on a zero divisor, ``try_divide`` gives null;
    neither is what a double division yields.
    """
    return (
        f"CASE WHEN ({den}) <> 0 THEN ({num}) / ({den}) "
        f"WHEN ({num}) > 0 THEN double('Infinity') WHEN ({num}) < 0 THEN double('-Infinity') "
        f"WHEN ({num}) IS NOT NULL AND ({den}) IS NOT NULL THEN double('NaN') END"
    )


def pct_change_sql(cur: str, prev: str) -> str:
    """(cur - prev) / prev with the reference's double semantics."""
    return java_divide_sql(f"{cur} - {prev}", prev)


def signed_log_sql(r: str) -> str:
    """r > 0 -> ln r, r < 0 -> -ln(-r), r = 0 -> 0, NaN and null pass through.

    ``signum(r) * ln(abs(r))`` would be null at 0 and silently drop the point.
    Spark orders NaN above every number, so NaN is asked for first.
    """
    return f"CASE WHEN isnan({r}) THEN {r} WHEN {r} > 0 THEN ln({r}) WHEN {r} < 0 THEN -ln(-{r}) ELSE {r} END"

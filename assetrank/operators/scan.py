"""Skew-safe ordered scans over per-key series.

A plain ``Window.partitionBy(key)`` puts a whole series into one task; a key
holding a third of all rows would then run as a third of the job in a single
task. Here the rows are laid out once in the order of (key, order columns) by
Spark's range partitioning and written to the shared folder. Every range is a
**block**: the ranges hold about equally many rows, so a hot key spans many
blocks, a burst or a pile of copies at one instant is cut like anything else
(by the tie-break columns and, last, by an id per row), and short keys share a
block. Null keys, null, NaN and infinite order values sort where Spark sorts
them and need no care.

The work inside a block is an ordinary window over ``(key, block)``. What a
piece needs from the pieces before it (a running total, the last value, the
last ``size - 1`` rows, moments, an EWM state) comes from a table with one row
per (key, block), joined back on ``(key, block)``. A key is in as many blocks
as its rows fill, so that table has at most blocks + keys rows.

The key travels as the non-nullable struct ``_k``: null keys form their own
series, and the joins stay plain equi-joins that keep the rows' partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetrank.config import block_rows as conf_block_rows
from assetrank.config import shared_dir

# Internal series key: struct(key...) is never null, even when a key column is.
KEY = "_k"
#: Block number, growing along the order.
BLOCK = "_tb"
#: A number per row, growing along the order over all blocks and gapless inside a block.
INDEX = "_i"


@dataclass(frozen=True)
class Series:
    """How to read a DataFrame as many ordered series.

    ``key`` names the series (ticker); ``order`` sorts within it, most
    significant first; tie-break columns make it total.
    """

    key: tuple[str, ...]
    order: tuple[str, ...]

    @staticmethod
    def of(key: str | Sequence[str], order: str | Sequence[str]) -> "Series":
        k = (key,) if isinstance(key, str) else tuple(key)
        o = (order,) if isinstance(order, str) else tuple(order)
        if not k or not o:
            raise ValueError("a series needs at least one key and one order column")
        return Series(k, o)


@dataclass(frozen=True)
class BlockPlan:
    """One input laid out in blocks, ready for any number of operators."""

    source: DataFrame
    series: Series
    rows: DataFrame  # the input's columns without the key's, with _k, _tb, _i
    sizes: DataFrame  # _k, _tb, _n (rows), _lo (first _i): one row per (key, block)

    def check(self, df: DataFrame, s: Series) -> "BlockPlan":
        if s != self.series or not (df is self.source or df.sameSemantics(self.source)):
            raise ValueError("the plan was made for another input or series")
        return self

    def summary(self, name: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What an operator needs of each (key, block), ``of(rows)``. A stored layout
        (``layout.py``) keeps it by ``name``, so appended rows go on from it."""
        return of(self.rows)

    def whole(self) -> bool:
        """Whether ``rows`` are all rows that ``sizes`` counts."""
        return True

    def bounds(self) -> tuple[int, int]:
        """(most blocks of a key, most rows of a key in a block): a small job on ``sizes``."""
        top = self.sizes.groupBy(KEY).agg(F.count(F.lit(1)).alias("b"), F.max("_n").alias("n")).agg(F.max("b"), F.max("n")).first()
        return (top[0] or 0, top[1] or 0)


def plan_blocks(df: DataFrame, s: Series, block_rows: int | None = None) -> BlockPlan:
    """Lay ``df`` out in blocks. This runs jobs: Spark samples the input for the
    ranges, and the rows are written, sorted, to the shared folder
    (``spark.checkpoint.dir``). Make the plan once and pass it to every
    operator on the same input; an operator called without one makes its own.

    Without ``block_rows`` (and without ``assetrank.blockRows``) the session's
    shuffle settings size the blocks; with it the rows are counted first and
    blocks hold about that many.
    """
    rows = _written(lay_out(df, s, block_rows), "blocks")
    sizes = block_sizes(rows)
    return BlockPlan(df, s, rows, _written(sizes, "block-sizes"))


def lay_out(df: DataFrame, s: Series, block_rows: int | None = None, first_block: int = 0) -> DataFrame:
    """The input's columns without the key's, with _k, _tb, _i, sorted and cut into
    ranges; block numbers begin at ``first_block``."""
    block_rows = block_rows or conf_block_rows(df.sparkSession)
    # the last sort column tells rows apart that are equal in all order columns
    told = df.withColumns({KEY: F.struct(*s.key), "_id": F.monotonically_increasing_id()})
    order = [F.col(KEY), *(F.col(c) for c in s.order), F.col("_id")]
    if block_rows:
        ranged = told.repartitionByRange(max(1, -(-df.count() // block_rows)), *order)
    else:
        ranged = told.repartitionByRange(*order)
    # a block's rows are numbered from block << 33 on
    number = {BLOCK: F.spark_partition_id() + first_block, INDEX: F.monotonically_increasing_id() + (first_block << 33)}
    return ranged.sortWithinPartitions(*order).withColumns(number).drop("_id", *s.key)


def block_sizes(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy(KEY, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.min(INDEX).alias("_lo"), *more)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return read_laid(df.sparkSession, df.schema, path)


def read_laid(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    """Written rows or a table per (key, block) of them."""
    read = spark.read.schema(schema).parquet(*paths)
    # files know no "never null"; without it a join would filter one of two branches over
    # the same rows and they could not share an exchange
    sure = {c: F.coalesce(c, F.lit(-1).cast(schema[c].dataType)) for c in (BLOCK, INDEX) if c in schema.names}
    return read.withColumns({KEY: F.struct(*(F.col(KEY)[f].alias(f) for f in schema[KEY].dataType.names))} | sure)


def _plan(df: DataFrame, s: Series, plan: BlockPlan | None) -> BlockPlan:
    return plan.check(df, s) if plan else plan_blocks(df, s)


def finish(res: DataFrame, df: DataFrame, s: Series, *extra) -> DataFrame:
    """Original columns in their order (keys restored from ``_k``) plus ``extra``."""
    cols = [F.col(KEY)[c].alias(c) if c in s.key else F.col(c) for c in df.columns]
    return res.select(*cols, *extra)


def _in_block() -> Window:
    return Window.partitionBy(KEY, BLOCK).orderBy(INDEX)


def _over_blocks() -> Window:
    return Window.partitionBy(KEY).orderBy(BLOCK)


def _before() -> Window:
    return _over_blocks().rowsBetween(Window.unboundedPreceding, -1)


def join_on(rows: DataFrame, summary: DataFrame, keys: Sequence[str] = (KEY, BLOCK)) -> DataFrame:
    """Left equi-join of per-block values onto rows; Spark broadcasts the summary
    when it is small enough and else moves it to the rows' partitioning."""
    return rows.join(summary, list(keys), "left")


# --------------------------------------------------------------------------
# Positions (exact 1-based row numbers along the series)
# --------------------------------------------------------------------------


def _offsets(plan: BlockPlan) -> DataFrame:
    """``sizes`` with ``_off``, the rows of the key in earlier blocks."""
    return plan.sizes.withColumn("_off", F.coalesce(F.sum("_n").over(_before()), F.lit(0)))


def _placed(plan: BlockPlan) -> DataFrame:
    """Rows with ``_pos``: no window over rows, only the sizes of earlier blocks."""
    rows = join_on(plan.rows, _offsets(plan))
    return rows.withColumn("_pos", (F.col(INDEX) - F.col("_lo") + F.col("_off") + 1).cast("bigint"))


def with_positions(df: DataFrame, s: Series, plan: BlockPlan | None = None) -> DataFrame:
    """Add ``_pos``: the row's 1-based place in its series (skew-safe ``row_number``)."""
    return finish(_placed(_plan(df, s, plan)), df, s, "_pos")


def with_sliding_rows(df: DataFrame, s: Series, size: int, plan: BlockPlan | None = None) -> DataFrame:
    """Rows plus halo copies for windows of ``size`` rows.

    Every row gets ``_pos`` (its place in the series) and ``_own = true``. The
    last ``size - 1`` rows before a block also come, with ``_own = false``, into
    that block. Small consecutive pieces of a key first share a group, so that a
    series has at most one group per ``size`` rows: the copies never outnumber
    the rows, and a row is copied twice at most. Returns internal columns;
    window with :func:`sliding_window`, finish with :func:`finish`.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    plan = _plan(df, s, plan)
    if not plan.whole():
        raise ValueError("sliding windows need the rows before the newest generation: pass the whole layout")
    rows = _placed(plan)
    # a piece joins the group of the size-wide stretch of positions in which it begins
    group = F.floor(F.col("_off") / size).cast("bigint")
    rows = rows.withColumn("_g", group)
    keep = [c for c in rows.columns if c not in ("_n", "_lo", "_off", "_g", BLOCK)]
    own = rows.select(*keep, F.col("_g").alias(BLOCK), F.lit(True).alias("_own"))
    if size == 1:
        return own
    # a window reaches back over two groups at most: two together always hold more than ``size`` rows
    starts = _offsets(plan).withColumn("_g", group).groupBy(KEY, "_g").agg((F.min("_off") + 1).alias("_from"))
    nexts = Window.partitionBy(KEY).orderBy("_g")
    starts = starts.select(KEY, "_g", *(F.lead(c, k).over(nexts).alias(f"{c}{k}") for c in ("_g", "_from") for k in (1, 2)))
    near = rows.join(starts, [KEY, "_g"]).where(F.col("_from1") - F.col("_pos") < size)
    target = F.explode(F.array(*(F.struct(F.col(f"_g{k}").alias("g"), F.col(f"_from{k}").alias("f")) for k in (1, 2))))
    halo = near.withColumn("_t", target).where(F.col("_t.f") - F.col("_pos") < size)
    return own.unionByName(halo.select(*keep, F.col("_t.g").alias(BLOCK), F.lit(False).alias("_own")))


def sliding_window(s: Series, size: int):
    return Window.partitionBy(KEY, BLOCK).orderBy("_pos").rowsBetween(-(size - 1), Window.currentRow)


def with_window_parts(df: DataFrame, s: Series, col: str, size: int, plan: BlockPlan | None = None) -> DataFrame:
    """Complete windows of ``size`` rows as two parts each, in constant time a row.

    Positions are cut into stretches of ``size`` rows. A window that ends at a row
    is the row's stretch up to it (``_late``) and the end of the stretch before it,
    from the row ``size - 1`` places earlier on (``_early``). Both are running
    aggregates, one forwards and one backwards, and the second is looked up at that
    row; a moving frame would go over ``size`` rows again for every row. Nothing is
    taken off a running value, so no digits cancel, and minimum and maximum work too.
    Each part is a struct (n, sum, mean, var, min, max) of the non-null values.
    """
    # one exchange serves the three windows: all are inside (key, block)
    rows = with_sliding_rows(df, s, size, plan).repartition(KEY, BLOCK)
    rows = rows.withColumn("_s", F.floor((F.col("_pos") - 1) / size).cast("bigint"))
    x = F.col(col).cast("double")
    aggregates = {"n": F.count, "sum": F.sum, "mean": F.avg, "var": F.var_pop, "min": F.min, "max": F.max}

    def running(order: Column) -> Column:
        frame = Window.partitionBy(KEY, BLOCK, "_s").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.struct(*(fn(x).over(frame).alias(name) for name, fn in aggregates.items()))

    rows = rows.withColumn("_tail", running(F.col("_pos").desc())).withColumn("_late", running(F.col("_pos").asc()))
    if size > 1:
        early = F.lag("_tail", size - 1).over(Window.partitionBy(KEY, BLOCK).orderBy("_pos"))
    else:
        early = F.col("_tail")
    none = F.lit(None)
    alone = F.struct(F.lit(0).cast("bigint").alias("n"), *(none.cast("double").alias(c) for c in ("sum", "mean", "var", "min", "max")))
    # a window that is a whole stretch has no earlier part
    rows = rows.withColumn("_early", F.when(F.col("_pos") % size == 0, alone).otherwise(early))
    return rows.where(F.col("_own") & (F.col("_pos") >= size))


# --------------------------------------------------------------------------
# Previous value (lag by one along the series)
# --------------------------------------------------------------------------


def with_previous(df: DataFrame, s: Series, cols: Sequence[str], plan: BlockPlan | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each column: its value on the previous row, null
    on a series' first row. Inside a block it is ``lag``; the first row of a
    block takes the last row of the key's previous block."""
    plan = _plan(df, s, plan)
    b = plan.rows.withColumns({f"prev_{c}": F.lag(c).over(_in_block()) for c in cols})

    def ends(rows: DataFrame) -> DataFrame:
        return rows.groupBy(KEY, BLOCK).agg(*(F.max_by(c, INDEX).alias(f"_last{k}") for k, c in enumerate(cols)), F.min(INDEX).alias("_lo"))

    last = plan.summary(f"last {','.join(cols)}", ends)
    carry = last.select(KEY, BLOCK, "_lo", *(F.lag(f"_last{k}").over(_over_blocks()).alias(f"_last{k}") for k in range(len(cols))))
    out = join_on(b, carry)
    first = F.col(INDEX) == F.col("_lo")
    prev = [F.when(first, F.col(f"_last{k}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}") for k, c in enumerate(cols)]
    return finish(out, df, s, *prev)


# --------------------------------------------------------------------------
# Running and expanding aggregates
# --------------------------------------------------------------------------


def with_running_sum(df: DataFrame, s: Series, col: str, out: str, plan: BlockPlan | None = None) -> DataFrame:
    """``out`` = sum of ``col`` over the series up to and including the row."""
    plan = _plan(df, s, plan)
    b = plan.rows.withColumn("_loc", F.sum(col).over(_in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    tot = plan.summary(f"sum {col}", lambda rows: rows.groupBy(KEY, BLOCK).agg(F.sum(col).alias("_bs")))
    carry = tot.select(KEY, BLOCK, F.sum("_bs").over(_before()).alias("_carry"))
    res = join_on(b, carry)
    # nulls are skipped as in a plain running SUM window: null only while
    # every value so far is null
    loc, car = F.col("_loc"), F.col("_carry")
    total = F.when(loc.isNull() & car.isNull(), F.lit(None)).otherwise(F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0)))
    return finish(res, df, s, total.alias(out))


def with_expanding(df: DataFrame, s: Series, col: str, plan: BlockPlan | None = None, inclusive: bool = False) -> DataFrame:
    """Add ``exp_n``, ``exp_sum``, ``exp_mean``, ``exp_std`` (population) over
    all earlier rows of the series (``inclusive`` adds the row itself), and
    ``_last`` marking each series' final row.

    Inside a block Spark's running aggregates give count, sum, mean and
    variance. The earlier blocks add their count, sum and the sums of (x - c)
    and (x - c)^2, plain running sums over the block table; c is the mean of
    the key's finite block means, so the squares stay small. Empty windows
    give n = 0 and null sum, mean and deviation.
    """
    plan = _plan(df, s, plan)
    end = Window.currentRow if inclusive else -1
    frame = _in_block().rowsBetween(Window.unboundedPreceding, end)
    x = F.col(col).cast("double")
    aggregates = {"n": F.count, "sum": F.sum, "mean": F.avg, "var": F.var_pop}
    b = plan.rows.withColumns({f"_l{name}": fn(x).over(frame) for name, fn in aggregates.items()})
    blocks = plan.summary(f"moments {col}", lambda rows: rows.groupBy(KEY, BLOCK).agg(*(fn(x).alias(f"_l{name}") for name, fn in aggregates.items())))
    whole = Window.partitionBy(KEY)
    finite = F.when(F.abs("_lmean") < float("inf"), F.col("_lmean"))
    blocks = blocks.withColumn("_c", F.coalesce(F.avg(finite).over(whole), F.lit(0.0)))

    def shifted(c: str) -> tuple[Column, Column]:
        """Sums of (x - c) and (x - c)^2 of a block or of the block's part so far."""
        off = F.col("_lmean") - F.col(c)
        one = F.coalesce(F.col("_ln") * off, F.lit(0.0))
        return one, F.coalesce(F.col("_ln") * (F.col("_lvar") + off * off), F.lit(0.0))

    one, two = shifted("_c")
    blocks = blocks.withColumns({"_one": one, "_two": two})
    carry = blocks.join(plan.sizes, [KEY, BLOCK]).select(
        KEY, BLOCK, "_c", (F.col("_lo") + F.col("_n") - 1).alias("_hi"), F.lead(BLOCK).over(_over_blocks()).isNull().alias("_end"),
        *(F.coalesce(F.sum(v).over(_before()), F.lit(0)).alias(name) for v, name in (("_ln", "_pn"), ("_lsum", "_psum"), ("_one", "_pone"), ("_two", "_ptwo"))),
    )
    res = join_on(b, carry)
    one, two = shifted("_c")
    n = F.col("_pn") + F.col("_ln")
    total = F.col("_psum") + F.coalesce("_lsum", F.lit(0.0))
    s1, s2 = F.col("_pone") + one, F.col("_ptwo") + two
    res = res.withColumns({"_tn": n, "_tsum": total, "_tvar": F.try_divide(s2, n) - F.try_divide(s1, n) * F.try_divide(s1, n)})
    some = F.col("_tn") > 0
    return finish(
        res, df, s,
        F.col("_tn").cast("bigint").alias("exp_n"),
        F.when(some, F.col("_tsum")).alias("exp_sum"),
        F.when(some, F.col("_tsum") / F.col("_tn")).alias("exp_mean"),
        F.when(some, F.sqrt(F.greatest("_tvar", F.lit(0.0)))).alias("exp_std"),
        (F.col("_end") & (F.col(INDEX) == F.col("_hi"))).alias("_last"),
    )


# --------------------------------------------------------------------------
# Exponentially weighted mean (linear recurrence)
# --------------------------------------------------------------------------


#: A weight b^k goes down to 2^-WEIGHT_BITS inside a stretch of values.
WEIGHT_BITS = 340


def with_ewm(
    df: DataFrame,
    s: Series,
    col: str,
    span: float,
    out: str = "ewm",
    plan: BlockPlan | None = None,
) -> DataFrame:
    """``out`` = exponentially weighted mean with alpha = 2 / (1 + span),
    seeded with the first value: y0 = x0, y = y_prev + alpha * (x - y_prev).
    A null value leaves the mean as it is; before the first value it is null.
    After an infinite or NaN value it is that value, NaN once they differ.

    With b = 1 - alpha this is y_t = b * y_(t-1) + alpha * x_t started from the state
    x0, a sum of all values weighted by powers of b. Over a long series the
    powers leave the range of a double, so their exponent is split: values are
    counted, every ``stretch`` values make a stretch over which the weight falls to
    2^-340, and a value's weight is taken to the end of its stretch, in (2^-340, 1].

    1. a running sum inside a stretch of a block gives ``loc``, what the stretch
       itself adds to the state at a row;
    2. the state before a stretch is the end of the one before it, and 2^-340 of
       the one before that; three are taken, an older one adds less than 2^-1020 of
       its value, which no double shows;
    3. blocks of a key are put together the same way on the block table: running
       sums inside stretches of values, then the three stretches before.

    Each step is a window pass; there are no rounds, whatever the lengths.
    """
    if span < 1:
        raise ValueError("span must be >= 1")
    alpha = 2.0 / (1.0 + span)
    beta = 1.0 - alpha
    plan = _plan(df, s, plan)
    if not beta:
        return _with_last_value(df, s, col, out, plan)
    stretch = min(1 << 40, max(1, int(WEIGHT_BITS / -math.log2(beta))))  # values in a stretch

    def power(k: Column) -> Column:
        return F.pow(F.lit(beta), k)

    rows = _ewm_rows(plan.rows, col, alpha, stretch, power)
    ends = _ewm_ends(rows, stretch, power)
    blocks = plan.summary(f"ewm {col} {span!r}", lambda of: _ewm_blocks(_ewm_ends(_ewm_rows(of, col, alpha, stretch, power), stretch, power), power))
    blocks = _states_before(blocks, stretch, power)

    starts = ends.select(KEY, BLOCK, "_st", "_before").join(blocks, [KEY, BLOCK])
    state = F.col("_before") + power(F.col("_st") * stretch) * F.col("_s0")
    starts = starts.select(KEY, BLOCK, "_st", state.alias("_state"), "_seen", F.col("_odd").alias("_odd0"))
    res = join_on(rows, starts, [KEY, BLOCK, "_st"])
    y = F.col("_loc") + power(F.col("_c")) * F.col("_state")
    odd = F.when(F.col("_odd").isNotNull() | F.col("_odd0").isNotNull(), F.coalesce("_odd", F.lit(0.0)) + F.coalesce("_odd0", F.lit(0.0)))
    return finish(res, df, s, F.when(F.col("_seen") + F.col("_v") > 0, F.coalesce(odd, y)).alias(out))


def _with_last_value(df: DataFrame, s: Series, col: str, out: str, plan: BlockPlan) -> DataFrame:
    """``out`` = the newest non-null value: the mean of span 1, where each value replaces it."""
    x = F.col(col).cast("double")
    so_far = _in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = plan.rows.withColumn("_here", F.last(x, ignorenulls=True).over(so_far))
    ends = plan.summary(f"newest {col}", lambda of: of.groupBy(KEY, BLOCK).agg(F.max_by(x, F.when(x.isNotNull(), F.col(INDEX))).alias("_end")))
    carry = ends.select(KEY, BLOCK, F.last("_end", ignorenulls=True).over(_before()).alias("_prior"))
    return finish(join_on(rows, carry), df, s, F.coalesce("_here", "_prior").alias(out))


Power = Callable[[Column], Column]


def _ewm_rows(rows: DataFrame, col: str, alpha: float, stretch: int, power: Power) -> DataFrame:
    """Rows with ``_v`` (values of the block so far), ``_odd`` (sum of the infinite and NaN ones),
    ``_st`` (stretch in the block), ``_c`` (values in it so far) and ``_loc``."""
    x = F.col(col).cast("double")
    finite = F.abs(x) < float("inf")
    so_far = _in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = rows.withColumns({"_x": F.when(finite, x).when(x.isNotNull(), F.lit(0.0)), "_odd": F.when(~finite, x)})
    b = b.withColumns({"_v": F.count("_x").over(so_far), "_odd": F.sum("_odd").over(so_far)})
    b = b.withColumn("_st", F.floor(F.greatest(F.col("_v") - 1, F.lit(0)) / stretch).cast("bigint"))
    b = b.withColumn("_c", F.col("_v") - F.col("_st") * stretch)
    inside = Window.partitionBy(KEY, BLOCK, "_st").orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = power(F.lit(stretch) - F.col("_c"))
    b = b.withColumn("_sum", F.sum(F.lit(alpha) * F.col("_x") * weight).over(inside))
    return b.withColumn("_loc", F.when(F.col("_c") > 0, F.col("_sum") / weight).otherwise(0.0)).drop("_sum")


def _ewm_ends(rows: DataFrame, stretch: int, power: Power) -> DataFrame:
    """One row per (key, block, stretch), with ``_before``: the state before it, from the
    block's own stretches alone."""
    ends = rows.groupBy(KEY, BLOCK, "_st").agg(
        F.max_by("_loc", INDEX).alias("_end"), F.max("_c").alias("_n"), F.max("_v").alias("_v"), F.max_by("_odd", INDEX).alias("_odd"),
        F.min_by("_x", F.when(F.col("_x").isNotNull(), F.col(INDEX))).alias("_first"),
    )
    along = Window.partitionBy(KEY, BLOCK).orderBy("_st")
    before = [F.coalesce(F.lag("_end", d).over(along), F.lit(0.0)) * power(F.lit(stretch * (d - 1))) for d in (1, 2, 3)]
    return ends.withColumn("_before", before[0] + before[1] + before[2])


def _ewm_blocks(ends: DataFrame, power: Power) -> DataFrame:
    return ends.groupBy(KEY, BLOCK).agg(
        F.max("_v").alias("_v"), F.max_by(F.col("_end") + power(F.col("_n")) * F.col("_before"), "_st").alias("_end"),
        F.max_by("_odd", "_st").alias("_odd"), F.min_by("_first", F.when(F.col("_first").isNotNull(), F.col("_st"))).alias("_first"),
    )


def _states_before(blocks: DataFrame, stretch: int, power: Power) -> DataFrame:
    """KEY, BLOCK, ``_s0`` (the state before the block), ``_seen`` (values before it),
    ``_odd`` (sum of the infinite and NaN values before it) of a block table with the
    block's values ``_v``, its end ``_end`` from a state of zero, and its ``_first`` value.

    A block's end counts in the stretch of values (along the key) in which it ends.
    """
    upto = _over_blocks().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = _over_blocks().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = blocks.withColumns({"_seen": F.sum("_v").over(upto), "_x0": F.first("_first", ignorenulls=True).over(whole), "_odds": F.sum("_odd").over(upto)})
    t = t.withColumn("_e", F.floor((F.col("_seen") - 1) / stretch).cast("bigint"))
    last = (F.col("_e") + 1) * stretch
    weight = power(last - F.col("_seen"))
    inside = Window.partitionBy(KEY, "_e").orderBy(BLOCK)
    t = t.withColumn("_run", F.sum(F.col("_end") * weight).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = t.groupBy(KEY, "_e").agg(F.max_by("_run", BLOCK).alias("_t"))
    order = Window.partitionBy(KEY).orderBy("_e")
    totals = totals.select(KEY, "_e", *(F.lag(c, d).over(order).alias(f"{c}{d}") for c in ("_e", "_t") for d in (1, 2, 3)))
    t = t.join(totals, [KEY, "_e"])
    older = [F.coalesce(F.col(f"_t{d}") * power(F.col("_seen") - (F.col(f"_e{d}") + 1) * stretch), F.lit(0.0)) for d in (1, 2, 3)]
    after = F.col("_run") / weight + older[0] + older[1] + older[2] + power(F.col("_seen")) * F.col("_x0")
    t = t.withColumn("_after", after)
    return t.select(
        KEY, BLOCK, F.coalesce(F.lag("_after").over(_over_blocks()), "_x0").alias("_s0"),
        F.coalesce(F.lag("_seen").over(_over_blocks()), F.lit(0)).alias("_seen"), F.lag("_odds").over(_over_blocks()).alias("_odd"),
    )


__all__ = ["BLOCK", "INDEX", "KEY", "BlockPlan", "Series", "finish", "plan_blocks", "sliding_window"]

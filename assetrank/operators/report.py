"""Text sinks: ranking report (R1), price row text (R2), report file."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetrank.sources import files

# The report's labels, as the reference prints them.
RANK_PREFIX = "Rank "
EMPTY_SLOT = "NULL"
INDUSTRY_LABEL = "  - Industry: "
SECTOR_LABEL = "  - Sector: "
RETURNS_LABEL = "  - Returns: "
VOLATILITY_LABEL = "  - Volatility: "
PE_LABEL = "  - P/E Ratio: "
JAVA_NULL = "null"
REPORT_NAME = "SPARK.DONE"

NL = "\n"


def number_text(c: Column | str, digits: int | None = None) -> Column:
    """Double as text: JVM ``Double.toString`` style by default (``1.0E-5``,
    ``12.0``), or fixed ``digits`` decimals after rounding."""
    x = F.col(c) if isinstance(c, str) else c
    if digits is None:
        return F.coalesce(x.cast("string"), F.lit(JAVA_NULL))
    scale = F.lit(10.0**digits)
    y = x * scale + F.lit(0.5)
    rounded = F.when(F.isnan(y) | (F.abs(y) >= F.lit(1e15)), x).otherwise(F.floor(y).cast("double") / scale)
    return F.coalesce(F.format_string(f"%.{digits}f", rounded), F.lit(JAVA_NULL))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(JAVA_NULL))


def ranking_report(padded: DataFrame, digits: int | None = None) -> DataFrame:
    """One text block per rank slot (R1): rank, text.

    Filled slot: ``Rank i: name (ticker)`` and five indented lines; empty slot:
    ``Rank i: NULL``. Each block ends with a newline; joining the blocks with
    newlines gives the reference's report, blank line after each entry.
    """
    rank = F.col("rank").cast("string")
    filled = F.concat(
        F.lit(RANK_PREFIX), rank, F.lit(": "), _text("name"), F.lit(" ("), _text("ticker"), F.lit(")"), F.lit(NL),
        F.lit(INDUSTRY_LABEL), _text("industry"), F.lit(NL),
        F.lit(SECTOR_LABEL), _text("sector"), F.lit(NL),
        F.lit(RETURNS_LABEL), number_text("ret", digits), F.lit(NL),
        F.lit(VOLATILITY_LABEL), number_text("vol", digits), F.lit(NL),
        F.lit(PE_LABEL), number_text("pe", digits), F.lit(NL),
    )
    empty = F.concat(F.lit(RANK_PREFIX), rank, F.lit(": "), F.lit(EMPTY_SLOT), F.lit(NL))
    return padded.select("rank", F.when(F.col("ticker").isNull(), empty).otherwise(filled).alias("text"))


def price_to_text(prices: DataFrame, date_col: str = "date") -> DataFrame:
    """``d/m/y open high low close adj_close volume ticker`` per price row (R2).

    Day and month are unpadded, doubles in JVM text form, a null ticker reads
    ``null``.
    """
    d = F.col(date_col)
    day = F.concat_ws("/", F.dayofmonth(d).cast("string"), F.month(d).cast("string"), F.year(d).cast("string"))
    nums = [number_text(c) for c in ("open", "high", "low", "close", "adj_close", "volume")]
    return prices.withColumn("text", F.concat_ws(" ", day, *nums, _text("ticker")))


def write_report(report: DataFrame, path: str) -> str:
    """Write the report as the text file ``<path>/SPARK.DONE`` (S4); returns that file.

    One task writes the rank slots' blocks (one row each) into a folder aside, whose
    only file is then renamed: whoever waits for the report finds it whole. Only
    the report itself is replaced, whatever else lies in ``path`` stays.
    """
    spark = report.sparkSession
    folder = path.rstrip("/")
    aside = f"{folder}/.{REPORT_NAME}-{uuid.uuid4().hex[:12]}"
    report.coalesce(1).sortWithinPartitions("rank").select("text").write.text(aside)
    parts = [n for n in files.names(spark, aside) if n.startswith("part-")]
    target = f"{folder}/{REPORT_NAME}"
    # an empty report has no part in some Spark versions
    done = files.move(spark, f"{aside}/{parts[0]}", target, replace=True) if parts else files.write_text(spark, target, "")
    files.remove(spark, aside)
    files.remove(spark, f"{folder}/.{REPORT_NAME}.crc")  # the local file system's checksum, of no use to a reader
    if not done:
        raise OSError(f"the report could not be moved to {target}")
    return target


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report written under ``path`` back as one ``value`` row per file."""
    return spark.read.text(f"{path.rstrip('/')}/{REPORT_NAME}", wholetext=True)


def print_report(padded: DataFrame, digits: int | None = None) -> str:
    """Print the ranking report on the driver, slot by slot (S5), and return the text.
    All slots are printed; their number is the ranking's ``k``."""
    text = []
    for row in ranking_report(padded, digits).orderBy("rank").toLocalIterator():
        print(row["text"])
        text.append(row["text"] + NL)
    return "".join(text)

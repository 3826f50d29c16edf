"""Price source: headerless CSV scan (S1), null filter (F1), parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assetrank.functions.dates import parse_date

# The eight positional fields of a price row, in file order
# (Date, Open, High, Low, Close, Adj Close, Volume, Stock).
RAW_COLUMNS = ("date", "open", "high", "low", "close", "adj_close", "volume", "ticker")
NUMERIC_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])


def scan_prices_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Read price CSV as eight text columns.

    An explicit schema avoids an inference pass; extra trailing fields are
    ignored and short rows are padded with nulls. CSV splits by byte range,
    so a large file is read by many tasks.
    """
    return spark.read.schema(RAW_SCHEMA).option("header", header).option("mode", "PERMISSIVE").csv(path)


def write_prices_csv(df: DataFrame, path: str) -> None:
    """Write eight-column price text as headerless CSV (the reference's input format)."""
    df.select(*RAW_COLUMNS).write.mode("overwrite").option("header", False).csv(path)


def filter_null_prices(raw: DataFrame) -> DataFrame:
    """Drop rows with a null in any of the eight fields (F1).

    ``na.drop`` is a plain ``IS NOT NULL`` conjunction, which reaches the
    scan as pushed filters, unlike an opaque row lambda.
    """
    return raw.na.drop(how="any", subset=list(RAW_COLUMNS))


def parse_prices(raw: DataFrame) -> DataFrame:
    """Text fields -> typed price rows (P1); unparsable fields become null.

    The date must look like ``y-m-d`` (one-digit month and day accepted);
    numbers go through ``try_cast`` so a bad value never fails the job.
    """
    return raw.select(
        F.col("ticker"),
        parse_date("date").alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in NUMERIC_COLUMNS],
    )


def rejected_prices(raw: DataFrame) -> DataFrame:
    """Rows of ``raw`` that null filtering plus parsing would drop (Q1)."""
    parsed = [F.col("ticker"), parse_date("date")] + [F.col(c).try_cast("double") for c in NUMERIC_COLUMNS]
    bad = parsed[0].isNull()
    for e in parsed[1:]:
        bad = bad | e.isNull()
    return raw.where(bad)


def explain_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The lines of price files that cleaning drops, with ``reason`` and origin.

    Columns: the eight fields as read, ``reason``, ``line`` (the line as it stands, where its
    fields could not be told apart) and ``file``, ``block_start`` (Spark's file path and the
    first byte of the split that held it). ``reason`` names what is wrong first, from left to right:
    ``wrong number of fields``, ``empty <field>`` or ``unparsable <field>``. A quoted
    field may hold line breaks with ``multi_line``, which reads a file in one task;
    without it such a line is two lines with a wrong number of fields.
    """
    schema = StructType([*RAW_SCHEMA, StructField("line", StringType(), True)])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "line").option("mode", "PERMISSIVE")
    rows = reader.option("multiLine", multi_line).csv(path)
    typed = {"date": parse_date("date")} | {c: F.col(c).try_cast("double") for c in NUMERIC_COLUMNS}
    # more fields than eight are no fault: the ones past the eighth are ignored
    short = F.col("line").isNotNull() & F.col(RAW_COLUMNS[-1]).isNull()
    reason = F.when(short, F.lit("wrong number of fields"))
    for c in RAW_COLUMNS:
        reason = reason.when(F.col(c).isNull(), F.lit(f"empty {c}"))
        if c in typed:
            reason = reason.when(typed[c].isNull(), F.lit(f"unparsable {c}"))
    found = rows.select(*RAW_COLUMNS, reason.alias("reason"), "line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"))
    return found.where("reason IS NOT NULL")


def load_prices(raw: DataFrame) -> DataFrame:
    """F1 then P1, then drop rows whose fields did not parse (Q1).

    An explicit ``IS NOT NULL`` test: ``na.drop`` would also drop a parsed
    ``NaN``, which the reference keeps.
    """
    typed = parse_prices(filter_null_prices(raw))
    ok = F.lit(True)
    for c in typed.columns:
        ok = ok & F.col(c).isNotNull()
    return typed.where(ok)

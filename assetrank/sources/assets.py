"""Asset metadata source: JSON scan (S2), projection (P2), preview (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from assetrank.sources.json_arrays import scan_json_arrays

# The metadata fields the pipeline reads, by name.
STRING_FIELDS = ("symbol", "isin", "figi", "name", "description", "industry", "sector")
DOUBLE_FIELDS = ("price_earning_ratio", "growth")

ASSET_SCHEMA = StructType(
    [StructField(c, StringType(), True) for c in STRING_FIELDS]
    + [StructField(c, DoubleType(), True) for c in DOUBLE_FIELDS]
)


def scan_assets_json(spark: SparkSession, path: str, multi_line: bool | str = True) -> DataFrame:
    """Read asset metadata with an explicit schema.

    The schema replaces inference: an integer P/E reads as a double, a text
    P/E such as ``"n/a"`` becomes null for that record only, and an absent
    field reads as null. ``multi_line`` accepts one JSON document (or array)
    per file, read in one task; ``multi_line="split"`` reads such files by many
    tasks (:mod:`json_arrays`, which runs jobs); JSON Lines (``multi_line=False``)
    needs neither.
    """
    if multi_line == "split":
        return scan_json_arrays(spark, path, ASSET_SCHEMA)
    reader = spark.read.schema(ASSET_SCHEMA).option("multiLine", multi_line)
    return reader.option("recursiveFileLookup", True).json(path)


def write_assets_json(df: DataFrame, path: str) -> None:
    df.select(*[c for c in ASSET_SCHEMA.fieldNames() if c in df.columns]).write.mode("overwrite").json(path)


def write_assets_documents(df: DataFrame, path: str, per_file: int = 64) -> None:
    """Write records as multi-line JSON arrays, one per file, of about ``per_file`` records each."""
    records = df.select(*[c for c in ASSET_SCHEMA.fieldNames() if c in df.columns])
    files = max(1, -(-records.count() // per_file))
    part = F.pmod(F.xxhash64("symbol"), F.lit(files)).alias("part")
    arrays = records.groupBy(part).agg(F.collect_list(F.struct(*records.columns)).alias("a"))
    text = arrays.select("part", F.to_json("a", {"pretty": "true"}).alias("value"))
    text.write.partitionBy("part").text(path)  # one row, hence one file, per part


def project_assets(raw: DataFrame, zero_missing_pe: bool = False) -> DataFrame:
    """Metadata rows -> the columns the ranking joins on.

    ``symbol`` becomes the join key ``ticker``. With ``zero_missing_pe`` a
    missing P/E or growth reads as 0.0, as the reference stores it; the
    ranking treats 0 and null alike (F5).
    """
    pe, growth = F.col("price_earning_ratio"), F.col("growth")
    if zero_missing_pe:
        pe, growth = F.coalesce(pe, F.lit(0.0)), F.coalesce(growth, F.lit(0.0))
    return raw.select(
        F.col("symbol").alias("ticker"),
        "isin",
        "figi",
        "name",
        "description",
        "industry",
        "sector",
        pe.alias("pe"),
        growth.alias("growth"),
    )


def preview_first(df: DataFrame, order: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """First record (S3), made deterministic by an explicit order."""
    return df.orderBy(*order).limit(1)

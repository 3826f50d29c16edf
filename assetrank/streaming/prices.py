"""Incremental ingestion of price CSV files with Structured Streaming.

The reference reads its inputs in batch only; this module applies the same
source and cleaning steps (S1, F1, P1) to files as they arrive, so a growing
price history can be kept as a Parquet table that the batch ranking reads.
No stateful operator is involved: every file is cleaned on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetrank.sources.prices import RAW_SCHEMA, load_prices


def stream_prices(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of cleaned, typed prices from CSV files under ``path``."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", False).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return load_prices(reader.csv(path))


def ingest_prices(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    files_per_year: int = 4,
) -> StreamingQuery:
    """Append cleaned prices to a Parquet table partitioned by year.

    ``checkpoint`` must be on shared storage (for example under
    ``spark.checkpoint.dir``) so a restarted driver resumes exactly once.
    With ``available_now`` the query processes what is there and stops. A batch
    writes at most ``files_per_year`` files for a year, whatever its tasks.
    """
    df = stream_prices(spark, source).withColumn("year", F.year("date"))
    df = df.repartition(F.col("year"), F.pmod(F.xxhash64("ticker", "date"), F.lit(files_per_year)))
    writer = (
        df.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

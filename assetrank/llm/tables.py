"""Small shared helpers: written tables, checked broadcasts, module shipping, row keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without that setting (tests) gets a temporary
    folder; on a cluster an unset folder raises, since executors could not see
    a machine-local one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), f"assetrank-{os.getpid()}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, so a lost executor never sends later stages back to the source. All
    tables of an application lie in one folder, to be removed with it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/assetrank-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (on a cluster the package comes with ``--py-files`` or the image)."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a Python worker; what Arrow keeps of one is given back before the next."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def small_side(df: DataFrame, rows: int, row_bytes: int, most_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast when ``rows`` (counted by the caller) are small enough;
    otherwise leave the join to Spark's shuffle joins."""
    return F.broadcast(df) if rows * row_bytes <= most_bytes else df


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that tell rows of a document table apart by id and text; null-safe."""
    parts = [F.coalesce(F.col(doc_id).cast("string"), F.lit("\x00")), F.coalesce(F.col(text), F.lit("\x00"))]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"))


def docs_of(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

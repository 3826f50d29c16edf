"""Pipeline settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Defaults:
    """Fixed values of the ranking pipeline (the reference's constants).

    end_date 2020-04-01, volatility ceiling 4, P/E threshold 25, a trailing
    window of 251 prices, returns over 5 days, top 5 assets.
    """

    end_date: str = "2020-04-01"
    volatility_ceiling: float = 4.0
    pe_threshold: float = 25.0
    window: int = 251
    return_days: int = 5
    k: int = 5


# Rows per block of the skew-safe ordered scans (operators/scan.py). Unset, the
# session's shuffle settings size the blocks.
BLOCK_ROWS_CONF = "assetrank.blockRows"


def block_rows(spark: SparkSession) -> int | None:
    rows = spark.conf.get(BLOCK_ROWS_CONF, None)
    return int(rows) if rows else None


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a ``local`` session gets a temporary folder;
    executors of a cluster could not read a machine-local one, so there it
    raises. The session's settings are never changed. All paths of an application
    lie in one folder, to be removed with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), f"assetrank-{os.getpid()}")
    return f"{base.rstrip('/')}/assetrank/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"

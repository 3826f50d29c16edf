"""Streaming ingestion gives the same rows as the batch source."""

import os

from assetrank.config import shared_dir
from assetrank.sources import fixtures as fx
from assetrank.sources import prices as psrc
from assetrank.streaming.prices import ingest_prices

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    base = shared_dir(spark, "stream-test")
    src, out, chk = os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "chk")
    psrc.write_prices_csv(fx.price_text(spark, SF), src)
    q = ingest_prices(spark, src, out, chk)
    q.awaitTermination(300)
    got = spark.read.parquet(out).drop("year")
    want = psrc.load_prices(psrc.scan_prices_csv(spark, src))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_year_partitions_pruned_by_cutoff(spark):
    from assetrank.operators.features import filter_end_date
    from tests_plan_util import plan_text

    base = shared_dir(spark, "stream-prune")
    src, out, chk = os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "chk")
    psrc.write_prices_csv(fx.price_text(spark, SF), src)
    ingest_prices(spark, src, out, chk).awaitTermination(300)
    table = spark.read.parquet(out)
    kept = filter_end_date(table, "1996-06-30", year_partition="year")
    assert "PartitionFilters: [isnotnull(year" in plan_text(kept) and "(year#" in plan_text(kept)
    assert kept.count() == table.where("date <= date'1996-06-30'").count() > 0

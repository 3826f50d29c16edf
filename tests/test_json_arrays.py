"""Multi-line JSON cut into records by many tasks, against Spark's own multi-line reader."""

import json
import os
import random

import pytest

from assetrank.sources import assets as asrc


def record(rng, k):
    texts = ["plain", 'quote " and \\ back', "brace } { ] [ in text", "esc \\\" }", "ünï \U0001f600", "", "line\nbreak\ttab", "x" * 3000 if k % 50 == 0 else "short"]
    return {"symbol": f"S{k}", "name": rng.choice(texts), "sector": rng.choice([None, *texts]), "price_earning_ratio": rng.choice([1.5, 7, None, "n/a"]), "address": {"a": [1, {"b": "}"}], "c": []}}


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("split", [200, 5000, 1 << 27])
def test_equals_the_multi_line_reader(spark, tmp_dir, split):
    rng = random.Random(split)
    some = [record(rng, k) for k in range(120)]
    files = {
        "pretty.json": json.dumps(some[:40], indent=2),
        "rows.json": "[" + ",\n".join(json.dumps(r) for r in some[40:70]) + "]\n",
        "tight.json": json.dumps(some[70:90], indent=1).replace("},\n {", "}, {").replace("[\n", "["),
        "one.json": json.dumps(some[90], indent=4),
        "line.json": json.dumps(some[91:95]),
        "empty.json": "[\n\n]\n",
        "blank.json": "[\r\n" + ",\r\n\r\n".join(json.dumps(r, indent=3) for r in some[95:]) + "\r\n]",
    }
    os.makedirs(f"{tmp_dir}/in")
    for name, text in files.items():
        write(f"{tmp_dir}/in/{name}", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", min(split, 1 << 22))
        got = asrc.scan_assets_json(spark, f"{tmp_dir}/in", multi_line="split")
        assert rows(got) == rows(asrc.scan_assets_json(spark, f"{tmp_dir}/in", multi_line=True))
        assert got.count() == 120
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 22)


def test_one_file_is_read_by_many_tasks(spark, tmp_dir):
    write(f"{tmp_dir}/big.json", json.dumps([record(random.Random(k), k) for k in range(2000)], indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 10)
        text = spark.read.text(f"{tmp_dir}/big.json")
        assert text.rdd.getNumPartitions() > 5
        got = asrc.scan_assets_json(spark, f"{tmp_dir}/big.json", multi_line="split")
        assert got.count() == 2000 and got.select("symbol").distinct().count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 22)


def test_other_elements_and_broken_records(spark, tmp_dir):
    write(f"{tmp_dir}/odd.json", '[1, "text {", null,\n{"symbol": "A"}, true, [2, {"symbol": "inner"}],\n{"symbol": "B", "name": }\n, {"symbol": "C"}]')
    got = asrc.scan_assets_json(spark, f"{tmp_dir}/odd.json", multi_line="split").select("symbol").collect()
    assert sorted(str(r.symbol) for r in got if r.symbol in ("A", "C", "inner")) == ["A", "C"]

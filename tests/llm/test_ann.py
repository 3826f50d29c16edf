import duckdb
import numpy as np
import pytest
from helpers import with_clashes

from assetrank.llm import ann
from assetrank.llm.catalog import ORACLE, op3_vantage_point_trees

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    """(query_id, rank, vec_id, score) of all queries (vec_id % 100 = 0)."""
    used = [(i, np.array(v, dtype="float64")) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for n, (q, a) in enumerate(used):
        if q is None or q % 100:
            continue
        near = sorted((float(np.sqrt(np.cumsum((a - b) ** 2)[-1])), c) for m, (c, b) in enumerate(used) if m != n)
        out += [(q, r, c, d) for r, (d, c) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block", [(8192, 2048), (60, 3)])
def test_factor_one_is_exact(spark, shard_rows, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(k, (centres[k % 12] + 0.1 * rng.normal(size=8)).astype("float32").tolist()) for k in range(600)]
    rows += [(1000 + k, rows[7][1]) for k in range(40)]  # ties
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = ann.nearest(with_clashes(table), "vec_id % 100 = 0", k=10, factor=1.0, shard_rows=shard_rows, block_queries=block, leaf=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [1.0, None]), (400, [float("nan"), 1.0]), (500, [float("inf"), 1.0]), (600, []), (3, [0.5, 0.5]), (4, [0.5, 0.5])]
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = ann.nearest(table, "vec_id % 100 = 0", k=10)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)
    assert ann.nearest(table.limit(0), "vec_id % 100 = 0").count() == 0
    assert ann.nearest(table.where("vec_id = 3"), "vec_id = 3").count() == 0


def test_query_recall_and_oracle(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, op3_vantage_point_trees(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(ORACLE["op3_vantage_point_trees"]).fetchall())


def test_recall_at_production_factor(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = {(q, c) for q, _, c, _ in brute(rows, 10)}
    got = {(r.query_id, r.vec_id) for r in op3_vantage_point_trees(spark, sf).collect()}
    assert len(want & got) >= 0.95 * len(want)


def test_larger_factor_prunes_more():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 4
    vectors = centres[np.arange(4000) % 40] + rng.normal(size=(4000, 16))
    ids = np.arange(4000)
    tree = ann.Tree(ids.copy(), ids.copy(), vectors.copy(), 16)
    best = [tree.search(ids[:50], ids[:50], vectors[:50], 5, f)[2].reshape(50, 5) for f in (1.0, 2.0, 20.0)]
    assert (best[0] <= best[1] + 1e-12).all() and (best[1] <= best[2] + 1e-12).all() and best[2].sum() > best[0].sum()

import random

import numpy as np
import pytest
from helpers import docs, edge_rows, sentences, with_clashes
from pyspark.sql import functions as F

from assetrank.llm import simhash_tree
from assetrank.llm.catalog import op11_simhash_trees


def plain_fingerprint(spark, text):
    """Bit by bit, with Spark's own XXH64 (seed 42) as the hash."""
    w = (text or "").encode("utf-8").lower().split()
    if not w:
        return 0
    runs = [b" ".join(w[k : k + 4]).decode() for k in range(len(w) - 3)] or [b" ".join(w).decode()]
    frame = spark.createDataFrame([(r,) for r in runs], "r string")
    h = [r[0] % (1 << 64) for r in frame.select(F.xxhash64("r")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, distance):
    """root of each value by comparing all pairs."""
    values = np.array(values, dtype="uint64")
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values[a] ^ values[a + 1 :]) <= distance) + a + 1:
            root[find(a)] = find(int(b))
    return [find(k) for k in range(len(values))]


def expected(rows, distance=4):
    prints = [simhash_tree.fingerprint(t) for _, t in rows]
    roots = brute_components(prints, distance)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        ids = [x for x in (least.get(r), i) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(((i, format(p, "016x"), least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True)), key=str)


def got(df, **kw):
    found = simhash_tree.simhash_components(df, **kw).select("doc_id", "fingerprint", "component_id")
    return sorted(map(tuple, found.collect()), key=str)


def test_fingerprints_bit_by_bit(spark):
    texts = ["", None, " \n", "one", "one two three", "one two three four", "a b c d e", "x " * 50, "ünï Cödé TEXT \U0001f600 a b c", *sentences(1, 3, 30)]
    for text in texts:
        assert simhash_tree.fingerprint(text) == plain_fingerprint(spark, text)


def near(rng, value, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << b
    return value


def some_values(seed=3, base=400):
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(base)]
    values += [near(rng, v, 5) for v in values[:150]]
    hot = rng.getrandbits(64)
    values += [near(rng, hot, 3) for _ in range(600)]  # a dense group
    step = rng.getrandbits(64)
    for _ in range(60):  # a chain whose ends are far apart
        values.append(step)
        step = near(rng, step, 4)
    return sorted(set(values))


@pytest.mark.parametrize("distance,segments", [(4, 3), (4, 2), (4, 1), (4, 5), (3, 3), (0, 3), (7, 3)])
def test_links_connect_what_all_pairs_connect(spark, distance, segments):
    values = some_values(base=150)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash_tree.links(distinct, distance, segments, shard_rows=40, shard_most=100, sample=300).collect()
    place = {v: k for k, v in enumerate(signed)}
    assert all((a ^ b).bit_count() <= distance for a, b in ((r.a % (1 << 64), r.b % (1 << 64)) for r in links))
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for r in links:
        root[find(place[r.a])] = find(place[r.b])
    want = brute_components(values, distance)
    same = {}
    for k in range(len(values)):
        assert same.setdefault(find(k), want[k]) == want[k]
    assert len(same) == len(set(want))


def test_pruning_on_unrelated_fingerprints():
    """Shards hold far fewer pairs than all, and few copies of a value."""
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 1 << 63, 60_000, dtype="uint64") * np.uint64(2) + rng.integers(0, 2, 60_000, dtype="uint64"))
    pairs = copies = 0
    for first, width in simhash_tree.segment_bounds(3):
        own = simhash_tree.segment(values, first, width)
        tree = simhash_tree.Tree(np.sort(own)[::2], 1, 16)
        at, leaves = tree.route(own)
        sizes = np.bincount(leaves).astype("float64")
        pairs += (sizes * (sizes - 1) / 2).sum()
        copies += len(at)
    assert pairs < 0.02 * len(values) * (len(values) - 1) / 2
    assert copies < 45 * len(values)


def test_near_copies_of_texts(spark):
    rng = random.Random(8)
    rows = list(enumerate(sentences(3, 120, 50)))
    base = sentences(4, 1, 400)[0]

    def edited(text, edits):
        w = text.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        return " ".join(w)

    rows += [(1000 + k, edited(base, k % 6)) for k in range(120)]  # hot near copies
    rows += [(2000 + k, base.upper()) for k in range(60)]
    for f, text in enumerate(sentences(5, 15, 200)):
        rows += [(3000 + 10 * f + k, edited(text, k)) for k in range(4)]
    rng.shuffle(rows)
    want = expected(rows)
    assert len({c for _, _, c in want}) < len(rows) - 60
    frame = docs(spark, rows).repartition(7)
    assert got(frame) == want
    assert got(frame, shard_rows=20, shard_most=40, sample=60) == want


def test_edges(spark):
    rows = edge_rows() + [(8, "word two"), (9, "")]
    assert got(docs(spark, rows)) == expected(rows)
    assert got(with_clashes(docs(spark, rows))) == expected(rows)
    assert got(docs(spark, [])) == []
    assert got(docs(spark, [(None, "a b c d e"), (3, "a b c d e")])) == [(3, format(simhash_tree.fingerprint("a b c d e"), "016x"), 3), (None, format(simhash_tree.fingerprint("a b c d e"), "016x"), 3)]


def test_query(spark):
    found = op11_simhash_trees(spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found.dtypes[:3] == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)

import random

import numpy as np
import pytest
from helpers import docs, edge_rows, sentences, with_clashes

from assetrank.llm import ngram_join
from assetrank.llm.catalog import op5_vertical_jaccard_join
from assetrank.llm.components import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(doc_id, set size, smallest doc_id reachable) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    held = {}
    for k, s in enumerate(sets):
        for g in s:
            held.setdefault(g, []).append(k)
    for a in range(len(rows)):
        for b in {k for g in sets[a] for k in held[g] if k < a}:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        ids = [i for i in (least.get(find(k)), doc_id) if i is not None]
        least[find(k)] = min(ids) if ids else None
    return sorted(((d, len(sets[k]), least[find(k)] if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    """Families of near copies from barely alike to equal, a hot family, shared lines and passages."""
    rng = random.Random(11)
    line, passage = " ".join(sentences(1, 1, 9)), " ".join(sentences(2, 1, 60))
    rows = [(k, t) for k, t in enumerate(sentences(3, 150, 60))]
    base = sentences(4, 1, 150)[0]
    rows += [(1000 + k, edited(rng, base, k % 9)) for k in range(400)]  # a third of all: hot near copies
    rows += [(2000 + k, base.upper()) for k in range(60)]
    for f, text in enumerate(sentences(5, 30, 80)):
        rows += [(3000 + 10 * f + k, edited(rng, text, k)) for k in range(5)]
    rows += [(4000 + k, f"{line}\n{t}\n{passage if k % 3 else ''}") for k, t in enumerate(sentences(6, 120, 50))]
    rows += [(5000 + k, t) for k, t in enumerate(["a b c d", "a b c d", "a b c", "a b c d e", "A B C D"])]
    rng.shuffle(rows)
    return rows + edge_rows()


def test_components_equal_all_pairs(spark, copies):
    out = ngram_join.jaccard_components(with_clashes(docs(spark, copies).repartition(5)))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == brute(copies)


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op5_vertical_jaccard_join(spark, sf).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("fragments", [1, 3])
def test_fragments_do_not_change_the_result(spark, copies, fragments):
    rows = copies[:300]
    out = ngram_join.jaccard_components(docs(spark, rows), fragments=fragments)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == brute(rows)


def test_empty(spark):
    assert ngram_join.jaccard_components(docs(spark, [(1, "x")]).limit(0)).count() == 0
    assert ngram_join.keep_one(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_keep_one_keeps_one_of_each(spark, copies):
    # an id that two texts share is left to the next test
    rows = list({r[0]: r for r in copies if r[0] is not None}.values())
    table = with_clashes(docs(spark, rows))
    out = ngram_join.keep_one(table)
    assert out.columns == table.columns
    parts = brute(rows)
    bare = [r for r in parts if r[1] == 0]
    want = {r[2] for r in parts if r[1]}
    got = [r for r in out.collect()]
    assert sorted(r.doc_id for r in got if r.text and r.text.split()) == sorted(want)
    assert len([r for r in got if not (r.text and r.text.split())]) == len(bare)


def test_keep_one_with_repeated_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (1, text.upper()), (None, text), (2, text), (None, "a b c d e f g"), (None, "a b c d e f g"), (3, None), (3, None)]
    out = sorted((tuple(r) for r in ngram_join.keep_one(docs(spark, rows)).collect()), key=str)
    assert [r[0] for r in out] == [1, 3, 3, None] and out[-1][1] == "a b c d e f g"


def test_head_and_overlap_bounds():
    for size in range(1, 400):
        for other in range(size, 400):
            least = next(o for o in range(size + 1) if 100 * o >= 80 * (size + other - o)) if 100 * size >= 80 * other else None
            if least is not None:
                assert ngram_join.head_size(size, 80) >= size - least + 1 and ngram_join.head_size(other, 80) >= other - least + 1


def test_connected_components_of_long_paths(spark):
    rng = np.random.default_rng(2)
    links = [(k, k + 1) for k in range(1, 400)] + [(1000 + a, 1000 + b) for a, b in rng.integers(0, 300, (250, 2)).tolist()] + [(5, 5)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: find(k) for k in root if k in got} and {k for a, b in links if a != b for k in (a, b)} == set(got)


def test_signatures_never_hide_a_link(spark):
    """The bits that differ are no more than the n-grams that differ, also when one signature is folded."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rows = []
    for n in (1, 3, 60, 64, 65, 500, 3000):
        base = rng.integers(0, 2**63, n, dtype="uint64")
        for cut in (0, 1, n // 10, n // 5):
            other = np.concatenate([base[cut:], rng.integers(0, 2**63, cut // 2, dtype="uint64")])
            if len(other):
                a, b = np.unique(base), np.unique(other)
                rows.append((ngram_join.parity(a).tolist(), ngram_join.parity(b).tolist(), len(np.setxor1d(a, b))))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, differ long")
    got = df.select("differ", ngram_join._bits_apart(F.col("a"), F.col("b")).alias("bits")).collect()
    assert all(r.bits <= r.differ for r in got) and any(r.bits for r in got) and any(len(a) != len(b) for a, b, _ in rows)


def test_lists_sort_each_posting_once(spark):
    """Lists of equal, near and lone sets against plain Python; a task reads and sorts its postings once, without a join with itself."""
    heads = {7: [1, 2, 3], 8: [2, 4], 9: [5, 2], 10: [6], 11: [12], -3: [3, 5]}
    rows = [(s, 10 + len(h), h) for s, h in heads.items()] + [(11, 11, [12]), (7, 13, [1, 2, 3]), (7, 13, None), (None, 0, None)]
    sets = spark.createDataFrame(rows, "set long, size long, head array<long>")
    lists = ngram_join._lists(sets)
    held = {}
    for s, h in heads.items():
        for at, g in enumerate(h):
            held.setdefault(g, []).append((at, 10 + len(h), s))
    expected = sorted((g, s, size, at, min(ends)) for g, ends in held.items() if len(ends) > 1 for at, size, s in ends)
    assert sorted((r["gram"], r["set"], r["size"], r["at"], tuple(r["c"])) for r in lists.collect()) == expected
    plan = lists._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Join" not in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1 and plan.count("Sort ") == 1, plan

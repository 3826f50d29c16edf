import random
from collections import Counter

import numpy as np
from helpers import docs, edge_rows, sentences, with_clashes

from assetrank.llm import decontaminate, words
from assetrank.llm.catalog import op8_seed_and_align

SF = "/root/testdata/sf0.01"


def brute_score(item, text):
    """Smith-Waterman, cell by cell."""
    above, best = [0] * (len(text) + 1), 0
    for a in item:
        row = [0]
        for k, b in enumerate(text):
            row.append(max(0, above[k] + (2 if a == b else -1), above[k + 1] - 1, row[-1] - 1))
        above, best = row, max(best, *row)
    return best


def test_alignment_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 14))]
        windows = [[rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(5)]
        best, end = decontaminate.smith_waterman(np.array(item, "uint64"), [np.array(w, "uint64") for w in windows])
        assert best.tolist() == [brute_score(item, w) for w in windows]
        for k, w in enumerate(windows):
            assert brute_score(item, w[: end[k]]) == best[k]


def brute(rows, items, least=0.5):
    """Every item aligned with every whole text; items of one or two words must stand there as a whole."""
    out = set()
    for doc_id, text in rows:
        tokens = words.plain_words(text or "")
        for item_id, item in items:
            item = words.plain_words(item or "")
            if item and 2 * sum((Counter(tokens) & Counter(item)).values()) >= least * 2 * len(item):  # else no score can reach it
                score = brute_score(item, tokens) / (2 * len(item))
                if score >= (least if len(item) > 2 else 1.0):
                    out.add((doc_id, item_id, round(score, 6)))
    return out


def found(rows):
    return {(r.doc_id, r.item_id, round(r.score, 6)) for r in rows.collect()}


def test_query_equals_whole_text_alignment(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if len(r[1] or "") < 6000]  # the cell-by-cell walk is slow
    ids = {r[0] for r in rows}
    got = {m for m in found(op8_seed_and_align(spark, SF)) if m[0] in ids}
    assert got and got == brute(rows, items)


def test_edited_and_hot_copies(spark):
    rng = random.Random(9)
    items = list(enumerate(sentences(21, 12, 30)))
    rows = [(k, t) for k, t in enumerate(sentences(22, 200, 120))]
    for k in range(200):  # two thirds hold a copy of item 0 or an edited copy of another
        which = 0 if k % 2 else 1 + k % 11
        copy = items[which][1].split()
        for _ in range(0 if k % 2 else 6):
            copy[rng.randrange(len(copy))] = "changed"
        if k % 4 == 0:
            copy.insert(10, "inserted")
            del copy[20]
        lead = rows[k][1].split()
        rows.append((1000 + k, " ".join(lead[:60] + copy + lead[60:]).title()))
    out = decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = found(out)
    assert got == brute(rows, items)
    assert {d for d, _, _ in got} == set(range(1000, 1200))


def test_recall_on_edited_copies(spark):
    """Copies with every k-th word replaced, deleted, or another inserted, against plain alignment: none is lost."""
    items = list(enumerate(sentences(31, 8, 30))) + [(100 + k, t) for k, t in enumerate(sentences(32, 6, 9))]
    rows = []
    for item_id, text in items:
        for k in (2, 3, 4, 5, 7):
            for begin in range(k):
                w = text.split()
                for how, edit in (("replaced", lambda x: [f"new{x}"]), ("deleted", lambda x: []), ("inserted", lambda x: [x, f"new{x}"])):
                    copy = [y for at, x in enumerate(w) for y in (edit(x) if at % k == begin else [x])]
                    rows.append((len(rows), " ".join([*sentences(len(rows), 1, 12)[0].split(), *copy, *sentences(len(rows) + 7, 1, 12)[0].split()])))
        rows.append((len(rows), " ".join(y for x in text.split() for y in (x, f"noise{x}"))))  # a word after every word
    want = brute(rows, items)
    got = found(decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")))
    assert got <= want
    # a word put in after every word leaves no seed; all else is found
    lost = {d for d, _, _ in want - got}
    assert len(want) > 600 and lost <= {r[0] for r in rows if "noise" in r[1]} and len(got) >= 0.98 * len(want), sorted(want - got)[:10]


def test_many_seeds_are_joined_by_spark(spark, monkeypatch):
    items = list(enumerate(sentences(41, 6, 25)))
    rows = [(k, " ".join([*t.split()[:20], *items[k % 6][1].split()[: 14 + k % 12], *t.split()[20:]])) for k, t in enumerate(sentences(42, 60, 40))]
    frames = docs(spark, rows + rows[:5]), spark.createDataFrame(items, "item_id long, text string")
    shared = sorted(map(str, decontaminate.contaminated(*frames).collect()))
    monkeypatch.setattr(decontaminate, "SEEDS_SHARED", 0)
    assert shared and sorted(map(str, decontaminate.contaminated(*frames).collect())) == shared


def test_edges(spark):
    item = "alpha beta gamma delta epsilon zeta"
    items = spark.createDataFrame([(1, item), (1, item), (2, item.upper()), (None, item), (3, None), (4, ""), (5, "two words"), (6, "one")], "item_id long, text string")
    rows = edge_rows() + [(50, f"x {item} y"), (50, f"x {item} y"), (51, "two words one"), (None, item)]
    table = docs(spark, rows)
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(with_clashes(table), with_clashes(items)).collect()), key=str)
    # an item of one or two words is found where it stands as a whole
    short = [(51, 5), (51, 6), (4, 6), (4, 6)]
    want = {(d, i) for d, i, _ in brute(rows, [(i, t) for i, t in [(1, item), (2, item), (5, "two words"), (6, "one")]])}
    assert {g for g in got if g[1] is not None} == want and {(d, i) for d, i in short} <= want
    assert [g for g in got if g[1] in (1, 2, None)] == sorted([(d, i) for d in (50, None) for i in (1, 1, 2, None)], key=str)
    clean = decontaminate.decontaminate(with_clashes(table), items)
    assert clean.columns == with_clashes(table).columns and clean.count() == len(rows) - 6  # 50, 50, 51, 4, 4 and the item itself
    assert decontaminate.contaminated(table.limit(0), items).count() == 0
    assert decontaminate.decontaminate(table, items.limit(0)).count() == len(rows)


def test_a_task_holds_one_python_worker(spark):
    """Windows are cut and aligned in different stages: two Python steps in one would hold two workers a core."""
    texts = sentences(31, 40)
    found = decontaminate.contaminated(docs(spark, [(k, t) for k, t in enumerate(texts)]), spark.createDataFrame([(1, texts[3]), (2, texts[7])], "item_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    aligned, cut = (next(k for k, line in enumerate(plan) if kind in line) for kind in ("MapInPandas", "MapInArrow"))
    between = plan[aligned + 1 : cut]
    assert aligned < cut and any("Exchange hashpartitioning(doc_id" in line for line in between), "\n".join(plan)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(3, 1), (7, 2)}

"""The pipeline against a plain version of every stage, stage by stage."""

import pytest
from helpers import docs, edge_rows, with_clashes
from test_decontaminate import brute as leaks_by_hand
from test_ngram_join import brute as components_by_hand
from test_packing import check as check_packing
from test_pii import FOUND

import __spark_entry__
import corpus_pipeline
from assetrank.llm import quality, tables
from assetrank.llm.catalog import tokenizer_path

SF = "/root/testdata/sf0.01"


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each."""
    table = tables.docs_of(spark, SF)
    out = [table]
    for _, stage in corpus_pipeline.STAGES:
        table = tables.stored(stage(spark, table, SF), "step")
        out.append(table)
    return out


def rows(table):
    return [tuple(r) for r in table.select("doc_id", "text").collect()]


def test_all_but_the_last_return_documents(steps):
    assert all(t.columns == steps[0].columns for t in steps[:-1])


def test_quality_stage(spark, steps):
    model = quality.fit(steps[0])
    assert sorted(rows(steps[1])) == sorted(r for r in rows(steps[0]) if model.judge(r[1])[0] >= 0.3)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _ in rows(steps[1])}
    assert all(d in kept for d, r in labels.items() if r.quality == 1 and r.toxic == 0)
    assert not any(d in kept for d, t in rows(steps[0]) if len(set((t or "").encode().lower().split()) & quality.INSULTS) > 1)


def test_near_copy_stage(steps):
    before = rows(steps[1])
    stays = {c for _, size, c in components_by_hand(before)}
    assert sorted(rows(steps[2])) == sorted(r for r in before if r[0] in stays)


def test_benchmark_stage(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = [r for r in rows(steps[2]) if len(r[1]) < 6000]
    ids = {r[0] for r in before}
    gone = {d for d, _, _ in leaks_by_hand(before, items)}
    assert gone and {d for d, _ in rows(steps[3])} & ids == ids - gone


def test_pii_stage(steps):
    before, after = dict(rows(steps[3])), dict(rows(steps[4]))
    assert sorted(before) == sorted(after)
    for k, text in before.items():
        a, b = FOUND.findall(text), FOUND.findall(after[k])
        assert len(a) == len(b) and not set(a) & set(b) and FOUND.sub("", text) == FOUND.sub("", after[k])
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_packing_stage_and_run(spark, steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    check_packing(rows(steps[4]), steps[5].collect(), tokenizer, 4096)
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, steps[5].collect()))


@pytest.mark.parametrize("number", range(5))
def test_stages_bear_odd_and_empty_tables(spark, number):
    _, stage = corpus_pipeline.STAGES[number]
    table = with_clashes(docs(spark, edge_rows()).selectExpr("doc_id", "text", "'en' AS lang", "CAST(NULL AS string) AS source", "CAST(1 AS bigint) AS n_chars"))
    out = stage(spark, table, SF)
    assert out.count() > 0
    empty = stage(spark, table.limit(0), SF)
    assert empty.count() == 0
    if number < 4:
        assert out.columns == empty.columns == table.columns

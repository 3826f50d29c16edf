import re

import pytest
from helpers import docs, edge_rows, with_clashes
from tests_plan_util import plan_text

from assetrank.llm import pii
from assetrank.llm.catalog import op1_surrogates

SF = "/root/testdata/sf0.01"
FOUND = re.compile(r"[^\s@]+@[^\s@]*[A-Za-z]|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d+\.\d+\.\d+\.\d+(?!\d)|\b[0-9a-fA-F]{40}\b")


def one(spark, *texts):
    return [r.text for r in pii.replace(docs(spark, list(enumerate(texts))), "secret").orderBy("doc_id").collect()]


def test_query_replaces_everything_consistently(spark):
    before = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    after = dict(op1_surrogates(spark, SF).collect())
    assert sorted(before) == sorted(after)
    pairs = set()
    for k, text in before.items():
        a, b = FOUND.findall(text), FOUND.findall(after[k])
        assert len(a) == len(b) and FOUND.sub("", text) == FOUND.sub("", after[k])
        pairs |= {(x.lower(), y.lower()) for x, y in zip(a, b)}
        assert all(re.sub(r"\d", "9", x) == re.sub(r"\d", "9", y) for x, y in zip(a, b) if "@" not in x and len(x) != 40)
    old, new = {x for x, _ in pairs}, {y for _, y in pairs}
    assert len(pairs) == len(old) == len(new) > 50  # one to one: coreference and distinctness
    assert not old & new


def test_formats_and_types(spark):
    (out,) = one(spark, "Call +1 (415) 555-0134, +14155550134 or (415) 555-0134; card 4111 1111 1111 1111 = 4111111111111111, 378282246310005; ssn 123-45-6789; ip 10.20.30.4; Ann.Lee7@Corp.co.uk ANN.LEE7@CORP.CO.UK")
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1\d{10}|(?<!1 )\(\d{3}\) \d{3}-\d{4}", out)
    assert len(phones) == 3 and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "14155550134"
    spaced, plain, amex = re.search(r"card ((?:\d{4} ?){4}) = (\d{16}), (\d{15});", out).groups()
    assert spaced.replace(" ", "") == plain and plain[0] == "4" and amex[0] == "3"
    for card in (plain, amex):  # valid checksums stay valid
        digits = [int(c) for c in card[::-1]]
        assert sum(digits[0::2]) % 10 == -sum(2 * d - 9 * (d > 4) for d in digits[1::2]) % 10
    assert re.search(r"ssn \d{3}-\d{2}-\d{4}; ip \d\d\.\d\d\.\d\d\.\d;", out) and "123-45-6789" not in out
    low, high = out.split()[-2:]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{2}\.uk", low) and high == low.upper()


def test_names_keep_gender_script_and_coreference(spark):
    a, b, c = one(spark, "Mr. John Smith met Mrs. Anna Smith; later John Smith told Anna, and MR. SMITH left.", "Dr Smith wrote to Frau Smith. Smithson did not.", "г-н Иван Петров и г-жа Анна Петров")
    first, wife = re.match(r"Mr\. (\S+ \S+) met Mrs\. (\S+ \S+);", a).groups()
    given, family = first.split()
    assert given.split("-")[0] in pii.GIVEN["latin_m"] and wife.split()[0].split("-")[0] in pii.GIVEN["latin_f"] and wife.split()[1] == family
    assert a.endswith(f"later {first} told {wife.split()[0]}, and MR. {family.upper()} left.")
    assert b == f"Dr {family} wrote to Frau {family}. Smithson did not."
    assert re.fullmatch(r"г-н \w[\w-]* ([\w-]+) и г-жа \w[\w-]* \1", c) and not re.search("Иван |Анна |Петров", c)


def test_collisions_are_drawn_again(spark):
    """More names than the list has, and formats nearly used up: all stay distinct and new."""
    from pyspark.sql import functions as F

    many = spark.range(300).select(F.lit("family_latin").alias("kind"), F.concat(F.lit("name"), F.col("id").cast("string")).alias("canon"))
    many = many.union(spark.range(30).select(F.lit("family_latin"), F.lower(F.element_at(F.array(*(F.lit(x) for x in pii.FAMILY["latin"])), F.col("id").cast("int") + 1))))
    many = many.union(spark.range(100).select(F.lit("ip"), F.concat(F.lit("1.1."), F.col("id").cast("int") % 10, F.lit("."), (F.col("id") / 10).cast("int"))))
    many = many.union(spark.range(90).select(F.lit("phone"), F.concat(F.lit("0"), F.col("id") + 10)))
    out = pii.surrogates(many, "k").collect()
    assert len(out) == 520
    for kind in ("family_latin", "ip", "phone"):
        mine = [r for r in out if r.kind == kind]
        new = {r.surrogate.lower() for r in mine}
        assert len(new) == len(mine) and not new & {r.canon for r in mine}


def test_key_matters_and_runs_agree(spark):
    table = docs(spark, [(1, "a.b@example.com 10.11.12.13")])
    runs = [pii.replace(table, k).first().text for k in ("x", "x", "y")]
    assert runs[0] == runs[1] != runs[2]


def test_edges(spark):
    rows = edge_rows() + [(30, "x@y.zz" + " 1.2.3.4" * 500), (30, "x@y.zz" + " 1.2.3.4" * 500), (31, "ag" * 10000 + "@"), (32, "@ + ( 1234 5678"), (33, "1.2.3.4.5 999.1.1.1 12345678901234567")]
    table = with_clashes(docs(spark, rows))
    out = pii.replace(table, "k")
    assert out.columns == table.columns
    got, want = sorted(((r.doc_id, r.text) for r in out.collect()), key=str), sorted(rows, key=str)
    assert [r for r in got if r[0] != 30] == [r for r in want if r[0] != 30]
    changed = [r[1] for r in got if r[0] == 30]
    assert len(changed) == 2 and changed[0] == changed[1] and "1.2.3.4" not in changed[0] and len(set(changed[0].split())) == 2
    assert pii.replace(table.limit(0), "k").count() == 0


@pytest.mark.parametrize("part", ["mentions", "replace"])
def test_native_plan(spark, part):
    table = docs(spark, [(1, "a.b@example.com"), (2, None)]).repartition(2)
    df = pii.mentions(table) if part == "mentions" else pii.replace(table, "k")
    assert not any(w in plan_text(df) for w in ("EvalPython", "InPandas", "InArrow", "CartesianProduct"))

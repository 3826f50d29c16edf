import random

import pytest
from helpers import docs, edge_rows, with_clashes

from assetrank.llm import license_scan, words
from assetrank.llm.catalog import op4_patience_licenses
from assetrank.llm.license_texts import LICENSES

SF = "/root/testdata/sf0.01"


def templates():
    return [license_scan.Template(name, text, 0.8, 0.6, 1) for name, text in sorted(LICENSES.items())]


def test_query_against_plain_search(spark):
    """All notices of the tables are short and unedited there: a word search finds them."""
    short = {n: words.plain_words(t) for n, t in LICENSES.items() if n.endswith("notice")}
    want = set()
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        tokens = words.plain_words(text or "")
        for name, notice in short.items():
            want |= {(doc_id, name, 1.0, k, k + len(notice)) for k in range(len(tokens)) if tokens[k : k + len(notice)] == notice}
    got = {(r.doc_id, r.license, r.coverage, r.first_word, r.end_word) for r in op4_patience_licenses(spark, SF).collect()}
    assert want and got == want


def test_longest_increasing_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        values = [rng.randrange(9) for _ in range(rng.randrange(9))]
        kept = [values[k] for k in license_scan.longest_increasing(values)]
        assert all(a < b for a, b in zip(kept, kept[1:]))
        some = ([v for k, v in enumerate(values) if m >> k & 1] for m in range(1 << len(values)))
        assert len(kept) == max(len(s) for s in some if all(a < b for a, b in zip(s, s[1:])))


def test_patience_pairs_are_equal_and_increasing():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(25))] for _ in range(2))
        pairs = license_scan.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert license_scan.patience(list("xaybzc"), list("abc")) == [(1, 0), (3, 1), (5, 2)]
    assert license_scan.patience(list("aabaa"), list("aabaa")) == [(k, k) for k in range(5)]


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.1])
def test_edited_copies_are_found_in_place(rate):
    rng = random.Random(int(rate * 100))
    junk = "the of and software to any copy notice rights furnished".split()
    body = [w if rng.random() >= rate else "changed" for w in LICENSES["MIT"].split()]
    lead = rng.choices(junk, k=500)
    text = " ".join(lead + body + rng.choices(junk, k=300) + LICENSES["Apache-2.0"].split() + body)
    found = license_scan.scan(text, templates())
    assert [m[0] for m in found] == ["MIT", "Apache-2.0", "MIT"]
    assert abs(found[0][2] - 500) <= 3 and all(m[1] >= 0.8 for m in found)


@pytest.mark.parametrize("name", ["MIT notice", "MIT", "Apache-2.0"])
@pytest.mark.parametrize("copies", [1, 2, 3, 10])
def test_notices_back_to_back(name, copies):
    size = len(words.plain_words(LICENSES[name]))
    for lead in (0, 3, size // 3, size + 7):
        text = " ".join(["junk"] * lead + [LICENSES[name]] * copies + ["d e f"])
        found = [m for m in license_scan.scan(text, templates()) if m[0] == name]
        assert [m[1:4] for m in found] == [(1.0, lead + k * size, lead + (k + 1) * size) for k in range(copies)]


@pytest.mark.parametrize("rate", [0.03, 0.08])
def test_edited_notices_back_to_back(rate):
    rng = random.Random(int(rate * 100))
    body = words.plain_words(LICENSES["MIT"])
    edits = {0: lambda w: ["changed"], 1: lambda w: [], 2: lambda w: [w, "added"]}
    copies = [[v for w in body for v in ([w] if rng.random() >= rate else edits[rng.randrange(3)](w))] for _ in range(10)]
    text = ["junk"] * 50 + [w for c in copies for w in c] + ["junk"] * 50
    found = [m for m in license_scan.scan(" ".join(w if isinstance(w, str) else w.decode() for w in text), templates()) if m[0] == "MIT"]
    starts = [50 + sum(map(len, copies[:k])) for k in range(10)]
    assert len(found) == 10 and all(abs(m[2] - at) <= 5 for m, at in zip(found, starts))


def test_edges(spark):
    rows = edge_rows() + [(8, "Released under the MIT License. " * 40), (8, "Released under the MIT License. " * 40), (9, "released under MIT"), (10, "under the " * 20000)]
    out = license_scan.scan_licenses(with_clashes(docs(spark, rows)), LICENSES).collect()
    assert {r.doc_id for r in out} == {8} and len(out) == 80 and {r.license for r in out} == {"MIT notice"}
    assert license_scan.scan_licenses(docs(spark, rows).limit(0), LICENSES).count() == 0

import random
import zlib

import numpy as np
import pytest
from helpers import docs, edge_rows, with_clashes
from pyspark.sql import functions as F

from assetrank.llm import packing
from assetrank.llm.catalog import op9_best_fit_packing, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def expected_pieces(tokenizer, text, most):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    return [(k // most, k, ids[k : k + most]) for k in range(0, len(ids), most)]


@pytest.mark.parametrize(
    "text",
    ["", "  ", "It's  a\ttest\n\nof\u00a0white\u2003space.", "<|startoftext|>x<|endoftext|> y", "e\u0301 \u0301x ΣΑΣ İ ﬁ", "a\x1cb\x85c\u200bd", "don't WE'LL 12345 !!!???", "漢字かな 한국어 \U0001f600\u200d\U0001f600", "x" * 3000, "Word, word. WORD!? Straße; ÉTÉ) é. ß, I'M, you're. (don't) a_b _ a_, x<|endoftext|>, Ǆ, K, ﬀ. ١٢, e\u0301, ㅎㅏㄴ. ª, Ⅷ. a|b|, <|,"],
)
def test_word_table_equals_whole_text(tokenizer, text):
    table = packing.WordIds(tokenizer_path())
    for _ in range(2):  # filled, then from the table
        assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_fuzzed_texts(tokenizer):
    """Marks after words whose lower case ends in a combining mark, contractions, odd blanks, scripts."""
    rng = random.Random(12)
    marks = list("abcXYZ.,!?-()<>|_'#123 \n\t") + ["\u0130", "\u0131", "\u00df", "\u0301", "\u0307", "\ufb01", "\u2167", "\u4e2d", "\u30a2", "\u03c2", "\u03a3", "\u01f0", "\u200d", "\u00ad", "\u2019", "\u00a0", "\u2003", "\u0085", "\U0001f600", "'s", "'LL"]
    parts = ["gelir", "A\u0130LER\u0130,", "TE\u015eEKK\u00dcRLER\u0130,", "A\u0130. x", "DON'T!", "IT'S.", "stra\u00dfe,", "\u03a3\u0391\u03a3,"]
    table = packing.WordIds(tokenizer_path())
    for _ in range(20_000):
        text = " ".join(rng.choices(parts, k=rng.randrange(4))) + "".join(rng.choices(marks, k=rng.randrange(1, 20)))
        assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_full_word_table_stays_right(tokenizer):
    table = packing.WordIds(tokenizer_path(), most=2)
    text = "one two three four two one five"
    assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(table) == 2


def check(rows, out, tokenizer, most):
    want = sorted((str(d), p, s, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())) for d, t in rows for p, s, ids in expected_pieces(tokenizer, t, most))
    got = [(str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(got) == want
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert all(n <= most for n in filled.values())
    return len(filled), sum(filled.values())


def test_query_covers_all_documents(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    used, total = check(rows, op9_best_fit_packing(spark, SF).collect(), tokenizer, 4096)
    assert used <= -(-total // 4096) + 1


def test_edges_and_clashing_columns(spark, tokenizer):
    rows = edge_rows()
    check(rows, packing.pack_documents(with_clashes(docs(spark, rows)), tokenizer_path(), max_tokens=512).collect(), tokenizer, 512)
    assert packing.pack_documents(docs(spark, rows).limit(0), tokenizer_path()).count() == 0


def test_round_trip_of_sequences(spark, tokenizer):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    placed = packing.pack_documents(table, tokenizer_path(), max_tokens=1024)
    made = {r.sequence_id: r for r in packing.sequences(table, placed, tokenizer_path(), max_tokens=1024).collect()}
    texts = dict(table.select("doc_id", "text").collect())
    for r in placed.collect():
        ids = made[r.sequence_id].ids[r.offset : r.offset + r.length]
        assert ids == [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start : r.start + r.length]


def brute_best_fit(lengths, most, open_most):
    open_bins, places, next_id = {}, [], 0
    for n in lengths:
        fits = [(free, s) for s, free in open_bins.items() if free >= n]
        if fits:
            free, s = min(fits)
        else:
            if len(open_bins) == open_most:
                open_bins.pop(min((f, s) for s, f in open_bins.items())[1])
            s, free, next_id = next_id, most, next_id + 1
        places.append(most - free)
        open_bins[s] = free - n
        if not open_bins[s]:
            del open_bins[s]
    return places, next_id


@pytest.mark.parametrize("open_most", [1, 3, 50])
def test_best_fit_against_brute_force(open_most):
    lengths = np.random.default_rng(open_most).integers(1, 101, 2000).tolist()
    packer = packing.BestFit(100, open_most)
    offsets = [packer.place(n)[1] for n in lengths]
    places, used = brute_best_fit(lengths, 100, open_most)
    assert offsets == places and packer.next_id == used


def test_rerun_gives_the_same_places(spark):
    pieces = packing.tokenize_pieces(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path(), 4096)
    one, two = (sorted(map(tuple, packing.pack(pieces.repartition(n), 4096).collect()), key=str) for n in (3, 7))
    assert one == two


def test_no_pieces_lost_when_many_tasks(spark):
    pieces = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 100 + 1).alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    out = packing.pack(pieces, 100, sequences_per_task=100)
    assert out.select("doc_id").distinct().count() == 5000
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 100").count() == 0

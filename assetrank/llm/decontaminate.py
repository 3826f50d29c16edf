"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Seeds are n words in a row, or with one word left out before the last (``a b c``,
   ``a b _ c``), in texts and items alike and named by the words alone, so a
   copy with every third word replaced, taken out or put in still shares some.
   The seeds of all test items set bits in a filter sized by their number. Documents count, over the
   whole corpus, how many of them hold each seed that passes.
2. An item keeps the seeds held by few documents, or by at most four times as many as its
   rarer ones are; the rarer half stay in any case. So an item that leaked widely keeps
   its own seeds, and loses those that many other texts hold.
3. Documents are scanned for seeds. Neighbouring hits form a window of words,
   wide enough for the longest item on both sides. Windows join items by seed.
4. Each (window, item) pair is aligned locally, word by word (match +2,
   mismatch and gap -1). A document is contaminated by an item when the best
   score reaches ``min_score`` of a perfect one, so edited, shortened and
   paraphrased copies count.

A copy that scores 0.5 keeps at least two thirds of the words when words are replaced, and then
holds a seed wherever the item has eight words or more. What can be lost is a copy with an
edit beside nearly every word, as one with a word put in after each; tests/llm measures the
recall against alignment of everything with everything.

Defined cases: null or empty texts hold nothing; an item with fewer words than a
seed is found where all its words stand together; an item without words matches nothing; items
with the same words each give a row; documents are
told apart by doc_id and text, and rows alike in both give one row per item;
texts of any length are scanned to their end; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables, words

#: Bits of the seed filter, as powers of two: at least, at most, and per seed.
FILTER_LOG, FILTER_LOG_MOST, BITS_EACH = 22, 28, 16
#: Up to so many seeds go to every task with their items; more are joined by Spark.
SEEDS_SHARED = 2_000_000


def smith_waterman(item: np.ndarray, windows: list[np.ndarray], match: int = 2, other: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` in each window, and the window position after its end.

    All windows advance one item word at a time; a running maximum along the
    window settles the gaps inside a row at once.
    """
    width = max(len(w) for w in windows)
    grid = np.zeros((len(windows), width), dtype="uint64")
    real = np.zeros((len(windows), width), dtype=bool)
    for k, w in enumerate(windows):
        grid[k, : len(w)] = w
        real[k, : len(w)] = True
    ramp = np.arange(width, dtype="int32") * -other
    above = np.zeros((len(windows), width + 1), dtype="int32")
    best = np.zeros(len(windows), dtype="int32")
    end = np.zeros(len(windows), dtype="int32")
    for word in item:
        row = np.maximum(above[:, :-1] + np.where((grid == word) & real, match, other), above[:, 1:] + other)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        above[:, 1:] = row
        top = row.argmax(axis=1)
        score = row[np.arange(len(windows)), top]
        better = score > best
        best[better], end[better] = score[better], top[better] + 1
    return best, end


Patterns = list[tuple[int, ...]]
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype="uint64")


def patterns(n: int) -> Patterns:
    """Places of a seed's words: n in a row, and with one word left out before the last."""
    return [tuple(range(n)), (*range(n - 1), n)] if n > 1 else [(0,)]


def seeds_of(hashed: np.ndarray, wanted: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit names, first places) of all seeds, by pattern. The name is that of the words, so a
    word left out or put in between leaves it as it is."""
    names, places = [], []
    products = [(hashed + np.uint64(k)) * _FACTORS[k] for k in range(max(map(len, wanted), default=0))]
    for places_ in wanted:
        count = len(hashed) - places_[-1]
        if count <= 0:
            continue
        total = products[0][:count] + np.uint64(len(places_))
        for product, at in zip(products[1:], places_[1:], strict=False):
            total += product[at : at + count]
        names.append(words.mixed(total))
        places.append(np.arange(count))
    if not names:
        return np.empty(0, dtype="uint64"), np.empty(0, dtype="int64")
    return np.concatenate(names), np.concatenate(places)


def _items(benchmark: DataFrame, n: int) -> DataFrame:
    """item_key, item_id, words (uint64 bytes), n_words, grams (its seeds; a short item is one)."""

    def seeds(hashed: np.ndarray) -> np.ndarray:
        wanted = patterns(n) if len(hashed) >= n else [tuple(range(len(hashed)))] if len(hashed) else []
        return words.signed(np.unique(seeds_of(hashed, wanted)[0]))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashed = [words.hashes(words.plain_words(t or "")) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "item_key": words.signed(np.array([words.run_hash(h) for h in hashed], dtype="uint64")),
                    "item_id": batch["item_id"],
                    "words": [h.tobytes() for h in hashed],
                    "n_words": [len(h) for h in hashed],
                    "grams": [seeds(h) for h in hashed],
                }
            )

    only = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return only.mapInPandas(made, "item_key long, item_id long, words binary, n_words int, grams array<long>")


class SeedFilter:
    """A bit per hash bucket that some seed falls into."""

    def __init__(self, size_log: int, table: np.ndarray):
        self.size_log, self.table = size_log, table

    @cached_property
    def flags(self) -> np.ndarray:
        return np.unpackbits(self.table.view("uint8"), bitorder="little").astype(bool)

    def passing(self, names: np.ndarray) -> np.ndarray:
        at = (names >> np.uint64(64 - self.size_log)).astype("int64")
        if self.size_log <= 24:  # a byte a bucket is faster, and small enough
            return self.flags[at]
        return (self.table[at >> 6] >> (at & 63).astype("uint64")) & np.uint64(1) != 0


def _filter_of(grams: DataFrame, rows: int) -> SeedFilter:
    """The filter of the column ``gram``. At most 2^FILTER_LOG_MOST / 64 words reach
    the driver, whatever the number of seeds."""
    size_log = min(FILTER_LOG_MOST, max(FILTER_LOG, (rows * BITS_EACH).bit_length()))
    bucket = F.shiftrightunsigned("gram", 64 - size_log)
    words_ = grams.select(F.shiftright(bucket, 6).alias("at"), (bucket % 64).cast("int").alias("bit"))
    got = words_.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(1 << (size_log - 6), dtype="uint64")
    table[got["at"].to_numpy()] = got["bits"].to_numpy().view("uint64")
    return SeedFilter(size_log, table)


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), words (their hashes as uint64 bytes) of the rows that hold words."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            found = pa.array([words.hashes(words.plain_words(text.as_py() or "")).tobytes() for text in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "key", "words"])

    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("\x00")))
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(made, "doc_id long, key long, words binary").where(F.octet_length("words") > 0)


def _holders(hashed: DataFrame, seen: Broadcast, wanted: Patterns) -> DataFrame:
    """gram, holders: counts of documents per passing seed and batch."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            held: Counter[int] = Counter()
            for found in batch.column(0):
                names, _ = seeds_of(np.frombuffer(found.as_buffer(), dtype="uint64"), wanted)
                held.update(words.signed(np.unique(names[seen.value.passing(names)])).tolist())
            yield pa.RecordBatch.from_pydict({"gram": pa.array(held.keys(), pa.int64()), "holders": pa.array(held.values(), pa.int64())})

    return hashed.select("words").mapInArrow(counted, "gram long, holders long")


class SeedItems:
    """The items of each seed, as sorted arrays."""

    def __init__(self, grams: np.ndarray, items: np.ndarray):
        order = np.argsort(grams, kind="stable")
        self.grams, self.items = grams[order], items[order]

    def of(self, grams: np.ndarray) -> np.ndarray:
        """Distinct items that hold one of the seeds."""
        first, last = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        some = [self.items[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True) if a < b]
        return np.unique(np.concatenate(some)) if some else np.empty(0, dtype="int64")


def _windows(hashed: DataFrame, seen: Broadcast, wanted: Patterns, margin: int, owners: Broadcast | None) -> DataFrame:
    """Windows of words around seed hits: doc_id, key, nth, first, words, and ``held``: the window's
    seeds, or with ``owners`` the items that they lead to (windows without any are left out)."""
    widest = max(p[-1] for p in wanted) + 1

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            rows = []
            for k, all_words in enumerate(batch.column(2)):
                hashes = np.frombuffer(all_words.as_buffer(), dtype="uint64")
                names, places = seeds_of(hashes, wanted)
                hit = seen.value.passing(names)
                if not hit.any():
                    continue
                names, places = words.signed(names[hit]), places[hit]
                order = np.argsort(places, kind="stable")
                names, places = names[order], places[order]
                cuts = np.nonzero(np.diff(places) > margin)[0] + 1
                for nth, (near, some) in enumerate(zip(np.split(places, cuts), np.split(names, cuts), strict=True)):
                    held = owners.value.of(np.unique(some)) if owners is not None else np.unique(some)
                    if len(held):
                        first = max(0, int(near[0]) - margin)
                        rows.append((k, nth, first, hashes[first : int(near[-1]) + widest + margin].tobytes(), held))
            picked = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(picked),
                    batch.column(1).take(picked),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.binary()),
                    pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                ],
                names=["doc_id", "key", "nth", "first", "words", "held"],
            )

    return hashed.select("doc_id", "key", "words").mapInArrow(found, "doc_id long, key long, nth int, first int, words binary, held array<long>")


def _aligned(pairs: DataFrame, min_score: float) -> DataFrame:
    """Alignments of (window, item) rows that reach min_score."""

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            windows = [np.frombuffer(w, dtype="uint64") for w in batch["words"]]
            score, end = np.zeros(len(batch), dtype="float64"), np.zeros(len(batch), dtype="int64")
            for item, at in batch.groupby("item_words").indices.items():
                item = np.frombuffer(item, dtype="uint64")
                at = sorted(at, key=lambda k: len(windows[k]))  # windows of like length share a grid
                while at:
                    size = max(1, min(256, 2_000_000 // len(windows[at[-1]])))
                    part, at = at[-size:], at[:-size]
                    best, last = smith_waterman(item, [windows[k] for k in part])
                    score[part], end[part] = best / (2.0 * len(item)), last
            batch["score"], batch["end"] = score, end + batch["first"]
            yield batch.loc[batch["score"] >= min_score, ["doc_id", "key", "item_key", "score", "end"]]

    return pairs.select("doc_id", "key", "first", "words", "item_key", "item_words").mapInPandas(
        align, "doc_id long, key long, item_key long, score double, end long"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, rare_share: float = 0.0001, min_score: float = 0.5) -> DataFrame:
    """One row per (document, test item) whose best alignment reaches ``min_score``:
    doc_id, key (hash of the text), item_id, score, end (word position after the copy)."""
    spark = docs.sparkSession
    tables.ship(spark)
    sc = spark.sparkContext
    items = tables.stored(_items(benchmark, n), "items")
    texts = items.where(F.size("grams") > 0).groupBy("item_key").agg(*(F.first(c).alias(c) for c in ("words", "n_words", "grams")))
    texts = tables.stored(texts, "item-texts")
    owned = texts.select("item_key", F.explode("grams").alias("gram"), F.size("grams").alias("n_grams"))
    lengths = texts.where(F.col("n_words") < n).select("n_words").distinct().collect()  # n - 1 at most
    wanted = patterns(n) + [tuple(range(r["n_words"])) for r in sorted(lengths)]
    seen = sc.broadcast(_filter_of(owned, owned.count()))

    hashed = tables.stored(_hashed(docs), "hashed")  # both passes read the words' hashes, not the texts
    total = docs.count()
    holders = _holders(hashed, seen, wanted).groupBy("gram").agg(F.sum("holders").alias("holders"))
    ranked = owned.join(holders, "gram")
    # an item's grams are a bounded list: one sorted array per item gives the ranks
    ranked = ranked.groupBy("item_key").agg(F.array_sort(F.collect_list(F.struct("holders", "gram"))).alias("grams"), F.max("n_grams").alias("n_grams"))
    usual = F.get("grams", (F.size("grams") / 4).cast("int"))["holders"].alias("usual")
    ranked = ranked.select("item_key", "n_grams", usual, F.posexplode("grams").alias("rank", "held")).select("item_key", "n_grams", "usual", "rank", "held.*")
    rare = (F.col("holders") <= max(3.0, rare_share * total)) | (F.col("holders") <= 4 * F.col("usual"))
    seeds = ranked.where(rare | (F.col("rank") * 2 < F.col("n_grams")))
    seeds = tables.stored(seeds.select("gram", "item_key"), "seeds")

    margin = texts.agg(F.max("n_words")).first()[0] or 0
    seed_rows, text_rows = seeds.count(), texts.count()
    chosen = sc.broadcast(_filter_of(seeds, seed_rows))
    if seed_rows <= SEEDS_SHARED:  # 16 bytes each: every task can tell a window's items itself
        got = seeds.toArrow()
        owners = sc.broadcast(SeedItems(got["gram"].to_numpy(), got["item_key"].to_numpy()))
        # an exchange: a task that cuts and aligns at once would hold two Python workers, which stay for a minute
        windows = _windows(hashed, chosen, wanted, margin, owners).repartition("doc_id", "key")
        pairs = windows.withColumn("item_key", F.explode("held")).drop("held")
    else:
        windows = tables.stored(_windows(hashed, chosen, wanted, margin, None), "windows")
        hit = windows.select("doc_id", "key", "nth", "first", F.explode("held").alias("gram")).join(seeds, "gram")
        hit = hit.select("doc_id", "key", "nth", "first", "item_key").distinct()
        same = [F.col(f"h.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("doc_id", "key", "nth", "first")]
        once = windows.dropDuplicates(["doc_id", "key", "nth", "first"]).drop("held")
        pairs = hit.alias("h").join(once.alias("w"), same).select("w.*", "h.item_key")
    sides = texts.select("item_key", F.col("words").alias("item_words"))
    pairs = pairs.join(tables.small_side(sides, text_rows, 16 * max(1, margin)), "item_key")
    best = _aligned(pairs, min_score).groupBy("doc_id", "key", "item_key").agg(F.max_by(F.struct("score", "end"), F.col("score")).alias("b"))
    ids = items.select("item_key", "item_id")
    return best.join(ids, "item_key").select("doc_id", "key", "item_id", "b.score", "b.end")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    found = tables.stored(contaminated(docs, benchmark, **settings).select("doc_id", "key").distinct(), "leaks")
    # helper columns under names that no input has
    ours = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("\x00")))
    taken = set(docs.columns)
    names = [next(n for n in (base + "_" * k for k in range(len(taken) + 1)) if n not in taken) for base in ("leak_id", "leak_key")]
    found = tables.small_side(found.toDF(*names), found.count(), 48)
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found[names[0]]) & (ours == found[names[1]]), "left_anti")

"""N-gram Jaccard self-join by vertical partitioning.

All word n-grams have one global order: by how often their bucket of a
fixed-size count table occurs in the corpus, then by hash. The order is cut
into fragments, and with it every document's set.

* The head fragments hold each set's rarest n-grams, as many as a set that
  reaches the threshold must share at least one of (prefix filter). Sets meet
  in the lists of their head n-grams, under length and position bounds.
* For sets that met, a short parity signature bounds the overlap from above; where
  it allows a link, overlaps are counted fragment by fragment, each fragment on
  its own, and summed per pair; the sum decides exactly.

Documents with equal sets form a class first, and only classes are joined. Big
groups of near copies would give all pairs, so pairs come in two rounds: first
every set of a list meets the list's most central set; the links found give
components; then sets meet only across components. A link inside a component
cannot change it, so no component is lost, and nothing is capped.

Defined cases: null texts and texts without words have no set and link with
nothing; a text with fewer than n words is one n-gram as a whole; repeated
doc_ids are separate rows with the same id (a component's id is the smallest
doc_id in it; null ids count only when there is no other); an empty table gives
an empty result; other columns are ignored. Sets and n-grams are told apart by
64-bit hashes (a set's hash is seeded with its size).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetrank.llm import tables, words
from assetrank.llm.components import components

BUCKET_BITS = 20
SLICES = 16
FAN_IN = 32


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    hashed = words.hashes(words.ascii_words(text or ""))
    if len(hashed) >= n:
        return np.unique(words.grams(hashed, n))
    return np.array([words.run_hash(hashed)], dtype="uint64") if len(hashed) else np.empty(0, dtype="uint64")


def set_name(grams: np.ndarray) -> int | None:
    return words.run_hash(grams) - (1 << 63) if len(grams) else None


def buckets(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype("int64")


def ordered(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Grams in the global order (the input is sorted by hash)."""
    return grams[np.argsort(counts[buckets(grams)], kind="stable")]


def parity(grams: np.ndarray) -> np.ndarray:
    """Per bucket of n-grams whether their number is odd, as 64-bit words. Two
    sets differ in at least as many n-grams as their signatures do in bits. The
    buckets are the low bits of the hashes, two to four per n-gram; a signature
    folds to half its length by xor of its halves."""
    bits = max(128, 1 << (2 * len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype("int64"), minlength=bits) & 1
    return np.packbits(odd.astype("uint8")).view("int64")


def _bits_apart(a: Column, b: Column) -> Column:
    """In how many bits two signatures differ, the longer one folded. Lengths within
    a link's bounds differ by one fold at most; others count as not apart."""

    def folded(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    one = F.when(F.size(a) == 2 * F.size(b), folded(a)).otherwise(a)
    two = F.when(F.size(b) == 2 * F.size(a), folded(b)).otherwise(b)
    return F.aggregate(F.zip_with(one, two, lambda p, q: F.coalesce(F.bit_count(p.bitwiseXOR(q)), F.lit(0))), F.lit(0), lambda n, x: n + x)


def head_size(size: int, percent: int) -> int:
    """A set must share one of its first so many n-grams with every set it links to."""
    return size - -(-percent * size // 100) + 1


def least_overlap(a, b, percent: int):
    """Smallest overlap of two linked sets of these sizes."""
    return F.ceil(percent * (a + b) / F.lit(100.0 + percent) - F.lit(1e-9))


def bucket_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many (document, n-gram) pairs fall into each bucket: a table of fixed
    size, summed by slices on the executors."""
    width = (1 << BUCKET_BITS) // SLICES

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << BUCKET_BITS, dtype="int64")
        for batch in tables.each(batches):
            some, size = [], 0
            for text in batch.column(0):
                some.append(buckets(shingles(text.as_py(), n)))
                size += len(some[-1])
                if size > 1 << BUCKET_BITS:  # few enough to hold, many enough to pay for the table
                    total += np.bincount(np.concatenate(some), minlength=1 << BUCKET_BITS)
                    some, size = [], 0
            if some:
                total += np.bincount(np.concatenate(some), minlength=1 << BUCKET_BITS)
        parts = [zlib.compress(total[k * width : (k + 1) * width].tobytes(), 1) for k in range(SLICES)]
        names = {"slice": pa.array(range(SLICES), pa.int32()), "part": pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32())}
        yield pa.RecordBatch.from_pydict(names | {"counts": pa.array(parts, pa.binary())})

    def summed(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), dtype="int64") for c in part["counts"])
        return pd.DataFrame({"slice": part["slice"].iloc[:1], "part": part["part"].iloc[:1] // FAN_IN, "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "slice int, part int, counts binary"
    parts = tables.stored(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, schema), "bucket-counts")
    last = parts.agg(F.max("part")).first()[0] or 0
    while last:  # a tree of sums: a task adds up FAN_IN slices at most
        parts = parts.groupBy("slice", F.expr(f"part div {FAN_IN}")).applyInPandas(summed, schema)
        last //= FAN_IN
    total = np.zeros(1 << BUCKET_BITS, dtype="int64")
    for row in parts.collect():  # SLICES rows
        total[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), dtype="int64")
    return total


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("\x00")))


def _sets(docs: DataFrame, counts, n: int, percent: int) -> DataFrame:
    """doc_id, key (hash of the text), set (hash; null without words), size, bits
    (parity signature), head (n-grams in order). Bits and head come only with
    a set's first row in a task, so copies bring few."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        seen: set[int] = set()
        for batch in tables.each(batches):
            names, sizes, bits, heads = [], [], [], []
            for text in batch.column(2):
                grams = shingles(text.as_py(), n)
                name = set_name(grams)
                sizes.append(len(grams))
                names.append(name)
                new = name is not None and name not in seen
                bits.append(parity(grams) if new else None)
                heads.append(words.signed(ordered(grams, table)[: head_size(len(grams), percent)]) if new else None)
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())]
                + [pa.array(x, pa.list_(pa.int64())) for x in (bits, heads)],
                names=["doc_id", "key", "set", "size", "bits", "head"],
            )

    text = F.col("text").cast("string")
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    return only.mapInArrow(made, "doc_id long, key long, set long, size long, bits array<long>, head array<long>")


def _segments(docs: DataFrame, counts, n: int, fragments: int) -> DataFrame:
    """set, fragment, grams: the sets of ``docs`` cut along the global order.
    A fragment is a range of the count table's order, the same for all sets."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        bounds = np.quantile(table, np.arange(1, fragments) / fragments) if table.any() else np.zeros(fragments - 1)
        for batch in tables.each(batches):
            rows = []
            for text in batch.column(0):
                grams = shingles(text.as_py(), n)
                if not len(grams):
                    continue
                at = np.searchsorted(bounds, table[buckets(grams)])
                rows += [(set_name(grams), int(k), words.signed(grams[at == k])) for k in np.unique(at)]
                if len(rows) >= 1000:
                    yield as_batch(rows)
                    rows = []
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [("set", pa.int64()), ("fragment", pa.int32()), ("grams", pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(cut, "set long, fragment int, grams array<long>")


def _linked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, counts, n: int, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, a_size, b, b_size) whose summed partial overlaps reach the threshold, as (a, b)."""
    pairs = tables.stored(pairs, "pairs")
    needed = tables.stored(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct(), "needed")
    some = sets.join(tables.small_side(needed, needed.count(), 24), "set", "left_semi")
    some = tables.stored(some.groupBy("set").agg(F.min(F.struct("doc_id", "key")).alias("c"), F.first("bits", ignorenulls=True).alias("bits")), "signatures")
    bits = some.select("set", "bits")
    likely = pairs.join(bits.toDF("a", "a_bits"), "a").join(bits.toDF("b", "b_bits"), "b")
    most = (F.col("a_size") + F.col("b_size") - _bits_apart(F.col("a_bits"), F.col("b_bits"))) / 2
    pairs = tables.stored(likely.where(most >= least_overlap(F.col("a_size"), F.col("b_size"), percent)).select(*pairs.columns), "likely")

    # one text per set that is still in a pair is read again
    needed = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    chosen = some.join(needed, "set", "left_semi")
    chosen = tables.stored(chosen.select(F.col("c.doc_id").alias("chosen_id"), F.col("c.key").alias("chosen_key")), "chosen")
    chosen = tables.small_side(chosen, chosen.count(), 24)
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    own = own.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("key") == F.col("chosen_key")), "left_semi")
    segments = tables.stored(_segments(own.dropDuplicates(["doc_id", "key"]), counts, n, fragments), "segments")
    left = segments.select(F.col("set").alias("a"), "fragment", F.col("grams").alias("a_grams"))
    right = segments.select(F.col("set").alias("b"), "fragment", F.col("grams").alias("b_grams"))
    part = pairs.join(left, "a").join(right, ["b", "fragment"])
    part = part.select("a", "a_size", "b", "b_size", F.size(F.array_intersect("a_grams", "b_grams")).alias("overlap"))
    total = part.groupBy("a", "a_size", "b", "b_size").agg(F.sum("overlap").alias("overlap"))
    return total.where(F.col("overlap") * 100 >= percent * (F.col("a_size") + F.col("b_size") - F.col("overlap"))).select("a", "b")


def _lists(sets: DataFrame) -> DataFrame:
    """gram, set, size, at, c (the most central set) of the n-grams that stand in the
    heads of several sets. Postings meet by n-gram in one exchange, which is read and
    sorted once: a task holds one sort, not the aggregates and sorts of a join with
    itself. Equal sets become one among the few postings that are left."""
    posted = sets.where("head IS NOT NULL").select("set", "size", F.posexplode("head").alias("at", "gram")).repartition("gram")
    listed, end = Window.partitionBy("gram"), F.struct("at", "size", "set")
    ends = posted.withColumns({"c": F.min(end).over(listed), "other": F.max("set").over(listed), "one": F.min("set").over(listed)})
    return ends.where("one <> other").select("gram", "set", "size", "at", "c").distinct()


def _may_link(percent: int):
    """Length and position bounds for two sets that meet at an n-gram."""
    left, right = F.col("l.size") - F.col("l.at"), F.col("r.size") - F.col("r.at")
    lengths = F.least("l.size", "r.size") * 100 >= F.greatest("l.size", "r.size") * percent
    return lengths & (F.least(left, right) >= least_overlap(F.col("l.size"), F.col("r.size"), percent))


def _pair(rows: DataFrame) -> DataFrame:
    """Distinct unordered pairs of (l.set, r.set), the smaller hash first."""
    first = F.col("l.set") < F.col("r.set")
    one, two = F.struct("l.set", "l.size"), F.struct("r.set", "r.size")
    ends = rows.select(F.when(first, one).otherwise(two).alias("x"), F.when(first, two).otherwise(one).alias("y"))
    return ends.select(F.col("x.set").alias("a"), F.col("x.size").alias("a_size"), F.col("y.set").alias("b"), F.col("y.size").alias("b_size")).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, fragments: int = 8) -> DataFrame:
    """doc_id, n_shingles, set (hash of the n-gram set), component_id for every row."""
    spark = docs.sparkSession
    tables.ship(spark)
    counts = spark.sparkContext.broadcast(bucket_counts(docs, n))  # of fixed size
    sets = tables.stored(_sets(docs, counts, n, percent), "sets")

    lists = tables.stored(_lists(sets), "lists")

    # round one: every set of a list meets the list's most central set
    met = lists.select(F.struct("set", "size", "at").alias("l"), F.struct("c.set", "c.size", "c.at").alias("r"))
    met = _pair(met.where(F.col("l.set") != F.col("r.set")).where(_may_link(percent)))
    links = tables.stored(_linked(met, docs, sets, counts, n, percent, fragments), "links")

    # round two: sets of different components, in lists that hold several
    roots = components(links).withColumnRenamed("node", "set")
    roots = tables.small_side(roots, 2 * links.count(), 24)
    rooted = lists.drop("c").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")).repartition("gram")
    listed = Window.partitionBy("gram")
    rooted = rooted.withColumns({"lo": F.min("root").over(listed), "hi": F.max("root").over(listed)}).where("lo <> hi").drop("lo", "hi")
    ends = (F.col("l.gram") == F.col("r.gram")) & (F.struct("l.size", "l.set") < F.struct("r.size", "r.set"))
    across = rooted.alias("l").join(rooted.alias("r"), ends & (F.col("l.root") != F.col("r.root")) & _may_link(percent))
    more = _linked(_pair(across), docs, sets, counts, n, percent, fragments)
    roots = tables.stored(components(links.union(more)), "roots").withColumnRenamed("node", "set")

    # rows without a set stand alone; the others share their class's root
    named = sets.select("doc_id", "key", "set", "size").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # written, so that the join meets plain exchanges and Spark can split a big component's rows
    named = named.join(tables.stored(least, "least"), "root", "left")
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "key", F.col("size").alias("n_shingles"), "root", own.alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, fragments: int = 8) -> DataFrame:
    """``docs`` with one row of each component, all columns kept.

    The row with the smallest doc_id stays (of several with that id the one with
    the smallest text hash; a null id counts as the largest). Of rows alike in id
    and text one stays. Rows without a set all stay.
    """
    found = tables.stored(jaccard_components(docs, n, percent, fragments).where("root IS NOT NULL"), "found")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"), F.count("*").alias("rows"))
    several = found.join(tables.stored(first.where("rows > 1"), "first"), "root")
    stays = several["doc_id"].eqNullSafe(F.col("first.doc_id")) & (several["key"] == F.col("first.key"))
    marked = several.groupBy("doc_id", "key").agg(F.max(stays).alias("stays"), F.count("*").alias("alike"))
    marked = tables.stored(marked.where("NOT stays OR alike > 1"), "marked")

    taken = set(docs.columns)
    fresh = lambda base: next(k for k in (base + "_" * i for i in range(len(taken) + 1)) if k not in taken)
    own_id, own_key = docs["doc_id"].cast("long"), text_key(docs["text"].cast("string"))

    def side(rows: DataFrame) -> tuple[DataFrame, Column]:
        rows = rows.select(F.col("doc_id").alias(fresh("marked_id")), F.col("key").alias(fresh("marked_key")))
        same = own_id.eqNullSafe(rows[fresh("marked_id")]) & (own_key == rows[fresh("marked_key")])
        return tables.small_side(rows, rows.count(), 24), same

    goes, same = side(marked)
    left = docs.join(goes, same, "left_anti")
    alike = marked.where("stays")
    if alike.isEmpty():
        return left
    # rows alike in id and text of which one stays
    some, same = side(alike)
    one = docs.join(some, same, "left_semi").groupBy(own_id.alias(fresh("by_id")), own_key.alias(fresh("by_key")))
    return left.union(one.agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*"))

"""Phrase collocations by Toivonen's mining: a sample proposes, full passes decide.

A phrase is a run of up to three words inside a piece of a text. A phrase that
occurs ``least`` times has parts that occur as often, so:

1. **sample**: a quarter of the documents (by a hash of id and text, so copies
   are spread) is counted with a lowered limit; what reaches it is proposed.
2. **full pass**: over all documents the proposed phrases and their negative border
   are counted, that is every phrase all of whose parts are proposed: all
   words, the pairs of proposed words, the triples of two proposed pairs. A border
   phrase that occurs is counted where it stands; one that doesn't needs no row.
3. **border failures**: counted phrases that reach ``least`` but were not proposed.
   They are added, and a further full pass counts just the phrases that this makes
   countable, until no failure is left. The result then depends
   on the sample in no way, only the number of passes does.
4. a last pass takes the frequent phrases word by word: (hash of each word, count)
   rows, pre-summed per chunk of words and summed by Spark.

Most border phrases occur once or twice, and a row for each would be several times
the corpus. In step 2 a phrase is a 48-bit name: a task sorts the names of
millions of words, and each range of names leaves it as one packed list (differences
and counts, 4 bytes a name). The lists of a range meet in one task, which adds up the
counts of every name. Ranges are as many as the words ask for, and a hot phrase is
one entry of a list, so no range is hot. Names that coincide only let a phrase
more into step 4, where phrases are told apart by their words.

Proposals are looked up in bit tables, sized by their number (``BITS_EACH`` bits a
phrase, ``most_bits`` at most). A false hit only counts a phrase more. Words are
told apart by 64-bit hashes seeded by their language; their own counts are grouped by text.

Score of a cut into parts with counts l and r, for a phrase with count a:
floor(1000000 * a * a / (l * r)) in decimals of 38 digits, which hold every product
of counts below 10^15.

Defined cases: a null text is empty; a null language is ``und``; texts of any length
are read to their end; repeated rows count again; ties are settled by
count, then by the phrase's bytes; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetrank.llm import tables, words

# fixed values of the task: what ends a piece
ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(ENDS, b"." * len(ENDS))
STOP = b"."
BITS_EACH = 16
NAME_BITS = 48
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype="uint64")
#: Words whose phrases a task looks up at once, and names that it holds before it passes them on.
CHUNK = 1 << 18
NAMES_HELD = 1 << 21
#: Names of a range, about.
RANGE_NAMES = 1 << 18
#: Distinct words that a task counts before it passes them on.
WORDS_HELD = 150_000
#: Rows that one window of a ranking step holds, about.
RANK_ROWS = 65_536


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; ``STOP`` stands between pieces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_STOP).replace(STOP, b" . ").split()


class LanguageHashes(dict):
    """Word -> 64-bit hash for one language; 0 stands for the end of a piece only. ``room`` is
    shared by all languages: without any left a table keeps what it has."""

    def __init__(self, lang: str, room: list[int]):
        super().__init__({STOP: 0})
        self.seed, self.room = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass")), room

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed) or 1
        if self.room[0] > 0:
            self[word] = value
            self.room[0] -= 1
        return value


class Hashes:
    """A table per language, ``most`` words in all."""

    def __init__(self, most: int = 250_000):
        self.most, self.room = most, [most]
        self.tables: dict[str, LanguageHashes] = {}

    def of(self, lang: str, found: list[bytes]) -> np.ndarray:
        if lang not in self.tables:
            if len(self.tables) >= 1000:  # junk in the column: begin anew
                self.tables.clear()
                self.room[0] = self.most
            self.tables[lang] = LanguageHashes(lang, self.room)
        return np.fromiter(map(self.tables[lang].__getitem__, found), dtype="uint64", count=len(found))


_HASHES = Hashes()


def names_of(h: np.ndarray, size: int) -> np.ndarray:
    """A 48-bit name for the run of ``size`` word hashes at every place; a word's is its own top bits."""
    if size == 1:
        return h >> np.uint64(64 - NAME_BITS)
    count = max(0, len(h) - size + 1)
    total = np.zeros(count, dtype="uint64")
    for k, factor in enumerate(_FACTORS[:size]):
        total += (h[k : k + count] ^ (h[k : k + count] >> np.uint64(29))) * factor
    return words.mixed(total) >> np.uint64(64 - NAME_BITS)


class Bits:
    """A set of names as a bit table; it may hold more, never less."""

    def __init__(self, size_log: int, table: np.ndarray):
        self.size_log, self.table = size_log, table

    def has(self, names: np.ndarray) -> np.ndarray:
        at = (names >> np.uint64(NAME_BITS - self.size_log)).astype("int64")
        return (self.table[at >> 6] >> (at & 63).astype("uint64")) & np.uint64(1) != 0

    def with_names(self, names: DataFrame) -> "Bits":
        """The table with the column ``name`` as well; the driver gets its words at most, whatever the rows."""
        shift = NAME_BITS - self.size_log
        parts = names.groupBy(F.shiftright("name", shift + 6).alias("at"))
        got = parts.agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftright(name, {shift}) & 63 as int)))").alias("bits")).toArrow()
        more = self.table.copy()
        more[got["at"].to_numpy()] |= got["bits"].to_numpy().view("uint64")
        return Bits(self.size_log, more)


def bits_of(names: DataFrame, rows: int, most_bits: int) -> Bits:
    """The bit table of the column ``name``: one bit in ``BITS_EACH`` is set, as long as ``most_bits`` allows."""
    size_log = min(max(10, (max(1, rows) * BITS_EACH - 1).bit_length()), most_bits.bit_length() - 1, NAME_BITS - 6)
    return Bits(size_log, np.zeros(1 << (size_log - 6), dtype="uint64")).with_names(names)


class Proposed:
    """What a pass counts: phrases countable by the words and pairs proposed now, but not by those before."""

    def __init__(self, old_words: Bits | None, new_words: Bits, old_pairs: Bits | None, new_pairs: Bits | None):
        self.before, self.now = (old_words, old_pairs), (new_words, new_pairs)

    def countable(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of the pairs, and of the triples, that this pass counts."""
        real = h != 0
        joined = real[:-1] & real[1:]
        pair_names = names_of(h, 2)

        def starts(table: Bits | None, names: np.ndarray, where: np.ndarray) -> np.ndarray:
            """Places where two neighbours are both in the table."""
            hit = np.zeros(len(names), dtype=bool)
            if table is not None:
                hit[where] = table.has(names[where])
            return hit[:-1] & hit[1:]

        def both(tables_: tuple[Bits | None, Bits | None]) -> tuple[np.ndarray, np.ndarray]:
            pairs = starts(tables_[0], names_of(h, 1), real) & joined
            return pairs, starts(tables_[1], pair_names, pairs)

        pairs, triples = both(self.now)
        if self.before[0] is not None:
            old_pairs, old_triples = both(self.before)
            pairs, triples = pairs & ~old_pairs, triples & ~old_triples
        return pair_names[pairs], names_of(h, 3)[triples]


def packed(names: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """(range, packed list) of names: per range of the top ``bits`` the count of entries, the first
    name, the differences to the next ones, and place and count of entries that are several."""
    names = np.sort(names)
    new = np.ones(len(names), dtype=bool)
    new[1:] = names[1:] != names[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(names)))
    names = names[first]
    at = (names >> np.uint64(NAME_BITS - bits)).astype("int64")
    cuts = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(names))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        steps = np.diff(names[a:b])
        wide = len(steps) > 0 and int(steps.max()) >= 1 << 32
        several = np.flatnonzero(count[a:b] > 1)
        head = np.array([b - a, names[a], wide, len(several)], dtype="uint64").tobytes()
        yield int(at[a]), head + steps.astype("uint64" if wide else "uint32").tobytes() + several.astype("uint32").tobytes() + count[a:b][several].astype("uint32").tobytes()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(names, counts) of a packed list."""
    size, first, wide, several = np.frombuffer(blob, dtype="uint64", count=4).tolist()
    kind = np.dtype("uint64" if wide else "uint32")
    steps = np.frombuffer(blob, dtype=kind, count=size - 1, offset=32)
    names = np.cumsum(np.concatenate([[np.uint64(first)], steps.astype("uint64")]), dtype="uint64")
    counts = np.ones(size, dtype="int64")
    place = np.frombuffer(blob, dtype="uint32", count=several, offset=32 + steps.nbytes)
    counts[place] = np.frombuffer(blob, dtype="uint32", count=several, offset=32 + steps.nbytes + place.nbytes)
    return names, counts


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Word hashes of the texts (columns lang, text), 0 after each piece, some texts at a time."""
    some, size = [], 0
    for batch in tables.each(batches):
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            found = tokens(text.as_py())
            if found:
                some.append(np.append(_HASHES.of(lang.as_py(), found), np.uint64(0)))
                size += len(found)
            if size >= CHUNK:
                yield np.concatenate(some)
                some, size = [], 0
    if some:
        yield np.concatenate(some)


def count_words(texts: DataFrame) -> DataFrame:
    """lang, word, h (hash), n and drawn_n (in the sample) for every word of the texts (lang, text, drawn)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, bool], Counter] = {}
        size = 0
        for batch in tables.each(batches):
            for lang, text, drawn in zip(*batch.columns, strict=True):
                count = counts.setdefault((lang.as_py(), drawn.as_py()), Counter())
                size -= len(count)
                count.update(tokens(text.as_py()))
                size += len(count)
                if size > WORDS_HELD:
                    yield from as_batches(counts)
                    counts, size = {}, 0
        yield from as_batches(counts)

    def as_batches(counts: dict[tuple[str, bool], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, drawn), count in counts.items():
            del count[STOP]
            found = list(count)
            for k in range(0, len(found), 50_000):
                part = found[k : k + 50_000]
                n = pa.array([count[w] for w in part], pa.int64())
                kinds = [pa.array([lang] * len(part), pa.string()), pa.array([w.decode("utf-8", "replace") for w in part], pa.string())]
                h = pa.array(_HASHES.of(lang, part).view("int64"))
                yield pa.RecordBatch.from_arrays([*kinds, h, n, n if drawn else pa.array([0] * len(part), pa.int64())], names=["lang", "word", "h", "n", "drawn_n"])

    found = texts.select("lang", "text", "drawn").mapInArrow(made, "lang string, word string, h long, n long, drawn_n long")
    return found.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"), F.sum("drawn_n").alias("drawn_n"))


def count_names(texts: DataFrame, proposed: Broadcast, least: int, bits: int) -> DataFrame:
    """size (2 or 3), name, n of the countable phrases that occur ``least`` times, in 2^``bits`` ranges."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {2: [], 3: []}
        size = 0
        for h in _arrays(batches):
            for k, names in zip((2, 3), proposed.value.countable(h), strict=True):
                held[k].append(names)
                size += len(names)
            if size >= NAMES_HELD:
                yield from lists(held)
                held, size = {2: [], 3: []}, 0
        yield from lists(held)

    def lists(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, some in held.items():
            names = np.concatenate(some) if some else np.empty(0, dtype="uint64")
            some.clear()
            rows = list(packed(names, bits)) if len(names) else []
            for i in range(0, len(rows), 4096):
                part = rows[i : i + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(part), pa.int32()), pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary())], names=["size", "range", "names"])

    def summed(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        names, counts = map(np.concatenate, zip(*map(unpacked, lists["names"]), strict=True))
        order = np.argsort(names, kind="stable")
        names, counts = names[order], counts[order]
        first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        total = np.add.reduceat(counts, first)
        stay = total >= least
        return pd.DataFrame({"size": np.int32(key[0]), "name": names[first][stay].view("int64"), "n": total[stay]})

    found = texts.select("lang", "text").mapInArrow(made, "size int, range int, names binary")
    return found.groupBy("size", "range").applyInPandas(summed, "size int, name long, n long")


def count_phrases(texts: DataFrame, chosen: Broadcast) -> DataFrame:
    """h1, h2, h3 (null for pairs), n of the pairs and triples whose names ``chosen`` (two bit tables) holds."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in _arrays(batches):
            real = h != 0
            within = real
            for size, table in zip((2, 3), chosen.value, strict=True):
                within = within[:-1] & real[size - 1 :]
                names = names_of(h, size)
                starts = np.flatnonzero(within)
                starts = starts[table.has(names[starts])]
                if len(starts):
                    yield from rows(h, starts[np.argsort(names[starts], kind="stable")], size)

    def rows(h: np.ndarray, starts: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """Equal phrases of a chunk (neighbours by name) as one row."""
        cols = [h[starts + k] for k in range(size)]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        arrays = [pa.array(c[first].view("int64")) for c in cols] + [pa.nulls(len(first), pa.int64())] * (3 - size)
        for k in range(0, len(first), 1 << 16):
            yield pa.RecordBatch.from_arrays([*(a.slice(k, 1 << 16) for a in arrays), pa.array(count[k : k + (1 << 16)])], names=["h1", "h2", "h3", "n"])

    return texts.select("lang", "text").mapInArrow(made, "h1 long, h2 long, h3 long, n long").groupBy("h1", "h2", "h3").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, least: int, share: float, most_bits: int) -> tuple[DataFrame, DataFrame, int]:
    """(all words with counts, phrases of 2 and 3 words that occur ``least`` times, full passes that counted)."""
    spark = docs.sparkSession
    spread = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.pmod(spread, F.lit(1 << 20)) < int(share * (1 << 20))).alias("drawn"),
    )
    low = max(1, int(0.8 * share * least))
    word_name = F.shiftrightunsigned("h", 64 - NAME_BITS).alias("name")

    counted = tables.stored(count_words(texts), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    bits = min(18, max(4, (2 * total // RANGE_NAMES).bit_length()))

    def table(names: DataFrame) -> Bits:
        return bits_of(names, names.count(), most_bits)

    def names_from(now: Proposed, some: DataFrame, least: int) -> DataFrame:
        return tables.stored(count_names(some, spark.sparkContext.broadcast(now), least, bits), "names")

    # the sample proposes words, then pairs of them
    word_bits = table(counted.where(F.col("drawn_n") >= low).select(word_name))
    pair_bits = table(names_from(Proposed(None, word_bits, None, None), texts.where("drawn"), low).where("size = 2"))

    old_words = old_pairs = None
    found, passes = None, 0
    while True:
        new = names_from(Proposed(old_words, word_bits, old_pairs, pair_bits), texts, least)
        found, passes = new if found is None else found.union(new), passes + 1
        # border failures: frequent, counted, not proposed
        word_failures = tables.stored(_outside(counted.where(F.col("n") >= least).select(word_name), word_bits), "word-failures")
        pair_failures = tables.stored(_outside(new.where("size = 2").select("name"), pair_bits), "pair-failures")
        if word_failures.isEmpty() and pair_failures.isEmpty():
            break
        old_words, old_pairs = word_bits, pair_bits
        word_bits, pair_bits = word_bits.with_names(word_failures), pair_bits.with_names(pair_failures)
    chosen = tuple(table(found.where(F.col("size") == size)) for size in (2, 3))
    phrases = count_phrases(texts, spark.sparkContext.broadcast(chosen)).where(F.col("n") >= least)
    return counted, tables.stored(phrases, "phrases"), passes


def _outside(names: DataFrame, table: Bits) -> DataFrame:
    """The names that a bit table doesn't have."""
    shared = names.sparkSession.sparkContext.broadcast(table)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(own[~shared.value.has(own.view("uint64"))])], names=["name"])

    return names.mapInArrow(made, "name long")


def score_sql(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (l * r)) exactly."""
    wide = "decimal(38,0)"
    square = f"cast(cast(cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) as decimal(31,0)) * cast(1000000 as decimal(7,0)) as {wide})"
    return f"cast({square} div cast(cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)) as {wide}) as bigint)"


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, percent: int = 50, share: float = 0.25, most_bits: int = 1 << 28) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    tables.ship(docs.sparkSession)
    counted, phrases, _ = frequent(docs, least, share, most_bits)
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))  # a row per language
    known = counted.where(F.col("n") >= least).select("lang", "word", "h", F.col("n").alias("f"))
    known = tables.small_side(known, known.count(), 64)
    pairs = phrases.where("h3 IS NULL").select("h1", "h2", F.col("n").alias("a"))
    triples = phrases.where("h3 IS NOT NULL").select("h1", "h2", "h3", F.col("n").alias("a"))

    # a pair inside a triple with at least ``percent`` of its count goes
    inside = triples.select(F.explode(F.array(F.struct("h1", "h2", "a"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))).alias("p"))
    inside = inside.groupBy("p.h1", "p.h2").agg(F.max("p.a").alias("longer"))
    stay = pairs.join(inside, ["h1", "h2"], "left").where(F.expr(f"longer IS NULL OR 100 * longer < {percent} * a"))

    def word(k: int, *more: str) -> DataFrame:
        return known.select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *more)

    two = stay.join(word(1, "lang"), "h1").join(word(2), "h2")
    two = two.selectExpr("lang", "concat(w1, ' ', w2) AS phrase", "a", "f1 AS l", "f2 AS r")
    three = triples.join(pairs.select("h1", "h2", F.col("a").alias("f12")), ["h1", "h2"])
    three = three.join(pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23")), ["h2", "h3"])
    three = three.join(word(1, "lang"), "h1").join(word(2), "h2").join(word(3), "h3")
    three = three.withColumns({"s1": F.expr(score_sql("a", "f1", "f23")), "s2": F.expr(score_sql("a", "f12", "f3"))})
    three = three.selectExpr("lang", "concat(w1, ' ', w2, ' ', w3) AS phrase", "a", "if(s2 < s1, f12, f1) AS l", "if(s2 < s1, f3, f23) AS r")
    scored = two.union(three).withColumn("score", F.expr(score_sql("a", "l", "r")))
    return best(tables.stored(scored, "scored"), top).join(F.broadcast(total), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def best(scored: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` rows with their rank. A language is cut into parts
    of about ``RANK_ROWS`` rows, whose firsts meet in fewer parts, until one is left."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = -(-scored.count() // RANK_ROWS)
    while parts > 1:
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        some = scored.withColumn("_part", part)
        firsts = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        scored = firsts.where(F.col("rank") <= top).drop("rank", "_part")
        parts = parts // 16 if parts > 16 else 1
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)

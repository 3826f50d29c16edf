"""Sequence packing: bounded-space online best fit.

Documents become token ids, are cut into pieces of at most ``max_tokens`` and
packed into sequences. A packer keeps a fixed number of open sequences. A bit
set holds one bit per free length that some open sequence has, so the best fit
(smallest free length that is large enough) is one shift and one lowest-bit
step. When no open sequence fits and all places are taken, the fullest closes.

Defined cases: a null text counts as empty; an empty text is the end id alone;
an empty table gives an empty result; repeated rows are packed as often as they
occur; other columns of the input are ignored.
"""

from __future__ import annotations

import string
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
SEQUENCE_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


#: ASCII marks that the tokenizer splits off a word (an apostrophe can begin a contraction, < a special token).
_MARKS = "".join(c for c in string.punctuation if c not in "'<|>_")


class WordIds(dict):
    """Ids (little-endian uint32 bytes) of text between blanks, filled on demand.

    The tokenizer's splitting never joins text across white space, nor letters
    with the marks after them, and it lower-cases: so a text's ids are its
    blank-separated parts' ids in a row, and ``Word,`` has those of ``word`` and
    ``,``. ``most`` bounds the memory: a full table keeps what it has (frequent
    parts come early) and encodes the rest anew. Joined parts take a quarter at most.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most

    def __missing__(self, part: str) -> bytes:
        word = part.rstrip(_MARKS)
        # lower-casing may end a word in a combining mark, which the tokenizer joins to what follows
        if word.isalpha() and word.lower().isalpha() and (len(word) < len(part) or word.isascii() and not word.islower()):
            if word.isascii():
                word = word.lower()
            marks = part[len(word) :]
            ids = self[word] + self[marks] if marks else self[word]
            room = self.most // 4
        else:
            ids = np.asarray(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
            room = self.most
        if len(self) < room and len(part) <= 64:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One table per worker process and tokenizer file."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def document_ids(table: WordIds, text: str | None, end_id: int) -> bytes:
    return table.encode(text or "") + np.asarray([end_id], dtype="<u4").tobytes()


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids``,
    the piece's ids as little-endian uint32 bytes, if asked for)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(tokenizer_path)
        step = 4 * max_tokens
        for batch in tables.each(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(table, text.as_py(), end_id)
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                if with_ids and len(out) >= 512:
                    yield as_batch(out)
                    out = []
            if out:
                yield as_batch(out)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 if with_ids else 5]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names[: len(kinds)])

    tables.ship(docs.sparkSession)
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(pieces, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


class BestFit:
    """Online best fit over at most ``open_most`` open sequences."""

    def __init__(self, max_tokens: int, open_most: int, first_id: int = 0):
        self.max_tokens, self.open_most, self.next_id = max_tokens, open_most, first_id
        self.bits = 0
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.open = 0

    def _take(self, free: int) -> int:
        places = self.by_free[free]
        sequence = places.pop()
        if not places:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of the next piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.open_most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, sequence = self.max_tokens, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.max_tokens - free


def pack(pieces: DataFrame, max_tokens: int, open_sequences: int = 512, sequences_per_task: int = 16384, lot: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset``.

    Pieces are dealt by hash to as many tasks as the total length asks for
    (about ``sequences_per_task`` sequences each) and packed online: a task holds
    its open sequences and one batch. They arrive in pseudo-random lots of about
    ``lot`` pieces, the long ones of a lot first, so that the short ones fill
    what the long ones leave while those sequences are still open. A rerun of
    a task gives the same rows.
    """
    total, count = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    tasks = max(1, -(-total // (max_tokens * sequences_per_task)))
    keys = ["doc_id", "piece", "ids_crc32", "length", "start"]
    order = [F.pmod(F.xxhash64("ids_crc32", "doc_id", "piece"), F.lit(max(1, count // (tasks * lot)))), F.desc("length")]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = BestFit(max_tokens, open_sequences, TaskContext.get().partitionId() << 40)
        for rows in batches:
            places = [packer.place(n) for n in rows["length"].tolist()]
            rows["sequence_id"] = np.array([s for s, _ in places], dtype="int64")
            rows["offset"] = np.array([o for _, o in places], dtype="int64")
            yield rows

    tables.ship(pieces.sparkSession)
    dealt = pieces.repartition(tasks, F.xxhash64(*keys)).sortWithinPartitions(*order, *keys)
    return dealt.mapInPandas(packed, SEQUENCE_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1, open_sequences: int = 512) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its place (SEQUENCE_SCHEMA).

    The pieces are written to the shared folder first, so neither the sizing
    sum nor a lost executor makes the texts be tokenized again.
    """
    pieces = tables.stored(tokenize_pieces(docs, tokenizer_path, max_tokens, end_id), "pieces")
    return pack(pieces, max_tokens, open_sequences)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens and ``ids`` (array
    of ints in order), from the same documents and their places."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    made = tokenize_pieces(docs, tokenizer_path, max_tokens, end_id, with_ids=True)
    # equal pieces of one document id are interchangeable: number both sides
    from pyspark.sql import Window

    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    left = made.withColumn("nth", spot).alias("m")
    right = placed.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("sequence_id", "offset"))).alias("p")
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"p.{k}")) for k in [*keys, "nth"]]
    joined = left.join(right, same).select("p.sequence_id", "p.offset", "p.length", "m.ids")
    gathered = joined.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    @F.pandas_udf("array<int>")
    def joined_ids(parts: pd.Series) -> pd.Series:
        return parts.map(lambda rows: np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), dtype="<u4").astype("int32"))

    return gathered.select("sequence_id", "n_tokens", joined_ids("parts").alias("ids"))

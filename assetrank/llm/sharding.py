"""Consistent-hash sharding with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard owns virtual nodes on it; a
document falls into the cell of its id's hash and belongs to the shard of the
next virtual node clockwise. A shard takes no more than its capacity: documents
beyond it continue clockwise to the next shard with room. Cells are served in
ring order, so the outcome depends on the multiset of rows only.

Only counts per cell (a fixed number of cells, whatever the input) reach the
driver; rows are numbered inside their cell and find shard and slot by an
equi-join on the cell. Native DataFrame operations throughout.

Capacities: with ``slack=0`` the capacities add up to the number of rows, so
every shard is exactly full and counts differ by one at most (law ``rows``).
With ``slack`` > 0 a shard holds at most (1 + slack) times the mean, and
adding a shard moves fewer rows.

Defined cases: rows with a null id are placed by their text; a null text
has no bytes; rows that are equal in id and text are interchangeable; a text of any length
counts whole; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetrank.llm import tables

CELLS = 1 << 16
#: Equal rows that unfold at once.
STEP = 1 << 16


def ring(shards: int, virtual_nodes: int, cells: int = CELLS) -> list[tuple[int, int]]:
    """Sorted (cell, shard) of all virtual nodes; a shard's nodes do not depend on the other shards."""
    nodes = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "big") % cells, digest, shard))
    return [(cell, shard) for cell, _, shard in sorted(nodes)]


def clockwise(nodes: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """For each node index, the shards in the order a clockwise walk meets them."""
    walks: list[list[int]] = [[]] * len(nodes)
    walk: list[int] = list(dict.fromkeys(shard for _, shard in nodes))
    for k in range(len(nodes) - 1, -1, -1):
        shard = nodes[k][1]
        walk = [shard, *(s for s in walk if s != shard)]
        walks[k] = walk
    return walks


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Largest number of rows of each shard."""
    base, extra = divmod(total, shards)
    if slack <= 0:
        return [base + (s < extra) for s in range(shards)]
    return [max(base + 1, int(-(-total * (1 + slack) // shards)))] * shards


def quotas(counts: dict[int, int], shards: int, virtual_nodes: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first rank) for every
    stretch of rows that one cell gives to one shard."""
    nodes = ring(shards, virtual_nodes)
    places = [cell for cell, _ in nodes]
    walks = clockwise(nodes, shards)
    room = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    out = []
    for cell in sorted(counts):
        left, rank = counts[cell], 0
        for shard in walks[bisect_left(places, cell) % len(nodes)]:
            take = min(left, room[shard] - used[shard])
            if take > 0:
                out.append((cell, rank, rank + take, shard, used[shard]))
                used[shard] += take
                rank += take
                left -= take
            if not left:
                break
    return out


def ring_cell(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(CELLS))


def shard_documents(docs: DataFrame, shards: int = 8, virtual_nodes: int = 128, slack: float = 0.0) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless in the shard)."""
    text = F.col("text").cast("string")
    # equal rows travel as one row with a count
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("alike"))
    # rows without an id go by their text
    alike = alike.withColumn("cell", F.when(F.col("doc_id").isNull(), ring_cell(F.struct("text_crc32", "size"))).otherwise(ring_cell(F.col("doc_id"))))
    alike = tables.stored(alike, "alike")
    counts = alike.groupBy("cell").agg(F.sum("alike").alias("n"))
    counted = {r["cell"]: r["n"] for r in counts.collect()}  # at most CELLS rows
    if not counted:
        return rows.where(F.lit(False)).select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    plan = docs.sparkSession.createDataFrame(
        quotas(counted, shards, virtual_nodes, slack), "cell long, first long, until long, shard int, base long"
    )
    in_cell = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")
    ranged = alike.withColumn("end", F.sum("alike").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)))
    # at most CELLS + shards * virtual nodes rows, so the side is small by construction
    met = ranged.join(F.broadcast(plan), "cell").where((F.col("first") < F.col("end")) & (F.col("until") > F.col("end") - F.col("alike")))
    # equal rows unfold in steps, so that no array holds more than STEP of them
    met = met.withColumns({"low": F.greatest("first", F.col("end") - F.col("alike")), "high": F.least("until", "end") - 1})
    met = met.withColumn("part", F.explode(F.sequence(F.col("low"), F.col("high"), F.lit(STEP))))
    rank = F.explode(F.sequence(F.col("part"), F.least(F.col("part") + STEP - 1, F.col("high"))))
    placed = met.select("doc_id", "size", "text_crc32", "shard", "base", "first", rank.alias("rank"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))

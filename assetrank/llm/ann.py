"""Approximate nearest neighbours: a vantage-point tree per shard.

Vectors are dealt into shards of bounded size; each shard's tree is built in one
task and stored as one row. Queries form blocks of bounded size; every (shard,
block) pair is one unit of work, found by an equi-join on the shard. A search
keeps each query's k best so far and skips a subtree when the triangle
inequality puts it farther than that distance divided by ``factor``: factor 1
skips only what cannot matter (exact search), a larger factor skips more.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do vectors whose length is not that of most; a
query never meets its own row but does meet other rows with its id; fewer
candidates than k give fewer results; ties go to the smaller id; an empty table
gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetrank.llm import tables

RESULT = "query_id long, query_row long, vec_id long, score double"


class Tree:
    """A vantage-point tree over rows of a matrix, as flat arrays (pickles small)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, leaf: int):
        self.order = np.arange(len(ids))
        self.vectors = vectors
        # node: (first, end, radius, inner child, outer child); leaves have child -1, a vantage point sits at ``first``
        self.nodes: list[tuple[int, int, float, int, int]] = []
        self._build(0, len(ids), leaf)
        self.ids, self.rows, self.vectors = ids[self.order], rows[self.order], vectors[self.order]
        self.lengths = (self.vectors**2).sum(1)

    def _build(self, first: int, end: int, leaf: int) -> None:
        todo = [(first, end, -1, 0)]
        nodes: list[list] = []
        while todo:
            first, end, parent, side = todo.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][3 + side] = here
            nodes.append([first, end, 0.0, -1, -1])
            if end - first <= leaf:
                continue
            part = self.order[first:end]
            points = self.vectors[part]
            # vantage point: the row farthest from the first one (a corner splits best)
            far = int(np.argmax(((points - points[0]) ** 2).sum(1)))
            part[[0, far]] = part[[far, 0]]
            away = np.sqrt(((self.vectors[part[1:]] - self.vectors[part[0]]) ** 2).sum(1))
            middle = len(away) // 2
            split = np.argpartition(away, middle)
            part[1:] = part[1:][split]
            nodes[here][2] = float(away[split[middle]])
            self.order[first:end] = part
            cut = first + 1 + middle
            todo += [(first + 1, cut, here, 0), (cut, end, here, 1)]
        self.nodes = [tuple(n) for n in nodes]

    def search(self, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, position in the tree, distance) of the k best of each query in this tree."""
        best = np.full((len(ids), k), np.inf)
        where = np.full((len(ids), k), -1, dtype="int64")
        lengths, own = (queries**2).sum(1), rows

        def offer(active: np.ndarray, first: int, end: int) -> None:
            # a product screens the pairs; those that may enter a list are measured exactly
            screen = lengths[active][:, None] + self.lengths[first:end][None, :] - 2.0 * (queries[active] @ self.vectors[first:end].T)
            may = screen <= (best[active, -1] ** 2 * (1 + 1e-9) + 1e-9)[:, None]
            may &= own[active][:, None] != self.rows[first:end][None, :]  # not its own row
            query, spot = np.nonzero(may)
            if not len(query):
                return
            query, spot = active[query], spot + first
            away = distances(queries, query, self.vectors, spot)
            touched = np.unique(query)
            old = where[touched] >= 0
            query = np.concatenate([query, np.repeat(touched, old.sum(1))])
            spot = np.concatenate([spot, where[touched][old]])
            away = np.concatenate([away, best[touched][old]])
            order = np.lexsort((self.ids[spot], away, query))
            query, spot, away = query[order], spot[order], away[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            keep = place < k
            best[query[keep], place[keep]] = away[keep]
            where[query[keep], place[keep]] = spot[keep]

        def visit(node: int, active: np.ndarray) -> None:
            first, end, radius, inner, outer = self.nodes[node]
            if inner < 0:
                offer(active, first, end)
                return
            offer(active, first, first + 1)
            away = distances(queries, active, self.vectors, np.full(len(active), first))
            near_inner = away < radius
            for child, mine in ((inner, near_inner), (outer, ~near_inner)):  # the nearer side first
                if mine.any():
                    visit(child, active[mine])
            for child, mine, gap in ((outer, near_inner, radius - away), (inner, ~near_inner, away - radius)):
                mine = mine & (gap * factor <= best[active, -1] + 1e-12)  # what rounding may take from a tie
                if mine.any():
                    visit(child, active[mine])

        if len(self.ids) and len(ids):
            visit(0, np.arange(len(ids)))
        found = where >= 0
        return np.nonzero(found)[0], where[found], best[found]


def distances(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows ``at`` of a to rows ``bt`` of b; the squares are added in the components' order."""
    out = np.empty(len(at))
    step = max(1, 2_000_000 // max(1, a.shape[1]))
    for k in range(0, len(at), step):
        out[k : k + step] = np.sqrt(np.cumsum((a[at[k : k + step]] - b[bt[k : k + step]]) ** 2, axis=1)[:, -1])
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, row (a number of its own per row), v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where("v is not null and size(v) > 0").where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.withColumn("row", F.monotonically_increasing_id())


def nearest(vectors: DataFrame, is_query: str, k: int = 10, factor: float = 1.5, shard_rows: int = 8192, block_queries: int = 2048, leaf: int = 128) -> DataFrame:
    """The k nearest other rows of every row for which ``is_query`` holds:
    query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    tables.ship(spark)
    rows = tables.stored(usable(vectors), "vectors")
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = sizes["dim"], sizes["count"]
    rows = rows.where(F.size("v") == dim)
    shards = max(1, -(-total // shard_rows))
    asked = rows.where(is_query)
    blocks = max(1, -(-asked.count() // block_queries))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "row"])
        tree = Tree(part["vec_id"].to_numpy(), part["row"].to_numpy(), np.stack(part["v"].to_numpy()).astype("float64"), leaf)
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "tree": [pickle.dumps(tree, protocol=5)]})

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        block = (part["vec_id"].to_numpy(), part["row"].to_numpy(), np.stack(part["v"].to_numpy()).astype("float64"))
        return pd.DataFrame({"block": [int(part["block"].iloc[0])], "queries": [pickle.dumps(block, protocol=5)]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, block in zip(batch["tree"], batch["queries"], strict=True):
                tree, (ids, own, queries) = pickle.loads(tree), pickle.loads(block)
                at, spot, away = tree.search(ids, own, queries, k, factor)
                yield pd.DataFrame({"query_id": ids[at], "query_row": own[at], "vec_id": tree.ids[spot], "score": away})

    trees = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    trees = tables.stored(trees.groupBy("shard").applyInPandas(build, "shard int, tree binary"), "trees")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    asked = tables.stored(asked.groupBy("block").applyInPandas(gather, "block int, queries binary"), "queries")
    units = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    units = units.repartition(max(1, min(shards * blocks, 4096)), "shard", "block").join(trees.hint("shuffle_hash"), "shard")
    found = units.select("tree", "queries").mapInPandas(search, RESULT)
    best = Window.partitionBy("query_id", "query_row").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

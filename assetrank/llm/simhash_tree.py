"""SimHash near-duplicates through vantage-point trees over Hamming distance.

A fingerprint has 64 bits: bit b is 1 when it is set in over half the 64-bit hashes
of the text's word runs. Two fingerprints link when at most ``distance`` bits
differ; links make components. All search is exact.

Distances between unrelated fingerprints crowd at 32 with a spread of 4, as wide
as the search radius, so a triangle bound on whole fingerprints prunes almost
nothing. The bits are therefore cut into segments: fingerprints that differ in
at most 4 bits differ in at most 1 bit of some segment of three. Each segment has a
vantage-point tree of its own, and there the radius is 1:

* a tree is fitted on a bounded sample (``sample`` fingerprints, taken by hash). A
  node has a vantage point v and a cut m; values with d(v, x) <= m go in, the
  others out. Its leaves are the shards. The sample shapes the shards only: every
  fingerprint is routed.
* by the triangle inequality a pair cut apart by a node has its inner end at m - 1 <
  d(v, x) <= m; those values also visit the outer shards. Every linked pair so
  meets in a shard, and all other branches are pruned.
* a shard goes on with the same trees in its task until pieces are small, and
  compares those bit by bit over all 64 bits. It reports a spanning forest of its
  links, never all pairs of a group.
* a shard with more than ``shard_most`` values is cut into blocks, and every two
  blocks meet in a task of their own, so no task holds more than two blocks.

Equal fingerprints are one before the search, so copies cost nothing there.

Defined cases: a null or empty text, or one without words, has fingerprint zero,
which links like any other; a text with fewer than ``n`` words is one run as a
whole; a text of any length is read to its end, in one pass; repeated doc_ids are
separate rows with their own fingerprints; a null doc_id names a component only
when it holds no other; an empty table gives an empty result; other columns are
ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables, words
from assetrank.llm.components import components

SEED = 42
#: A piece of a shard that is compared at once.
PIECE = 512


def fingerprint(text: str | None, n: int = 4) -> int:
    """The 64 bits of a text: majority of the hashes of its runs of ``n`` words, repeats included."""
    found = words.ascii_words(text or "")
    if not found:
        return 0
    whole = b" ".join(found)
    runs = len(found) - n + 1
    if runs <= 1:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), dtype="int64", count=len(found)) + 1)
    firsts = np.concatenate([[0], ends[: runs - 1]]).tolist()
    lasts = (ends[n - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype="int64")
    for k in range(0, runs, 65536):  # bits of so many runs at once
        some = [digest(whole[a:b], SEED) for a, b in zip(firsts[k : k + 65536], lasts[k : k + 65536], strict=True)]
        bits = np.unpackbits(np.array(some, dtype="<u8").view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype="int64")
    majority = np.packbits((2 * counts > runs).astype("uint8"), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            bits = np.array([fingerprint(t.as_py(), n) for t in batch.column(1)], dtype="uint64").view("int64")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "fp"])

    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(made, "doc_id long, fp long")


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment, widths as even as they can be."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def segment(values: np.ndarray, first: int, width: int) -> np.ndarray:
    return (values >> np.uint64(first)) & np.uint64((1 << width) - 1)


def best_cut(values: np.ndarray, radius: int, tries: int = 12) -> tuple[int, int] | None:
    """(vantage point, cut) that leaves the fewest comparisons on both sides, or None
    when every cut leaves nearly all of them. The vantage points tried are spread
    evenly over the sorted values, so equal input gives equal trees."""
    spread = np.unique(values)
    if len(spread) < 2:
        return None
    best, least = None, 0.97 * float(len(values)) ** 2
    for v in spread[np.linspace(0, len(spread) - 1, min(tries, len(spread))).astype("int64")]:
        at = np.bincount(np.bitwise_count(values ^ v), minlength=66)
        inner = np.cumsum(at)
        for m in np.flatnonzero(at)[:-1]:
            copies = inner[m] - (inner[m - radius] if m >= radius else 0)
            work = float(inner[m]) ** 2 + float(len(values) - inner[m] + copies) ** 2
            if work < least:
                best, least = (int(v), int(m)), work
    return best


def parted(values: np.ndarray, vantage: int, cut: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which values go in and which go out; values near the cut go both ways."""
    away = np.bitwise_count(values ^ np.uint64(vantage)).astype("int64")
    return away <= cut, away > cut - radius


class Tree:
    """A vantage-point tree over one segment; ``nodes`` holds (vantage, cut, inner,
    outer) or None for a leaf, and leaves are numbered in order."""

    def __init__(self, sample: np.ndarray, radius: int, leaf: int):
        self.radius = radius
        self.nodes: list[tuple[int, int, int, int] | None] = []
        self.leaf_of: dict[int, int] = {}
        todo = [(sample, -1, 0)]
        links: dict[tuple[int, int], int] = {}
        cuts: list[tuple[int, int] | None] = []
        while todo:
            values, parent, side = todo.pop()
            here = len(cuts)
            links[(parent, side)] = here
            cut = best_cut(values, radius) if len(values) > leaf else None
            cuts.append(cut)
            if cut:
                inner, outer = parted(values, *cut, radius)
                todo += [(values[outer], here, 1), (values[inner], here, 0)]
        for here, cut in enumerate(cuts):
            self.nodes.append((*cut, links[(here, 0)], links[(here, 1)]) if cut else None)
            if not cut:
                self.leaf_of[here] = len(self.leaf_of)

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of a value, leaf) for every leaf that a value visits."""
        at, leaves = [], []
        todo = [(0, np.arange(len(values)))]
        while todo:
            node, index = todo.pop()
            if not len(index):
                continue
            here = self.nodes[node]
            if here is None:
                at.append(index)
                leaves.append(np.full(len(index), self.leaf_of[node], dtype="int32"))
                continue
            vantage, cut, inner, outer = here
            goes_in, goes_out = parted(values[index], vantage, cut, self.radius)
            todo += [(inner, index[goes_in]), (outer, index[goes_out])]
        if not at:
            return np.empty(0, dtype="int64"), np.empty(0, dtype="int32")
        return np.concatenate(at), np.concatenate(leaves)


def forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``distance``, as few as connect it. A value
    that was reached is compared with those not reached yet only, so a dense group
    collapses in a few steps."""
    links: list[tuple[int, int]] = []
    if len(values) <= PIECE:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
        values = values[near.sum(1) > 1]
    left = values
    while len(left) > 1:
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            some, reached = reached[:64], reached[64:]
            near = np.bitwise_count(some[:, None] ^ left[None, :]) <= distance
            hit = near.any(0)
            if hit.any():
                links += zip(some[near[:, hit].argmax(0)].tolist(), left[hit].tolist(), strict=True)
                reached = np.concatenate([reached, left[hit]])
                left = left[~hit]
    return links


def shard_links(values: np.ndarray, first: int, width: int, radius: int, distance: int) -> list[tuple[int, int]]:
    """Links inside a shard: the tree goes on until pieces are small or no cut helps."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    kept = []
    todo = [np.unique(values)]
    while todo:
        part = todo.pop()
        cut = None
        if len(part) > PIECE:
            own = segment(part, first, width)
            # the cut is chosen on some values, all are parted
            cut = best_cut(own[:: max(1, len(own) // 4096)], radius, tries=4)
        if cut:
            inner, outer = parted(own, *cut, radius)
            if inner.all() or outer.all():  # the values looked at were unlike the rest
                cut = None
            else:
                todo += [part[inner], part[outer]]
        if not cut:
            for a, b in forest(part, distance):
                a_top, b_top = top(a), top(b)
                if a_top != b_top:
                    root[max(a_top, b_top)] = min(a_top, b_top)
                    kept.append((a, b))
    return kept


def links(distinct: DataFrame, distance: int, segments: int, shard_rows: int, shard_most: int, sample: int) -> DataFrame:
    """(a, b): links that connect all fingerprints (column fp, distinct) within ``distance``."""
    radius = distance // segments
    total = distinct.count()
    bounds = segment_bounds(segments)
    share = min(1.0, sample / max(1, total))
    some = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(sample)
    shape = np.sort(np.array([r[0] for r in some.collect()], dtype="int64").view("uint64"))  # ``sample`` rows at most
    leaf = max(16, int(shard_rows * max(1, len(shape)) / max(1, total)))
    trees = [Tree(segment(shape, *b), radius, leaf) for b in bounds]
    trees = distinct.sparkSession.sparkContext.broadcast(trees)  # as large as the sample allows

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            values = batch.column(0).to_numpy(zero_copy_only=False).view("uint64")
            for k, (tree, b) in enumerate(zip(trees.value, bounds, strict=True)):
                at, leaves = tree.route(segment(values, *b))
                arrays = [pa.array(np.full(len(at), k, dtype="int32")), pa.array(leaves), pa.array(values[at].view("int64"))]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "leaf", "fp"])

    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = shard_links(part["fp"].to_numpy().view("uint64"), *bounds[key[0]], radius, distance)
        ends = np.array(found, dtype="uint64").reshape(-1, 2).view("int64")
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    placed = tables.stored(distinct.mapInArrow(routed, "tree int, leaf int, fp long"), "routed")
    sizes = placed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / F.lit(shard_most)).cast("int").alias("blocks"))
    large = sizes.where("blocks > 1")  # a row per shard, fixed by the trees
    placed = placed.join(F.broadcast(large), ["tree", "leaf"], "left")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    units = placed.select("tree", "leaf", "fp", F.explode(meets).alias("u")).select("tree", "leaf", F.col("u.i").alias("i"), F.col("u.j").alias("j"), "fp")
    return units.groupBy("tree", "leaf", "i", "j").applyInPandas(search, "a long, b long")


def simhash_components(
    docs: DataFrame,
    n: int = 4,
    distance: int = 4,
    segments: int = 3,
    shard_rows: int = 4096,
    shard_most: int = 65_536,
    sample: int = 65_536,
) -> DataFrame:
    """doc_id, fp (long), fingerprint (16 hexadecimal digits), component_id for every row."""
    if not 0 <= distance < 64 or not 1 <= segments <= 16:
        raise ValueError("distance must be 0 to 63 and segments 1 to 16")
    tables.ship(docs.sparkSession)
    rows = tables.stored(fingerprints(docs, n), "fingerprints")
    least = tables.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = tables.stored(links(least.select("fp"), distance, segments, shard_rows, shard_most, sample).distinct(), "links")
    roots = tables.stored(components(found), "roots").withColumnRenamed("node", "fp")
    named = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the last join meets plain exchanges and Spark can split a hot fingerprint's rows
    ids = tables.stored(named.select("fp", "root").join(ids, "root").select("fp", "component_id"), "component-ids")
    return rows.join(ids, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""A stored layout: rows laid out in blocks once, reopened, and appended to.

``plan_blocks`` lays its input out for one session. Here the layout stays in a folder:

* ``store_layout`` writes the blocks as generation 0, with a table of bounds: for
  every (key, block) its rows and its first and last order values.
* ``open_layout`` gives a :class:`StoredPlan` for any operator, in any session,
  without a job over rows: nothing is sampled, sorted or written again.
* ``append_layout`` lays out new rows only. Each key's new rows must come after
  its stored ones (checked against the bounds); they become blocks with higher
  numbers, so every series goes on where it ended. A manifest names the generations
  and appears whole, last, so a reader sees the layout before an append or after it, and
  a run that dies leaves nothing that is ever read.
* what operators need of each block (totals, last values, moments, states of the
  exponential mean) is kept per generation beside the rows. ``newest()`` limits
  the rows to the last generation: an operator then reads only those and goes on
  from the kept states of all earlier ones (sliding windows need earlier rows and refuse).
* ``compact_layout`` lays everything out anew as one generation in a new folder,
  when many small appends have cut the series into many pieces.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetrank.operators.scan import BLOCK, INDEX, KEY, BlockPlan, Series, block_sizes, finish, lay_out, read_laid
from assetrank.sources import files

MANIFEST = "manifest"


@dataclass(frozen=True)
class StoredPlan(BlockPlan):
    """A layout in a folder; ``source`` is its rows as a table."""

    spark: SparkSession
    path: str
    generations: tuple[dict, ...]
    columns: StructType  # of the table
    laid: StructType  # of the rows as laid out
    recent: bool = False  # rows are the last generation's only

    def whole(self) -> bool:
        return not self.recent

    def summary(self, name: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Kept tables per generation; a missing one is made from its generation's rows."""
        place = f"states-{sha256(name.encode()).hexdigest()[:16]}"
        paths, schema = [], None
        for g in self.generations:
            at = f"{self.path}/{g['name']}/{place}"
            table = of(read_laid(self.spark, self.laid, f"{self.path}/{g['name']}/rows"))
            schema = table.schema
            if files.changed(self.spark, f"{at}/_SUCCESS") is None:
                table.write.mode("overwrite").parquet(at)
            paths.append(at)
        return read_laid(self.spark, schema, *paths)

    def newest(self) -> "StoredPlan":
        """The plan whose rows (and ``source``) are the last generation's only."""
        rows = read_laid(self.spark, self.laid, f"{self.path}/{self.generations[-1]['name']}/rows")
        return StoredPlan(_table(rows, self.columns, self.series), self.series, rows, self.sizes, self.spark, self.path, self.generations, self.columns, self.laid, True)


def _table(rows: DataFrame, columns: StructType, s: Series) -> DataFrame:
    shape = rows.sparkSession.createDataFrame([], columns)
    return finish(rows, shape, s)


def store_layout(df: DataFrame, s: Series, path: str, block_rows: int | None = None) -> StoredPlan:
    """Lay ``df`` out into the new folder ``path`` (on storage that all executors share)."""
    path = path.rstrip("/")
    if _manifests(df.sparkSession, path):
        raise ValueError(f"{path} holds a layout already")
    return _add(df, s, path, [], block_rows)


def _add(df: DataFrame, s: Series, path: str, generations: list[dict], block_rows: int | None) -> StoredPlan:
    spark = df.sparkSession
    first = generations[-1]["end"] if generations else 0
    laid = lay_out(df, s, block_rows, first)
    # a folder of its own per attempt: one that died is never read
    name = f"generation-{len(generations)}-{uuid.uuid4().hex[:12]}"
    laid.write.parquet(f"{path}/{name}/rows")
    rows = read_laid(spark, laid.schema, f"{path}/{name}/rows")
    along = F.struct(*s.order)
    bounds = block_sizes(rows, F.min_by(along, INDEX).alias("_from"), F.max_by(along, INDEX).alias("_to"))
    bounds.write.parquet(f"{path}/{name}/bounds")
    top = read_laid(spark, bounds.schema, f"{path}/{name}/bounds").agg(F.max(BLOCK)).first()[0]
    added = {"name": name, "end": first if top is None else top + 1}
    manifest = {
        "key": s.key, "order": s.order, "generations": [*generations, added],
        "columns": df.schema.jsonValue(), "laid": laid.schema.jsonValue(), "bounds": bounds.schema.jsonValue(),
    }
    if not files.write_text(spark, f"{path}/{MANIFEST}-{len(generations):08d}", json.dumps(manifest)):
        raise RuntimeError(f"another append to {path} was first; nothing of this one is read")
    return open_layout(spark, path)


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.names(spark, path) if n.startswith(MANIFEST) and not n.endswith(".tmp")]


def open_layout(spark: SparkSession, path: str) -> StoredPlan:
    """The layout in ``path``: reads the manifest, runs no job over rows."""
    path = path.rstrip("/")
    found = _manifests(spark, path)
    if not found:
        raise ValueError(f"{path} holds no layout")
    m = json.loads(files.read_text(spark, f"{path}/{found[-1]}"))
    s = Series(tuple(m["key"]), tuple(m["order"]))
    columns, laid, bounds = (StructType.fromJson(m[c]) for c in ("columns", "laid", "bounds"))
    rows = read_laid(spark, laid, *(f"{path}/{g['name']}/rows" for g in m["generations"]))
    sizes = read_laid(spark, bounds, *(f"{path}/{g['name']}/bounds" for g in m["generations"])).drop("_from", "_to")
    return StoredPlan(_table(rows, columns, s), s, rows, sizes, spark, path, tuple(m["generations"]), columns, laid)


def bounds_of(plan: StoredPlan) -> DataFrame:
    """Per (key, block): _n rows, _lo, and the order values _from and _to of its first and last row."""
    paths = [f"{plan.path}/{g['name']}/bounds" for g in plan.generations]
    return plan.spark.read.parquet(*paths)


def append_layout(plan: StoredPlan, new: DataFrame, block_rows: int | None = None) -> StoredPlan:
    """``plan``'s layout with ``new`` rows (the same columns) as a further generation.

    Only the new rows are laid out. A row that comes before its key's last stored
    one can't be appended: ValueError tells how many keys have such rows.
    """
    plan = open_layout(plan.spark, plan.path)
    new = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in plan.columns))
    s = plan.series
    along = F.struct(*s.order)
    ends = bounds_of(plan).groupBy(KEY).agg(F.max_by("_to", BLOCK).alias("_to"))
    starts = new.groupBy(F.struct(*s.key).alias(KEY)).agg(F.min(along).alias("_new"))
    same = [starts[KEY][k].eqNullSafe(ends[KEY][k]) for k in s.key]
    late = starts.join(ends, same).where("_new < _to").count()
    if late:
        raise ValueError(f"{late} keys have rows before their last stored one: rebuild the layout with store_layout")
    return _add(new, s, plan.path, list(plan.generations), block_rows)


def compact_layout(plan: StoredPlan, path: str, block_rows: int | None = None) -> StoredPlan:
    """All generations laid out anew as one, in the new folder ``path``."""
    return store_layout(plan.source, plan.series, path, block_rows)


__all__ = ["StoredPlan", "append_layout", "bounds_of", "compact_layout", "open_layout", "store_layout"]

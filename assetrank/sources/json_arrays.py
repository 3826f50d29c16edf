"""Large JSON files that hold one array (or one document after the other), read by many tasks.

Spark reads a ``multiLine`` file in one task. Here the file is read as lines, which
Spark splits by bytes, and cut into records:

1. JSON strings hold no line breaks, so a line alone tells its brackets from its text:
   strings are taken out and the rest gives the line's change of depth.
2. A running sum over the file's lines (the blocked scan of ``operators/scan.py``, so no file
   is in one task) gives the depth at which a line begins.
3. A line is cut where an object ends at the records' depth (1 in an array, else 0); a
   second running sum over the ends numbers the records along the file.
4. Lines of a record meet by (file, number) and are parsed with the explicit schema.

Defined cases: objects are records, other elements of the array are skipped; brackets, quotes
and escapes inside strings are text; a record may span any number of lines and a line any
number of records; blank lines and an empty array give nothing; a record that doesn't parse has null
fields. A file without any line break is one line, hence one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetrank.config import shared_dir
from assetrank.operators.scan import Series
from assetrank.operators.series import cum_sum

# possessive: no backtracking, so strings of any length
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: Up to and with the next bracket outside strings.
_TOKEN = rf"(?:{_STRING}|[^\"\[\]{{}}])*+[\[\]{{}}]|(?:{_STRING}|[^\"\[\]{{}}])++"
#: Marks a record's first brace; JSON holds no such character as it is.
BEGIN = "\x01"
_LINES = Series(("file",), ("start", "at"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_json_arrays(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records of the JSON files under ``path``, with ``schema``. Runs jobs: the
    lines are laid out in order, twice, and written to the shared folder."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    # a split is read in order by one task, so ids grow along it
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    brackets = F.regexp_replace(F.regexp_replace("value", _STRING, ""), r"[^\[\]{}]", "")
    opened = F.length(F.regexp_replace("b", r"[\]}]", ""))
    lines = lines.withColumn("b", brackets).withColumn("change", (2 * opened - F.length("b")).cast("long"))
    lines = _stored(lines.where("trim(value) <> ''"), "json-lines")

    first = lines.where("b <> ''").groupBy("file").agg(F.min_by("b", F.struct("start", "at")).alias("first"))
    level = first.select("file", F.when(F.col("first").startswith("["), 1).otherwise(0).alias("level"))
    deep = cum_sum(lines, _LINES, "change", out="depth").join(level, "file")
    deep = deep.withColumn("tokens", F.regexp_extract_all("value", F.lit(_TOKEN), F.lit(0)))

    def step(state, token):
        """Depth, ends so far, and the pieces (text, ends before it) of a line, token by token."""
        last = F.right(token, F.lit(1))
        depth = state["depth"] + F.when(last.isin("[", "{"), 1).when(last.isin("]", "}"), -1).otherwise(0)
        ends = state["ends"] + F.when((last == "}") & (depth == F.col("level")), 1).otherwise(0)
        begins = (last == "{") & (state["depth"] == F.col("level"))
        more = F.array(F.struct(F.when(begins, F.lit(BEGIN + "{")).otherwise(token).alias("text"), state["ends"].alias("nth")))
        return F.struct(depth.cast("long").alias("depth"), ends.cast("int").alias("ends"), F.concat(state["pieces"], more).alias("pieces"))

    begin = F.struct(
        (F.col("depth") - F.col("change")).cast("long").alias("depth"), F.lit(0).alias("ends"), F.array().cast("array<struct<text: string, nth: int>>").alias("pieces")
    )
    cut = deep.withColumn("c", F.aggregate("tokens", begin, step)).select("file", "start", "at", F.col("c.ends").cast("long").alias("ends"), "c.pieces")
    cut = _stored(cut, "json-pieces")
    placed = cum_sum(cut, _LINES, "ends", out="upto").select("file", "start", "at", (F.col("upto") - F.col("ends")).alias("before"), F.posexplode("pieces").alias("k", "p"))
    parts = placed.groupBy("file", (F.col("before") + F.col("p.nth")).alias("record")).agg(F.array_sort(F.collect_list(F.struct("start", "at", "k", "p.text"))).alias("parts"))
    # what stands before a record's brace is the array's bracket, a comma or elements that are no objects
    records = parts.select(F.array_join(F.transform("parts", lambda x: x["text"]), " ").alias("value")).where(F.col("value").contains(BEGIN))
    records = records.select(F.substring_index("value", BEGIN, -1).alias("value"))
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")

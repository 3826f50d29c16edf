"""Fixtures shared by the tests of the corpus operators."""

import random

#: Names that operators use inside; inputs may have them too.
CLASHING = ["key", "set", "size", "head", "root", "h1", "h2", "m", "p", "new", "gram", "pick", "score", "length", "piece", "cell", "shard", "n", "kind", "canon"]


def with_clashes(df):
    """The table with columns of names that operators use inside."""
    from pyspark.sql import functions as F

    for k, name in enumerate(c for c in CLASHING if c not in df.columns):
        df = df.withColumn(name, F.lit(f"x{k}") if k % 2 else F.lit(k))
    return df


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def edge_rows():
    """Null id, null and empty text, blanks, repeats, a very long text."""
    long_text = " ".join(f"word{k % 977} of" for k in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id at all"), (None, None), (5, long_text), (6, "ünï cödé \U0001f600 text"), (7, "a\x00b\x1cc")]


def sentences(seed, count, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    return [" ".join(rng.choice(vocabulary) for _ in range(words)) for _ in range(count)]

"""Small files on any Hadoop file system: whole text files that appear at once."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def changed(spark: SparkSession, path: str) -> int | None:
    """Time of the last change of ``path``; None if it is not there."""
    at, system = _at(spark, path)
    return system.getFileStatus(at).getModificationTime() if system.exists(at) else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    at, system = _at(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []


def move(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Rename a file or folder; False when ``target`` is there (unless replaced) or the rename fails."""
    at, system = _at(spark, source)
    to, _ = _at(spark, target)
    if system.exists(to):
        if not replace:
            return False
        system.delete(to, True)
    system.mkdirs(to.getParent())
    return system.rename(at, to)


def remove(spark: SparkSession, path: str) -> None:
    at, system = _at(spark, path)
    system.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file beside ``path`` and rename it, so that it is there whole or
    not at all; False when ``path`` is there already."""
    aside, system = _at(spark, f"{path}.tmp")
    out = system.create(aside, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return move(spark, f"{path}.tmp", path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return spark.read.text(path, wholetext=True).first()["value"]

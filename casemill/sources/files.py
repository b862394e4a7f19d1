"""Small files in the folders that Spark's own file systems reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = hadoop(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, at = hadoop(spark, folder)
    return sorted(e.getPath().getName() for e in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = hadoop(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file under another name and rename it, so that a reader
    sees all of it or none."""
    fs, part = hadoop(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not fs.rename(part, hadoop(spark, path)[1]):
        raise FileExistsError(path)

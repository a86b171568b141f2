"""Small files beside a table, through the file system that Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that is not there yet; False if it is. One of several that try succeeds."""
    system, where = _system(spark, path)
    try:
        stream = system.create(where, False)
    except Py4JJavaError:
        if system.exists(where):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file in the place of another in one step, so that a reader sees either."""
    context = spark.sparkContext
    jvm, fresh = context._jvm, f"{path}.new"
    system, source = _system(spark, fresh)
    stream = system.create(source, True)
    stream.write(text.encode())
    stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), context._jsc.hadoopConfiguration()
    )
    files.rename(source, jvm.org.apache.hadoop.fs.Path(path), options)


def remove(spark: SparkSession, path: str) -> None:
    """Take away a file or a folder; nothing happens if there is none."""
    system, where = _system(spark, path)
    system.delete(where, True)

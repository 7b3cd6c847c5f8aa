"""Small files and folder names in the shared folder, through the file system that Spark uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _fs(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    fs, where, _ = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where, _ = _fs(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where, jvm = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Whole or not at all: written under another name, then renamed; an old file of the name goes."""
    fs, where, jvm = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(text.encode())
    stream.close()
    fs.delete(where, False)
    if not fs.rename(draft, where):
        raise RuntimeError(f"could not write {path}")

"""Listing of paths on any Hadoop file system; only names reach the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    matched = fs.globStatus(jpath)
    return matched is not None and len(matched) > 0


def folders(spark: SparkSession, path: str) -> list[str]:
    jpath, fs = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not there: written beside its place and renamed."""
    jpath, fs = _path(spark, path)
    beside, _ = _path(spark, f"{path}.new")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(jpath, False)
    if not fs.rename(beside, jpath):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, hidden ones too."""
    jpath, fs = _path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder to its final place, in which nothing may be."""
    jsource, fs = _path(spark, source)
    jtarget, _ = _path(spark, target)
    fs.mkdirs(jtarget.getParent())
    if fs.exists(jtarget) or not fs.rename(jsource, jtarget):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    fs.delete(jpath, True)

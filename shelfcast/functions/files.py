"""Paths of stored tables, through the file system the session is configured for."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath) and fs.delete(jpath, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def states(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, size, time of change) of files, in order; each folder is listed once."""
    wanted, found = set(paths), []
    for folder in sorted({p.rsplit("/", 1)[0] for p in paths}):
        fs, jpath = _fs(spark, folder)
        for s in fs.listStatus(jpath):
            path = f"{folder}/{s.getPath().getName()}"
            if path in wanted:
                found.append((path, s.getLen(), s.getModificationTime()))
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if another writer was first."""
    fs, jpath = _fs(spark, path)
    try:
        stream = fs.create(jpath, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    try:
        stream.writeUTF(text)
    finally:
        stream.close()
    return True


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, making the folders above the target; an error if it does not happen."""
    fs, jpath = _fs(spark, target)
    fs.mkdirs(jpath.getParent())
    if not fs.rename(_fs(spark, source)[1], jpath):
        raise OSError(f"could not move {source} to {target}")

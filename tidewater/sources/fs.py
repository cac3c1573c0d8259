"""File-system helpers (metadata and markers only), on the file systems Spark itself uses.

Every path goes through the session's Hadoop configuration, so a path without a
scheme, ``s3a://`` or ``viewfs://`` means here what it means to a reader or
writer.  No table data moves through this module.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def qualify(spark: SparkSession, uri: str) -> str:
    """The path with the scheme and authority that Spark gives it."""
    fs, path = _open(spark, uri)
    return fs.makeQualified(path).toString()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _open(spark, uri)
    return fs.exists(path)


def _hidden(name: str) -> bool:
    # as Spark's listing: markers and temporary folders, but not partition folders
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def data_files(spark: SparkSession, uri: str, first: bool = False) -> list[str]:
    """Data files below a folder (none if it is absent); ``first``: at most one."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return []
    found, todo = [], [path]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if _hidden(status.getPath().getName()):
                continue
            if status.isDirectory():
                todo.append(status.getPath())
            elif status.getLen() >= 0:
                found.append(status.getPath().toString())
                if first:
                    return found
    return found


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write one small object (a marker)."""
    fs, path = _open(spark, uri)
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def put_if_absent(spark: SparkSession, uri: str, text: str) -> bool:
    """Put one small object in place whole, by a rename; False if there is one already."""
    fs, path = _open(spark, uri)
    if fs.exists(path):
        return False
    parent = path.getParent()
    fs.mkdirs(parent)
    aside = f"{parent.toString()}/.{path.getName()}-{uuid.uuid4().hex}"
    write_text(spark, aside, text)
    try:
        done = fs.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), path)
    except Py4JJavaError:  # some file systems raise where others return false
        done = False
    if not done:
        delete(spark, aside)
        if not fs.exists(path):
            raise OSError(f"cannot rename to {uri}")
    return bool(done)


def names(spark: SparkSession, uri: str) -> list[str]:
    """Names in a folder, without those a reader ignores (none if it is absent)."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if not _hidden(n))


def folders(spark: SparkSession, uri: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, path = _open(spark, uri)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and not _hidden(s.getPath().getName()))


def literal(path: str) -> str:
    """The path for a reader that takes patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def size(spark: SparkSession, uri: str) -> int:
    """Bytes of the files below a folder or of a file (0 if it is absent)."""
    fs, path = _open(spark, uri)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def read_text(spark: SparkSession, uri: str) -> str:
    fs, path = _open(spark, uri)
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, uri: str) -> None:
    """Remove a table's own folder (a staged copy, an emptied partition)."""
    fs, path = _open(spark, uri)
    fs.delete(path, True)


def stamp(spark: SparkSession, uri: str) -> str:
    """Path, sizes and modification times of a file or of the files below a folder."""
    fs, path = _open(spark, uri)
    files = data_files(spark, uri) if fs.getFileStatus(path).isDirectory() else [uri]
    found = [fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)) for f in sorted(files)]
    return fs.makeQualified(path).toString() + ";".join(f"{s.getLen()},{s.getModificationTime()}" for s in found)

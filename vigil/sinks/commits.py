"""Commits in a shared folder: small markers that exactly one writer can create.

A marker appears with its whole content or not at all, and never replaces another one, so its name is
a compare-and-set: of two writers that publish the same name one succeeds and the other is told so.
Data files are written before, into a folder of their own that no reader knows until the marker names it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path): works in any store that Spark reads."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - the portable way to list and create files
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def publish(spark: SparkSession, path: str, content: dict) -> bool:
    """Create the marker `path`; False if there is one already."""
    fs, p = file_system(spark, path)
    if fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    try:
        if fs.getScheme() == "file":  # renaming replaces files there; a hard link never does
            local = [jvm.java.io.File(x.toUri().getPath()).toPath() for x in (p, draft)]
            try:
                jvm.java.nio.file.Files.createLink(*local)
            except Exception as e:
                if "FileAlreadyExists" not in str(e):
                    raise
                return False
            return True
        return bool(fs.rename(draft, p))
    finally:
        fs.delete(draft, False)
        if fs.getScheme() == "file":
            crc = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{draft.getName()}.crc")
            fs.delete(crc, False)


def read(spark: SparkSession, path: str) -> dict:
    """The content of a marker."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))  # noqa: SLF001
    finally:
        stream.close()

"""Versions of a table: small files that say which folders make it up.

Version n of a table is the file ``_versions/<n>.json`` in its folder. It is written under
another name and then renamed to its own only if that is free, so it is there whole
or not at all, and of two writers that started from one version the second fails. Readers
take the highest number; the folders it names are never changed. So a table changes
in one step, and a job that dies before that step leaves it as it was.

The rename is exclusive on HDFS. Local folders check for the name and then rename, object stores
copy: there one writer at a time must be ensured from outside.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"  # readers of the table's folder skip names with an underscore


class CommitConflictError(RuntimeError):
    pass


def _path(spark: SparkSession, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(name)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{FOLDER}/{number:012d}.json"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``; none if it does not exist."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    found = (re.fullmatch(r"([0-9]{12})\.json", n) for n in names_in(spark, f"{path.rstrip('/')}/{FOLDER}"))
    return [int(m[1]) for m in found if m]


def read_version(spark: SparkSession, path: str, number: int) -> dict:
    p, fs = _path(spark, _file(path, number))
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make ``content`` version ``number``, or fail if there is such a version already."""
    own, fs = _path(spark, f"{path.rstrip('/')}/{FOLDER}/_{uuid.uuid4().hex}")
    out = fs.create(own, False)
    out.write(json.dumps(content).encode())
    out.close()
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # never over a file that is there
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(fs.makeQualified(own), fs.makeQualified(_path(spark, _file(path, number))[0]), options)
    except Py4JJavaError as e:
        fs.delete(own, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise CommitConflictError(f"{path}: version {number} was written by another job meanwhile") from None
        raise


def forget(spark: SparkSession, path: str, number: int) -> None:
    """Delete the file of a version; the folders it names stay."""
    p, fs = _path(spark, _file(path, number))
    fs.delete(p, False)

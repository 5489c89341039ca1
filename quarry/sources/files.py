"""File sources: CSV with a header, JSON documents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False, extra: bool = False, **options) -> DataFrame:
    """CSV with a header row.

    With a ``schema``, its columns are found by their header names, in any order, and cast
    (text that is no value of the type becomes NULL); a column that the file lacks is an
    error. Files whose headers differ from the first one's are refused by the reader.
    ``extra=True`` keeps the file's other columns, as text, after those of the schema.
    Without a schema all columns are text, or inferred (an extra pass over the input).
    Without a header, columns are taken by position.
    """
    r = spark.read.options(header=header, enforceSchema=False, **options)
    if schema is None:
        return r.option("inferSchema", infer).csv(path)
    if not header:
        return r.schema(schema).csv(path)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = r.csv(path)
    missing = [f.name for f in wanted if f.name not in text.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing} in the header {text.columns}")
    names = set(wanted.names)
    more = [text[_quoted(c)] for c in text.columns if extra and c not in names]
    return text.select(*[text[_quoted(f.name)].try_cast(f.dataType).alias(f.name) for f in wanted], *more)


FILE = ["path", "modificationTime", "length"]


def list_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Path, time and length of the files under ``path``, which are not opened; ``options`` as of a file reader."""
    return spark.read.format("binaryFile").options(**options).load(path).select(*FILE)


def file_name(path: str) -> str:
    """A file's path as readers take it, who read patterns: with its signs escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_documents(spark: SparkSession, path=None, schema: StructType | str | None = None,
                   format: str = "json", **options) -> DataFrame:
    """Documents of a collection.

    ``format="json"`` reads exported documents (one per line). For a live
    document store pass its connector's format name (for MongoDB the 10.x
    connector registers ``"mongodb"``; it must be on the classpath) and its
    options (``connection.uri``, ``database``, ``collection``). A schema skips
    the sampling pass that inference would need.
    """
    r = spark.read.format(format)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path is not None else r.load()

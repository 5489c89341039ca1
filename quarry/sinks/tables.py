"""Catalog tables: every write is a new version folder, then the table is repointed.

A catalog table here is an external Parquet table, optionally bucketed by its
key. Writes never touch the folder readers currently use:

* :func:`create_table` writes the first version and registers it;
* :func:`overwrite_table` writes a new version next to the current one and
  repoints the table (``ALTER TABLE ... SET LOCATION`` + ``REFRESH TABLE``);
* :func:`update_table` computes and stages the change set against the current
  version, writes the merged rows as a new version and repoints. With no
  change, nothing is written and the table keeps its location.

Bucketing (``buckets=B``): every version is written hash-partitioned by the
key into B buckets, one sorted file per bucket. Later change-set joins and
anti-joins against the table then shuffle only the incoming side; the table
side is read bucket by bucket without an exchange, for the key check as well. Keys are
unique (checked before every update), so no bucket can hold a hot key. New versions keep
the table's bucket spec.

Old versions stay on storage for readers still planning against them;
removing them is a retention decision left to the operator.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.staging import remove
from quarry.sinks.files import EmptyResultError, write_overwrite, write_parquet, write_update
from quarry.specs import JobResult


def _ident(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _describe(spark: SparkSession, name: str) -> dict:
    return {r["col_name"]: r["data_type"]
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name)}").collect()}


def table_location(spark: SparkSession, name: str) -> str:
    """Current storage location of a catalog table (from DESCRIBE, a few rows)."""
    loc = _describe(spark, name).get("Location")
    if not loc:
        raise ValueError(f"table {name} has no location (not a file-based table)")
    return loc


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a table, or None."""
    d = _describe(spark, name)
    if "Num Buckets" not in d:
        return None
    cols = [c.strip().strip("`") for c in d["Bucket Columns"].strip("[]").split(",")]
    return int(d["Num Buckets"]), cols


def next_version(location: str, name: str) -> str:
    """A new sibling folder for the next version of ``name``."""
    parent = location.rstrip("/").rsplit("/", 1)[0]
    leaf = name.replace(".", "_")
    return f"{parent}/{leaf}__v{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"


def _bucketed_writer(spark: SparkSession, buckets: int, key: list[str]):
    """Write a bucketed version through a short-lived external table definition."""
    def write(df: DataFrame, path: str) -> None:
        tmp = f"quarry_version_{uuid.uuid4().hex[:12]}"
        (df.repartition(buckets, *key).write.format("parquet")
           .bucketBy(buckets, *key).sortBy(*key)
           .option("path", path).saveAsTable(tmp))
        spark.sql(f"DROP TABLE {_ident(tmp)}")  # external: the files stay
    return write


def _writer_for(spark: SparkSession, name: str):
    spec = bucket_spec(spark, name)
    return _bucketed_writer(spark, *spec) if spec else write_parquet


def _repoint(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {_ident(name)} SET LOCATION {_literal(path)}")
    spark.sql(f"REFRESH TABLE {_ident(name)}")


def create_table(df: DataFrame, name: str, path: str, buckets: int | None = None,
                 key=None, allow_empty: bool = True) -> JobResult:
    """Write ``df`` to ``path`` and register it as external Parquet table ``name``.

    With ``buckets``, the table is bucketed (and sorted) by ``key``.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} already exists")
    if buckets:
        key = [key] if isinstance(key, str) else list(key or [])
        if not key:
            raise ValueError("a bucketed table needs its key")
        (df.repartition(buckets, *key).write.format("parquet")
           .bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(name))
        n = spark.table(name).count()  # from the files' footers; an observation is lost on an empty plan
        if not n and not allow_empty:
            spark.sql(f"DROP TABLE {_ident(name)}")
            remove(spark, path)
            raise EmptyResultError(f"no rows to write to {name}; the table is not created")
        return JobResult(mode="overwrite", target=name, rows_written=n, wrote=True,
                         details={"location": path, "buckets": buckets})
    res = write_overwrite(df, path, allow_empty=allow_empty)
    spark.sql(f"CREATE TABLE {_ident(name)} USING parquet LOCATION {_literal(path)}")
    res.target = name
    return res


def overwrite_table(df: DataFrame, name: str, allow_empty: bool = True) -> JobResult:
    """Replace the rows of ``name`` with ``df`` (new version, then repoint)."""
    spark = df.sparkSession
    path = next_version(table_location(spark, name), name)
    _writer_for(spark, name)(df, path)
    n = spark.read.schema(df.schema).parquet(path).count()  # from the files' footers
    if not n and not allow_empty:
        remove(spark, path)
        raise EmptyResultError(f"no rows to write to {name}; the table stays as it is")
    res = JobResult(mode="overwrite", target=name, rows_written=n, wrote=True)
    _repoint(spark, name, path)
    res.target = name
    res.details["location"] = path
    return res


def update_table(source: DataFrame, name: str, key, columns, keep_missing: bool = True,
                 rule: str = "null_safe", check_keys: bool = True) -> JobResult:
    """Apply new and changed ``source`` rows to table ``name`` (new version, then repoint)."""
    spark = source.sparkSession
    current = spark.table(name)
    path = next_version(table_location(spark, name), name)
    buckets = bucket_spec(spark, name)  # they join without a shuffle
    res = write_update(source, current, key, columns, path, keep_missing=keep_missing,
                       rule=rule, check_keys=check_keys, writer=_writer_for(spark, name),
                       key_filter=False if buckets else None, one_pass=False if buckets else None)
    if res.wrote:
        _repoint(spark, name, path)
        res.details["location"] = path
    res.target = name
    return res

"""Which files of a Parquet table can hold a value, told without opening them.

An index has one row per file: smallest and largest value of a column, whether it has NULLs, and a bitmap of
2^15 places (4 KB) with one bit per hashed value. A file is passed over if the value lies
outside its range or its place is empty. Ranges tell files of sorted tables apart, bitmaps
those whose values are scattered, up to some ten thousand different ones a file; beyond that the
bitmap fills up and the range alone tells.

The index knows a file by path, time and length. Files it does not know (written after it was built, or
replaced) are always read and files that are gone are not listed, so an index that is
out of date costs time and never a row. :func:`refresh_index` reads the files that are new.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.staging import remove
from quarry.sources.files import FILE, file_name, list_files

_PLACES = 1 << 15  # of one bitmap, fixed by the function that builds it


class FileIndexError(ValueError):
    pass


def _files(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path, pathGlobFilter="*.parquet", recursiveFileLookup="true")


def _place(value):
    return F.pmod(F.xxhash64(value), F.lit(_PLACES))


def _summaries(spark: SparkSession, root: str, paths: list[str], column: str) -> DataFrame:
    named = F.col("`" + column.replace("`", "``") + "`")
    rows = spark.read.option("basePath", root).parquet(*[file_name(p) for p in paths]).select(
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_path").alias("path"), named.alias("v"))
    # One row a file: minima, maxima and bitmaps are merged on the map side. url_decode would turn a plus into a space.
    return (rows.groupBy("path", "modificationTime", "length")
            .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max(F.col("v").isNull()).alias("nulls"),
                 F.bitmap_construct_agg(F.when(F.col("v").isNotNull(), _place(F.col("v")))).alias("bits"))
            .withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))))


def refresh_index(spark: SparkSession, path: str, column: str, index: str) -> int:
    """Bring the index of ``column`` at ``index`` up to date with the table at ``path``; how many files were
    read for it. What it holds of files that are gone stays until the index is built anew."""
    listed = _files(spark, path)
    held = _read(spark, index)
    if held is not None:
        listed = listed.join(held.select(*FILE), FILE, "left_anti")
    new = [r["path"] for r in listed.collect()]  # names only
    if not new:
        return 0
    got = _summaries(spark, path, new, column).withColumn("column", F.lit(column))
    if held is not None:
        kept = held.select("column", "low").first()
        if kept is not None and (kept["column"] != column or held.schema["low"].dataType != got.schema["low"].dataType):
            raise FileIndexError(f"{index} is an index of {kept['column']} ({held.schema['low'].dataType.simpleString()})")
    folder = f"{index.rstrip('/')}/files-{uuid.uuid4().hex}"
    try:
        got.write.mode("errorifexists").parquet(folder)
    except Exception:
        remove(spark, folder)
        raise
    return len(new)


def _read(spark: SparkSession, index: str) -> DataFrame | None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(index)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path) or not len(fs.listStatus(jvm_path)):
        return None
    return spark.read.option("recursiveFileLookup", "true").parquet(index)


def files_with(spark: SparkSession, path: str, index: str, value) -> list[str]:
    """The table's files that can hold ``value``: by the index, or because it does not know them."""
    listed, held = _files(spark, path), _read(spark, index)
    if held is None:
        return sorted(r["path"] for r in listed.collect())
    dtype = held.schema["low"].dataType
    v = F.lit(value).cast(dtype)
    spot = _place(v)
    byte = F.conv(F.hex(F.substr("bits", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = (v >= F.col("low")) & (v <= F.col("high")) & (F.getbit(byte, F.pmod(spot, F.lit(8)).cast("int")) == 1)
    if value is None:
        may = F.col("nulls")
    marked = held.select(*FILE, F.coalesce(may, F.lit(False)).alias("__may"))
    found = listed.join(marked, FILE, "left").where(F.coalesce("__may", F.lit(True))).select("path").distinct()
    return sorted(r["path"] for r in found.collect())


def read_equal(spark: SparkSession, path: str, column: str, index: str, value) -> DataFrame:
    """The rows of the table whose ``column`` is ``value`` (NULL: those without one), from the files that can hold it."""
    whole = spark.read.parquet(path)
    named = F.col("`" + column.replace("`", "``") + "`")
    if value is not None and spark.range(1).select(F.lit(value).cast(whole.schema[column].dataType).eqNullSafe(F.lit(value))).first()[0] is not True:
        raise FileIndexError(f"{value!r} is no {whole.schema[column].dataType.simpleString()}")
    files = [file_name(f) for f in files_with(spark, path, index, value)]
    rows = spark.read.schema(whole.schema).option("basePath", path).parquet(*files) if files else whole.limit(0)
    return rows.where(named.eqNullSafe(F.lit(value).cast(whole.schema[column].dataType)))

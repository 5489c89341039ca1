"""One folder of CSV files whose headers differ: other column orders, other sets of columns.

The CSV reader takes the header of one file for all of them. Here the header line of each file
is read first, on the executors: one task a file, which stops after the first line that is not
blank, so a file of any length costs one buffer. Files of equal header lines are then scanned
together, each group with its own header, and their columns put together by name.

The driver holds the names of the files, as the reader's own file list does. A plan holds one
scan per different header line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.sources.files import file_name

_WHOLE = 1 << 40  # bytes of a split and cost of opening one, so that each file is a task of its own


class HeaderError(ValueError):
    pass


def header_lines(spark: SparkSession, path) -> dict[str, list[str]]:
    """Files under ``path`` by their first line that is not blank. Files without one are left out."""
    own = spark.newSession()  # its settings are not the caller's
    own.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE)
    own.conf.set("spark.sql.files.openCostInBytes", _WHOLE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)

    def first(batches: Iterable) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = (own.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
             .where(F.col("value").rlike(r"[^\x00-\x20]"))
             .mapInArrow(first, "value string, file string, start long").where("start = 0"))
    out: dict[str, list[str]] = {}
    for r in lines.select("value", "file").collect():
        out.setdefault(r["value"], []).append(unquote(r["file"]))
    return {line: sorted(files) for line, files in sorted(out.items())}


def read_csv_folder(spark: SparkSession, path, schema: StructType | str, optional: Iterable[str] = (), **options) -> DataFrame:
    """The columns of ``schema`` from every file under ``path``, found by name in each file's own
    header and cast (text that is no value of the type becomes NULL).

    A column that a file lacks is an error that names the file, unless ``optional`` lists it: then
    it is NULL there. Other columns are left out. A header is one line; ``options`` are the CSV reader's."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    spare = set(optional)
    out = None
    for files in header_lines(spark, path).values():
        text = spark.read.options(header=True, enforceSchema=False, **options).csv([file_name(f) for f in files])
        missing = [f.name for f in wanted if f.name not in text.columns and f.name not in spare]
        if missing:
            raise HeaderError(f"{files[0]} and {len(files) - 1} more files: no column {missing} in the header {text.columns}")
        got = text.select(*[(text["`" + f.name.replace("`", "``") + "`"].try_cast(f.dataType) if f.name in text.columns
                             else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])
        out = got if out is None else out.unionByName(got)
    return spark.createDataFrame([], StructType([*wanted])) if out is None else out

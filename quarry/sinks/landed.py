"""Payload files to a table, each once: the ledger of what was taken lies in the table's versions.

A run lists the folder (names, times and lengths; no content), takes away the files that
the table's ledger holds, reads the rest and applies their rows as one update. The ledger's new
entries and the rows take effect in one step, as the table's next version. A run that dies before
that step leaves both as they were and the next run takes the same files; after it,
nothing is taken twice. Of two runs at the same time one fails unharmed.

A file is known by its path, length and time: one that was replaced under its name is taken again.
Files must be whole once they are seen (written elsewhere, then renamed into the folder).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.staging import collected, remove
from quarry.sinks.partitions import LEDGER, layout, note_of, update_partitioned
from quarry.sources.files import FILE, file_name, list_files
from quarry.specs import InsertMode, JobResult

_ENTRY = "path string, modificationTime timestamp, length bigint, run bigint"
MAX_FOLDERS = 32  # of a ledger; beyond that its entries are written together


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """The files that ``table`` has taken, with the number of the run that took each."""
    return _entries(spark, table, note_of(spark, table)[1].get(LEDGER, []))


def _entries(spark: SparkSession, table: str, names: list[str]) -> DataFrame:
    folders = [f"{table.rstrip('/')}/{name}" for name in names]
    return spark.read.schema(_ENTRY).parquet(*folders) if folders else spark.createDataFrame([], _ENTRY)


def update_from_landed(spark: SparkSession, folder: str, table: str, rows_of: Callable[[list[str]], DataFrame],
                       columns: Iterable[str], **options) -> JobResult:
    """Take the files of ``folder`` that ``table`` (in hash partitions) has not taken yet.

    ``rows_of(paths)`` plans the rows of those files, at most one per key of the table: what it
    says of a key that several files of one run hold is its own matter. A later run's row
    replaces an earlier one's. ``options`` are a file reader's (``pathGlobFilter``, ``recursiveFileLookup``). ``details["files"]`` counts the files taken and ``details["run"]``
    numbers the run; without new files nothing is read or written. What ``rows_of`` stages is deleted at the end."""
    table = table.rstrip("/")
    key, _ = layout(spark, table)
    version, note = note_of(spark, table)
    run, folders = note.get("runs", 0) + 1, note.get(LEDGER, [])
    known = _entries(spark, table, folders)
    new = list_files(spark, folder, **options).join(known, FILE, "left_anti").withColumn("run", F.lit(run).cast("bigint"))
    name = f"{LEDGER}-{uuid.uuid4().hex}"
    whole = len(folders) >= MAX_FOLDERS
    committed = False
    try:
        (new.unionByName(known) if whole else new).write.mode("errorifexists").parquet(f"{table}/{name}")
        taken = spark.read.schema(_ENTRY).parquet(f"{table}/{name}").where(F.col("run") == run)
        paths = sorted(file_name(r["path"]) for r in taken.select("path").collect())  # names, as in a reader's file list
        if not paths:
            return JobResult(mode=InsertMode.UPDATE.value, target=table, rows_read=0, details={"files": 0, "run": run - 1})
        with collected() as staged:
            try:
                result = update_partitioned(rows_of(paths), table, key, list(columns), version_read=version,
                                            note={LEDGER: [name] if whole else [*folders, name], "runs": run})
                committed = True
            finally:
                for s in staged:
                    s.drop()
        result.details.update(files=len(paths), run=run)
        return result
    finally:
        if not committed:
            remove(spark, f"{table}/{name}")

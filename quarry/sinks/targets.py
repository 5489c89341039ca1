"""Where a job writes: a Parquet path, a catalog table or a JDBC table.

All take both modes. An overwrite creates a table that does not exist.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quarry.sinks import jdbc, tables
from quarry.sinks.files import assert_not_reading, write_overwrite, write_update
from quarry.sources.jdbc import read_table
from quarry.specs import InsertMode, JobResult, TableSpec


@dataclass(frozen=True)
class PathTarget:
    """A Parquet folder; an update writes the new table to ``out_path``."""

    path: str
    out_path: str | None = None

    def check(self, mode: InsertMode, source: DataFrame) -> None:
        if mode is InsertMode.UPDATE and not self.out_path:
            raise ValueError("update needs out_path: the target is never overwritten in place")
        assert_not_reading(source, self.path if mode is InsertMode.OVERWRITE else self.out_path)

    def overwrite(self, df: DataFrame, allow_empty: bool) -> JobResult:
        return write_overwrite(df, self.path, allow_empty=allow_empty)

    def update(self, df: DataFrame, spec: TableSpec, keep_missing: bool) -> JobResult:
        current = df.sparkSession.read.parquet(self.path)
        return write_update(df, current, spec.key, spec.columns, self.out_path, keep_missing=keep_missing)


@dataclass(frozen=True)
class TableTarget:
    """A catalog table; ``location`` (and ``buckets`` by the key) are used if it must be created."""

    name: str
    location: str | None = None
    buckets: int | None = None
    key: tuple[str, ...] = ()

    def check(self, mode: InsertMode, source: DataFrame) -> None:
        if not source.sparkSession.catalog.tableExists(self.name):
            if mode is InsertMode.UPDATE:
                raise ValueError(f"table {self.name} does not exist")
            if not self.location:
                raise ValueError(f"table {self.name} does not exist, and no location is given for it")

    def overwrite(self, df: DataFrame, allow_empty: bool) -> JobResult:
        if df.sparkSession.catalog.tableExists(self.name):
            return tables.overwrite_table(df, self.name, allow_empty)
        return tables.create_table(df, self.name, self.location, self.buckets, list(self.key), allow_empty)

    def update(self, df: DataFrame, spec: TableSpec, keep_missing: bool) -> JobResult:
        return tables.update_table(df, self.name, spec.key, spec.columns, keep_missing=keep_missing)


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    read_options: dict = field(default_factory=dict)  # partition_column, lower_bound, ...

    def check(self, mode: InsertMode, source: DataFrame) -> None:
        pass

    def overwrite(self, df: DataFrame, allow_empty: bool) -> JobResult:
        return jdbc.write_overwrite(df, self.url, self.table, self.properties, allow_empty=allow_empty)

    def update(self, df: DataFrame, spec: TableSpec, keep_missing: bool) -> JobResult:
        current = read_table(df.sparkSession, self.url, self.table, self.properties, **self.read_options)
        return jdbc.write_update(df, current, self.url, self.table, self.properties, spec.key, spec.columns,
                                 keep_missing=keep_missing)


def parse_target(text: str, out_path: str | None = None, location: str | None = None,
                 properties: dict | None = None) -> PathTarget | TableTarget | JdbcTarget:
    """``table:NAME``, ``jdbc:...#TABLE`` (URL, then the table) or else a path."""
    if text.startswith("table:"):
        return TableTarget(text[len("table:"):], location)
    if text.startswith("jdbc:"):
        url, mark, table = text.rpartition("#")
        if not mark or not url:
            raise ValueError("a JDBC target is URL#TABLE")
        return JdbcTarget(url, table, properties or {})
    return PathTarget(text, out_path)

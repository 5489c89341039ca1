"""Materialising small results and broadcasting them only after a size check."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from quarry.session import staging_path

# Largest side ever broadcast by these helpers: rows, and bytes of the rows in memory.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass
class Staged:
    df: DataFrame
    path: str
    written: int | None = None
    memory: int | None = None

    def rows(self) -> int:
        """Row count: observed while writing, else from the Parquet footers."""
        return self.written if self.written is not None else self.df.count()

    def drop(self) -> None:
        """Delete the staged files; only once nothing lazy still reads them."""
        remove(self.df.sparkSession, self.path)

    def bytes(self) -> int:
        """Bytes of the rows in memory: observed while writing, else measured in one pass."""
        if self.memory is None:
            self.memory = int(self.df.agg(_row_bytes(self.df).alias("b")).first()["b"] or 0)
        return self.memory


def _row_bytes(df: DataFrame):
    """Sum over all rows of their size as Spark keeps them: a header, eight bytes for a
    field, and the bytes of strings, binaries and (as JSON text) arrays and maps."""
    def size(column, dtype):
        if isinstance(dtype, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 8
        if isinstance(dtype, StructType):
            total = F.lit(16)
            for f in dtype:
                total = total + size(column[f.name], f.dataType)
            return total
        if isinstance(dtype, (ArrayType, MapType)):
            return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 16
        return F.lit(8)

    total = F.lit(16).cast("long")
    for f in df.schema:
        total = total + size(_name(f.name), f.dataType)
    return F.sum(total)


def _name(column: str):
    return F.col("`" + column.replace("`", "``") + "`")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (from file sizes and projections)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def planner_broadcasts(df: DataFrame) -> bool:
    """True when the planner would broadcast ``df`` as a join side on its own."""
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return 0 <= limit and estimated_bytes(df) <= limit


_COLLECTORS: list[list[Staged]] = []


@contextmanager
def collected():
    """A list of all that is staged inside the block, to be dropped by the caller once what
    reads it is written."""
    held: list[Staged] = []
    _COLLECTORS.append(held)
    try:
        yield held
    finally:
        _COLLECTORS.remove(held)


def remove(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str, path: str | None = None, partition_by: str | None = None) -> Staged:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written files, not
    from the whole upstream plan) and freezes the result, so every later
    reader of the same rows sees the same values.

    ``path``: a folder of the caller's instead, which is not among the :func:`collected`.
    ``partition_by``: a folder for each value of that column.
    """
    spark, own = df.sparkSession, path is None
    path = staging_path(spark, name) if own else path
    obs = Observation(f"stage-{name}-{uuid.uuid4().hex[:8]}")
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), _row_bytes(df).alias("bytes"))
    if partition_by is None:
        seen.write.mode("errorifexists").parquet(path)
        back = spark.read.parquet(path)
    else:
        seen.write.mode("errorifexists").partitionBy(partition_by).parquet(path)
        back = spark.read.schema(df.schema).parquet(path)  # there may be no file to take it from
    got = obs.get
    # An observation is lost on an empty plan.
    staged = Staged(back, path, int(got.get("rows") or 0), int(got.get("bytes") or 0))
    for held in _COLLECTORS if own else ():
        held.append(staged)
    return staged


def broadcast_if_small(staged: Staged, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The staged frame with a broadcast hint only if both size checks pass."""
    if staged.bytes() <= max_bytes and staged.rows() <= max_rows:
        return F.broadcast(staged.df)
    return staged.df


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES, name: str = "small",
               held: list | None = None) -> DataFrame:
    """Join ``big`` to a side expected to be small, with a checked broadcast.

    ``small`` is written to the shared folder first; its real size decides the
    strategy. Within the limits it is broadcast (``big`` is not shuffled);
    beyond them the join is a shuffle join, where AQE can still split skewed
    partitions of ``big``. The staged side is appended to ``held``, so that the caller can
    drop it once the result is written; the returned plan reads it until then.
    """
    staged = stage(small, name)
    if held is not None:
        held.append(staged)
    side = broadcast_if_small(staged, max_rows, max_bytes)
    return big.join(side, on=on, how=how)

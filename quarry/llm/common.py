"""Helpers shared by the training-data operators: word rules, row locators, clash-free names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from quarry.operators.staging import broadcast_if_small, stage
from quarry.session import ship_package

# White space of the word rule: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULTS = (None, "67108864b", "-1b", "-1")

FILE, ROW = "__loc_file", "__loc_row"


def text_of(df: DataFrame, name: str) -> Column:
    """The text column as string; null counts as empty."""
    return F.coalesce(df[quoted(name)].cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def squeezed(text: Column) -> Column:
    """The text without white space."""
    return F.regexp_replace(text, SPACE + "+", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable, not an
    expression that Catalyst may copy into each use)."""
    return F.transform(F.array(value), body)[0]


def in_arrow(df: DataFrame, batches, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path, in batches of bounded bytes.

    Spark's own bound is higher; it is lowered for the session unless the user chose one.
    Batches come with columns by position: ``mapInArrow`` cannot take names with dots."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH, None) in _BATCH_DEFAULTS:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(batches, schema)


def named(column: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col(quoted(column))


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """64-bit hash of the row's values in ``columns``; NULLs count by their place."""
    def hashable(kind) -> bool:
        inner = [f.dataType for f in kind] if isinstance(kind, StructType) else [kind.elementType] if isinstance(kind, ArrayType) else []
        return not isinstance(kind, (MapType, VariantType)) and all(hashable(k) for k in inner)

    parts = []
    for c in columns:
        value = df[quoted(c)]
        if not hashable(df.schema[c].dataType):  # a map's or variant's entries, as text
            value = F.to_json(F.struct(value.alias("v")))
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _is_parquet_scan(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return (relation.getClass().getSimpleName() == "HadoopFsRelation"
            and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat")


def located(df: DataFrame, name: str = "located") -> DataFrame:
    """``df`` with a stable row locator: file path and row index in that file, in two
    columns whose names (``__loc_file``, ``__loc_row``) are reserved.

    A frame that reads Parquet files takes the reader's own metadata. Any other
    frame is first written to the shared folder, so that each row, repeated ones
    included, has an identity that a recomputation cannot change.
    """
    if not _is_parquet_scan(df):
        df = stage(df, name).df
    meta = df.metadataColumn("_metadata")
    return df.withColumns({FILE: meta.getField("file_path"), ROW: meta.getField("row_index")})


def without_rows(df: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a located frame whose locator is not in ``dropped``; the latter is staged
    and broadcast only if its measured size allows."""
    gone = broadcast_if_small(stage(dropped.select(FILE, ROW), "dropped"))
    return df.join(gone, [FILE, ROW], "left_anti").select(*[df[quoted(c)] for c in columns])

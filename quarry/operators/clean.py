"""Projections and filters (renames, required fields, null rows, final columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.predicates import all_present


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns by a map; every source name must exist."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(mapping)


def require(df: DataFrame, names, trim: bool = False) -> DataFrame:
    """Keep rows where every named column is present (not NULL, not '')."""
    return df.where(all_present(df, names, trim))


def drop_any_null(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of ``subset`` (default: all)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def lift_field(df: DataFrame, struct_col: str, field: str, alias: str,
               drop_struct: bool = True) -> DataFrame:
    """Lift ``struct_col.field`` into its own column.

    A plain (non-struct) column is taken as the value itself, since some
    document stores deliver the id as a string rather than a struct.
    """
    from pyspark.sql.types import StructType

    dtype = df.schema[struct_col].dataType
    value = F.col(f"{struct_col}.{field}") if isinstance(dtype, StructType) else F.col(struct_col)
    out = df.withColumn(alias, value)
    return out.drop(struct_col) if drop_struct and struct_col != alias else out


def keep_columns(df: DataFrame, names) -> DataFrame:
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing output columns {missing}")
    return df.select(*names)

"""Order-free digests of groups of rows, to tell whether a group changed without reading it.

A row's hash covers every column, NULLs by their place. A group's digest is its number of
rows and the sums of the four halves of two such 64-bit hashes: the same for any order
and partitioning, added up on the map side, and an error instead of an overflow beyond
2^31 rows. Two different groups of as many rows share a digest by chance only, about once
in 2^128; hashes are not meant to withstand someone who builds collisions. Values that are
equal under ``<=>`` have equal hashes if their types are equal, so cast them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

SUMS = ("a", "b", "c", "d")


def hashable(dtype: DataType) -> bool:
    """Whether Spark hashes such values (it does not hash maps and variants)."""
    if isinstance(dtype, StructType):
        return all(hashable(f.dataType) for f in dtype)
    if isinstance(dtype, ArrayType):
        return hashable(dtype.elementType)
    return not isinstance(dtype, (MapType, VariantType))


def row_hash(columns: list[str], seed: int) -> Column:
    named = ["`" + c.replace("`", "``") + "`" for c in columns]
    return F.xxhash64(F.lit(seed), *[x for c in named for x in (F.col(c).isNull(), F.col(c))])


def digests(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """One row per value of ``group``: rows, and the sums ``a`` to ``d`` over ``columns``."""
    low = F.lit(0xFFFFFFFF).cast("long")
    hashed = df.select(group, row_hash(columns, 1).alias("h"), row_hash(columns, 2).alias("g"))
    halves = [x for h in ("h", "g") for x in (F.shiftright(h, 32), F.col(h).bitwiseAND(low))]
    return hashed.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(x).alias(n) for x, n in zip(halves, SUMS, strict=True)])

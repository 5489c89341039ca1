"""Top-k rows by a measure with a fixed tie-break.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each partition
keeps its own best k rows and only those reach the final merge, so no full
shuffle or sort of the input happens. NULL and NaN measures never win in either
direction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quarry.specs import QueryType


def top_k(df: DataFrame, by: str, k: int = 1, direction="highest", tiebreak=()) -> DataFrame:
    direction = QueryType.parse(direction)
    if k < 1:
        raise ValueError("k must be at least 1")
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    first = (F.col(by).desc_nulls_last() if direction is QueryType.HIGHEST
             else F.col(by).asc_nulls_last())
    known = F.col(by).isNotNull()
    if isinstance(df.schema[by].dataType, (DoubleType, FloatType)):
        known = known & ~F.isnan(by)
    return (df.where(known)
              .orderBy(first, *[F.col(t).asc_nulls_last() for t in tiebreak])
              .limit(k))

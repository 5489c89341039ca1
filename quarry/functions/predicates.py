"""Row predicates built from column lists."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def all_of(preds: list[Column]) -> Column:
    return reduce(and_, preds) if preds else F.lit(True)


def any_of(preds: list[Column]) -> Column:
    return reduce(or_, preds) if preds else F.lit(False)


def present(df: DataFrame, name: str, trim: bool = False) -> Column:
    """Not NULL, and for text not the empty string.

    With ``trim=False`` (the default) ``' '`` counts as present, as in a plain
    ``!= ''`` test.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        text = F.trim(c) if trim else c
        return c.isNotNull() & (text != F.lit(""))
    return c.isNotNull()


def all_present(df: DataFrame, names, trim: bool = False) -> Column:
    return all_of([present(df, n, trim) for n in names])

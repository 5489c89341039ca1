"""JDBC tables: parallel reads.

Not exercised by the registered queries or tests: they would need a
database, and none is started here. The functions only assemble standard
``spark.read.jdbc`` options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A whole table; split into ``num_partitions`` range reads when a numeric
    ``partition_column`` and its bounds are given (one connection per task).
    Without them the read is one task, which is only acceptable for small tables.
    """
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs bounds and num_partitions")
        return spark.read.jdbc(url, table, column=partition_column,
                               lowerBound=lower_bound, upperBound=upper_bound,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)

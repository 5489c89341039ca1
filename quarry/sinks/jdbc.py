"""JDBC sinks: overwrite, and update as staging table + one transaction.

Not exercised by the registered queries or tests: they would need a
database, and none is started here.

Spark's JDBC writer has no upsert, and an overwrite of a table that the plan
reads drops the table before the tasks read it. So an update:

1. computes the change set once and stages it in the shared folder;
2. writes it to a uniquely named staging table (parallel, one connection per
   partition);
3. checks the staging table's row count against the staged delta: a task
   retried after a lost executor can leave the rows of its failed attempt
   behind, and such a staging table is never merged;
4. applies it with one DELETE + INSERT in a single transaction on the driver's
   connection (set-based SQL, no rows pass through the driver), then drops
   the staging table.

``write_overwrite`` goes the same way (stage, staging table, count check, one
transaction), so a failed or retried write never leaves a half-written table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from quarry.operators.delta import assert_unique_sides, changed_rows, missing_keys
from quarry.operators.staging import stage
from quarry.sinks.files import EmptyResultError
from quarry.specs import InsertMode, JobResult


def write_overwrite(df: DataFrame, url: str, table: str, properties: dict,
                    batch_size: int = 10_000, num_partitions: int | None = None,
                    allow_empty: bool = True) -> JobResult:
    """Replace the rows of ``table``, keeping its definition and grants; a table that does not
    exist is created with the frame's columns. No rows leave the table as it is, unless
    ``allow_empty``."""
    frozen = stage(df, "jdbc-overwrite")
    n = frozen.rows()
    if not n and not allow_empty:
        frozen.drop()
        raise EmptyResultError(f"no rows to write to {table}; the table stays as it is")
    staging = _load_staging(frozen.df, n, url, table, properties, batch_size, num_partitions)
    cols = ", ".join(_quote(c) for c in df.columns)
    if not _table_exists(df.sparkSession, url, properties, table):
        df.limit(0).write.jdbc(url, table, mode="errorifexists", properties=dict(properties))
    _run_transaction(df.sparkSession, url, properties, [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}",
        f"DROP TABLE {staging}",
    ])
    frozen.drop()
    return JobResult(mode=InsertMode.OVERWRITE.value, target=table, rows_written=n, wrote=True)


def _load_staging(rows: DataFrame, expected: int, url: str, table: str, properties: dict,
                  batch_size: int, num_partitions: int | None) -> str:
    """Write ``rows`` to a fresh staging table and verify its row count."""
    staging = f"{table}__stage_{uuid.uuid4().hex[:10]}"
    w = rows.coalesce(num_partitions) if num_partitions else rows
    w.write.jdbc(url, staging, mode="errorifexists",
                 properties=dict(properties, batchsize=str(batch_size)))
    got = _query_scalar(rows.sparkSession, url, properties, f"SELECT count(*) FROM {staging}")
    if got != expected:
        _run_transaction(rows.sparkSession, url, properties, [f"DROP TABLE {staging}"])
        raise RuntimeError(f"staging table for {table} holds {got} rows, expected {expected}; "
                           "nothing was merged")
    return staging


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def merge_statements(table: str, staging: str, key, columns, keep_missing: bool = True):
    """SQL applying ``staging`` to ``table`` (portable DELETE + INSERT)."""
    key = list(key)
    cols = key + [c for c in columns if c not in key]
    # A NULL key is a key (portable spelling of null-safe equality).
    match = " AND ".join(f"(t.{_quote(k)} = s.{_quote(k)} OR (t.{_quote(k)} IS NULL AND s.{_quote(k)} IS NULL))" for k in key)
    col_list = ", ".join(_quote(c) for c in cols)
    if keep_missing:
        delete = (f"DELETE FROM {table} t WHERE EXISTS "
                  f"(SELECT 1 FROM {staging} s WHERE {match})")
    else:
        delete = f"DELETE FROM {table}"
    insert = f"INSERT INTO {table} ({col_list}) SELECT {col_list} FROM {staging}"
    return [delete, insert]


def write_update(source: DataFrame, target: DataFrame, url: str, table: str,
                 properties: dict, key, columns, keep_missing: bool = True,
                 rule: str = "null_safe", check_keys: bool = True,
                 batch_size: int = 10_000, num_partitions: int | None = None) -> JobResult:
    key = [key] if isinstance(key, str) else list(key)
    if check_keys:
        assert_unique_sides({"source": source, "target": target}, key)
    frozen = stage(changed_rows(source, target, key, columns, rule), "jdbc-delta")
    n = frozen.rows()
    result = JobResult(mode=InsertMode.UPDATE.value, target=table, rows_written=n)
    removed = 0
    if not keep_missing:
        removed = missing_keys(target, source, key).count()
        result.details["rows_removed"] = removed
    if not n and not removed:
        frozen.drop()
        return result
    if keep_missing:
        rows, expected = frozen.df, n
    else:
        whole = stage(source.select(*key, *[c for c in columns if c not in key]), "jdbc-source")
        rows, expected = whole.df, whole.rows()
    staging = _load_staging(rows, expected, url, table, properties, batch_size, num_partitions)
    _run_transaction(source.sparkSession, url, properties,
                     merge_statements(table, staging, key, columns, keep_missing)
                     + [f"DROP TABLE {staging}"])
    frozen.drop()
    if not keep_missing:
        whole.drop()
    result.wrote = True
    return result


def _connect(spark, url: str, properties: dict):
    jvm = spark._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    jprops = jvm.java.util.Properties()
    for k, v in properties.items():
        jprops.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def _query_scalar(spark, url: str, properties: dict, sql: str) -> int:
    conn = _connect(spark, url, properties)
    try:
        rs = conn.createStatement().executeQuery(sql)
        rs.next()
        return int(rs.getLong(1))
    finally:
        conn.close()


def _table_exists(spark, url: str, properties: dict, table: str) -> bool:
    conn = _connect(spark, url, properties)
    try:
        conn.createStatement().executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0")
        return True
    except Exception:  # the driver's own error for an unknown table
        return False
    finally:
        conn.close()


def _run_transaction(spark, url: str, properties: dict, statements) -> None:
    conn = _connect(spark, url, properties)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for sql in statements:
            st.executeUpdate(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()

"""Parquet table sinks: overwrite, update (upsert) and the no-change case.

Rules:

1. Never write to a location the plan still reads. Spark deletes the old files
   before its tasks read them, so a plan that reads its own target loses the
   table. :func:`assert_not_reading` refuses such a write before anything is
   deleted. It compares the root paths of the analysed plan, below cached frames too.
2. An overwrite writes the new rows to a folder beside the table and swaps the
   two by renaming once all rows are there; a job that fails leaves the old table.
3. An update shuffles each side once, merges them and stages the merged rows, marked, in the
   shared folder (:func:`merged_rows`); key check, counts and write all use the staged rows, so they cannot differ.
   Where the target need not be shuffled (bucketed by the key, or a small source's keys sort
   its rows out), the change set is staged instead and then joined to the target. What was staged is
   deleted once the new table is written.
4. The merged table is written to a new location; the caller repoints readers
   to it (catalog ``ALTER TABLE ... SET LOCATION``, or a path in the job's
   configuration). The old version stays readable until then.
"""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.operators.delta import (
    CHANGE, CHANGED, GONE, REPEATED_SOURCE, REPEATED_TARGET, assert_unique_sides, changed_rows, merged_rows,
    missing_keys, upsert_rows,
)
from quarry.operators.key_filter import MAX_KEYS, same_types
from quarry.operators.staging import estimated_bytes, remove, stage
from quarry.session import qualify
from quarry.specs import InsertMode, JobResult


class OwnInputError(ValueError):
    pass


def _uri_key(uri: str) -> tuple[str, str, str]:
    parts = urlsplit(uri)
    path = posixpath.normpath(unquote(parts.path) or "/")
    return parts.scheme or "file", parts.netloc, path.rstrip("/") + "/"


def root_paths(df: DataFrame) -> set[str]:
    """The folders and files that the frame's relations were opened on, its subqueries'
    included: a few per relation, however many files they hold."""
    out, plans = set(), [df._jdf.queryExecution().analyzed()]
    while plans:
        plan = plans.pop()
        below = plan.subqueriesAll()
        plans += [below.apply(i) for i in range(below.size())]
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName() != "LogicalRelation":
                continue
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                out |= {roots.apply(j).toString() for j in range(roots.size())}
    return out


def assert_not_reading(df: DataFrame, path: str) -> None:
    """Refuse to write ``df`` to ``path`` if ``df`` reads from it, below it or above it."""
    spark = df.sparkSession
    scheme, netloc, target = _uri_key(qualify(spark, path))
    for root in sorted(root_paths(df)):
        s, n, p = _uri_key(qualify(spark, root))
        if (s, n) == (scheme, netloc) and (p.startswith(target) or target.startswith(p)):
            raise OwnInputError(f"refusing to write to {path}: the plan reads {root}")


def swap(spark, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one is deleted last."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs, old = to.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    had = fs.exists(to)
    if had and not fs.rename(to, old):
        raise OSError(f"cannot move {path} aside; the new rows are in {new}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(new), to):
        if had:
            fs.rename(old, to)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old, True)


class EmptyResultError(ValueError):
    pass


def write_overwrite(df: DataFrame, path: str, partition_by=None, allow_empty: bool = True) -> JobResult:
    """Replace the table at ``path``; counts come from an observed metric.

    With ``allow_empty=False``, no rows leave the old table and raise."""
    assert_not_reading(df, path)
    spark, new = df.sparkSession, f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    obs = Observation(f"overwrite-{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(new)
        n = int(obs.get["rows"])
        if not n and not allow_empty:
            raise EmptyResultError(f"no rows to write to {path}; the table stays as it is")
    except Exception:
        remove(spark, new)
        raise
    swap(spark, new, path)
    return JobResult(mode=InsertMode.OVERWRITE.value, target=path, rows_written=n, wrote=True)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def write_update(source: DataFrame, target: DataFrame, key, columns, out_path: str,
                 keep_missing: bool = True, rule: str = "null_safe",
                 check_keys: bool = True, writer=write_parquet, key_filter: bool | None = None,
                 one_pass: bool | None = None) -> JobResult:
    """Apply new and changed source rows to ``target``; write the result to ``out_path``.

    Nothing is written when the change set is empty (``wrote=False``,
    ``rows_written=0``). ``rows_written`` counts the added or modified rows. With
    ``keep_missing=False``, rows whose key the source lacks are a change too: they go, and
    ``details["rows_removed"]`` counts them.
    ``writer(df, path)`` writes the merged table (plain Parquet by default).

    ``key_filter``: sort target rows out by a bitmap of the incoming keys before the joins shuffle
    them (:mod:`quarry.operators.key_filter`). By default, where the key's types are equal, the incoming side is too large
    to broadcast and at most a quarter of the target.

    ``one_pass``: merge both sides in one shuffle instead of joining twice. By default, where keys are checked,
    the bitmap does not apply and the types of key and ``columns`` are equal. The result is the same in every way.
    """
    key = [key] if isinstance(key, str) else list(key)
    columns = list(columns)
    assert_not_reading(source, out_path)
    assert_not_reading(target, out_path)

    def filtered(side_bytes) -> bool:
        if key_filter is not None or not same_types(source, target, key):
            return bool(key_filter)
        limit = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
        return max(limit, 0) < side_bytes() <= estimated_bytes(target) // 4

    spark = source.sparkSession
    by_bitmap = filtered(lambda: estimated_bytes(source))
    if one_pass is None:
        named = [c for c in {*key, *columns} if c in source.columns and c in target.columns]
        one_pass = check_keys and not key_filter and not by_bitmap and same_types(source, target, named)
    if one_pass:
        return _update_in_one_pass(source, target, key, columns, out_path, keep_missing, rule, writer)
    if check_keys:
        assert_unique_sides({"source": source, "target": target}, key)
    delta = stage(changed_rows(source, target, key, columns, rule, by_bitmap), "delta")
    n = delta.rows()
    result = JobResult(mode=InsertMode.UPDATE.value, target=out_path, rows_written=n)
    removed = 0
    if not keep_missing:
        removed = missing_keys(target, source, key).count()
        result.details["rows_removed"] = removed
    if n or removed:
        small = n <= MAX_KEYS and filtered(delta.bytes)
        merged = upsert_rows(target, delta.df, key, columns, keep_missing, source, key_filter=small)
        writer(merged, out_path)
        result.wrote = True
    # The staged delta only froze the rows between the count and the write.
    delta.drop()
    return result


def _update_in_one_pass(source: DataFrame, target: DataFrame, key: list[str], columns: list[str], out_path: str,
                        keep_missing: bool, rule: str, writer) -> JobResult:
    merged = stage(merged_rows(source, target, key, columns, keep_missing, rule), "merged")
    try:
        def marked(change: int) -> DataFrame:
            return merged.df.where(F.col(CHANGE) == change)

        n = {r[CHANGE]: r["count"] for r in merged.df.groupBy(CHANGE).count().collect()}  # at most five rows
        if n.keys() & {REPEATED_SOURCE, REPEATED_TARGET}:
            assert_unique_sides({"source": marked(REPEATED_SOURCE), "target": marked(REPEATED_TARGET)}, key)
        result = JobResult(mode=InsertMode.UPDATE.value, target=out_path, rows_written=n.get(CHANGED, 0))
        if not keep_missing:
            result.details["rows_removed"] = n.get(GONE, 0)
        if n.get(CHANGED) or n.get(GONE):
            writer(merged.df.where(F.col(CHANGE) != GONE).drop(CHANGE), out_path)
            result.wrote = True
        return result
    finally:
        merged.drop()

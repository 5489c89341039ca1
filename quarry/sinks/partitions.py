"""Parquet tables in hash partitions of their key, with versions: an update reads and writes
only what it touches, and takes effect in one step.

A table is cut by a hash of its key modulo the number of parts. Number, key and schema are
fixed when the table is made and kept with it; an update with others would leave a key in two
parts and is refused. So a row never moves and a changed row touches one part.

A version (``sinks/versions``) names the folder of each part, with the digest of its
rows. A write puts new parts in a folder of its own, beside those in use, and then
commits the next version. Until then readers have the old table, whole; from then on the new
one. Folders that no version names any more go with :func:`vacuum`.

An update that names all columns takes the digests of the source's parts first, in one pass
with partial sums. Parts of equal digest are not read; if all are equal, no row of the
table is. The others are merged with the source in one shuffle of both, straight into the new
folder; parts in which nothing changed are deleted there and the old ones stay.

Rows are dealt out by slots, several to a part, so that a large part is more than one task. The
files hold a column beside the schema's, ``__change``: what the last write made of the row
(:func:`quarry.operators.delta.merged_rows`). Readers name their columns and do not see it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from quarry.operators import digests
from quarry.operators.delta import (
    CHANGE, CHANGED, GONE, REPEATED_SOURCE, REPEATED_TARGET, assert_unique, marked_rows, merged_rows,
)
from quarry.operators.staging import remove, stage
from quarry.sinks import versions
from quarry.sinks.files import EmptyResultError, assert_not_reading
from quarry.specs import InsertMode, JobResult

PART = "__part"
_SLOT = "__slot"
_SLOTS = 8  # of a part
_DATA = "data-"
LEDGER = "landed"  # the note that lists the folders of a table's ledger, and how their names begin


class LayoutError(ValueError):
    pass


def _current(spark: SparkSession, path: str, number: int | None = None) -> tuple[int, dict]:
    known = versions.versions(spark, path)
    if not known or number not in (None, *known):
        raise LayoutError(f"{path} has no version {number}" if known else f"{path} is no table in hash partitions: it has no version")
    number = known[-1] if number is None else number
    return number, versions.read_version(spark, path, number)


def layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Key and number of parts of the table at ``path``."""
    _, v = _current(spark, path)
    return v["key"], v["parts"]


def _part(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int").alias(PART)


def _dealt(key: list[str], parts: int) -> dict[str, Column]:
    """Part and slot of a row: slots are a finer remainder of the same hash."""
    return {PART: _part(key, parts), _SLOT: F.pmod(F.xxhash64(*key), F.lit(parts * _SLOTS)).cast("int")}


def _rows_of(spark: SparkSession, path: str, version: dict, numbers=None) -> DataFrame:
    """The rows of a version, or of some of its parts."""
    schema, held = StructType.fromJson(version["schema"]), version["held"]
    folders = [f"{path.rstrip('/')}/{p['folder']}" for n, p in held.items() if numbers is None or int(n) in numbers]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _digests_of(df: DataFrame, columns: list[str]) -> dict[int, list[int]]:
    """Rows and digest sums by part: at most as many entries as the table has parts. Without
    columns that can be hashed, rows only."""
    if all(digests.hashable(df.schema[c].dataType) for c in columns):
        found = digests.digests(df, PART, columns)
    else:
        found = df.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    return {r[PART]: list(r)[1:] for r in found.collect()}


def _write_parts(rows: DataFrame, path: str, columns: list[str]) -> tuple[str, dict, DataFrame]:
    """Write rows, with their parts, to a new folder; its name, folder and digest of each part, and what was
    written. ``GONE`` rows lie apart, in parts with negative numbers, which are not the table's."""
    spark, name = rows.sparkSession, _DATA + uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/{name}"
    try:
        written = stage(rows.drop(_SLOT), "parts", folder, PART).df
        held = _digests_of(written.where(F.col(PART) >= 0), columns)
        return name, {str(n): {"folder": f"{name}/{PART}={n}", "digest": d} for n, d in held.items()}, written
    except Exception:
        remove(spark, folder)
        raise


def _assert_written_once(written: DataFrame, folder: str, key: list[str], mark: int, what: str) -> None:
    """:func:`assert_unique` for rows that are written: those marked are all that can repeat."""
    try:
        assert_unique(written.where(F.col(CHANGE) == mark), key, what)
    except Exception:
        remove(written.sparkSession, folder)
        raise


def _commit(spark: SparkSession, path: str, number: int, content: dict, name: str | None = None) -> None:
    try:
        versions.commit(spark, path, number, content)
    except versions.CommitConflictError:
        if name:
            remove(spark, f"{path.rstrip('/')}/{name}")
        raise


def note_of(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number of the last version, and what writers noted beside its rows (see :func:`update_partitioned`)."""
    number, version = _current(spark, path)
    return number, version.get("note", {})


def _write_all(df: DataFrame, path: str, key: list[str], parts: int, number: int, allow_empty: bool, schema: StructType | None = None,
               note: dict | None = None) -> JobResult:
    name, held, written = _write_parts(marked_rows(df, key, _dealt(key, parts)), path, df.columns)
    _assert_written_once(written, f"{path.rstrip('/')}/{name}", key, REPEATED_SOURCE, path)
    rows = sum(p["digest"][0] for p in held.values())
    if not rows and not allow_empty:
        remove(df.sparkSession, f"{path.rstrip('/')}/{name}")
        raise EmptyResultError(f"no rows to write to {path}; the table stays as it is")
    content = {"key": key, "parts": parts, "schema": (schema or df.schema).jsonValue(), "held": held, "note": note or {}}
    _commit(df.sparkSession, path, number, content, name)
    return JobResult(mode=InsertMode.OVERWRITE.value, target=path, rows_read=rows, rows_written=rows, wrote=True, details={"version": number})


def create_partitioned(df: DataFrame, path: str, key, parts: int, allow_empty: bool = True) -> JobResult:
    """Write ``df``, whose ``key`` must be unique, to a new table of ``parts`` hash partitions."""
    if own := {PART, _SLOT, CHANGE}.intersection(df.columns):
        raise LayoutError(f"{', '.join(sorted(own))}: a name of the table's own columns")
    if versions.names_in(df.sparkSession, path):
        raise LayoutError(f"{path} is not empty")
    return _write_all(df, path, [key] if isinstance(key, str) else list(key), parts, 1, allow_empty)


def overwrite_partitioned(df: DataFrame, path: str, allow_empty: bool = True) -> JobResult:
    """Put ``df`` in the place of the table's rows, as its next version."""
    spark = df.sparkSession
    number, v = _current(spark, path)
    assert_not_reading(df, path)
    schema = StructType.fromJson(v["schema"])
    if set(df.columns) != set(schema.names):
        raise LayoutError(f"{path} has the columns {schema.names}, not {df.columns}")
    return _write_all(_as_in(df, schema, path), path, v["key"], v["parts"], number + 1, allow_empty, schema, v.get("note"))


def read_partitioned(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table's rows: of the last version, or of an earlier one that is still there."""
    return _rows_of(spark, path, _current(spark, path, version)[1])


def _as_in(df: DataFrame, schema: StructType, path: str) -> DataFrame:
    """``df`` in the table's types, where that loses nothing."""
    jvm = df.sparkSession._jvm
    java = lambda t: jvm.org.apache.spark.sql.types.DataType.fromJson(t.json())
    for f in schema:
        if f.name in df.columns and not jvm.org.apache.spark.sql.catalyst.expressions.Cast.canUpCast(
                java(df.schema[f.name].dataType), java(f.dataType)):
            raise LayoutError(f"{path}: column {f.name} is {f.dataType.simpleString()}, which does not hold every "
                              f"{df.schema[f.name].dataType.simpleString()}; cast the source")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])


def _different(source: dict, held: dict, keep_missing: bool) -> list[int]:
    """Parts whose rows may differ: source digests by part against the table's."""
    own = {int(n): p["digest"] for n, p in held.items()}
    return sorted(n for n in (source if keep_missing else {**own, **source}) if source.get(n) != own.get(n))


def update_partitioned(source: DataFrame, path: str, key, columns, parts: int | None = None, keep_missing: bool = True,
                       rule: str = "null_safe", trust_digests: bool = True, note: dict | None = None,
                       version_read: int | None = None) -> JobResult:
    """Apply new and changed ``source`` rows (and, with ``keep_missing=False``, deletions) to the
    table at ``path`` as its next version. Columns of the table that ``columns`` does not name keep
    their values.

    ``details["compared"]`` lists the parts that were read, ``details["parts"]`` those that were
    rewritten; ``rows_read`` counts the source. Digests decide which parts are read only if the update names every column,
    the rule is ``null_safe`` and ``trust_digests`` is left on.

    ``note`` is kept with the version that the update makes, its entries over those of the version before; with
    a note there is a next version even if no row changed. So what a writer must remember takes effect with its rows.
    A writer whose note follows from an earlier look at the table names the version it saw, ``version_read``: if another
    is current by now, the update fails."""
    spark = source.sparkSession
    key = [key] if isinstance(key, str) else list(key)
    cols = key + [c for c in columns if c not in key]
    number, version = _current(spark, path)
    if version_read not in (None, number):
        raise versions.CommitConflictError(f"{path}: version {number} was written by another job since version {version_read} was read")
    if key != version["key"] or parts not in (None, version["parts"]):
        raise LayoutError(f"{path} has {version['parts']} parts of {version['key']}, not {parts} of {key}")
    parts, schema, held_parts = version["parts"], StructType.fromJson(version["schema"]), version["held"]
    strange = [c for c in cols if c not in schema.names or c not in source.columns]
    if strange:
        raise LayoutError(f"{path}: columns {strange} must exist in source and table")
    assert_not_reading(source, path)
    source = _as_in(source.select(*cols), schema, path)
    numbered = source.select("*", _part(key, parts))
    digested = (trust_digests and rule == "null_safe" and set(cols) == set(schema.names)
                and all(digests.hashable(f.dataType) for f in schema))
    if digested:
        found = _digests_of(numbered, schema.names)
        compared = _different(found, held_parts, keep_missing)
    else:
        found = {r[PART]: [r["rows"]] for r in numbered.groupBy(PART).agg(F.count(F.lit(1)).alias("rows")).collect()}
        compared = sorted(set(found) | (set() if keep_missing else {int(n) for n in held_parts}))
    result = JobResult(mode=InsertMode.UPDATE.value, target=path, rows_read=sum(d[0] for d in found.values()),
                       details={"compared": compared, "parts": [], "version": number})
    if not keep_missing:
        result.details["rows_removed"] = 0
    noted = {**version, "note": {**version.get("note", {}), **(note or {})}}

    def unchanged() -> JobResult:
        if note is not None:
            _commit(spark, path, number + 1, noted)
            result.details["version"] = number + 1
        return result

    if not compared:
        return unchanged()
    if len(compared) < parts:
        source = numbered.where(F.col(PART).isin(compared)).drop(PART)
    target = _rows_of(spark, path, version, set(compared))
    merged = merged_rows(source, target, key, cols, keep_missing, rule, _dealt(key, parts))
    if not keep_missing:
        merged = merged.withColumn(PART, F.when(F.col(CHANGE) == GONE, -1 - F.col(PART)).otherwise(F.col(PART)))
    name, new, written = _write_parts(merged, path, schema.names)
    folder = f"{path.rstrip('/')}/{name}"
    # Keys of parts that are not compared are those of the table, where they are unique.
    _assert_written_once(written, folder, key, REPEATED_SOURCE, "source")
    _assert_written_once(written, folder, key, REPEATED_TARGET, path)
    counts = written.where(F.col(CHANGE).isin(CHANGED, GONE)).groupBy(PART, CHANGE).count().collect()  # at most two a part
    result.rows_written = sum(r["count"] for r in counts if r[CHANGE] == CHANGED)
    if not keep_missing:
        result.details["rows_removed"] = sum(r["count"] for r in counts if r[CHANGE] == GONE)
    numbers = sorted({r[PART] if r[PART] >= 0 else -1 - r[PART] for r in counts})
    result.details["parts"] = numbers
    if not numbers:
        remove(spark, folder)
        return unchanged()
    for part in [p for p in versions.names_in(spark, folder) if p.startswith(f"{PART}=") and int(p.partition("=")[2]) not in numbers]:
        remove(spark, f"{folder}/{part}")
    rest = {n: p for n, p in held_parts.items() if int(n) not in numbers}
    _commit(spark, path, number + 1, {**noted, "held": {**rest, **{n: p for n, p in new.items() if int(n) in numbers}}}, name)
    result.wrote, result.details["version"] = True, number + 1
    return result


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all versions but the last ``keep`` and every folder that none of those names (also
    what a job that died left); how many folders went. Not while a job writes the table, nor
    while a reader is still at a version that goes."""
    if keep < 1:
        raise ValueError("the last version must stay")
    known = versions.versions(spark, path)
    for number in known[:-keep]:
        versions.forget(spark, path, number)
    held = [versions.read_version(spark, path, n) for n in known[-keep:]]
    used = {p["folder"] for v in held for p in v["held"].values()}
    ledgers = {name for v in held for name in v.get("note", {}).get(LEDGER, [])}
    went, root = 0, path.rstrip("/")
    for name in (n for n in versions.names_in(spark, root) if n.startswith(LEDGER + "-") and n not in ledgers):
        remove(spark, f"{root}/{name}")
    for name in (n for n in versions.names_in(spark, root) if n.startswith(_DATA)):
        parts = [f"{name}/{p}" for p in versions.names_in(spark, f"{root}/{name}") if p.startswith(PART)]
        away = [f for f in parts if f not in used]
        for folder in [name] if len(away) == len(parts) else away:
            remove(spark, f"{root}/{folder}")
        went += len(away)
    return went

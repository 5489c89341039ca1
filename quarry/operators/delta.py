"""Change set of a source against a target table: new rows and changed rows.

Generic over the key and the value columns (one function for every table).
Two comparison rules:

* ``"null_safe"`` (default): a row is changed when the key is missing in the
  target or any value differs under ``<=>`` (NULL equals NULL).
* ``"null_as_changed"``: the original rule, per column ``target IS NULL OR
  target != source``. NULL on both sides counts as a change every time, and a
  source NULL against a target value is never seen.

Keys are compared null-safe: a NULL key is a key like any other, and occurs at most
once per side (see :func:`assert_unique`).

The join is a left outer join on the key. Both sides can be large, so it is a
shuffle join chosen by the planner (AQE turns it into a broadcast join only
when the target turns out to be small at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.predicates import any_of
from quarry.operators.key_filter import split_by_keys

RULES = ("null_safe", "null_as_changed")
_T = "__t_"
_PRESENT = "__t_present"
CHANGE = "__change"  # of a merged row: one of the next five, see :func:`merged_rows`
KEPT, CHANGED, GONE, REPEATED_SOURCE, REPEATED_TARGET = range(5)
_SIDE, _BEFORE, _AFTER = "__side", "__side_before", "__side_after"


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their counts (partial aggregation first)."""
    key = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def assert_unique(df: DataFrame, key, what: str = "table") -> None:
    """Fail with a count when a key repeats (a join on it would multiply rows)."""
    dups = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("keys"),
                                       F.sum("n").alias("rows")).first()
    if dups["keys"]:
        raise DuplicateKeyError(
            f"{what}: {dups['keys']} key values repeat, covering {dups['rows']} rows")


def assert_unique_sides(sides: dict, key) -> None:
    """:func:`assert_unique` for several frames, naming every side that fails.

    Each side is grouped on its own: a table bucketed by the key is counted bucket by
    bucket, without a shuffle."""
    failed = []
    for name, df in sides.items():
        try:
            assert_unique(df, key, name)
        except DuplicateKeyError as e:
            failed.append(str(e))
    if failed:
        raise DuplicateKeyError("; ".join(failed))


def join_by_key(left: DataFrame, right: DataFrame, key, how: str) -> DataFrame:
    """``left`` joined to ``right``, whose key columns are named ``__t_`` + key, with NULL
    equal to NULL.

    Rows with a whole key are joined by plain equality, which a table bucketed by the key
    serves without a shuffle; null-safe equality would not be. The rows with a NULL in
    their key are joined on their own; the scans skip to them by file statistics.
    """
    def gap(df, names):
        return any_of([df[n].isNull() for n in names])

    far = [_T + k for k in key]
    whole_l, whole_r = left.where(~gap(left, key)), right.where(~gap(right, far))
    whole = whole_l.join(whole_r, [whole_l[k] == whole_r[_T + k] for k in key], how)
    if not any(left.schema[k].nullable for k in key):
        return whole
    part_l, part_r = left.where(gap(left, key)), right.where(gap(right, far))
    return whole.unionByName(part_l.join(part_r, [part_l[k].eqNullSafe(part_r[_T + k]) for k in key], how))


def missing_keys(target: DataFrame, source: DataFrame, key) -> DataFrame:
    """Keys of the target that the source does not have (deletions)."""
    key = [key] if isinstance(key, str) else list(key)
    return join_by_key(target.select(*key), source.select(*[F.col(k).alias(_T + k) for k in key]), key, "left_anti")


def changed_rows(source: DataFrame, target: DataFrame, key, columns=None,
                 rule: str = "null_safe", key_filter: bool = False) -> DataFrame:
    """Source rows (key + columns, source values) that are new or changed.

    ``key_filter``: target rows without a key of the source are sorted out by a bitmap of those keys
    (:mod:`quarry.operators.key_filter`) and not shuffled. It costs a pass over the source's keys."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    key = [key] if isinstance(key, str) else list(key)
    if columns is None:
        columns = [c for c in source.columns if c not in key]
    columns = [c for c in columns if c not in key]
    _assert_in_both(source, target, key + columns)

    if key_filter:
        target = split_by_keys(target, source, key)[0]
    t = target.select(*[F.col(c).alias(_T + c) for c in key + columns], F.lit(True).alias(_PRESENT))
    j = join_by_key(source.select(*key, *columns), t, key, "left")
    changed = F.col(_PRESENT).isNull() | _differs(rule, [(F.col(c), F.col(_T + c)) for c in columns])
    return j.where(changed).select(*key, *columns)


def _assert_in_both(source: DataFrame, target: DataFrame, columns) -> None:
    for c in columns:
        if c not in source.columns or c not in target.columns:
            raise ValueError(f"column {c!r} must exist in source and target")


def _differs(rule: str, pairs: list[tuple[Column, Column]]) -> Column:
    """Whether a source row's values differ from the target's under ``rule``: pairs of (source, target)."""
    if rule == "null_safe":
        return any_of([~s.eqNullSafe(t) for s, t in pairs])
    return F.coalesce(any_of([t.isNull() | (t != s) for s, t in pairs]), F.lit(False))


def marked_rows(df: DataFrame, key, by: dict[str, Column]) -> DataFrame:
    """The rows of a new table, marked and dealt out as those of :func:`merged_rows`: ``KEPT``, or
    ``REPEATED_SOURCE`` where the key occurs more than once."""
    w = Window.partitionBy(*by, *key)
    n = F.count(F.lit(1)).over(w)
    return (df.withColumns(by).repartition(list(by)[-1])
            .select(*by, *df.columns, F.when(n > 1, REPEATED_SOURCE).otherwise(KEPT).alias(CHANGE)))


def merged_rows(source: DataFrame, target: DataFrame, key, columns, keep_missing: bool = True,
                rule: str = "null_safe", by: dict[str, Column] | None = None) -> DataFrame:
    """The target after the update, and in ``__change`` what became of each row: the same rows as
    :func:`changed_rows` and then :func:`upsert_rows` give, from one shuffle of each side.

    Both sides are dealt out by the key together, and each row looks at its neighbours of the same key:
    ``KEPT`` rows have the target's values, ``CHANGED`` rows are new or have the source's. With
    ``keep_missing=False``, target rows without a source row are ``GONE``, for the caller to count and
    leave out. Rows of a key that a side holds more than once are ``REPEATED_SOURCE`` or ``REPEATED_TARGET``, all of them
    and not multiplied; where there are any, the others mean nothing. Key columns and ``columns``
    must have the same types on both sides.

    ``by``: columns computed from the key, added in front. Rows are dealt out by the last of them, and each task's
    rows are ordered by all.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    key = [key] if isinstance(key, str) else list(key)
    columns = [c for c in columns if c not in key]
    _assert_in_both(source, target, key + columns)
    others = [c for c in target.columns if c not in key + columns]
    names, by = [*key, *columns, *others], by or {}
    nothing = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in others]
    rows = source.select(*key, *columns, *nothing, F.lit(1).alias(_SIDE)).unionByName(
        target.select(*names, F.lit(0).alias(_SIDE)))
    if by:
        rows = rows.withColumns(by).repartition(list(by)[-1])
    w = Window.partitionBy(*by, *key).orderBy(_SIDE)
    seen = rows.withColumns({_BEFORE: F.lag(_SIDE).over(w), _AFTER: F.lead(_SIDE).over(w),
                             **{_T + c: F.lag(c).over(w) for c in names}})  # not of a struct: it would be shuffled beside its columns
    mine, before, after, prev = F.col(_SIDE) == 1, F.col(_BEFORE), F.col(_AFTER), lambda c: F.col(_T + c)
    known = F.coalesce(before == 0, F.lit(False))
    twice = F.coalesce(before == F.col(_SIDE), F.lit(False)) | F.coalesce(after == F.col(_SIDE), F.lit(False))
    change = (F.when(twice, F.when(mine, REPEATED_SOURCE).otherwise(REPEATED_TARGET))
               .when(mine, F.when(~known | _differs(rule, [(F.col(c), prev(c)) for c in columns]), CHANGED).otherwise(KEPT))
               .when(after.isNull(), KEPT if keep_missing else GONE))  # else the source's row comes in its place
    marked = seen.withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull())
    own = ~mine | ~known | (F.col(CHANGE) != KEPT) | F.lit(not keep_missing)
    return marked.select(*by, *[F.when(own, F.col(c)).otherwise(prev(c)).alias(c) for c in key + columns],
                         *[F.when(mine & known, prev(c)).otherwise(F.col(c)).alias(c) for c in others], CHANGE)


def with_target_columns(rows: DataFrame, target: DataFrame, key, columns) -> DataFrame:
    """``rows`` with the target's other columns beside key and ``columns``: a row that the target
    has keeps their values, a new one has NULL."""
    cols = list(key) + [c for c in columns if c not in key]
    others = [c for c in target.columns if c not in cols]
    if not others:
        return rows.select(*cols)
    held = target.select(*[F.col(c).alias(_T + c) for c in [*key, *others]])
    return join_by_key(rows.select(*cols), held, key, "left").select(*cols, *[F.col(_T + c).alias(c) for c in others])


def upsert_rows(target: DataFrame, delta: DataFrame, key, columns,
                keep_missing: bool = True, source: DataFrame | None = None, key_filter: bool = False) -> DataFrame:
    """The target after applying ``delta``.

    ``keep_missing=True``: target rows whose key is not in the delta stay,
    delta rows replace or add. ``keep_missing=False``: the target becomes the
    source (keys absent from the source are removed); ``source`` is required.
    Columns of the target that the update does not name keep their values (see
    :func:`with_target_columns`). ``key_filter``: target rows that cannot have a key of the delta
    stay without a shuffle; the target is scanned twice for it.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols = key + [c for c in columns if c not in key]
    if not keep_missing:
        if source is None:
            raise ValueError("keep_missing=False needs the whole source")
        return with_target_columns(source, target, key, columns)
    others = [c for c in target.columns if c not in cols]
    every = target.select(*cols, *others)
    may, cannot = split_by_keys(every, delta, key) if key_filter else (every, None)
    kept = join_by_key(may, delta.select(*[F.col(k).alias(_T + k) for k in key]), key, "left_anti")
    merged = kept.unionByName(with_target_columns(delta, may, key, columns))
    return merged if cannot is None else cannot.unionByName(merged)

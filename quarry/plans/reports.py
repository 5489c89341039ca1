"""The four report questions, as one-row DataFrames.

Each report takes the tables and the column roles, so the same question can
be asked of any table pair. Output column names default to the names of the
original report responses. An empty result means "no data for these
parameters"; argument errors are raised on the driver before any job runs.

* :func:`lookup` - values of two tables joined on differently named keys,
  for one user-given value of the key (bound as a literal, never pasted into
  SQL text);
* :func:`extreme_row` - the row with the highest or lowest measure;
* :func:`best_group` - the group with the highest or lowest mean, where the
  measure may differ by direction;
* :func:`best_group_joined` - the same over an inner join of two tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.exact_sums import binned_sums, bins, mean_of, part_sums, with_limbs
from quarry.operators.impute import MEAN_SUMS, binned, mean_from_sums, mean_places, mean_sums, rounded_mean
from quarry.operators.staging import planner_broadcasts
from quarry.operators.topk import top_k
from quarry.specs import QueryType

REPORT_DIGITS = 3


class NoDataError(LookupError):
    """A report found no row for its parameters."""


def fetch_one(report: DataFrame) -> dict:
    """The report's single row as a dict; :class:`NoDataError` when there is none.

    Reports are one-row plans (``limit(1)``), so this moves one row to the
    driver. The column names and types are fixed by the plan, so no per-value
    type guard is needed.
    """
    rows = report.limit(1).collect()
    if not rows:
        raise NoDataError("the report has no row for these arguments")
    return rows[0].asDict()


def lookup(left: DataFrame, right: DataFrame, left_on: str, right_on: str, value: str,
           columns: dict[str, str]) -> DataFrame:
    """Rows of ``left JOIN right ON left_on = right_on`` where the key equals ``value``.

    ``columns`` maps output names to input column names. The first row in
    output-column order is returned, so the answer does not depend on the plan.
    """
    if not isinstance(value, str):
        raise TypeError("lookup value must be a string")
    if value == "":
        raise ValueError("lookup value not provided")
    # Filter both sides before the join; Catalyst would infer it too, but this
    # keeps the pushed filters visible at both scans. Only the first row in output
    # order is wanted, so each side is cut to its distinct wanted columns first: a
    # value that fills a side does not multiply with the other.
    lhs = left.where(F.col(left_on) == F.lit(value))
    rhs = right.where(F.col(right_on) == F.lit(value))
    # A column that both sides have is the left side's. The sides are cut apart by new names, as the
    # key or a wanted column may be called the same on both.
    from_left = {name: src for name, src in columns.items() if src in left.columns}
    from_right = {name: src for name, src in columns.items() if src not in left.columns}
    place = {name: f"__{i}" for i, name in enumerate(columns)}
    lhs = lhs.select(F.col(left_on).alias("__lk"), *[F.col(src).alias(place[n]) for n, src in from_left.items()]).distinct()
    rhs = rhs.select(F.col(right_on).alias("__rk"), *[F.col(src).alias(place[n]) for n, src in from_right.items()]).distinct()
    j = lhs.join(rhs, F.col("__lk") == F.col("__rk"), "inner")
    out = j.select(*[F.col(place[name]).alias(name) for name in columns])
    return out.orderBy(*[F.col(n).asc_nulls_last() for n in columns]).limit(1)


def extreme_row(df: DataFrame, label: str, measure: str, query_type="lowest",
                label_as: str = "country", measure_as: str = "internet_users") -> DataFrame:
    """The row with the highest/lowest ``measure``; ties go to the smallest label."""
    qt = QueryType.parse(query_type)
    best = top_k(df.select(label, measure), measure, 1, qt, tiebreak=[label])
    return best.select(F.col(label).alias(label_as), F.col(measure).alias(measure_as),
                       F.lit(qt.value).alias("query_type"))


def _best(sums: DataFrame, group: str, places: int | None, qt: QueryType, group_as: str,
          value_as: str, digits: int | None, k: int) -> DataFrame:
    """Groups ranked on the unrounded mean of their sums; the value shown is rounded once."""
    names = sums.columns
    if "__bins" in names:
        means = sums.select(F.col(group), mean_of("__bins").alias("__mean")).withColumn("__value", rounded_mean(F.col("__mean"), digits))
    else:
        means = sums.select(F.col(group), mean_from_sums(names, None).alias("__mean"),
                            mean_from_sums(names, places, digits).alias("__value"))
    best = top_k(means, "__mean", k, qt, tiebreak=[group])
    return best.select(F.col(group).alias(group_as), F.col("__value").alias(value_as),
                       F.lit(qt.value).alias("query_type"))


def best_group(df: DataFrame, group: str, measure: dict | str, query_type="lowest",
               group_as: str = "region", value_as: str = "price",
               digits: int | None = REPORT_DIGITS, scale: int | None = None, k: int = 1) -> DataFrame:
    """Group(s) with the highest/lowest mean; ``measure`` may map direction to column.

    ``k=1`` is the original report; a larger ``k`` gives the top-k groups. ``scale``: see
    :func:`quarry.operators.impute.mean_sums`.
    """
    qt = QueryType.parse(query_type)
    col = measure[qt.value] if isinstance(measure, dict) else measure
    dtype = df.schema[col].dataType
    double = binned(col, dtype, scale)
    sums = binned_sums(df, [group], {"__": double}, {}) if double else df.groupBy(group).agg(*mean_sums(col, dtype, scale))
    return _best(sums, group, mean_places(col, dtype, scale), qt, group_as, value_as, digits, k)


def best_group_joined(left: DataFrame, right: DataFrame, on, group: str, measure: str,
                      query_type="lowest", group_as: str = "region",
                      value_as: str = "internet_speed",
                      digits: int | None = REPORT_DIGITS, scale: int | None = None,
                      pre_aggregate: bool | None = None, k: int = 1) -> DataFrame:
    """:func:`best_group` over ``left JOIN right ON left[on[0]] = right[on[1]]`` (inner).

    ``measure`` comes from ``left`` and ``group`` from ``right``. With
    ``pre_aggregate``, ``left`` is first reduced to one row per join key (sum and
    count, partial aggregation on the map side), so a shuffle join moves one row per
    key instead of every fact row; the sums add up to the same either way. The default
    (None) pre-aggregates only when the planner would not broadcast ``right``: with a
    broadcast join the fact rows are never shuffled and the extra aggregate only costs
    a stage.
    """
    qt = QueryType.parse(query_type)
    lk, rk = on
    dtype = left.schema[measure].dataType
    if pre_aggregate is None:
        pre_aggregate = not planner_broadcasts(right)
    double = binned(measure, dtype, scale)
    if double:
        # By bin as well: integers, which add up to the same either way.
        rows, at = with_limbs(left.select(lk, measure), {"__": double}), lk
        if pre_aggregate:
            rows, at = rows.groupBy(F.col(lk).alias("__k"), "__b").agg(*part_sums("__")), "__k"
        found = rows.join(right.select(F.col(rk).alias("__rk"), F.col(group).alias("__group")), F.col(at) == F.col("__rk"), "inner")
        sums = (found.groupBy(F.col("__group").alias(group), "__b").agg(*part_sums("__"))
                .groupBy(group).agg(bins("__").alias("__bins")))
    elif pre_aggregate:
        per_key = left.groupBy(F.col(lk).alias("__k")).agg(*mean_sums(measure, dtype, scale))
        sums = per_key.join(right, per_key["__k"] == right[rk], "inner").groupBy(group).agg(
            *[F.sum(c).alias(c) for c in per_key.columns if c in MEAN_SUMS])
    else:
        sums = left.join(right, left[lk] == right[rk], "inner").select(group, measure).groupBy(
            group).agg(*mean_sums(measure, dtype, scale))
    return _best(sums, group, mean_places(measure, dtype, scale), qt, group_as, value_as, digits, k)

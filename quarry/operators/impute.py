"""Group means and filling NULLs with the mean of the row's group.

Plan: one aggregate (partial on the map side, so a huge group costs one row
per map task in the shuffle), the means written to the shared folder, then a
left join back that is a broadcast join when the means are provably small.
A window ``avg(x) over (partition by group)`` would instead move every row of
a group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
)

from quarry.operators.exact_sums import binned_sums, mean_of
from quarry.operators.staging import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, join_small

# Exact sums keep at most this many decimal places, so that Spark's decimal
# arithmetic below never shortens a scale.
MOST_PLACES = 6
MEAN_SUMS = ("__s", "__h", "__p", "__q", "__d", "__n", "__e")
# Doubles that hold decimals are summed as whole numbers of their last place, below this size (beyond
# it a double does not tell neighbours apart), in three limbs: a long holds over 10^13 of each.
WHOLE, LIMB = 2 ** 53, 18


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _addends(name: str, dtype: DataType | None, scale: int | None) -> tuple[str | None, str | None, int | None]:
    """SQL of a column as a decimal and as a double (whichever is needed), and the decimal's places."""
    c = _quoted(name)
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return f"CAST({c} AS DECIMAL(28, 0))", None, 0
    if isinstance(dtype, DecimalType) and dtype.scale <= MOST_PLACES:
        if dtype.precision <= 28:
            return f"CAST({c} AS DECIMAL({max(dtype.precision, 1)}, {dtype.scale}))", None, dtype.scale
        # A group with a value beyond 28 digits gets the mean of its double sum.
        return f"TRY_CAST({c} AS DECIMAL(28, {dtype.scale}))", f"CAST({c} AS DOUBLE)", dtype.scale
    x = f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))"
    if scale is None:
        return None, x, None
    if not 0 <= scale <= MOST_PLACES:
        raise ValueError(f"scale must be 0 to {MOST_PLACES}")
    # The whole number whose quotient is the very double; division by a power of ten rounds correctly.
    unit = f"{10 ** scale}D"
    whole = f"rint({x} * {unit})"
    return f"CASE WHEN abs({x} * {unit}) < {WHOLE}D AND {whole} / {unit} = {x} THEN CAST({whole} AS BIGINT) END", x, scale


def mean_places(name: str, dtype: DataType | None, scale: int | None) -> int | None:
    """Decimal places of the exact sum; None where only doubles are summed."""
    return _addends(name, dtype, scale)[2]


def binned(name: str, dtype: DataType | None, scale: int | None) -> str | None:
    """SQL of a column that is summed as doubles only, by bins; None for the others."""
    exact, double, _ = _addends(name, dtype, scale)
    return None if exact else double


def _sums(name: str, dtype: DataType | None, scale: int | None) -> dict[str, str]:
    exact, double, _ = _addends(name, dtype, scale)
    out = {"__n": f"count({double or exact})"}
    if exact and double and not isinstance(dtype, DecimalType):
        mask = (1 << LIMB) - 1
        out |= {"__h": f"sum(shiftright({exact}, {2 * LIMB}))", "__p": f"sum(shiftright({exact}, {LIMB}) & {mask}L)",
                "__q": f"sum({exact} & {mask}L)", "__e": f"count({exact})"}
    elif exact:
        out |= {"__s": f"sum({exact})", "__e": f"count({exact})"}
    if double:
        out["__d"] = f"sum({double})"
    return out


def mean_sums(name: str, dtype: DataType | None, scale: int | None = None, prefix: str = "") -> list[Column]:
    """The sums and counts behind a mean, as aggregates that can be summed again over
    several partial groups: ``__s`` or ``__h``, ``__p``, ``__q`` (exact), ``__d`` (double), ``__n``
    (values) and ``__e`` (values in the exact sum), those that apply.

    Integers and decimals (up to six places) are summed exactly. Other columns are summed
    as doubles by :mod:`quarry.operators.exact_sums`, not here (see :func:`binned`). For
    columns that hold decimals of a known number of places (amounts of money), ``scale``
    sums them exactly as such; a group with a value of more places, or of 2^53 of its last
    place and beyond, gets the mean of its double sum. NaN counts as missing.
    """
    return [F.expr(sql).alias(prefix + a) for a, sql in _sums(name, dtype, scale).items()]


def _rounded(total: str, n: str, places: int, digits: int) -> str:
    """An exact sum's mean, rounded half away from zero once, from the unrounded quotient.

    The quotient, which Spark cuts to six places, gives a candidate; the remainder
    ``sum - candidate * count`` tells whether it is one unit off. All terms are cast to one
    scale, so that no comparison shortens them."""
    kind, whole = f"DECIMAL(38, {digits})", f"DECIMAL(38, {max(places, digits)})"
    count, size = f"CAST({n} AS DECIMAL(20, 0))", f"abs(CAST({total} AS {whole}))"
    unit = f"CAST('{10.0 ** -digits:.{digits}f}' AS DECIMAL(7, {digits}))"
    near = f"CAST(round({size} / {count}, {digits}) AS {kind})"
    rest = f"CAST({size} - CAST({near} * {count} AS {whole}) AS {whole})"
    half = f"CAST({unit} * {count} AS {whole})"
    twice = f"CAST({rest} + {rest} AS {whole})"
    mean = (f"CAST({near} + CASE WHEN {twice} >= {half} THEN {unit} WHEN {twice} < -{half} THEN -{unit} "
            f"ELSE CAST(0 AS DECIMAL(7, {digits})) END AS {kind})")
    return f"CASE WHEN {n} > 0 THEN IF({total} < 0, -{mean}, {mean}) END"


def mean_from_sums(columns: list[str], places: int | None, digits: int | None = None,
                   integer: bool = False, prefix: str = "") -> Column:
    """The mean (double; bigint when ``integer``) from columns named as by :func:`mean_sums`."""
    n, total, double, held, high = (_quoted(prefix + c) if prefix + c in columns else None for c in ("__n", "__s", "__d", "__e", "__h"))
    if high:
        limbs = [f"CAST({_quoted(prefix + c)} AS DECIMAL(38, 0))" for c in ("__h", "__p", "__q")]
        total = f"({limbs[0]} * {2 ** (2 * LIMB)} + {limbs[1]} * {2 ** LIMB} + {limbs[2]})"
        total = f"CAST({total} * CAST('{10.0 ** -(places or 0):.{places or 0}f}' AS DECIMAL(7, {places or 0})) AS DECIMAL(38, {places or 0}))"
    digits = 0 if integer and digits is None else digits
    kind = "BIGINT" if integer else "DOUBLE"
    plain = f"CASE WHEN {n} > 0 THEN {double or f'CAST({total} AS DOUBLE)'} / {n} END"
    if digits is None:
        return F.expr(plain)
    plain = f"CAST(round({plain}, {digits}) AS {kind})"
    if places is None or not 0 <= digits <= MOST_PLACES:
        return F.expr(plain)
    exact = f"CAST({_rounded(total, n, places, digits)} AS {kind})"
    return F.expr(f"CASE WHEN {held} = {n} THEN {exact} ELSE {plain} END" if double else exact)


def group_means(df: DataFrame, group, columns: dict, integer=(), prefix: str = "avg_",
                scale: dict | None = None) -> DataFrame:
    """One row per group with ``prefix + column`` holding the rounded mean.

    ``columns`` maps a column to its number of decimal places (None: unrounded); means are
    rounded once, half away from zero. Columns in ``integer`` are rounded to whole numbers
    and typed bigint. ``scale`` maps a column of doubles to the places at which it is
    summed exactly (see :func:`mean_sums`).
    """
    scale = scale or {}
    group = [group] if isinstance(group, str) else list(group)
    integer = set(integer)
    types = {f.name: f.dataType for f in df.schema}  # one round trip to the JVM
    parts = {c: f"__{i}" for i, c in enumerate(columns)}
    by_bins = {p: x for c, p in parts.items() if (x := binned(c, types[c], scale.get(c)))}
    sums = binned_sums(df, group, by_bins, {
        p + a: sql for c, p in parts.items() if p not in by_bins for a, sql in _sums(c, types[c], scale.get(c)).items()})
    names = sums.columns

    def mean(c: str, p: str) -> Column:
        if p not in by_bins:
            return mean_from_sums(names, mean_places(c, types[c], scale.get(c)), columns[c], c in integer, p)
        return rounded_mean(mean_of(p + "bins"), columns[c], c in integer)

    return sums.select(*group, *[mean(c, p).alias(prefix + c) for c, p in parts.items()])


def rounded_mean(mean: Column, digits: int | None, integer: bool = False) -> Column:
    """A double mean rounded half away from zero (bigint when ``integer``)."""
    digits = 0 if integer and digits is None else digits
    return (mean if digits is None else F.round(mean, digits)).cast("bigint" if integer and digits is not None else "double")


def impute_group_mean(df: DataFrame, group, columns: dict, integer=(),
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                      scale: dict | None = None, held: list | None = None) -> DataFrame:
    """Replace NULLs in ``columns`` by the rounded mean of the row's group.

    Non-NULL values never change. A row whose group key is NULL, or whose whole
    group is NULL in a column, keeps its NULL. Result types follow the usual
    widening of the value and the mean (int value with a double mean gives
    double). Output columns are the input's, in its order.

    Building the plan runs the job for the means (their size decides the join), and the
    input is evaluated once more for the result; ``held``: see
    :func:`quarry.operators.staging.join_small`.
    """
    group = [group] if isinstance(group, str) else list(group)
    prefix = "__mean_"
    means = group_means(df, group, columns, integer, prefix, scale)
    joined = join_small(df, means, on=group, how="left",
                        max_rows=max_broadcast_rows, max_bytes=max_broadcast_bytes,
                        name="group-means", held=held)
    filled = {c: F.coalesce(F.col(c), F.col(prefix + c)) for c in columns}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c)
                           for c in df.columns])

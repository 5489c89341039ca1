"""Sums of doubles that are the same bits however the rows are partitioned.

A double is a whole number times a power of two. Each value goes to the bin of its exponent
(16 powers of two wide) and is cut, without rounding, into whole-number limbs of at most 18
bits in that bin's unit. Limbs are summed as integers by group and bin (partial
aggregation as usual), so the order of the rows does not matter and nothing overflows; a
long holds the limbs of over 10^13 rows. At the end a group's few bins are added
from the smallest up, with the rounding errors carried along, relative to the largest bin:
two values of 1.7e308 have the mean 1.7e308.

NaN and NULL are no values. An infinity is kept apart: it makes the mean infinite, both
signs make it NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN, LIMB = 16, 18
INFINITE = 9999           # bin of the infinities
SMALLEST = -68            # bin of zero and of the smallest doubles
LIMBS = ("h", "p", "q", "r")
PARTS = ("n", *LIMBS)     # summed for each bin


def with_limbs(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """``df`` with the columns prefix + b, n, h, p, q, r for every prefix: SQL of a double in ``values``."""
    def step(make):
        return {k: F.expr(v) for p, sql in values.items() for k, v in make(p, sql).items()}

    unit = 2.0 ** LIMB
    df = df.withColumns(step(lambda p, x: {f"{p}x": f"nanvl(CAST({x} AS DOUBLE), CAST(NULL AS DOUBLE))"}))
    df = df.withColumns(step(lambda p, _: {f"{p}b": (
        f"CASE WHEN abs({p}x) = DOUBLE('Infinity') THEN {INFINITE} WHEN {p}x = 0 THEN {SMALLEST} "
        f"ELSE CAST(floor(log2(abs({p}x)) / {BIN}) AS INT) END")}))
    # In two factors: the power of two itself may be beyond a double.
    half = f"pow(2D, CAST(-{BIN // 2} * {{p}}b AS DOUBLE))"
    df = df.withColumns(step(lambda p, _: {f"{p}h_": (
        f"CASE WHEN {p}b = {INFINITE} THEN 0D ELSE {p}x * {half.format(p=p)} * {half.format(p=p)} END")}))
    for limb, rest in (("h", "p"), ("p", "q"), ("q", "r")):
        df = df.withColumns(step(lambda p, _: {f"{p}{limb}": f"CAST({p}{limb}_ AS BIGINT)"}))
        df = df.withColumns(step(lambda p, _: {f"{p}{rest}_": f"({p}{limb}_ - {p}{limb}) * {unit!r}D"}))
    return df.withColumns(step(lambda p, _: {
        f"{p}r": f"CAST({p}r_ AS BIGINT)", f"{p}n": f"IF({p}x IS NULL, 0L, 1L)",
        # The infinities are counted, by sign.
        f"{p}h": f"IF({p}b = {INFINITE} AND {p}x > 0, 1L, {p}h)", f"{p}p": f"IF({p}b = {INFINITE} AND {p}x < 0, 1L, {p}p)"}))


def part_sums(prefix: str) -> list[Column]:
    return [F.sum(prefix + c).alias(prefix + c) for c in PARTS]


def bins(prefix: str, when: Column | None = None) -> Column:
    """Aggregate: a group's bins as a list, from rows that hold one bin each."""
    one = F.struct(F.col(prefix + "b").alias("b"), *[F.col(prefix + c).alias(c) for c in PARTS])
    given = F.col(prefix + "b").isNotNull() if when is None else when & F.col(prefix + "b").isNotNull()
    return F.collect_list(F.when(given, one))


def mean_of(listed: str) -> Column:
    """The mean from a group's list of bins; NULL where there is no value."""
    mask, shift = (1 << LIMB) - 1, LIMB
    finite = f"filter({listed}, v -> v.b <> {INFINITE})"
    infinite = f"filter({listed}, v -> v.b = {INFINITE})"
    count = f"aggregate({listed}, 0L, (a, v) -> a + v.n)"
    # Carries, so that all limbs but the first are exact as doubles.
    carried = (f"transform(transform(transform(array_sort({finite}), "
               f"v -> named_struct('b', v.b, 'h', v.h, 'p', v.p, 'q', v.q + shiftright(v.r, {shift}), 'r', v.r & {mask}L)), "
               f"v -> named_struct('b', v.b, 'h', v.h, 'p', v.p + shiftright(v.q, {shift}), 'q', v.q & {mask}L, 'r', v.r)), "
               f"v -> named_struct('b', v.b, 'h', v.h + shiftright(v.p, {shift}), 'p', v.p & {mask}L, 'q', v.q, 'r', v.r))")
    body = (f"transform(array(named_struct('all', {carried}, 'top', array_max(transform({finite}, v -> v.b)))), g -> "
            f"aggregate(flatten(transform(g.all, v -> transform(array("
            f"v.r * {2.0 ** (-3 * shift)!r}D, v.q * {2.0 ** (-2 * shift)!r}D, v.p * {2.0 ** -shift!r}D, CAST(v.h AS DOUBLE)), "
            f"d -> d * pow(2D, CAST({BIN} * (v.b - g.top) AS DOUBLE))))), "
            f"named_struct('s', 0D, 'c', 0D), "
            # Knuth's sum: what s + d loses is added to c.
            f"(a, d) -> named_struct('s', a.s + d, 'c', a.c + ((a.s - ((a.s + d) - ((a.s + d) - a.s))) + (d - ((a.s + d) - a.s)))), "
            f"a -> (a.s + a.c) / {count} * pow(2D, CAST({BIN // 2} * g.top AS DOUBLE)) * pow(2D, CAST({BIN // 2} * g.top AS DOUBLE))))[0]")
    plus, minus = (f"exists({infinite}, v -> v.{c} > 0)" for c in ("h", "p"))
    return F.expr(f"CASE WHEN {count} = 0 THEN NULL WHEN {plus} AND {minus} THEN DOUBLE('NaN') WHEN {plus} THEN DOUBLE('Infinity') "
                  f"WHEN {minus} THEN DOUBLE('-Infinity') ELSE {body} END")


def binned_sums(df: DataFrame, group: list[str], values: dict[str, str], others: dict[str, str]) -> DataFrame:
    """One row per group: for every prefix in ``values`` its bins as the list prefix + ``bins``, and the
    sums ``others`` (alias: SQL of a sum or count that can be summed again)."""
    held = with_limbs(df, values) if values else df
    if not values:
        return held.groupBy(*group).agg(*[F.expr(sql).alias(a) for a, sql in others.items()])
    first = held.groupBy(*group, *[p + "b" for p in values]).agg(
        *[c for p in values for c in part_sums(p)], *[F.expr(sql).alias(a) for a, sql in others.items()])
    if len(values) == 1:
        p = next(iter(values))
        return first.groupBy(*group).agg(bins(p).alias(p + "bins"), *[F.sum(a).alias(a) for a in others])
    # Few rows are left: one for each group and combination of bins. Each becomes a row per column, so
    # that a group's list has at most one entry per bin.
    def entry(i: int | None, p: str | None) -> Column:
        return F.struct(F.lit(i).cast("int").alias("__i"), *[(F.col(p + c) if p else F.lit(None).cast("int" if c == "b" else "long")).alias("__" + c) for c in ("b", *PARTS)],
                        *[(F.col(a) if p is None else F.lit(None).cast(first.schema[a].dataType)).alias(a) for a in others])
    rows = first.select(*group, F.inline(F.array(entry(None, None), *[entry(i, p) for i, p in enumerate(values)])))
    second = rows.groupBy(*group, "__i", "__b").agg(*part_sums("__"), *[F.sum(a).alias(a) for a in others])
    return second.groupBy(*group).agg(*[bins("__", F.col("__i") == i).alias(p + "bins") for i, p in enumerate(values)],
                                      *[F.sum(a).alias(a) for a in others])

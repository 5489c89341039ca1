"""Means of doubles: exact, and the same bits for any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.operators.exact_sums import binned_sums, mean_of
from quarry.operators.impute import group_means
from quarry.plans.reports import best_group, best_group_joined


def means(df, group="g"):
    return {r[group]: r["m"] for r in binned_sums(df, [group], {"__": "v"}, {}).select(group, mean_of("__bins").alias("m")).collect()}


def near(got, values):
    exact = sum(map(Fraction, values)) / len(values)
    return abs(Fraction(got) - exact) <= abs(exact) * Fraction(1, 2 ** 51) + Fraction(1, 2 ** 1074)


def test_means_are_exact_and_repeat(spark):
    rng = random.Random(4)
    groups = {
        "cancel": [1e16, 1.0, -1e16, 3.0] * 50, "wide": [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(200)],
        "tiny": [5e-324, 1e-320, 2.5e-310] * 3, "huge": [1.7e308, 1.7e308], "mixed": [0.1] * 1000 + [1e-17] * 7, "zero": [0.0, -0.0],
        "powers": [2.0 ** k for k in range(-1074, 1023, 7)] + [-(2.0 ** k) for k in range(-1070, 1000, 16)],
        "edges": [x for k in (-16, 0, 16, 32, 512) for x in (2.0 ** k, math.nextafter(2.0 ** k, 0), math.nextafter(2.0 ** k, math.inf))]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("cancel", None), ("mixed", float("nan")), ("none", None)]
    want = None
    for parts, seed in ((1, 0), (3, 1), (7, 2)):
        rng.shuffle(rows)
        got = means(spark.createDataFrame(rows, "g string, v double").repartition(parts))
        assert got["none"] is None and got["huge"] == 1.7e308 and got["zero"] == 0
        assert all(near(got[g], vs) for g, vs in groups.items())
        want = want or got
        assert got == want


def test_infinities(spark):
    rows = [("a", float("inf")), ("a", 1.0), ("b", float("-inf")), ("c", float("inf")), ("c", float("-inf")), ("d", 2.0)]
    got = means(spark.createDataFrame(rows, "g string, v double"))
    assert got["a"] == math.inf and got["b"] == -math.inf and math.isnan(got["c"]) and got["d"] == 2


def test_several_columns_with_exact_ones(spark):
    rng = random.Random(1)
    rows = [(f"g{i % 3}", rng.uniform(-1e9, 1e9), rng.gauss(0, 1) * 10.0 ** rng.randint(-9, 9), i, float(i % 5)) for i in range(600)] + [("g9", None, 1.5, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y float, i int, z double")
    got = {r["g"]: r for r in group_means(df, "g", {"x": None, "y": None, "i": 2, "z": 1}).collect()}
    y = {g: [r["y"] for r in df.where(F.col("g") == g).collect()] for g in got}
    for g in ("g0", "g1", "g2"):
        mine = [r for r in rows if r[0] == g]
        assert near(got[g]["avg_x"], [r[1] for r in mine]) and near(got[g]["avg_y"], y[g])
        assert got[g]["avg_i"] == round(sum(r[3] for r in mine) / 200 + 1e-9, 2) and got[g]["avg_z"] == round(sum(r[4] for r in mine) / 200, 1)
    assert tuple(got["g9"]) == ("g9", None, 1.5, None, None)
    assert {tuple(r) for r in group_means(df.repartition(9), "g", {"x": None, "y": None, "i": 2, "z": 1}).collect()} == {tuple(r) for r in got.values()}
    assert group_means(df.limit(0), "g", {"x": None, "y": None}).collect() == []


def test_both_ways_of_the_joined_report_give_the_same_bits(spark):
    rng = random.Random(8)
    facts = spark.createDataFrame([(i % 40, rng.uniform(0, 1) * 10.0 ** rng.randint(-5, 12)) for i in range(3000)] + [(3, None), (None, 5.0)], "k int, v double")
    dims = spark.createDataFrame([(i, f"r{i % 4}") for i in range(38)] + [(0, "r1")], "id int, region string")
    found = [[tuple(r) for r in best_group_joined(facts.repartition(p), dims, ("k", "id"), "region", "v", "highest", digits=None, pre_aggregate=pre, k=9).collect()]
             for p in (1, 5) for pre in (True, False)]
    assert len(found[0]) == 4 and all(f == found[0] for f in found)
    one = best_group(facts.join(dims, facts.k == dims.id), "region", "v", "highest", digits=None, k=9)
    assert [tuple(r) for r in one.collect()] == found[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_decimals_equal_sparks_mean(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("SELECT * FROM VALUES ('a', CAST('123456789012345678901234567890.12' AS DECIMAL(38,2))), ('a', 2.00), ('b', 1.005), ('b', 2.00), ('c', NULL) AS t(g, v)").selectExpr("g", "CAST(v AS DECIMAL(38,2)) AS v")
        got = {r["g"]: r["avg_v"] for r in group_means(df, "g", {"v": 2}).collect()}
        avg = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.avg("v").alias("m")).collect()}
        assert got["a"] == pytest.approx(float(avg["a"]), rel=1e-15) and got["b"] == round(float(avg["b"]) + 1e-12, 2) and got["c"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)

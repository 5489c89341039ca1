from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators.impute import group_means, impute_group_mean
from tests.conftest import rows


def test_fill_rules(spark):
    data = [(1, "g1", 1.0), (2, "g1", None), (3, "g1", 4.0),
            (4, "g2", None), (5, "g2", None),
            (6, None, None), (7, None, 8.0)]
    df = spark.createDataFrame(data, "id int, g string, v double")
    out = impute_group_mean(df, "g", {"v": 2})
    assert out.columns == ["id", "g", "v"]
    assert rows(out) == [(1, "g1", 1.0), (2, "g1", 2.5), (3, "g1", 4.0),
                         (4, "g2", None), (5, "g2", None), (6, None, None), (7, None, 8.0)]


def test_integer_means_round_half_up(spark):
    df = spark.createDataFrame([("p", 2), ("p", 3), ("p", None), ("n", -2), ("n", -3), ("n", None)],
                               "g string, v bigint")
    out = impute_group_mean(df, "g", {"v": 0}, integer=["v"])
    assert out.schema["v"].dataType.simpleString() == "bigint"
    assert sorted(r["v"] for r in out.collect()) == [-3, -3, -2, 2, 3, 3]


def test_int_value_with_double_mean_widens(spark):
    df = spark.createDataFrame([("g", 1), ("g", None), ("g", 2)], "g string, v int")
    out = impute_group_mean(df, "g", {"v": 2})
    assert out.schema["v"].dataType.simpleString() == "double"
    assert sorted(r["v"] for r in out.collect()) == [1.0, 1.5, 2.0]


def test_mean_on_a_tie_is_exact_and_partition_free(spark):
    vals = [965.82, 965.83] * 5 + [0.1, 0.2, 0.3] * 3
    df = spark.createDataFrame([("a" if i < 10 else "b", v) for i, v in enumerate(vals)],
                               "g string, v double")
    for n in (1, 2, 5):
        got = dict(rows(group_means(df.repartition(n), "g", {"v": 2}, scale={"v": 2}), "g", "avg_v"))
        assert got == {"a": 965.83, "b": 0.2}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", float("nan")), ("g", 3.0)], "g string, v double")
    assert group_means(df, "g", {"v": 2}).first()["avg_v"] == 2.0


def test_plan_broadcasts_the_checked_means(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}", float(i)) for i in range(30)],
                               "id int, g string, v double")
    out = impute_group_mean(df, "g", {"v": 1})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan


def test_falls_back_to_shuffle_join_beyond_the_limit(spark):
    df = spark.createDataFrame([(i, f"g{i}", float(i)) for i in range(30)],
                               "id int, g string, v double")
    out = impute_group_mean(df, "g", {"v": 1}, max_broadcast_rows=5)
    assert len(out.collect()) == 30
    logical = out._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in logical.lower()


def test_non_null_values_never_change(spark):
    df = spark.createDataFrame([(i, f"g{i % 4}", None if i % 3 == 0 else float(i))
                                for i in range(40)], "id int, g string, v double")
    out = dict(rows(impute_group_mean(df, "g", {"v": 2}), "id", "v"))
    for r in df.collect():
        if r["v"] is not None:
            assert out[r["id"]] == r["v"]


def test_double_means_are_neither_cut_nor_capped(spark):
    df = spark.createDataFrame([("small", 1e-12), ("small", 3e-12), ("large", 1e19), ("large", 3e19)], "g string, v double")
    got = dict(rows(group_means(df, "g", {"v": None}), "g", "avg_v"))
    assert got == {"small": pytest.approx(2e-12, rel=1e-12), "large": 2e19}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_long_sums_beyond_63_bits(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("g", 1_700_000_000_000_000_000 + i) for i in range(10)], "g string, v bigint")
        assert group_means(df, "g", {"v": 0}, integer=["v"]).first()["avg_v"] == 1_700_000_000_000_000_005
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rounded_once_from_the_unrounded_mean(spark):
    df = spark.createDataFrame([("g", v) for v in (0.005, 0.005, 0.0049999999)], "g string, v double")
    assert group_means(df, "g", {"v": 2}).first()["avg_v"] == 0.0
    # One millionth below the tie in a sum of integers: the six-place quotient rounds to the tie.
    n = 3_000_001
    low = spark.range(n).selectExpr("'g' AS g", f"IF(id < {(n - 1) // 2}, 1, 0) AS v")
    assert group_means(low, "g", {"v": 0}, integer=["v"]).first()["avg_v"] == 0
    assert group_means(low, "g", {"v": 6}).first()["avg_v"] == 0.5


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.tuples(st.integers(0, 3), st.integers(-10 ** 6, 10 ** 6)), min_size=1, max_size=60), digits=st.integers(0, 4))
def test_scaled_means_equal_fractions(spark, values, digits):
    df = spark.createDataFrame([(g, v / 100) for g, v in values], "g int, v double")
    got = dict(rows(group_means(df.repartition(3), "g", {"v": digits}, scale={"v": 2}), "g", "avg_v"))
    for g in got:
        own = [Decimal(v) / 100 for h, v in values if h == g]
        want = abs(Fraction(sum(own)) / len(own)) * 10 ** digits + Fraction(1, 2)
        assert got[g] == pytest.approx((1 if sum(own) >= 0 else -1) * (want.numerator // want.denominator) / 10 ** digits)


def test_values_beyond_the_scale_are_neither_cut_nor_dropped(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 0.126), ("b", 1e30), ("b", 3e30), ("c", 0.125), ("c", 0.125)], "g string, v double")
    got = dict(rows(group_means(df, "g", {"v": 3}, scale={"v": 2}), "g", "avg_v"))
    assert got == {"a": 0.688, "b": 2e30, "c": 0.125}


def test_decimals_keep_their_own_places(spark):
    df = spark.sql("SELECT 'g' AS g, CAST(v AS DECIMAL(12, 4)) AS v FROM VALUES (1.0005), (1.0006) AS t(v)")
    assert group_means(df, "g", {"v": 4}).first()["avg_v"] == 1.0006

import pytest

from quarry.operators.topk import top_k
from quarry.plans import reports
from tests.conftest import rows


def people(spark):
    return spark.createDataFrame(
        [("B", 10), ("A", 10), ("C", 1), ("D", None)], "country string, internet_users bigint")


def test_extreme_ties_go_to_first_name(spark):
    df = people(spark)
    assert rows(reports.extreme_row(df, "country", "internet_users", "highest")) == [
        ("A", 10, "highest")]
    assert rows(reports.extreme_row(df, "country", "internet_users", "lowest")) == [
        ("C", 1, "lowest")]


def test_query_type_checked_before_any_job(spark):
    with pytest.raises(ValueError, match="lowest"):
        reports.extreme_row(people(spark), "country", "internet_users", "middle")
    with pytest.raises(TypeError):
        reports.extreme_row(people(spark), "country", "internet_users", None)


def test_group_with_only_nulls_is_never_chosen(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 2.0), ("z", 1.0)],
                               "region string, p double")
    hi = reports.best_group(df, "region", "p", "highest").first()
    lo = reports.best_group(df, "region", {"highest": "p", "lowest": "p"}, "lowest").first()
    assert (hi["region"], hi["price"]) == ("y", 2.0)
    assert (lo["region"], lo["price"]) == ("z", 1.0)


def test_best_group_joined(spark):
    speed = spark.createDataFrame([("c1", 10.0), ("c2", 20.0), ("c3", 3.0)],
                                  "country string, s double")
    users = spark.createDataFrame([("c1", "r1"), ("c2", "r1"), ("c3", "r2")],
                                  "country string, sub_region string")
    got = reports.best_group_joined(speed, users.withColumnRenamed("country", "ucountry"),
                                    ("country", "ucountry"), "sub_region", "s", "highest")
    assert rows(got) == [("r1", 15.0, "highest")]


def test_lookup(spark):
    prices = spark.createDataFrame([("O'Brien", 1.5), ("X", 2.0)], "name string, p double")
    speed = spark.createDataFrame([("O'Brien", 9.0), ("X", 8.0)], "country string, s double")
    cols = {"country": "country", "mbit_per_s": "s", "price_1gb_usd": "p"}
    assert rows(reports.lookup(prices, speed, "name", "country", "O'Brien", cols)) == [
        ("O'Brien", 9.0, 1.5)]
    assert reports.lookup(prices, speed, "name", "country", "nowhere", cols).isEmpty()
    with pytest.raises(ValueError):
        reports.lookup(prices, speed, "name", "country", "", cols)


def test_top_k_plan_has_no_full_sort(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    plan = top_k(df, "v", 3, "highest", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert rows(top_k(df, "v", 2, "highest", ["id"]), "id") == [(6,), (13,)]


def test_fetch_one_guards(spark):
    df = people(spark)
    got = reports.fetch_one(reports.extreme_row(df, "country", "internet_users", "highest"))
    assert got == {"country": "A", "internet_users": 10, "query_type": "highest"}
    empty = reports.extreme_row(df.where("internet_users > 100"), "country", "internet_users")
    with pytest.raises(reports.NoDataError):
        reports.fetch_one(empty)


def test_pre_aggregated_join_equals_row_level_join(spark):
    import random
    rnd = random.Random(3)
    facts = spark.createDataFrame(
        [(f"c{rnd.randint(0, 30)}", rnd.choice([None, rnd.randint(0, 999) / 8,
                                                 rnd.uniform(-1e9, 1e9)]))
         for _ in range(400)], "country string, s double")
    dims = spark.createDataFrame([(f"c{i}", f"r{i % 4}") for i in range(25)] + [("c3", "r9")],
                                 "ucountry string, sub_region string")
    for qt in ("highest", "lowest"):
        a = reports.best_group_joined(facts, dims, ("country", "ucountry"), "sub_region", "s", qt)
        a = reports.best_group_joined(facts, dims, ("country", "ucountry"), "sub_region", "s", qt,
                                      pre_aggregate=True)
        b = reports.best_group_joined(facts, dims, ("country", "ucountry"), "sub_region", "s", qt,
                                      pre_aggregate=False)
        assert rows(a) == rows(b) and a.count() == 1


def test_pre_aggregation_chosen_by_planner_size_check(spark, tmp_path):
    facts = spark.createDataFrame([("c1", 1.0), ("c2", 3.0)], "country string, s double")
    spark.createDataFrame([("c1", "r1"), ("c2", "r2")], "ucountry string, sub_region string") \
        .write.parquet(str(tmp_path / "dims"))
    dims = spark.read.parquet(str(tmp_path / "dims"))  # file size known to the planner
    small = reports.best_group_joined(facts, dims, ("country", "ucountry"), "sub_region", "s",
                                      "highest")
    assert "AS __k" not in small._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = reports.best_group_joined(facts, dims, ("country", "ucountry"), "sub_region", "s",
                                        "highest")
        assert "AS __k" in big._jdf.queryExecution().optimizedPlan().toString()
        assert rows(big) == rows(small) == [("r2", 3.0, "highest")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("values", [[1e-12, 9e-12, 5e-12], [1e19, 3e19, 2e19], [float("nan"), 2.0, 1.0]])
def test_both_ways_to_join_agree_on_hostile_values(spark, values):
    facts = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values * 2)], "k int, v double")
    groups = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (2, "c2")], "k2 int, g string")
    ways = [rows(reports.best_group_joined(facts, groups, ("k", "k2"), "g", "v", "highest", digits=None, pre_aggregate=p)) for p in (True, False)]
    assert ways[0] == ways[1] and ways[0][0][0] == "b"


def test_unmatched_keys_never_fail_a_report(spark):
    big = 7_000_000_000_000_000_000
    facts = spark.createDataFrame([(1, 4), (9, big), (9, big)], "k int, v bigint")
    groups = spark.createDataFrame([(1, "a")], "k2 int, g string")
    for p in (True, False):
        assert rows(reports.best_group_joined(facts, groups, ("k", "k2"), "g", "v", "highest", pre_aggregate=p)) == [("a", 4.0, "highest")]


def test_nan_is_never_the_extreme(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0)], "country string, internet_users double")
    for qt in ("highest", "lowest"):
        assert reports.extreme_row(df, "country", "internet_users", qt).first()["country"] == "b"


def test_lookup_of_a_value_that_fills_both_sides(spark):
    left = spark.range(500).selectExpr("'x' AS name", "id % 3 AS p")
    right = spark.range(500).selectExpr("'x' AS country", "id % 2 AS s")
    assert rows(reports.lookup(left, right, "name", "country", "x", {"c": "name", "p": "p", "s": "s"})) == [("x", 0, 0)]


def test_lookup_with_columns_of_the_same_name_on_both_sides(spark):
    left = spark.createDataFrame([("c1", "l", 1), ("c2", "m", 2)], "country string, note string, n int")
    right = spark.createDataFrame([("c1", "r", 10), ("c1", "q", 11)], "country string, note string, k int")
    got = reports.lookup(left, right, "country", "country", "c1", {"key": "country", "text": "note", "n": "n", "k": "k"}).collect()
    assert [tuple(r) for r in got] == [("c1", "l", 1, 10)]

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators.clean import drop_any_null
from quarry.operators.dedupe import keep_first, keep_first_each
from tests.conftest import rows


def test_same_survivor_on_any_partitioning(spark):
    data = [("A", 3.0, "z"), ("A", 1.0, "y"), ("A", 1.0, "x"), ("B", None, "q"), ("B", 2.0, "r")]
    df = spark.createDataFrame(data, "k string, v double, w string")
    results = {tuple(rows(keep_first(df.repartition(n), "k"))) for n in (1, 3, 7)}
    assert results == {(("A", 1.0, "x"), ("B", 2.0, "r"))}


def test_order_by_then_rest(spark):
    df = spark.createDataFrame([("A", 2, "a"), ("A", 1, "b"), ("A", 1, "a")],
                               "k string, o int, v string")
    assert rows(keep_first(df, "k", order_by="o")) == [("A", 1, "a")]


def test_two_keys_in_sequence(spark):
    data = [(2, "A"), (1, "B"), (1, "A")]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "id int, country string")
    # step 1 keeps (1,A) and (2,A); step 2 keeps (1,A) only
    assert rows(keep_first_each(df, [["id"], ["country"]])) == [(1, "A")]


def test_dedupe_then_dropna_versus_dropna_then_dedupe(spark):
    # order_by makes the NULL row win the tie-break
    df = spark.createDataFrame([("A", 0, None), ("A", 1, 1.0)], "country string, o int, v double")
    assert rows(drop_any_null(keep_first(df, "country", order_by="o"))) == []
    assert rows(keep_first(drop_any_null(df), "country", order_by="o")) == [("A", 1, 1.0)]


def test_nulls_last_prefers_complete_rows(spark):
    df = spark.createDataFrame([("A", None), ("A", 5.0)], "k string, v double")
    assert rows(keep_first(df, "k")) == [("A", 5.0)]


def test_plan_limits_each_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("A", 1)], "k string, v int")
    plan = keep_first(df, "k")._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("WindowGroupLimit")
    assert partial != -1 and "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in the text) the exchange
    assert plan.rfind("WindowGroupLimit") > plan.find("Exchange hashpartitioning")


def test_descending_columns(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 3, "y"), ("A", None, "z")],
                               "k string, v int, w string")
    assert rows(keep_first(df, "k", order_by="v", descending="v")) == [("A", 3, "y")]


def brute_force(data):
    best = {}
    key = lambda r: tuple((v is None, v) for v in r[1:])
    for r in data:
        if r[0] not in best or key(r) < key(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=lambda t: tuple((v is not None, v) for v in t))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.integers(-3, 3)),
                          st.sampled_from(["x", "y", None])), max_size=25),
       st.integers(1, 5))
def test_matches_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, "k string, v int, w string").repartition(parts)
    assert rows(keep_first(df, "k")) == brute_force(data)


def test_map_columns_are_ordered_by_their_entries(spark):
    df = spark.sql("SELECT * FROM VALUES ('A', map('y', 2)), ('A', map('x', 9, 'y', 1)) AS t(k, m)")
    assert keep_first(df, "k").first()["m"] == {"x": 9, "y": 1}
    nested = spark.sql("SELECT 'A' AS k, array(map('x', 1)) AS m, 1 AS o")
    with pytest.raises(ValueError, match="no order"):
        keep_first(nested, "k")
    assert keep_first(nested, "k", order_by="o", unique_order=True).count() == 1


def test_unique_order_sorts_only_the_stated_columns(spark):
    df = spark.createDataFrame([("A", 2, "long text"), ("A", 1, "other")], "k string, o int, v string")
    out = keep_first(df, "k", order_by="o", unique_order=True)
    assert rows(out) == [("A", 1, "other")]
    sorts = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if " Sort [" in x]
    assert sorts and all("v#" not in x for x in sorts)
    with pytest.raises(ValueError):
        keep_first(df, "k", unique_order=True)

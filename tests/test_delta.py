import pytest

from quarry.operators.delta import DuplicateKeyError, assert_unique, changed_rows
from tests.conftest import rows

SCHEMA = "k int, v string"


def frames(spark):
    source = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None), (5, "x")], SCHEMA)
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], SCHEMA)
    return source, target


def test_null_safe_rule(spark):
    s, t = frames(spark)
    assert rows(changed_rows(s, t, "k"), "k") == [(2,), (3,), (5,)]


def test_null_as_changed_rule(spark):
    s, t = frames(spark)
    assert rows(changed_rows(s, t, "k", rule="null_as_changed"), "k") == [(3,), (4,), (5,)]


def test_output_is_source_values(spark):
    s, t = frames(spark)
    assert rows(changed_rows(s, t, "k")) == [(2, None), (3, "c"), (5, "x")]


def test_change_set_against_itself_is_empty(spark):
    s, _ = frames(spark)
    assert changed_rows(s, s, ["k"]).isEmpty()


def test_duplicate_key_fails_with_count(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA)
    with pytest.raises(DuplicateKeyError, match="1 key values repeat, covering 2 rows"):
        assert_unique(t, "k", "target")


def test_bad_rule_or_column(spark):
    s, t = frames(spark)
    with pytest.raises(ValueError):
        changed_rows(s, t, "k", rule="nope")
    with pytest.raises(ValueError):
        changed_rows(s, t, "k", ["missing"])


def test_unique_check_for_both_sides_in_one_job(spark):
    from quarry.operators.delta import assert_unique_sides
    s = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (3, "e")], SCHEMA)
    assert_unique_sides({"source": s}, "k")
    with pytest.raises(DuplicateKeyError, match="target: 2 key values repeat, covering 4 rows"):
        assert_unique_sides({"source": s, "target": t}, "k")


def test_null_keys_equal_null_keys(spark):
    s = spark.createDataFrame([(None, "a"), (1, None), (2, "b")], SCHEMA)
    assert changed_rows(s, s, "k").isEmpty()
    t = spark.createDataFrame([(None, "z"), (1, None)], SCHEMA)
    assert rows(changed_rows(s, t, "k")) == [(None, "a"), (2, "b")]
    with pytest.raises(DuplicateKeyError, match="covering 2 rows"):
        assert_unique(s.union(spark.createDataFrame([(None, "c")], SCHEMA)), "k")


def test_tables_of_keys_only_find_new_rows(spark):
    s, t = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,)], "k int")
    for rule in ("null_safe", "null_as_changed"):
        assert rows(changed_rows(s, t, "k", rule=rule)) == [(None,), (2,)]

"""Rows that cannot have one of the keys are told before a shuffle, and the joins after it give the same."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators.delta import changed_rows, upsert_rows
from quarry.operators.key_filter import key_bitmap, split_by_keys
from quarry.operators.staging import stage
from quarry.sinks.files import write_update


def test_no_key_is_lost_and_few_others_stay(spark):
    big = spark.range(200_000).withColumn("odd `.` name", F.col("id") * 2)
    some = spark.range(0, 200_000, 97).select("id")
    may, cannot = split_by_keys(big, some, ["id"])
    assert may.columns == big.columns == cannot.columns
    assert may.join(some, "id").count() == some.count()
    assert may.count() + cannot.count() == 200_000 and may.count() < some.count() * 1.1
    assert key_bitmap(some, ["id"]).count() <= 4096
    for empty in (big.limit(0), ):
        assert [d.count() for d in split_by_keys(empty, some, ["id"])] == [0, 0]
        assert [d.count() for d in split_by_keys(big, empty.select("id"), ["id"])] == [0, 200_000]


def test_nulls_zeros_and_texts(spark):
    schema = "a double, b string"
    big = spark.createDataFrame([(0.0, "x"), (None, "x"), (None, None), (1.5, ""), (float("nan"), "é😀"), (2.0, None)], schema)
    some = spark.createDataFrame([(-0.0, "x"), (None, None), (float("nan"), "é😀")], schema)
    may, cannot = split_by_keys(big, some, ["a", "b"])
    assert may.count() == 3 and sorted(rows(cannot), key=str) == sorted([(None, "x"), (1.5, ""), (2.0, None)], key=str)
    with pytest.raises(ValueError, match="types"):
        split_by_keys(big, some.select(F.col("a").cast("float").alias("a"), "b"), ["a"])


def sides(spark):
    target = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") % 7).alias("v"), F.lit("n").alias("note"))
    source = spark.range(0, 5600, 50).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    return source, target


def test_change_set_and_merge_are_the_same(spark):
    source, target = sides(spark)
    for rule in ("null_safe", "null_as_changed"):
        assert rows(changed_rows(source, target, "k", ["v"], rule, key_filter=True)) == rows(changed_rows(source, target, "k", ["v"], rule))
    delta = changed_rows(source, target, "k", ["v"])
    got = upsert_rows(target, delta, "k", ["v"], key_filter=True)
    assert got.columns == target.columns and rows(got) == rows(upsert_rows(target, delta, "k", ["v"]))


@pytest.mark.parametrize("keep_missing", [True, False])
def test_update_with_and_without(spark, tmp_path, keep_missing):
    source, target = (stage(df, "side").df for df in sides(spark))
    out = []
    for on in (True, False):
        path = str(tmp_path / str(on))
        res = write_update(source, target, "k", ["v"], path, keep_missing=keep_missing, key_filter=on)
        out.append((res.rows_written, res.details, rows(spark.read.parquet(path))))
    assert out[0] == out[1]


def test_shuffled_rows_follow_the_delta(spark):
    """The exchange above the target takes the rows that passed the bitmap, not the table."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for sides too large to broadcast
    try:
        target = stage(spark.range(100_000).select("id", (F.col("id") % 7).alias("v")), "target").df
        delta = stage(spark.range(0, 100_000, 1000).select("id", F.lit(9).cast("long").alias("v")), "delta").df

        def shuffled(key_filter):
            got = upsert_rows(target, delta, "id", ["v"], key_filter=key_filter)
            assert got.where("v = 9").count() == 100
            plan = got._jdf.queryExecution()
            got._jdf.queryExecution().toRdd().count()
            total, todo = 0, [plan.executedPlan()]
            while todo:
                node = todo.pop()
                name = node.getClass().getSimpleName()
                if name == "AdaptiveSparkPlanExec":
                    todo.append(node.executedPlan())
                    continue
                if name.endswith("QueryStageExec"):
                    todo.append(node.plan())
                    continue
                if name == "ShuffleExchangeExec":
                    total += node.metrics().get("shuffleRecordsWritten").get().value()
                below = node.children()
                todo += [below.apply(i) for i in range(below.size())]
            return total

        assert shuffled(False) >= 100_000
        assert shuffled(True) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

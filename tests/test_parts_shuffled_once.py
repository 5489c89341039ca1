"""An update of a table in parts shuffles the source and the parts it compares once; the same for a new table."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators.delta import DuplicateKeyError, duplicate_keys
from quarry.sinks import partitions
from quarry.sinks.partitions import create_partitioned, read_partitioned, update_partitioned
from tests.conftest import rows


def shuffled(df) -> int:
    """Rows that the shuffles of ``df`` write when it is computed."""
    plan = df._jdf.queryExecution()
    plan.toRdd().count()
    total, todo = 0, [plan.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().get("shuffleRecordsWritten").get().value()
            below = node.children()
            todo += [below.apply(i) for i in range(below.size())]
    return total


def test_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    counts, inner = [], {n: getattr(partitions, n) for n in ("stage", "_write_parts", "assert_unique")}

    def stage(df, name, *folder):
        if not folder:  # else it is what _write_parts was given
            counts.append(shuffled(df))
        return inner["stage"](df, name, *folder)

    def write_parts(df, *args):
        counts.append(shuffled(df))
        return inner["_write_parts"](df, *args)

    def assert_unique(df, key, what):
        counts.append(shuffled(duplicate_keys(df, key)))
        return inner["assert_unique"](df, key, what)

    for f in (stage, write_parts, assert_unique):
        monkeypatch.setattr(partitions, "_write_parts" if f is write_parts else f.__name__, f)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for sides too large to broadcast
    try:
        path, table = str(tmp_path / "t"), spark.range(3000).select("id", (F.col("id") % 7).alias("v"))
        create_partitioned(table, path, "id", 8)
        assert sum(counts) <= 3000
        counts.clear()
        res = update_partitioned(table.withColumn("v", F.col("v") + (F.col("id") % 3 == 0).cast("int")), path, "id", ["v"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert res.rows_written == 1000 and res.details["parts"] == list(range(8)) and sum(counts) <= 6000


def test_parts_that_were_compared_in_vain_stay(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    table = spark.createDataFrame([(i, f"v{i}") for i in range(90)], schema)
    create_partitioned(table, path, "k", 4)
    res = update_partitioned(spark.createDataFrame([(i, "new" if i == 7 else f"v{i}") for i in range(80)], schema), path, "k", ["v"])
    assert res.details["compared"] == [0, 1, 2, 3] and len(res.details["parts"]) == 1 and res.rows_written == 1
    new = [d for d in glob.glob(f"{path}/data-*") if len(glob.glob(f"{d}/__part=*")) < 4]
    assert len(new) == 1 and [os.path.basename(p) for p in glob.glob(f"{new[0]}/__part=*")] == [f"__part={res.details['parts'][0]}"]
    got = read_partitioned(spark, path)
    assert got.columns == ["k", "v"] and dict(rows(got)) == {i: "new" if i == 7 else f"v{i}" for i in range(90)}


def test_repeated_keys_leave_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    table = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], schema)
    with pytest.raises(DuplicateKeyError, match="2 key values repeat, covering 5 rows"):
        create_partitioned(table.union(table.where("k IS NULL OR k = 1")).union(table.where("k = 1")), path, "k", 4)
    assert not glob.glob(f"{path}/data-*")
    create_partitioned(table, path, "k", 4)
    more = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], schema)
    with pytest.raises(DuplicateKeyError, match="source: 1 key values repeat, covering 2 rows"):
        update_partitioned(more, path, "k", ["v"])
    assert len(glob.glob(f"{path}/data-*")) == 1 and read_partitioned(spark, path).count() == 3


def test_a_part_is_more_than_one_task(spark):
    slots = spark.range(4000).select(*[c.alias(n) for n, c in partitions._dealt(["id"], 8).items()])
    assert slots.where(F.col(partitions.PART) != F.col(partitions._SLOT) % 8).count() == 0
    assert slots.distinct().count() == 8 * partitions._SLOTS

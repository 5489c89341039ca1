"""An update shuffles each side once, and gives what the change set and the upsert give in two joins."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.delta import DuplicateKeyError, duplicate_keys
from quarry.operators.staging import stage
from quarry.sinks import files
from quarry.sinks.files import write_parquet, write_update
from tests.conftest import rows

TARGET = "a int, b string, v double, w string, note string"
SOURCE = "a int, b string, v double, w string"


def sides(spark):
    target = [(i, None if i % 9 == 0 else f"k{i % 4}", None if i % 5 == 0 else i / 2, f"w{i}", f"n{i}") for i in range(60)]
    target += [(None, None, 1.0, "x", "n"), (None, "k", 0.0, None, "n")]
    source = [(a, b, (v, -1.0, None)[i % 3], w) for i, (a, b, v, w, _) in enumerate(target) if i % 7] + [(900, "new", 1.0, "w"), (None, "new", None, None)]
    return (stage(spark.createDataFrame(*x), "side").df for x in ((source, SOURCE), (target, TARGET)))


@pytest.mark.parametrize("rule", ["null_safe", "null_as_changed"])
@pytest.mark.parametrize("keep_missing", [True, False])
def test_one_pass_gives_the_same(spark, tmp_path, rule, keep_missing):
    source, target = sides(spark)
    for columns in (["v", "w"], ["w"]):
        got = []
        for one_pass in (True, False):
            path = str(tmp_path / f"{len(columns)}-{one_pass}")
            res = write_update(source, target, ["a", "b"], columns, path, keep_missing, rule, one_pass=one_pass)
            df = spark.read.parquet(path)
            got.append((res.rows_written, res.details, res.wrote, df.columns, df.dtypes, rows(df)))
        assert got[0] == got[1]


def test_repeated_keys_are_refused_on_either_side(spark, tmp_path):
    source, target = sides(spark)
    more = lambda df, n: df.union(df.where("a = 5 OR a IS NULL AND b IS NULL")).union(df.where("a = 5").limit(n))
    for s, t, says in ((more(source, 1), target, "source: 2 key values repeat, covering 5 rows"),
                       (source, more(target, 0), "target: 2 key values repeat, covering 4 rows"),
                       (more(source, 0), more(target, 1), "source: 2 key values repeat, covering 4 rows; target: 2 key values repeat, covering 5 rows")):
        with pytest.raises(DuplicateKeyError, match=says):
            write_update(s, t, ["a", "b"], ["v", "w"], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_an_update_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    frames, inner = [], files.assert_unique_sides
    monkeypatch.setattr(files, "stage", lambda df, name: frames.append(df) or stage(df, name))
    monkeypatch.setattr(files, "assert_unique_sides",
                        lambda held, key: frames.extend(duplicate_keys(df, key) for df in held.values()) or inner(held, key))
    target = stage(spark.range(3000).select("id", (F.col("id") % 7).alias("v")), "target").df
    source = stage(spark.range(100, 3100).select("id", (F.col("id") % 5).alias("v")), "source").df
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for sides too large to broadcast
    try:
        res = write_update(source, target, "id", ["v"], str(tmp_path / "out"),
                           writer=lambda df, path: frames.append(df) or write_parquet(df, path))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in frames]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3100 and 100 < res.rows_written < 3000
    assert sum(plan.count("Exchange ") for plan in plans) == 1

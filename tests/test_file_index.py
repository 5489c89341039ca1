"""Lookups open the files that can hold the value and lose no row, whatever the index knows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.plans.reports import lookup
from quarry.sources.file_index import FileIndexError, files_with, read_equal, refresh_index


def table(spark, path, n=4000, files=16, by="k"):
    df = spark.range(n).select(F.when(F.col("id") % 500 != 3, F.concat(F.lit("v"), F.col("id") % 400)).alias("k"), "id")
    df.repartition(files, by).write.mode("append").parquet(path)
    return df


def test_few_files_are_opened(spark, tmp_path):
    path, index = str(tmp_path / "t + %20"), str(tmp_path / "i")
    df = table(spark, path)
    every = files_with(spark, path, index, "v7")
    assert len(every) > 8 and rows(read_equal(spark, path, "k", index, "v7")) == rows(df.where("k = 'v7'"))
    assert refresh_index(spark, path, "k", index) == len(every) and refresh_index(spark, path, "k", index) == 0
    for value in ("v7", "v399", None):
        got = read_equal(spark, path, "k", index, value)
        assert rows(got) == rows(df.where(F.col("k").eqNullSafe(F.lit(value)))) != []
        assert len(files_with(spark, path, index, value)) <= 3 and len(got.inputFiles()) <= 3
    assert files_with(spark, path, index, "absent") == [] and rows(read_equal(spark, path, "k", index, "absent")) == []
    names = spark.createDataFrame([("v7", "seven")], "name string, text string")
    found = lookup(read_equal(spark, path, "k", index, "v7"), names, "k", "name", "v7", {"id": "id", "text": "text"})
    assert rows(found) == [(7, "seven")]


def test_files_the_index_does_not_know_are_read(spark, tmp_path):
    path, index = str(tmp_path / "t"), str(tmp_path / "i")
    table(spark, path)
    refresh_index(spark, path, "k", index)
    spark.createDataFrame([("v7", 90_000), ("late", 90_001)], "k string, id long").coalesce(1).write.mode("append").parquet(path)
    assert rows(read_equal(spark, path, "k", index, "late")) == [("late", 90_001)]
    assert read_equal(spark, path, "k", index, "v7").count() == 11
    assert refresh_index(spark, path, "k", index) == 1
    assert len(files_with(spark, path, index, "late")) == 1


def test_ranges_tell_where_bitmaps_are_full(spark, tmp_path):
    path, index = str(tmp_path / "t"), str(tmp_path / "i")
    spark.range(0, 400_000, 1, 4).write.parquet(path)  # 100,000 values a file
    refresh_index(spark, path, "id", index)
    assert len(files_with(spark, path, index, 250_000)) == 1
    assert rows(read_equal(spark, path, "id", index, 250_000)) == [(250_000,)]
    with pytest.raises(FileIndexError, match="no bigint"):
        read_equal(spark, path, "id", index, 2.5)


def test_an_index_of_another_column_is_refused(spark, tmp_path):
    path, index = str(tmp_path / "t"), str(tmp_path / "i")
    table(spark, path)
    refresh_index(spark, path, "k", index)
    table(spark, path)
    with pytest.raises(FileIndexError, match="index of k"):
        refresh_index(spark, path, "id", index)

import pytest
from pyspark.sql import functions as F

from quarry.operators.clean import (
    drop_any_null, keep_columns, lift_field, rename, require,
)
from tests.conftest import rows


def test_required_not_blank_keeps_space_and_value(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, " "), (4, "x")], "k int, v string")
    assert rows(require(df, ["v"]), "k") == [(3,), (4,)]
    assert rows(require(df, ["v"], trim=True), "k") == [(4,)]


def test_required_non_text_column_is_null_test(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert rows(require(df, ["v"]), "k") == [(2,)]


def test_drop_any_null_counts_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, v double")
    assert rows(drop_any_null(df), "k") == [(1,)]
    assert rows(drop_any_null(df, ["k"]), "k") == [(1,), (2,), (3,)]


def test_rename_and_errors(spark):
    df = spark.createDataFrame([(1, 2.0)], "`Country` int, `Avg(Mbit/s)Ookla` double")
    out = rename(df, {"Country": "country", "Avg(Mbit/s)Ookla": "avg_mbit_per_s_ookla"})
    assert out.columns == ["country", "avg_mbit_per_s_ookla"]
    with pytest.raises(ValueError):
        rename(df, {"nope": "x"})
    with pytest.raises(ValueError):
        keep_columns(df, ["missing"])


def test_lift_field_struct_and_plain(spark):
    nested = spark.createDataFrame([(("a1",), "X")], "_id struct<oid:string>, country string")
    out = lift_field(nested, "_id", "oid", "id")
    assert out.columns == ["country", "id"] and out.first()["id"] == "a1"
    plain = spark.createDataFrame([("a2", "X")], "_id string, country string")
    assert lift_field(plain, "_id", "oid", "id").first()["id"] == "a2"


def test_filters_reach_the_parquet_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(10).select(F.col("id"), F.col("id").cast("string").alias("s"),
                           F.lit(1).alias("extra")).write.parquet(p)
    plan = require(spark.read.parquet(p).select("id", "s"), ["s"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(s), Not(EqualTo(s,))]" in plan
    assert "extra" not in plan


def test_csv_inference_and_documents_inference(spark, tmp_path):
    from quarry.sources.files import read_csv, read_documents
    (tmp_path / "a.csv").write_text("Country,Avg(Mbit/s)Ookla\nA,1.5\nB,2\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), infer=True)
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields) == {
        "Country": "string", "Avg(Mbit/s)Ookla": "double"}
    (tmp_path / "d.json").write_text('{"_id": {"oid": "x1"}, "country": "A"}\n')
    docs = read_documents(spark, str(tmp_path / "d.json"))
    assert lift_field(docs, "_id", "oid", "id").first()["id"] == "x1"

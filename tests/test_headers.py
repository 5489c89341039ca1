import gzip

import pytest

from conftest import rows
from quarry.sources.headers import HeaderError, header_lines, read_csv_folder

SCHEMA = "k bigint, name string, v double"


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_orders_and_sets_of_columns(spark, tmp_path):
    path = land(tmp_path / "in", a="k,name,v\n1,x,1.5\n2,,bad\n", b='name,extra,v,k\n"a,b",q,2,3\n', c="v,k,name\n4,4,z\n", d="k,name,v\n5,w,5\n")
    (tmp_path / "in" / "odd [name] é%20.csv").write_text("\n  \nname,k,v\nn,6,6\n", encoding="utf-8")
    with gzip.open(tmp_path / "in" / "e.csv.gz", "wt") as f:
        f.write("v,name,k\n7,g,7\n")
    assert rows(read_csv_folder(spark, path, SCHEMA)) == [
        (1, "x", 1.5), (2, None, None), (3, "a,b", 2.0), (4, "z", 4.0), (5, "w", 5.0), (6, "n", 6.0), (7, "g", 7.0)]
    assert sorted(len(f) for f in header_lines(spark, path).values()) == [1, 1, 1, 1, 2]


def test_columns_a_file_lacks(spark, tmp_path):
    path = land(tmp_path / "in", a="k,name,v\n1,x,1\n", b="k,name\n2,y\n")
    with pytest.raises(HeaderError, match="b.csv"):
        read_csv_folder(spark, path, SCHEMA)
    assert rows(read_csv_folder(spark, path, SCHEMA, optional=["v"])) == [(1, "x", 1.0), (2, "y", None)]


def test_files_without_rows(spark, tmp_path):
    assert rows(read_csv_folder(spark, land(tmp_path / "in", a="", b="\n\n"), SCHEMA)) == []
    assert rows(read_csv_folder(spark, land(tmp_path / "in", c="v,k,name\n"), SCHEMA)) == []


def test_headers_are_found_in_long_files_and_settings_stay(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = land(tmp_path / "in", a="k,name,v\n" + "1,x,1\n" * 300_000, b="name,k,v\n" + "y,2,2\n" * 200_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)  # each file in several splits
    try:
        got = read_csv_folder(spark, path, SCHEMA).groupBy("k", "name", "v").count()
        assert rows(got) == [(1, "x", 1.0, 300_000), (2, "y", 2.0, 200_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

import glob
import os

from quarry.operators.staging import broadcast_if_small, collected, stage
from quarry.session import shared_dir, ship_package


def test_broadcast_is_decided_on_rows_in_memory_not_on_file_size(spark):
    # One long text a thousand times: a few KB as Parquet, 20 MB in memory.
    df = spark.range(1000).selectExpr("id", "repeat('x', 20000) AS text")
    staged = stage(df, "wide")
    files = glob.glob(staged.path.replace("file:", "") + "/*.parquet")
    assert sum(map(os.path.getsize, files)) < 2_000_000 < 20_000_000 < staged.bytes()
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert not hinted(broadcast_if_small(staged, max_bytes=10_000_000))
    assert hinted(broadcast_if_small(staged, max_bytes=50_000_000))
    assert not hinted(broadcast_if_small(staged, max_rows=999))
    staged.drop()


def test_sizes_cover_nested_columns_and_nulls(spark):
    df = spark.sql("SELECT named_struct('a', repeat('x', 100), 'b', array(repeat('y', 50), NULL)) AS s, "
                   "map('k', repeat('z', 30)) AS m, CAST(NULL AS string) AS n, CAST('12' AS binary) AS b")
    assert 180 < stage(df, "nested").bytes() < 600
    assert stage(df.limit(0), "none").bytes() == 0


def test_collected_tables_can_be_dropped_together(spark):
    at = shared_dir(spark).replace("file:", "") + "/quarry-stage/*"
    before = set(glob.glob(at))
    with collected() as held:
        stage(spark.range(3), "a")
        stage(spark.range(4), "b")
    stage(spark.range(5), "c").drop()
    assert [h.rows() for h in held] == [3, 4]
    for h in held:
        h.drop()
    assert set(glob.glob(at)) == before


def test_the_package_is_sent_to_workers_once(spark):
    ship_package(spark)
    sent = list(spark.sparkContext._python_includes)
    ship_package(spark)
    assert sent == list(spark.sparkContext._python_includes)
    assert sum("quarry-package" in x for x in sent) == 1

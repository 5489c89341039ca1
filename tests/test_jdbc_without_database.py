"""JDBC sink control flow on real Spark, with the database calls replaced.

No database is started anywhere in this repository; these tests patch the
three points where the sink talks to one (the JDBC writer, the count query
and the transaction) and check what would have been sent.
"""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import quarry.sinks.jdbc as jdbc
from tests.conftest import rows

SCHEMA = "k int, v string"
PROPS = {"user": "u", "password": "p", "driver": "org.example.Driver"}


@pytest.fixture
def fake_db(monkeypatch):
    db = {"tables": {}, "statements": [], "count_offset": 0}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        db["tables"][table] = rows(self._df)

    def fake_count(spark, url, properties, sql):
        table = sql.rsplit(" ", 1)[-1]
        return len(db["tables"][table]) + db["count_offset"]

    def fake_tx(spark, url, properties, statements):
        db["statements"].append(list(statements))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    monkeypatch.setattr(jdbc, "_query_scalar", fake_count)
    monkeypatch.setattr(jdbc, "_run_transaction", fake_tx)
    monkeypatch.setattr(jdbc, "_table_exists", lambda spark, url, properties, table: table not in db.get("absent", ()))
    return db


def test_update_stages_only_the_delta_and_merges_in_one_transaction(spark, fake_db):
    t = spark.createDataFrame([(1, "a"), (3, "z"), (9, "t")], SCHEMA)
    s = spark.createDataFrame([(1, "a"), (3, "c"), (5, "x")], SCHEMA)
    res = jdbc.write_update(s, t, "jdbc:x", "public.prices", PROPS, "k", ["k", "v"])
    assert res.wrote and res.rows_written == 2
    (staging, staged_rows), = fake_db["tables"].items()
    assert staging.startswith("public.prices__stage_") and staged_rows == [(3, "c"), (5, "x")]
    (tx,) = fake_db["statements"]
    assert tx[0].startswith("DELETE FROM public.prices t WHERE EXISTS")
    assert tx[1].startswith("INSERT INTO public.prices")
    assert tx[2] == f"DROP TABLE {staging}"


def test_retried_task_duplicates_block_the_merge(spark, fake_db):
    fake_db["count_offset"] = 1  # the staging table holds one row more than the delta
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA)
    with pytest.raises(RuntimeError, match="nothing was merged"):
        jdbc.write_update(s, t, "jdbc:x", "public.prices", PROPS, "k", ["k", "v"])
    # only the clean-up of the staging table was sent, never the merge
    assert all(stmts[0].startswith("DROP TABLE") for stmts in fake_db["statements"])


def test_no_change_sends_nothing(spark, fake_db):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    res = jdbc.write_update(t, t, "jdbc:x", "public.prices", PROPS, "k", ["k", "v"])
    assert not res.wrote and fake_db["tables"] == {} and fake_db["statements"] == []


def test_replace_mode_and_overwrite(spark, fake_db):
    t = spark.createDataFrame([(1, "a"), (9, "t")], SCHEMA)
    s = spark.createDataFrame([(1, "b")], SCHEMA)
    jdbc.write_update(s, t, "jdbc:x", "public.p", PROPS, "k", ["k", "v"], keep_missing=False)
    assert fake_db["statements"][-1][0] == "DELETE FROM public.p"
    res = jdbc.write_overwrite(s, "jdbc:x", "public.p", PROPS)
    assert res.rows_written == 1 and fake_db["statements"][-1][0] == "DELETE FROM public.p"


def test_overwrite_creates_an_absent_table_and_refuses_an_empty_result(spark, fake_db):
    s = spark.createDataFrame([(1, "b")], SCHEMA)
    fake_db["absent"] = {"public.new"}
    jdbc.write_overwrite(s, "jdbc:x", "public.new", PROPS)
    assert fake_db["tables"]["public.new"] == []  # created without rows; the transaction fills it
    assert fake_db["statements"][-1][1].startswith("INSERT INTO public.new")
    with pytest.raises(jdbc.EmptyResultError):
        jdbc.write_overwrite(s.limit(0), "jdbc:x", "public.p", PROPS, allow_empty=False)


def test_replace_mode_sends_deletions_alone(spark, fake_db):
    t = spark.createDataFrame([(1, "a"), (9, "t")], SCHEMA)
    res = jdbc.write_update(t.where("k = 1"), t, "jdbc:x", "public.p", PROPS, "k", ["k", "v"], keep_missing=False)
    assert res.wrote and res.details["rows_removed"] == 1 and fake_db["statements"][-1][0] == "DELETE FROM public.p"


def test_partitioned_read_needs_bounds(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader

    from quarry.sources.jdbc import read_table
    calls = []
    monkeypatch.setattr(DataFrameReader, "jdbc",
                        lambda self, url, table, **kw: calls.append((table, kw)) or "df")
    with pytest.raises(ValueError):
        read_table(spark, "jdbc:x", "public.t", PROPS, partition_column="id")
    assert read_table(spark, "jdbc:x", "public.t", PROPS, partition_column="id",
                      lower_bound=0, upper_bound=100, num_partitions=4) == "df"
    (table, kw), = calls
    assert kw["numPartitions"] == 4 and kw["column"] == "id"
    assert kw["properties"]["fetchsize"] == "10000"

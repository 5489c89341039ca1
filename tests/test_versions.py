"""Tables in hash partitions: versions, digests of parts, and what a job that dies leaves."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators.delta import DuplicateKeyError
from quarry.operators.digests import SUMS, digests
from quarry.sinks import partitions, versions
from quarry.sinks.files import EmptyResultError
from quarry.sinks.partitions import (LayoutError, create_partitioned, overwrite_partitioned, read_partitioned,
                                     update_partitioned, vacuum)

SCHEMA = "k int, v string"


def numbers(spark, n=200, change=None):
    """Keys 0 to n - 1 with texts; ``change`` maps some keys to other texts."""
    return spark.createDataFrame([(i, (change or {}).get(i, f"v{i % 7}")) for i in range(n)], SCHEMA)


def spoil(spark, path, but=()):
    """Overwrite the data files of all parts with noise, except for parts ``but``."""
    for f in glob.glob(f"{path}/data-*/__part=*/*.parquet"):
        if int(f.split("__part=")[1].split("/")[0]) not in but:
            with open(f, "wb") as out:
                out.write(b"no parquet")
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.remove(crc)


def test_a_run_without_changes_reads_no_row_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    create_partitioned(numbers(spark), path, "k", 16)
    spoil(spark, path)
    with pytest.raises(Exception, match="[Pp]arquet|PARQUET|FAILED_READ"):
        read_partitioned(spark, path).collect()
    for keep_missing in (True, False):
        res = update_partitioned(numbers(spark).repartition(3), path, "k", ["v"], keep_missing=keep_missing)
        assert not res.wrote and res.rows_read == 200 and res.rows_written == 0 and res.details["compared"] == []
    assert versions.versions(spark, path) == [1]


def test_only_parts_whose_digest_differs_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    create_partitioned(numbers(spark), path, "k", 16)
    s = numbers(spark, change={7: "new", 8: None})
    part = {r["k"]: r[partitions.PART] for r in s.select("k", partitions._part(["k"], 16)).collect()}
    spoil(spark, path, but={part[7], part[8]})
    res = update_partitioned(s, path, "k", ["v"])
    assert res.wrote and res.rows_written == 2 and res.details["compared"] == res.details["parts"] == sorted({part[7], part[8]})
    current = partitions._current(spark, path)[1]
    assert rows(partitions._rows_of(spark, path, current, {part[7], part[8]})) == rows(s.where(F.col("k").isin(
        [k for k, p in part.items() if p in (part[7], part[8])])))
    # A part that the source lacks is read for deletions only where those were asked for.
    few = s.where(partitions._part(["k"], 16) == part[7])
    assert update_partitioned(few, path, "k", ["v"]).details["compared"] == []


def test_updates_that_digests_cannot_answer_read_the_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = numbers(spark).withColumn("note", F.lit("n"))
    create_partitioned(wide, path, "k", 8)
    res = update_partitioned(numbers(spark), path, "k", ["v"])  # not every column
    assert res.details["compared"] == list(range(8)) and not res.wrote and res.rows_read == 200
    res = update_partitioned(wide, path, "k", ["v", "note"], rule="null_as_changed")
    assert res.details["compared"] == list(range(8)) and not res.wrote
    assert update_partitioned(wide, path, "k", ["v", "note"]).details["compared"] == []
    maps = numbers(spark).withColumn("m", F.create_map(F.lit("a"), F.col("k")))
    create_partitioned(maps, str(tmp_path / "m"), "k", 4)  # maps have no hash
    assert read_partitioned(spark, str(tmp_path / "m")).count() == 200
    res = update_partitioned(numbers(spark, change={3: "x"}), str(tmp_path / "m"), "k", ["v"])
    assert res.rows_written == 1 and res.details["compared"] == [0, 1, 2, 3]
    assert {r["k"]: r["m"] for r in read_partitioned(spark, str(tmp_path / "m")).collect()} == {i: {"a": i} for i in range(200)}


def digest_of(spark, data, schema="p int, x string, y string"):
    df = spark.createDataFrame(data, schema)
    return [tuple(r[n] for n in ("p", "rows", *SUMS)) for r in digests(df, "p", df.columns[1:]).orderBy("p").collect()]


def test_digests_tell_groups_apart_and_not_orders(spark):
    base = [(1, "a", "b"), (1, "c", "d"), (1, None, "e")]
    want = digest_of(spark, base)
    assert digest_of(spark, base[::-1]) == want
    others = [[(1, "a", "d"), (1, "c", "b"), (1, None, "e")],  # values swapped between rows
              [(1, "b", "a"), (1, "c", "d"), (1, None, "e")],  # and between columns
              [(1, "a", "b"), (1, "c", "d"), (1, "e", None)], base + base[:1],
              [(1, "a", "b"), (1, "a", "b"), (1, None, "e")], [(1, "ab", ""), (1, "c", "d"), (1, None, "e")]]
    assert len({str(digest_of(spark, o)) for o in others} | {str(want)}) == len(others) + 1
    assert digest_of(spark, []) == []
    same = [digest_of(spark, [(1, v)], "p int, x double") for v in (0.0, -0.0)]
    assert same[0] == same[1] != digest_of(spark, [(1, None)], "p int, x double")


def test_forced_collisions_change_nothing_without_trust(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quarry.operators.digests.row_hash", lambda columns, seed: F.lit(5).cast("long"))
    path = str(tmp_path / "t")
    create_partitioned(numbers(spark), path, "k", 4)
    s = numbers(spark, change={9: "new"})
    assert not update_partitioned(s, path, "k", ["v"]).wrote  # what a collision would do
    assert update_partitioned(s, path, "k", ["v"], trust_digests=False).rows_written == 1
    assert rows(read_partitioned(spark, path)) == rows(s)


STEPS = ["stage", "_write_parts", "_digests_of", "_commit", "_rows_of", "assert_unique"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_job_that_dies_leaves_the_whole_old_or_the_whole_new_table(spark, tmp_path, monkeypatch, step, after):
    path, old = str(tmp_path / "t"), numbers(spark, 60)
    new = numbers(spark, 80, change={1: "x", 33: "y"}).where("k <> 5")
    create_partitioned(old, path, "k", 4)
    inner = getattr(partitions, step)

    def die(*args, **more):
        if after:
            inner(*args, **more)
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as m:
        m.setattr(partitions, step, die)
        with pytest.raises(KeyboardInterrupt):
            update_partitioned(new, path, "k", ["v"], keep_missing=False)
    assert rows(read_partitioned(spark, path)) == rows(new if step == "_commit" and after else old)
    update_partitioned(new, path, "k", ["v"], keep_missing=False)  # run again
    vacuum(spark, path)
    assert rows(read_partitioned(spark, path)) == rows(new)
    used = {p["folder"] for p in partitions._current(spark, path)[1]["held"].values()}
    assert {f"{os.path.basename(os.path.dirname(f))}/{os.path.basename(f)}" for f in glob.glob(f"{path}/data-*/__part=*")} == used


def test_the_second_of_two_writers_fails_and_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_partitioned(numbers(spark, 40), path, "k", 4)
    inner = partitions._commit

    def other_first(*args):
        monkeypatch.setattr(partitions, "_commit", inner)
        update_partitioned(numbers(spark, 40, change={2: "other"}), path, "k", ["v"])
        inner(*args)

    monkeypatch.setattr(partitions, "_commit", other_first)
    with pytest.raises(versions.CommitConflictError):
        update_partitioned(numbers(spark, 40, change={2: "own"}), path, "k", ["v"])
    assert rows(read_partitioned(spark, path)) == rows(numbers(spark, 40, change={2: "other"}))
    assert len(glob.glob(f"{path}/data-*")) == 2 and versions.versions(spark, path) == [1, 2]
    assert sorted(os.listdir(f"{path}/_versions")) == sorted(x for n in (1, 2) for x in (f"{n:012d}.json", f".{n:012d}.json.crc"))


def test_versions_stay_readable_until_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    create_partitioned(numbers(spark, 30), path, "k", 4)
    reader = read_partitioned(spark, path)
    assert update_partitioned(numbers(spark, 30, change={1: "x"}), path, "k", ["v"]).details["version"] == 2
    res = overwrite_partitioned(numbers(spark, 10), path)
    assert (res.rows_read, res.rows_written, res.details["version"]) == (10, 10, 3)
    assert rows(reader) == rows(read_partitioned(spark, path, 1)) == rows(numbers(spark, 30))
    assert rows(read_partitioned(spark, path, 2)) == rows(numbers(spark, 30, change={1: "x"}))
    assert vacuum(spark, path, keep=2) == 1  # the part that version 2 replaced
    assert rows(read_partitioned(spark, path, 2)) == rows(numbers(spark, 30, change={1: "x"}))
    vacuum(spark, path)
    assert rows(read_partitioned(spark, path)) == rows(numbers(spark, 10)) and len(glob.glob(f"{path}/data-*")) == 1
    with pytest.raises(LayoutError):
        read_partitioned(spark, path, 1)


def test_what_a_partitioned_table_refuses(spark, tmp_path):
    path, none = str(tmp_path / "t"), numbers(spark, 0)
    with pytest.raises(EmptyResultError):
        create_partitioned(none, path, "k", 4, allow_empty=False)
    create_partitioned(none, str(tmp_path / "none"), "k", 4)
    assert rows(read_partitioned(spark, str(tmp_path / "none"))) == []
    assert update_partitioned(numbers(spark, 3), str(tmp_path / "none"), "k", ["v"]).rows_written == 3
    assert update_partitioned(none, str(tmp_path / "none"), "k", ["v"], keep_missing=False).details["rows_removed"] == 3
    assert read_partitioned(spark, str(tmp_path / "none")).columns == ["k", "v"]
    create_partitioned(numbers(spark, 5), path, "k", 4)
    with pytest.raises(LayoutError):
        create_partitioned(numbers(spark, 5), path, "k", 4)
    with pytest.raises(EmptyResultError):
        overwrite_partitioned(none, path, allow_empty=False)
    with pytest.raises(LayoutError, match="cast the source"):
        update_partitioned(numbers(spark, 5).withColumn("k", F.col("k").cast("double")), path, "k", ["v"])
    with pytest.raises(LayoutError, match="exist"):
        update_partitioned(numbers(spark, 5), path, "k", ["w"])
    with pytest.raises(DuplicateKeyError):
        update_partitioned(numbers(spark, 5).union(numbers(spark, 1, change={0: "x"})), path, "k", ["v"])
    small = numbers(spark, 5, change={1: "x"}).withColumn("k", F.col("k").cast("short"))  # widened
    assert update_partitioned(small, path, "k", ["v"]).rows_written == 1
    assert rows(read_partitioned(spark, path)) == rows(numbers(spark, 5, change={1: "x"}))

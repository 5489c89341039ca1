"""Payload files taken once: the ledger and the table's rows change in one step."""

import json

import pytest

from conftest import rows
from quarry.operators.delta import DuplicateKeyError
from quarry.operators.staging import stage
from quarry.sinks import landed, partitions, versions
from quarry.sinks.landed import ledger, update_from_landed
from quarry.sinks.partitions import create_partitioned, overwrite_partitioned, read_partitioned, update_partitioned, vacuum
from quarry.sources.delimited import read_payloads


@pytest.fixture
def place(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    create_partitioned(spark.createDataFrame([], "k string, v string"), table, "k", 4)
    opened = []

    def land(name, *lines):
        (folder / name).write_text(json.dumps(["k,v", *lines]), encoding="utf-8")

    def take(rows_of=None):
        def plan(paths):
            opened.append(sorted(p.rsplit("/", 1)[1] for p in paths))
            return read_payloads(spark, paths, ["k", "v"])
        return update_from_landed(spark, str(folder), table, rows_of or plan, ["v"])

    take.opened, take.folder = opened, folder
    return land, take, table


def test_each_file_is_taken_once(spark, place):
    land, take, table = place
    land("a [1].json", "1,x", "2,y")
    land("b%20é.json", "3,z")
    res = take()
    assert (res.rows_read, res.rows_written, res.wrote, res.details["files"], res.details["run"]) == (3, 3, True, 2, 1)
    res = take()
    assert (res.rows_read, res.wrote, res.details["files"]) == (0, False, 0) and versions.versions(spark, table) == [1, 2]
    land("c.json", "2,new", "4,w")
    assert take().rows_read == 2
    assert take.opened == [["a \\[1\\].json", "b%20é.json"], ["c.json"]]
    assert rows(read_partitioned(spark, table)) == [("1", "x"), ("2", "new"), ("3", "z"), ("4", "w")]
    assert sorted((r["path"].rsplit("/", 1)[1], r["run"]) for r in ledger(spark, table).collect()) == [
        ("a [1].json", 1), ("b%20é.json", 1), ("c.json", 2)]


def test_files_that_change_no_row_are_not_read_again(spark, place):
    land, take, table = place
    land("a.json", "1,x")
    take()
    land("b.json", "1,x")
    res = take()
    assert not res.wrote and res.details["files"] == 1 and res.details["version"] == 3
    assert take().details["files"] == 0
    land("a.json", "1,longer than before")  # replaced under its name
    assert take().details["files"] == 1 and rows(read_partitioned(spark, table)) == [("1", "longer than before")]


@pytest.mark.parametrize("where", ["rows_of", "write", "commit"])
def test_a_run_that_dies_leaves_table_and_ledger(spark, place, monkeypatch, where):
    land, take, table = place
    land("a.json", "1,x")
    take()
    before = versions.names_in(spark, table)
    land("b.json", "2,y")

    def die(*a, **k):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        if where == "write":
            m.setattr(partitions, "_write_parts", die)
        if where == "commit":
            m.setattr(versions, "commit", die)
        with pytest.raises(RuntimeError, match="died"):
            take(die if where == "rows_of" else None)
    assert rows(read_partitioned(spark, table)) == [("1", "x")] and ledger(spark, table).count() == 1
    assert [n for n in versions.names_in(spark, table) if n.startswith("landed-")] == [n for n in before if n.startswith("landed-")]
    assert take().rows_written == 1 and take().details["files"] == 0
    assert rows(read_partitioned(spark, table)) == [("1", "x"), ("2", "y")]


def test_a_second_writer_fails_and_its_files_are_taken_later(spark, place):
    land, take, table = place
    land("a.json", "1,x")

    def meanwhile(paths):
        update_partitioned(spark.createDataFrame([("9", "other")], "k string, v string"), table, "k", ["v"])
        return read_payloads(spark, paths, ["k", "v"])

    with pytest.raises(versions.CommitConflictError):
        take(meanwhile)
    assert rows(read_partitioned(spark, table)) == [("9", "other")] and ledger(spark, table).count() == 0
    assert take().rows_written == 1
    assert rows(read_partitioned(spark, table)) == [("1", "x"), ("9", "other")]


def test_keys_in_two_files_of_a_run_are_an_error(spark, place):
    land, take, table = place
    land("a.json", "1,x")
    land("b.json", "1,y")
    with pytest.raises(DuplicateKeyError):
        take()
    assert rows(read_partitioned(spark, table)) == [] and ledger(spark, table).count() == 0


def test_ledger_folders_are_put_together_and_kept(spark, place, monkeypatch):
    land, take, table = place
    monkeypatch.setattr(landed, "MAX_FOLDERS", 2)
    for n in range(4):
        land(f"{n}.json", f"{n},x")
        assert take().details["files"] == 1
    assert len(partitions.note_of(spark, table)[1]["landed"]) == 2  # runs 1 to 3 together, then run 4
    vacuum(spark, table)
    assert len([n for n in versions.names_in(spark, table) if n.startswith("landed-")]) == 2
    overwrite_partitioned(spark.createDataFrame([("0", "only")], "k string, v string"), table)
    assert ledger(spark, table).count() == 4 and take().details["files"] == 0
    assert rows(read_partitioned(spark, table)) == [("0", "only")]


def test_staged_rows_go_and_no_files_are_nothing(spark, place):
    land, take, table = place
    assert take().details["files"] == 0
    land("a.json", "1,x")
    kept = []

    def staged(paths):
        kept.append(stage(read_payloads(spark, paths, ["k", "v"]), "landed-rows"))
        return kept[0].df

    assert take(staged).rows_written == 1
    assert versions.names_in(spark, kept[0].path) == []

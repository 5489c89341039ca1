import pytest

from quarry.plans.jobs import (
    DELIMITED_JOB, DOCUMENT_JOB, FILE_JOB, PRICE_HEADER_MAP, PRICE_NAMES, USER_DOC_SCHEMA,
    run_job,
)
from quarry.plans import jobs
from quarry.sources.delimited import parse_lines, payload_lines
from quarry.sources.files import read_csv
from quarry.specs import InsertMode, TableSpec
from tests.conftest import rows


def test_insert_mode_is_checked_first():
    assert InsertMode.parse("update") is InsertMode.UPDATE
    with pytest.raises(ValueError):
        InsertMode.parse("append")
    with pytest.raises(TypeError):
        InsertMode.parse(None)


def test_bad_mode_fails_before_any_spark_job(spark, tmp_path):
    src = spark.createDataFrame([("A", 1.0)], "`Country` string, `Avg(Mbit/s)Ookla` double")
    with pytest.raises(ValueError):
        run_job(spark, FILE_JOB, src, "append", str(tmp_path / "t"))


def test_empty_source_fails_unless_allowed(spark, tmp_path):
    src = spark.createDataFrame([], "`Country` string, `Avg(Mbit/s)Ookla` double")
    with pytest.raises(ValueError, match="no rows"):
        run_job(spark, FILE_JOB, src, "overwrite", str(tmp_path / "t"))
    res = run_job(spark, FILE_JOB, src, "overwrite", str(tmp_path / "t"), allow_empty=True)
    assert res.rows_written == 0


def test_table_spec_validation():
    with pytest.raises(ValueError):
        TableSpec("t", ("k",), ("a", "b"))
    with pytest.raises(ValueError):
        TableSpec("t", (), ("a",))


def test_file_job_overwrite_then_update(spark, tmp_path):
    src = spark.createDataFrame([("A", 1.0), ("A", 0.5), ("B", None), ("C", 3.0)],
                                "`Country` string, `Avg(Mbit/s)Ookla` double")
    target = str(tmp_path / "speed")
    run_job(spark, FILE_JOB, src, "overwrite", target)
    assert rows(spark.read.parquet(target)) == [("A", 0.5), ("C", 3.0)]
    newer = spark.createDataFrame([("A", 0.5), ("C", 4.0), ("D", 1.0)],
                                  "`Country` string, `Avg(Mbit/s)Ookla` double")
    res = run_job(spark, FILE_JOB, newer, "update", target, out_path=str(tmp_path / "v2"))
    assert res.rows_written == 2
    assert rows(spark.read.parquet(str(tmp_path / "v2"))) == [("A", 0.5), ("C", 4.0), ("D", 1.0)]
    with pytest.raises(ValueError, match="out_path"):
        run_job(spark, FILE_JOB, newer, "update", target)


def test_document_job_hostile_rows(spark, tmp_path):
    docs = [
        '{"_id": {"oid": "1"}, "country": "X", "internet_users": "1,000", "population": "10,000",'
        ' "region": "R", "sub_region": "S"}',
        '{"_id": {"oid": "2"}, "country": "Y", "internet_users": "NA", "population": "3,000",'
        ' "region": "R", "sub_region": "S"}',
        '{"_id": {"oid": "3"}, "country": "", "internet_users": "5", "population": "5",'
        ' "region": "R", "sub_region": "S"}',
        '{"_id": {"oid": "4"}, "country": "Y", "internet_users": "2,000", "population": "1",'
        ' "region": "R", "sub_region": "S"}',
    ]
    path = tmp_path / "docs.json"
    path.write_text("\n".join(docs))
    src = spark.read.schema(USER_DOC_SCHEMA).json(str(path))
    out = DOCUMENT_JOB.plan(src)
    # country Y: id 4 ("2,000") wins over id 2 ("NA", no number)
    assert rows(out) == [("1", "X", 1000, 10000, "R", "S"), ("4", "Y", 2000, 1, "R", "S")]


COLUMNS = "`Country` string, `Avg(Mbit/s)Ookla` double"


def write_csv(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_csv_columns_by_name_and_extra_columns_in_dropna(spark, tmp_path):
    from quarry.plans.jobs import SPEED_CSV_SCHEMA
    from quarry.sources.files import read_csv
    path = write_csv(tmp_path, "a", "Rank,Avg(Mbit/s)Ookla,Country\n1,5.5,X\n,6.5,Y\n3,many,Z\n")
    got = read_csv(spark, path, schema=SPEED_CSV_SCHEMA)
    assert rows(got) == [("X", 5.5), ("Y", 6.5), ("Z", None)] and got.columns == ["Country", "Avg(Mbit/s)Ookla"]
    target = str(tmp_path / "t")
    run_job(spark, FILE_JOB, read_csv(spark, path, schema=SPEED_CSV_SCHEMA, extra=True), "overwrite", target)
    assert rows(spark.read.parquet(target)) == [("X", 5.5)]  # Y has no rank
    with pytest.raises(ValueError, match="no column"):
        read_csv(spark, write_csv(tmp_path, "b", "Rank,Country\n1,X\n"), schema=SPEED_CSV_SCHEMA)


def test_a_result_without_rows_leaves_the_target(spark, tmp_path):
    target = str(tmp_path / "t")
    run_job(spark, FILE_JOB, spark.createDataFrame([("A", 1.0)], COLUMNS), "overwrite", target)
    gone = spark.createDataFrame([("B", None)], COLUMNS)
    for mode in ("overwrite", "update"):
        with pytest.raises(ValueError, match="stays as it is"):
            run_job(spark, FILE_JOB, gone, mode, target, out_path=str(tmp_path / "v2"), keep_missing=False)
    assert rows(spark.read.parquet(target)) == [("A", 1.0)]


@pytest.mark.parametrize("job", [FILE_JOB, DOCUMENT_JOB, DELIMITED_JOB])
def test_a_job_never_overwrites_its_own_source(spark, tmp_path, job):
    from quarry.sinks.files import OwnInputError
    folder = tmp_path / "src"
    folder.mkdir()
    if job is FILE_JOB:
        (folder / "a.csv").write_text("Country,Avg(Mbit/s)Ookla\nA,1.0\n")
        src = spark.read.csv(str(folder), header=True, schema=COLUMNS)
    elif job is DOCUMENT_JOB:
        (folder / "a.json").write_text('{"_id": {"oid": "1"}, "country": "X", "internet_users": "1", "population": "2", "region": "R", "sub_region": "S"}')
        src = spark.read.schema(USER_DOC_SCHEMA).json(str(folder))
    else:
        (folder / "a.txt").write_text("c1,N1,R,3,$1,$2,$3,$4,$5\n")
        src = parse_lines(spark.read.text(str(folder)), PRICE_NAMES)
    before = sorted(p.name for p in folder.iterdir())
    for target in (folder, tmp_path):
        with pytest.raises(OwnInputError):
            run_job(spark, job, src, "overwrite", str(target))
    assert sorted(p.name for p in folder.iterdir()) == before and src.count() == 1


def test_table_target_in_both_modes(spark, tmp_path):
    from quarry.sinks.targets import TableTarget, parse_target
    name = "quarry_test_job_table"
    with pytest.raises(ValueError, match="does not exist"):
        run_job(spark, FILE_JOB, spark.createDataFrame([("A", 1.0)], COLUMNS), "update", TableTarget(name))
    target = TableTarget(name, str(tmp_path / "v1"), buckets=2, key=("country",))
    run_job(spark, FILE_JOB, spark.createDataFrame([("A", 1.0), ("B", 2.0)], COLUMNS), "overwrite", target)
    res = run_job(spark, FILE_JOB, spark.createDataFrame([("B", 3.0), ("C", 4.0)], COLUMNS), "update", parse_target(f"table:{name}"))
    assert res.rows_written == 2 and rows(spark.table(name)) == [("A", 1.0), ("B", 3.0), ("C", 4.0)]
    run_job(spark, FILE_JOB, spark.createDataFrame([("D", 5.0)], COLUMNS), "overwrite", parse_target(f"table:{name}"))
    assert rows(spark.table(name)) == [("D", 5.0)]
    spark.sql(f"DROP TABLE {name}")


def test_a_real_value_beats_a_blank_of_the_same_key(spark, tmp_path):
    lines = spark.createDataFrame([("AA,N,R,3,$1,$1,$1,$1,$1",), ("AA,N,R,3,$,$1,$1,$1,$1",), ("CC,M,R,3,$17,$1,$1,$1,$1",),
                                   ("BB,O,R,7,$1,$1,$1,$1,$1",), ("BB,O,R,,$1,$1,$1,$1,$1",)], "value string")
    out = {r["country_code"]: r for r in DELIMITED_JOB.plan(parse_lines(lines, PRICE_NAMES)).collect()}
    assert out["AA"]["avg_price_1gb_usd"] == 1.0 and out["BB"]["no_internal_plans"] == 7.0


def test_payload_headers_are_skipped_by_position_and_rejects_counted(spark, tmp_path):
    import json

    from quarry.sources.delimited import read_lines, read_payloads
    header = "Country code,Name,anything at all"
    line = "c{0},N{0},R,3,$1.00,$2.00,$3.00,$4.00,$5.00\n"
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.txt").write_text("\n".join(json.dumps([header, line.format(k), line.format(k + 5), "short,line\n"]) for k in (1, 2)))
    src, rejects = read_payloads(spark, str(tmp_path / "p"), PRICE_NAMES, with_rejects=True)
    assert {r[PRICE_NAMES[-1]] for r in src.collect()} == {"$5.00\n"}  # line breaks reach the parser
    res = run_job(spark, DELIMITED_JOB, src, "overwrite", str(tmp_path / "t"), rejects=rejects)
    assert res.rows_written == 4 and res.rows_rejected == 2 and res.rows_read == 4
    assert spark.read.parquet(str(tmp_path / "t")).agg({"avg_1gb_start2020_usd": "max"}).first()[0] == 5.0
    (tmp_path / "l").mkdir()
    for k in (1, 2):
        (tmp_path / "l" / f"{k}.txt").write_text(header + "\n" + line.format(k) + 'c9,"x,y",\x01,"\n')
    good, bad = read_lines(spark, str(tmp_path / "l"), PRICE_NAMES, first_is_header=True, with_rejects=True)
    assert rows(good, "country_code") == [("c1",), ("c2",)] and {r["line"] for r in bad.collect()} == {'c9,"x,y",\x01,"'}


def test_jobs_leave_no_staged_rows(spark, tmp_path):
    import glob

    from quarry.session import shared_dir
    at = shared_dir(spark).replace("file:", "") + "/quarry-stage/*"
    before = set(glob.glob(at))
    lines = spark.createDataFrame([("AA,N,R,3,$1,$1,$1,$1,$1",)], "value string")
    for mode in ("overwrite", "update"):
        run_job(spark, DELIMITED_JOB, parse_lines(lines, PRICE_NAMES), mode, str(tmp_path / "t"), out_path=str(tmp_path / "v2"))
    assert set(glob.glob(at)) == before


def test_delimited_job_hostile_rows(spark):
    header = ",".join(PRICE_HEADER_MAP)
    lines = spark.createDataFrame([
        (header,),
        ("c1,N1,R,3,$1.00,$2.00,$3.00,$4.00,$5.00\n",),
        ("c2,N2,R,,$3.00,$,$5.00,$6.00,$7.00\n",),
        ("c3,N3,,1,$1,$1,$1,$1,$1\n",),
        ("c4,N4,R,1,$1,$1,$1,$1\n",),
    ], "value string")
    out = DELIMITED_JOB.plan(parse_lines(lines, PRICE_NAMES, header=header))
    assert rows(out) == [
        ("c1", "N1", "R", 3.0, 1.0, 2.0, 3.0, 4.0, 5.0),
        ("c2", "N2", "R", 3.0, 3.0, 2.0, 5.0, 6.0, 7.0),
    ]


def test_rows_read_are_the_rows_of_the_source(spark, tmp_path):
    """Counted below the dedupe windows, in the job's own pass, for every job and both modes."""
    d = "/root/testdata/sf0.001"
    lines = parse_lines(payload_lines(jobs.price_payloads(spark, d)), PRICE_NAMES)
    for spec, source in ((jobs.FILE_JOB, read_csv(spark, jobs.speed_csv(spark, d), schema=jobs.SPEED_CSV_SCHEMA)),
                         (jobs.DOCUMENT_JOB, spark.read.json(jobs.user_documents(spark, d))), (jobs.DELIMITED_JOB, lines)):
        path = str(tmp_path / spec.name)
        first = jobs.run_job(spark, spec, source, "overwrite", path)
        again = jobs.run_job(spark, spec, source, "update", path, out_path=path + "-2")
        n = source.count()
        assert first.rows_read == n and again.rows_read == n and first.rows_written < n and not again.wrote


def test_a_plan_known_to_be_empty_has_no_count(spark, tmp_path):
    source = spark.createDataFrame([], jobs.SPEED_CSV_SCHEMA)
    assert jobs.run_job(spark, jobs.FILE_JOB, source, "overwrite", str(tmp_path / "o"), allow_empty=True).rows_read in (None, 0)

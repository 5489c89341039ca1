import json

import pytest

from quarry.cli import main, parse_args
from quarry.sinks.jdbc import merge_statements
from tests.conftest import rows


def test_mode_checked_by_argument_parser():
    with pytest.raises(SystemExit):
        parse_args(["file", "append", "--source", "x", "--target", "y"])


def test_file_job_from_the_command_line(spark, tmp_path, capsys):
    csv = tmp_path / "speed.csv"
    csv.write_text("Country,Avg(Mbit/s)Ookla\nA,1.5\nA,0.5\nB,\nC,3\n")
    target = tmp_path / "speed"
    assert main(["file", "overwrite", "--source", str(csv), "--target", str(target)],
                spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows_written"] == 2 and out["wrote"]
    assert rows(spark.read.parquet(str(target))) == [("A", 0.5), ("C", 3.0)]


def test_delimited_job_update_from_the_command_line(spark, tmp_path, capsys):
    header = ",".join(["h%d" % i for i in range(9)])
    land = tmp_path / "landing"
    land.mkdir()
    (land / "part-0.txt").write_text(header + "\nc1,N1,R,3,$1,$2,$3,$4,$5\n")
    hmap = tmp_path / "headers.json"
    hmap.write_text(json.dumps({f"h{i}": n for i, n in enumerate(
        ["country_code", "name", "continental_region", "no_internal_plans",
         "avg_price_1gb_usd", "cheapest_1gb_30days_usd", "most_expensive_1gb_usd",
         "avg_1gb_start2021_usd", "avg_1gb_start2020_usd"])}))
    v1, v2 = tmp_path / "v1", tmp_path / "v2"
    base = ["--source", str(land), "--header-map", str(hmap)]
    main(["delimited", "overwrite", *base, "--target", str(v1)], spark=spark)
    (land / "part-1.txt").write_text(header + "\nc2,N2,R,,$3,$4,$5,$6,$7\n")
    main(["delimited", "update", *base, "--target", str(v1), "--out", str(v2)], spark=spark)
    got = rows(spark.read.parquet(str(v2)), "country_code", "no_internal_plans")
    assert got == [("c1", 3.0), ("c2", 3.0)]


def test_merge_statements_are_set_based():
    d, i = merge_statements("public.t", "public.t__stage", ["k"], ["k", "v"])
    assert d == ('DELETE FROM public.t t WHERE EXISTS (SELECT 1 FROM public.t__stage s '
                 'WHERE (t."k" = s."k" OR (t."k" IS NULL AND s."k" IS NULL)))')
    assert i == 'INSERT INTO public.t ("k", "v") SELECT "k", "v" FROM public.t__stage'
    d2, _ = merge_statements("t", "s", ["k"], ["k", "v"], keep_missing=False)
    assert d2 == "DELETE FROM t"


def test_document_job_from_the_command_line(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "part-0.json").write_text(
        '{"_id": {"oid": "1"}, "country": "X", "internet_users": "1,500", "population": "9",'
        ' "region": "R", "sub_region": "S"}\n'
        '{"_id": {"oid": "2"}, "country": "Y", "internet_users": "NA", "population": "3",'
        ' "region": "R", "sub_region": "S"}\n')
    target = tmp_path / "users"
    main(["documents", "overwrite", "--source", str(docs), "--target", str(target)], spark=spark)
    got = rows(spark.read.parquet(str(target)), "id", "internet_users")
    assert got == [("1", 1500), ("2", 1500)]


def test_reports_from_the_command_line(spark, tmp_path, capsys):
    from quarry.sinks.partitions import create_partitioned
    prices, users = str(tmp_path / "prices"), str(tmp_path / "users")
    spark.createDataFrame([("Chile", "S", 2.0), ("Peru", "S", 4.0), ("Malta", "E", 3.5)], "name string, region string, price double").write.parquet(prices)
    create_partitioned(spark.createDataFrame([("Chile", 10, "A"), ("Malta", 30, "B"), ("Peru", 30, "A")], "country string, n int, part string"), users, "country", 4)

    def run(*args):
        code = main(["report", *args], spark=spark)
        out = capsys.readouterr().out.strip().splitlines()
        return code, json.loads(out[-1]) if out else None

    both = ["--left", prices, "--right", f"parts:{users}", "--on", "name=country"]
    found = ["--column", "country=name", "--column", "users=n"]
    assert run("lookup", *both, "--value", "Peru", *found) == (0, {"country": "Peru", "users": 30})
    assert run("lookup", *both, "--value", "Atlantis", *found) == (1, None)
    assert run("extreme", "--left", f"parts:{users}", "--label", "country", "--measure", "n", "--query-type", "highest") == (
        0, {"country": "Malta", "n": 30, "query_type": "highest"})
    assert run("group", "--left", prices, "--group", "region", "--measure", "price") == (0, {"region": "S", "price": 3.0, "query_type": "lowest"})
    assert run("joined", *both, "--group", "part", "--measure", "price", "--query-type", "highest") == (
        0, {"part": "B", "price": 3.5, "query_type": "highest"})


@pytest.mark.parametrize("bad", [["lookup", "--left", "x"], ["extreme", "--left", "x", "--label", "a"], ["other", "--left", "x"],
                                 ["group", "--left", "x", "--group", "a", "--measure", "b", "--query-type", "middle"],
                                 ["lookup", "--left", "x", "--right", "y", "--on", "a", "--value", "v", "--column", "a=b"]])
def test_report_arguments_are_checked_before_a_session(bad):
    with pytest.raises(SystemExit):
        main(["report", *bad], spark=None)

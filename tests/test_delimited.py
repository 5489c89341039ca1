import json

from quarry.sources.delimited import header_names, parse_lines, read_lines
from tests.conftest import rows

NAMES = ["a", "b", "c"]


def test_exact_field_count_header_and_rejects(spark):
    lines = spark.createDataFrame(
        [("a,b,c",), ("1,2,3",), ("1,2",), ("1,2,3,4",), ('1,"x,y",3',), ("1,2,",), (None,)],
        "value string")
    good, bad = parse_lines(lines, NAMES, header="a,b,c", with_rejects=True)
    assert rows(good) == [("1", "2", ""), ("1", "2", "3")]
    assert sorted(r["line"] or "" for r in bad.collect()) == sorted(
        ["", "1,2", "1,2,3,4", '1,"x,y",3'])


def test_quoted_mode_parses_quotes(spark):
    lines = spark.createDataFrame([('1,"x,y",3',), ("1,2",)], "value string")
    good = parse_lines(lines, NAMES, quoted=True)
    assert rows(good) == [("1", "x,y", "3")]


def test_line_breaks_stay_in_last_field(spark):
    lines = spark.createDataFrame([("1,2,$3.50\n",)], "value string")
    assert parse_lines(lines, NAMES).first()["c"] == "$3.50\n"


def test_read_lines_from_landed_files(spark, tmp_path):
    for i, body in enumerate(["a,b,c\n1,2,3\n4,5\n", "a,b,c\n6,7,8\n"]):
        (tmp_path / f"part-{i}.txt").write_text(body)
    got = read_lines(spark, str(tmp_path), NAMES, header="a,b,c")
    assert rows(got) == [("1", "2", "3"), ("6", "7", "8")]


def test_header_names_from_map_or_file(tmp_path):
    m = {"Country code": "country_code", "Name": "name"}
    assert header_names(m) == ["country_code", "name"]
    f = tmp_path / "h.json"
    f.write_text(json.dumps(m))
    assert header_names(str(f)) == ["country_code", "name"]


def test_broken_payloads_are_rejects(spark, tmp_path):
    from quarry.sources.delimited import read_payloads
    good, cut, text, other = '["a,b","1,2","3","4,5"]', '["a,b","6,7"', "not json", '{"a": 1}'
    (tmp_path / "p.txt").write_text("\n".join([good, cut, "", text, "[]", other, '["a,b","8,9"]']) + "\n")
    rows, rejects = read_payloads(spark, str(tmp_path), ["a", "b"], with_rejects=True)
    assert sorted(map(tuple, rows.collect())) == [("1", "2"), ("4", "5"), ("8", "9")]
    assert sorted(r["line"] for r in rejects.collect()) == sorted(["3", cut, text, other])
    assert read_payloads(spark, str(tmp_path), ["a", "b"]).count() == 3

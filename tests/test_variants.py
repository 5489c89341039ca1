from conftest import rows
from quarry.sources.variants import read_mixed_documents

FIELDS = {"id": (["$._id.oid", '$._id["$oid"]', "$._id"], "string"), "n": (["$.n"], "bigint"), "tag": (["$.tags[0]", "$.tags"], "string")}


def read(spark, tmp_path, text):
    path = tmp_path / "docs"
    path.mkdir()
    (path / "a.json").write_text(text, encoding="utf-8")
    good, bad = read_mixed_documents(spark, str(path), FIELDS, with_rejects=True)
    return rows(good), sorted(r["line"] for r in bad.collect())


def test_fields_of_several_types(spark, tmp_path):
    good, bad = read(spark, tmp_path, "\n".join([
        '{"_id": {"oid": "a"}, "n": 1, "tags": ["x", "y"]}', '{"_id": {"$oid": "b"}, "n": "2", "tags": "z"}', '{"_id": "c", "n": 3.0}',
        '{"_id": 4, "n": "many", "tags": {"k": 1}}', '{"_id": null}', '{"_id": {"other": 1}, "tags": []}', '  {"_id": "é😀", "n": 9223372036854775807}']))
    assert bad == []
    assert sorted(good, key=str) == sorted([("a", 1, "x"), ("b", 2, "z"), ("c", 3, None), ("4", None, None), (None, None, None),
                                            (None, None, None), ("é😀", 9223372036854775807, None)], key=str)


def test_lines_that_are_no_documents_are_rejects(spark, tmp_path):
    broken = ['{"_id": "a"', "not json", "[1, 2]", "null", '"text"', '{"_id": 1, "_id": 2}', '{"_id": "a"} {"_id": "b"}', '{"_id": "a"},{"_id": "b"}', '{"_id": "a"}]', '{"_id": "a"}}', '{"_id": "a"} x']
    good, bad = read(spark, tmp_path, "\n".join([*broken, "", " \t ", "{}", '{"_id": "kept"}']))
    assert bad == sorted(broken) and sorted(good, key=str) == [("kept", None, None), (None, None, None)]


def test_no_documents(spark, tmp_path):
    assert read(spark, tmp_path, "") == ([], [])


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"_id": "a"}\n')
    plan = read_mixed_documents(spark, str(tmp_path / "d"), FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1, plan

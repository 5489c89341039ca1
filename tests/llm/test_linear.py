"""Texts that made patterns or accumulators quadratic take seconds, and names with any characters are safe."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quarry.llm.line_dedup import line_dedup
from quarry.llm.pii import pii_spans, running


def test_running_sums(spark):
    rng = random.Random(1)
    lists = [[], [5], [1, 2, 3], [rng.randint(0, 9) for _ in range(1000)], [0] * 17]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<long>")
    for r in df.select("i", "v", running(F.col("v")).alias("s")).collect():
        assert r["s"] == [sum(r["v"][:k]) for k in range(len(r["v"]))]


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_many_matches_in_one_text(spark, n):
    df = spark.createDataFrame([(1, "10.0.0.1 " * n), (2, "mail a@b.co now")], "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: r for r in pii_spans(df).select("doc_id", F.size("spans").alias("n"), F.expr("spans[size(spans) - 1]").alias("last")).collect()}
    assert got[1]["n"] == n and (got[1]["last"]["start"], got[1]["last"]["end"]) == (9 * n - 9, 9 * n - 1) and got[2]["n"] == 1
    assert time.time() - start < 60


def page(html, n):
    return (n, f"http://h{n}.example/a", html)


@pytest.mark.parametrize("mark", ["<", "<!--", "<script ", "<style>", "< ", "a" + " " * 50, "</p "])
def test_large_pages_of_open_tags(spark, mark):
    html = "first<br>" + mark * (1_000_000 // len(mark)) + ("x" if mark.endswith(" ") else "")
    start = time.time()
    rows = line_dedup(spark.createDataFrame([page(h, n) for n, h in enumerate((html, html + ">tail", html + "<br>tail"))], "page_id long, url string, html string")).collect()
    assert all(r["kept_lines"][0] == "first" for r in rows) and time.time() - start < 40


def test_unclosed_parts_of_a_page(spark):
    cases = {"a<br>b<!-- c<br>d": ["a", "b"], "a<script>x</script>b<script>c": ["ab"], "a < b<br>c < d": ["a < b", "c < d"], "a < b<i>c < d": ["a c < d"], "a<p>b <i": ["a", "b <i"],
             "a<style>s": ["a"], "<!-- x --> y <!-- z": ["y"], "\t a \x0b<br>\f": ["a"]}
    rows = line_dedup(spark.createDataFrame([(i, f"http://h{i}.example/", h) for i, h in enumerate(cases)], "page_id long, url string, html string")).collect()
    assert {list(cases)[r["page_id"]]: r["kept_lines"] for r in rows} == cases


def test_clashing_and_dotted_names(spark):
    df = spark.createDataFrame([(1, "http://h.example/", "a<br>b", "x", "y", "z")], "page_id long, url string, html string, `__common` string, `a.b` string, host string")
    out = line_dedup(df)
    assert out.columns == [*df.columns, "host_", "n_lines", "kept_lines"] and [tuple(r) for r in out.collect()] == [
        (1, "http://h.example/", "a<br>b", "x", "y", "z", "h.example", 2, ["a", "b"])]

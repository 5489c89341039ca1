"""Exact dedup, SimHash near-dedup and components against brute force."""

import random

import brute
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import queries
from quarry.llm.components import components
from quarry.llm.exact_dedup import exact_dedup, exact_groups
from quarry.llm.simhash import (Allocation, choose_partitions, fingerprint, fingerprint_links, group_bits, near_dedup,
                                simhash_components)


def expected_groups(rows):
    """doc_id -> (keep_id, size) from (doc_id, text)."""
    out = {}
    for key, text in rows:
        out.setdefault(brute.squeezed(text), []).append((-len(text or ""), key is None, key))
    return {norm: (min(g)[2], len(g)) for norm, g in out.items()}


def test_exact_groups_on_hostile_rows(hostile):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    want = expected_groups(rows)
    got = exact_groups(hostile).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.digest, []).append(r)
    assert len(by) == len(want) and {brute.sha(n) for n in want} == set(by)
    for norm, (keep, size) in want.items():
        group = by[brute.sha(norm)]
        assert {r.rows for r in group} == {size} and len(group) == size
        assert {r.keep_key for r in group} == {keep}
        assert sum(r.kept for r in group) == 1  # repeated rows leave one


def test_exact_dedup_keeps_columns_and_one_of_each(hostile):
    got = exact_dedup(hostile)
    assert got.columns == hostile.columns
    texts = [brute.squeezed(r.text) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({brute.squeezed(r.text) for r in hostile.collect()})


def test_exact_checks_full_texts_when_digests_collide(hostile):
    """A digest of one hex digit covers many texts; the full texts still decide."""
    weak = exact_groups(hostile, digest=lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1))
    strong = exact_groups(hostile)
    def key(r):
        return (r.doc_id is None, r.doc_id, r.rows, r.keep_key is None, r.keep_key, r.kept)

    def view(df):
        return sorted(map(key, df.collect()), key=lambda t: tuple((x is not None, x) for x in t))
    assert view(weak) == view(strong)


def test_rows_of_any_frame_have_an_identity(spark, sf, tmp_path):
    """Scans, and frames that are no plain Parquet scan (a union with itself repeats locators)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs.limit(20).select("doc_id", F.regexp_replace("text", "\\s+", " ").alias("text")).write.option("header", True).csv(str(tmp_path / "c"))
    for frame in (docs.where("doc_id < 90"), docs.withColumn("text", F.upper("text")), docs.union(docs),
                  docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id"), spark.read.option("header", True).csv(str(tmp_path / "c"))):
        texts = {brute.squeezed(r.text) for r in frame.collect()}
        got = exact_dedup(frame)
        assert got.columns == frame.columns and sorted(brute.squeezed(r.text) for r in got.collect()) == sorted(texts)


def test_empty_tables(empty):
    assert exact_groups(empty).count() == 0 and exact_dedup(empty).count() == 0
    assert simhash_components(empty).count() == 0 and near_dedup(empty).count() == 0


def test_exact_query_on_files_reruns_alike(spark, sf):
    a = {r.doc_id: tuple(r) for r in queries.op3_exact_dedup(spark, sf).collect()}
    b = {r.doc_id: tuple(r) for r in queries.op3_exact_dedup(spark, sf).collect()}
    assert a == b and len(a) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_fingerprints_match_the_rule(hostile):
    for r in hostile.collect():
        if len(r.text or "") < 20_000:
            assert fingerprint((r.text or "").encode()) == brute.simhash(r.text)


def test_simhash_query_against_all_pairs(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [brute.simhash(t) for _, t in docs]
    roots = brute.groups_within(prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, sf).collect()}
    assert got == {d: (f"{p:016x}", docs[root][0]) for (d, _), p, root in zip(docs, prints, roots)}


def linked(spark, prints, distance, **how):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in components(fingerprint_links(df, distance, **how)).collect()}
    return [roots.get(s, s) for s in signed]


def same_partition(a, b):
    return [a.index(x) for x in a] == [b.index(x) for x in b]


@pytest.mark.parametrize("distance,partitions,cap", [(2, 2, 64), (2, 3, 64), (2, 4, 2), (1, 2, 3), (3, 2, 1), (0, 1, 64)])
def test_links_are_complete_for_any_partitions_and_caps(spark, distance, partitions, cap):
    """Clusters a few bits wide, chains, and a dense ball that overfills every bucket."""
    rng = random.Random(distance * 100 + partitions)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            prints.add(base)
            for _ in range(rng.randint(1, distance + 1)):
                base ^= 1 << rng.randrange(64)
    dense = rng.getrandbits(64)
    prints |= {dense ^ (1 << i) for i in range(0, 64, 3)} | {dense}
    prints = sorted(prints)
    assert same_partition(linked(spark, prints, distance, partitions=partitions, bucket_cap=cap), brute.groups_within(prints, distance))


def test_thresholds_spend_exactly_the_general_pigeonhole_sum():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for distance in (1, 2, 3):
        for m in range(1, distance + 2):
            groups = group_bits(np.eye(64), m)
            hist = {(i, j): rng.random(1 << len(g[k:k + 8])) * 100 for i, g in enumerate(groups) for j, k in enumerate(range(0, len(g), 8))}
            alloc = Allocation(groups, hist, distance)
            t = alloc.thresholds(fps)
            assert (t.sum(axis=1) == distance - m + 1).all() and t.min() >= -1
            cost = alloc.candidates(np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            chosen = sum(cost[np.arange(500), i, t[:, i] + 1] for i in range(m))
            best = np.full(500, np.inf)
            for option in np.ndindex(*[distance + 2] * m):
                if sum(option) == distance + 1:
                    best = np.minimum(best, sum(cost[:, i, e] for i, e in enumerate(option)))
            assert np.allclose(chosen, best)


def test_correlated_bits_share_a_partition():
    c = np.eye(64)
    for a, b in ((0, 40), (1, 41), (2, 42)):
        c[a, b] = c[b, a] = 0.9
    where = {b: i for i, g in enumerate(group_bits(c, 3)) for b in g}
    assert all(where[a] == where[b] for a, b in ((0, 40), (1, 41), (2, 42)))
    assert sorted(where) == list(range(64))
    assert choose_partitions(10 ** 3, 2) >= choose_partitions(10 ** 10, 2)


def test_near_dedup_keeps_one_per_component(hostile):
    found = simhash_components(hostile).collect()
    kept = near_dedup(hostile)
    assert kept.columns == hostile.columns
    assert kept.count() == sum(r.kept for r in found) == len({r.component_id for r in found})


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(edges=st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=40))
def test_components_property(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {x: find(x) for x in root}


def test_components_of_a_long_path_and_a_star(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1400).select(F.col("id").alias("a"), F.lit(2000).cast("long").alias("b"))
    got = {r.node: r.root for r in components(path.union(star)).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1400)} | {got[2000]} == {1000}

"""Embedding whitening against exact fractions and float64 decompositions."""

from fractions import Fraction

import numpy as np
import pytest

from quarry.llm import queries
from quarry.llm.whitening import clusters, eigen, fit, identity_error, whitened


def spread(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 5, 24),
    np.r_[np.ones(8), 1 + 1e-9 * np.arange(8), np.linspace(2, 3, 8)],             # clustered, some equal
    np.r_[np.zeros(4), np.full(10, 3.0), 3 + 1e-12 * np.arange(4), np.geomspace(1e-9, 1, 6)],
    np.full(5, 7.0), np.zeros(4), np.array([2.5]), np.geomspace(1e-6, 1e9, 30)])
def test_eigenvectors_to_double_precision(values):
    a = spread(values)
    e, x = eigen(a)
    size = max(np.abs(values).max(), 1e-300)
    assert np.abs(a @ x.astype(np.longdouble) - x.astype(np.longdouble) * e).max() < 4e-16 * size
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 2e-15
    assert np.allclose(e, np.sort(values)[::-1], rtol=0, atol=1e-15 * size) and (np.diff(e) <= 0).all()


def test_separated_vectors_are_better_than_float32_by_far():
    a = spread(np.linspace(1, 5, 24))
    x32 = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    x = eigen(a)[1]
    x64 = np.linalg.eigh(a.astype(np.float64))[1][:, ::-1]
    assert np.abs(np.abs(x) - np.abs(x64)).max() < 1e-13 < 1e-7 < np.abs(np.abs(x32) - np.abs(x64)).max()


def test_clusters_are_chains_of_small_gaps():
    got = clusters(np.array([5.0, 1.0, 1.05, 3.0, 1.1]), 0.06)
    assert [sorted(g.tolist()) for g in got] == [[1, 2, 4]]


def test_query_against_exact_sums(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in r["embedding"]] for r in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = {r["vec_id"]: int(d) for r, d in zip(rows, ((n * x - s) ** 2).sum(axis=1), strict=True)}
    centred = np.array([[float(Fraction(int(n * v - t), n)) for v, t in zip(row, s, strict=True)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    got = queries.op11_whitening(spark, sf).collect()
    assert len(got) == 32 * n and {(r["vec_id"], r["component"]) for r in got} == {(r["vec_id"], c) for r in rows for c in range(1, 33)}
    signs = {}
    for r in got:
        c = r["component"] - 1
        want = centred[place[r["vec_id"]]] @ u[:, c] / np.sqrt(e[c])
        signs.setdefault(c, np.sign(want * r["whitened"]))
        assert abs(want * signs[c] - r["whitened"]) < 1e-9
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] - e[c] / e.sum()) < 1e-10 and 0 <= r["identity_error"] < 1e-10
    assert len({r["identity_error"] for r in got}) == 1


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, `whitened` string, `a.b` int")


def test_odd_vectors_are_left_out_and_clashing_names_kept(spark):
    good = [(i, [float(i % 3), float(i * i % 7), 1.0], "w", i) for i in range(12)]
    odd = [(20, None, None, None), (21, [1.0, None, 2.0], "w", 1), (22, [float("nan"), 1.0, 1.0], "w", 1), (None, [1.0, float("inf"), 0.0], "w", 1),
           (23, [], "w", 1), (24, [1.0], "w", 1), (25, [1.0] * 5, "w", 1)]
    df = vectors(spark, good + odd + good[:2])
    model = fit(df)
    assert (model.n, model.dimension) == (14, 3)
    out = whitened(df, model)
    assert out.columns == ["vec_id", "embedding", "whitened", "a.b", "deviation", "whitened_"]
    rows = out.collect()
    assert sorted(r["vec_id"] for r in rows) == sorted([*range(12), 0, 1])
    # The third dimension is constant: its component has no variance to scale by.
    assert all(r["whitened_"][2] is None and None not in r["whitened_"][:2] for r in rows)
    assert identity_error(df, model) < 1e-12
    again = {(r["vec_id"], r["deviation"], tuple(r["whitened_"])) for r in whitened(df.repartition(5), fit(df.repartition(7))).collect()}
    assert again == {(r["vec_id"], r["deviation"], tuple(r["whitened_"])) for r in rows}  # equal bits, however it is partitioned


def test_empty_equal_and_large_vectors(spark):
    none = vectors(spark, [])
    assert fit(none) is None and identity_error(none, None) is None
    assert whitened(none, None).collect() == []
    same = vectors(spark, [(i, [0.5, 0.25], None, None) for i in range(4)])
    model = fit(same)
    assert [(r["deviation"], r["whitened_"]) for r in whitened(same, model).collect()] == [(0, [None, None])] * 4
    assert identity_error(same, model) is None and model.trace == 0
    # Far from zero and wide: products beyond 2^53 stay exact, a deviation beyond a long is null.
    wide = vectors(spark, [(i, [1e12 + (i - 1) * 3e9, float(i * i)], None, None) for i in range(3)], "double")
    model = fit(wide)
    x = [[int(64 * (1e12 + (i - 1) * 3e9)) + 10**6, 64 * i * i + 10**6] for i in range(3)]
    s = [sum(c) for c in zip(*x, strict=True)]
    exact = sum(Fraction(3 * r[0] - s[0], 3) ** 2 for r in x) / 3 + sum(Fraction(3 * r[1] - s[1], 3) ** 2 for r in x) / 3
    assert abs(model.trace / float(exact) - 1) < 1e-15
    assert [r["deviation"] for r in whitened(wide, model).collect()] == [d if (d := sum((3 * a - b) ** 2 for a, b in zip(r, s, strict=True))) < 2**63 else None for r in x]
    with pytest.raises(Exception, match="2\\^56"):
        fit(vectors(spark, [(1, [1e300], None, None)], "double"))


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op11_whitening(spark, str(tmp_path))
    assert got.collect() == [] and [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]

"""Hot keys: one key or group holds a third of all rows. Results must stay whole and exact."""

import random

import pytest

from quarry.operators.delta import DuplicateKeyError, assert_unique, changed_rows
from quarry.operators.dedupe import keep_first
from quarry.operators.impute import impute_group_mean
from tests.conftest import rows

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = []
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{i % 97}"
        val = None if i % 5 == 0 else float(rnd.randint(0, 1000)) / 4
        data.append((i, key, val))
    return data, spark.createDataFrame(data, "id int, k string, v double").repartition(6)


def test_dedupe_hot_key(spark, skewed):
    data, df = skewed
    best = {}
    for i, k, v in data:
        cand = (v is None, v, i)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, i, v))
    want = sorted(t[1] for t in best.values())
    got = sorted(rows(keep_first(df, "k", order_by=["v", "id"]), "k", "id", "v"))
    assert got == want


def test_impute_hot_group(spark, skewed):
    data, df = skewed
    from decimal import ROUND_HALF_UP, Decimal
    sums, counts = {}, {}
    for _, k, v in data:
        if v is not None:
            sums[k] = sums.get(k, Decimal(0)) + Decimal(str(v))
            counts[k] = counts.get(k, 0) + 1
    means = {k: float((sums[k] / counts[k]).quantize(Decimal("0.01"), ROUND_HALF_UP))
             for k in sums}
    got = dict(rows(impute_group_mean(df, "k", {"v": 2}), "id", "v"))
    assert len(got) == N
    for i, k, v in data:
        assert got[i] == (v if v is not None else means.get(k))


def test_change_set_refuses_duplicate_hot_key(spark, skewed):
    _, df = skewed
    with pytest.raises(DuplicateKeyError):
        assert_unique(df, "k")
    unique = df.select("id", "k", "v")
    changed = changed_rows(unique, unique.where("id % 2 = 0"), "id")
    assert changed.count() == N // 2

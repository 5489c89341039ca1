"""Randomised checks against plain-Python brute force."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.functions.numbers import thousands_to_bigint
from quarry.operators.delta import changed_rows, upsert_rows
from tests.conftest import rows

VAL = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
TABLE = st.dictionaries(st.one_of(st.none(), st.integers(0, 12)), st.tuples(VAL, st.one_of(st.none(), st.integers(0, 3))),
                        max_size=10)
SCHEMA = "k int, v string, w int"


def frame(spark, table):
    return spark.createDataFrame([(k, v, w) for k, (v, w) in table.items()], SCHEMA)


def brute_changed(source, target, rule):
    out = []
    for k, sv in source.items():
        tv = target.get(k)
        if rule == "null_safe":
            changed = tv is None or sv != tv
        else:  # per column: target NULL or (both known and different)
            if tv is None:
                changed = True
            else:
                changed = any(t is None or (s is not None and s != t) for s, t in zip(sv, tv))
        if changed:
            out.append((k, *sv))
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


@settings(max_examples=12, deadline=None)
@given(TABLE, TABLE)
def test_change_set_rules_match_brute_force(spark, source, target):
    s, t = frame(spark, source), frame(spark, target)
    for rule in ("null_safe", "null_as_changed"):
        assert rows(changed_rows(s, t, "k", ["v", "w"], rule)) == brute_changed(source, target, rule)


@settings(max_examples=12, deadline=None)
@given(TABLE, TABLE)
def test_upsert_matches_brute_force(spark, source, target):
    s, t = frame(spark, source), frame(spark, target)
    delta = changed_rows(s, t, "k", ["v", "w"])
    merged = {**target, **source}
    want = sorted(((k, *v) for k, v in merged.items()),
                  key=lambda t: tuple((x is not None, x) for x in t))
    assert rows(upsert_rows(t, delta, "k", ["k", "v", "w"])) == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-10**15, 10**15), min_size=1, max_size=20))
def test_thousands_text_round_trip(spark, values):
    texts = [f"{v:,}" for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["v"] for r in df.select(thousands_to_bigint("s").alias("v")).collect()]
    assert got == values

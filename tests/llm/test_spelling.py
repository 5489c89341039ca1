"""Spelling variant grouping against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import queries, spelling
from quarry.llm.spelling import Layout, edits, roots, spelling_groups


def words_of(rows, fewest=3):
    out = Counter()
    for key, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= fewest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1:])


def groups(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {w: (min(near[w], key=lambda v: (-words[v], v)) if near[w] else None) for w in words}
    form = {w: f if f and words[f] >= 2 * words[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def found(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows) and df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return out


def test_query_against_all_pairs(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op13_spelling(spark, sf)) == groups(words_of(rows))


def test_dense_words_ties_and_chains(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(250)]
    rows = [(i, " ".join(w.upper() if rng.random() < 0.3 else w for w in rng.choices(base, [2.0 ** -(j % 9) for j in range(250)], k=60)), "x") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    want = groups(words_of([r[:2] for r in rows]))
    assert sum(v[0] is not None for v in want.values()) > 30
    assert found(spelling_groups(df)) == want
    # Filters of a few blocks: several passes, many false positives, the same result.
    assert found(spelling_groups(df, max_bytes=64)) == want


def test_several_passes(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    words = {1: 10_000, 70: 4}
    assert Layout.of(words, 4096).slices == 5 and Layout.of(words).slices == 1
    assert found(spelling_groups(df, max_bytes=2048)) == found(spelling_groups(df))


def test_every_edit_passes_and_no_other_hash_is_wrong():
    rng = random.Random(1)
    for length in (5, 6, 64, 65, 200):
        word = "".join(rng.choice("abcxyzé") for _ in range(length))
        letters = sorted({ord(c) for c in "abcxyzé"})
        layout = Layout.of({int(spelling.shard(np.array([k]))[0]): 50 for k in (length - 1, length)})
        every = np.full(layout.total * 8, np.uint64(2**64 - 1))  # a filter that lets all through
        codes = np.array([[ord(c) for c in word]], dtype=np.uint64)
        made = []
        for _, at, put in edits(codes, np.array(letters, np.uint64), layout, every, 0):
            made += [word[:p] + (chr(c) if c else "") + word[p + 1:] for p, c in zip(at.tolist(), put.tolist(), strict=True)]
        want = {word[:i] + chr(c) + word[i + 1:] for i in range(length) for c in letters if c > ord(word[i])}
        if length > 5:
            want |= {word[:i] + word[i + 1:] for i in range(length)}
        assert sorted(made) == sorted(want)
        # The hash that an edit is probed with is the one its text is stored with.
        table = np.zeros((layout.total, 8), dtype=np.uint64)
        for _, codes_ in spelling.grouped(sorted(want)):
            block, _, z = layout.place((codes_ * spelling.powers(codes_.shape[1])).sum(axis=1, dtype=np.uint64), codes_.shape[1])
            for k in range(spelling.PROBED_BITS):
                bit = spelling._bit(z, k)
                np.bitwise_or.at(table, (block, (bit >> np.uint64(6)).astype(int)), np.uint64(1) << (bit & np.uint64(63)))
        kept = sum(len(w) for w, _, _ in edits(codes, np.array(letters, np.uint64), layout, table.reshape(-1), 0))
        assert kept == len(want)


def test_roots_follow_long_chains(spark):
    n = 40
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(n)] + [(f"v{i}", "w7") for i in range(50)], "word string, form string")
    got = {r["word"]: r["root"] for r in roots(forms).collect()}
    assert set(got.values()) == {f"w{n}"} and len(got) == n + 50
    assert roots(forms.limit(0)).collect() == []


def test_hostile_rows(spark, hostile, empty):
    rows = [(r["doc_id"], r["text"]) for r in hostile.collect()]
    assert found(spelling_groups(hostile)) == groups(words_of(rows))
    assert found(spelling_groups(hostile, fewest=1)) == groups(words_of(rows, 1))
    assert found(spelling_groups(empty)) == {}


@pytest.mark.parametrize("length", [300, 30_000])
def test_very_long_words(spark, length):
    a = "ab" * (length // 2)
    rows = [(1, f"{a} {a} {a} {a}"), (2, f"{a}c {a}c {a}c {a}c {a}c {a}c {a}c {a}c"), (3, f"z{a[1:]} z{a[1:]} z{a[1:]} plain")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling_groups(df)) == groups(words_of(rows))

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


HOSTILE = [None, "", " \t\n\x0b\f\r ", "one", "one two", "one two three", "one  two\tthree", "ONE two THREE four", "é😀  ü\x00 ß x",
           "a b c " * 3000, "x" * 40_000, "one two three", "İ ſ K ONE", "line\nline\n\nline \nother"]


@pytest.fixture(scope="session")
def hostile(spark):
    """Every odd text, nulls in every column, repeated rows, and columns named like the
    operators' own results and inner names."""
    rows = [(i, t, "en", "src" + str(i % 3) if i % 4 else None, i, f"k{i}", True, i) for i, t in enumerate(HOSTILE)]
    rows += [rows[5], rows[5], (None, "no key here at all", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep_id string, kept boolean, size long").cache()


@pytest.fixture(scope="session")
def empty(hostile):
    return hostile.limit(0)

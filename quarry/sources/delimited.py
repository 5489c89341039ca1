"""Delimited text lines to rows, split on the executors.

A payload is a list of text lines; its first is the header. Each line
is split on every delimiter (quotes are not special in ``strict`` mode), and
only lines with exactly the expected number of fields are kept. A trailing
empty field counts as a field. Lines with another count are returned as
rejects instead of being lost silently. ``quoted=True`` parses fields with
CSV quoting instead (``from_csv``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def header_names(header_map: dict | str) -> list[str]:
    """Column names from an ordered header map (its values, in order).

    Accepts the map or the path of a JSON file holding it. Only the values are
    used: the keys (source header texts) are not relied upon.
    """
    if isinstance(header_map, str):
        with open(header_map, encoding="utf-8") as fh:
            header_map = json.load(fh)
    if not header_map:
        raise ValueError("empty header map")
    return list(header_map.values())


def parse_lines(lines: DataFrame, names, delimiter: str = ",", header: str | None = None,
                line_col: str = "value", quoted: bool = False,
                with_rejects: bool = False):
    """Rows of string columns ``names`` from a DataFrame of text lines.

    ``header``: the header line text; lines equal to it are skipped (files
    landed in several parts each start with it). Payloads whose header text is not known
    are read by :func:`read_payloads`, which skips it by position.
    """
    names = list(names)
    n = len(names)
    line = F.col(line_col)
    if header is not None:
        lines = lines.where(line.isNull() | (line != F.lit(header)))
    if quoted:
        schema = StructType([StructField(c, StringType()) for c in names])
        parts = F.from_csv(line, schema.simpleString(), {"sep": delimiter, "mode": "PERMISSIVE"})
        count = F.size(F.split(F.regexp_replace(line, r'"[^"]*"', ""), _re(delimiter), -1))
        fields = [F.col(f"__p.{c}").alias(c) for c in names]
    else:
        parts = F.split(line, _re(delimiter), -1)
        count = F.size(parts)
        fields = [F.col("__p")[i].alias(c) for i, c in enumerate(names)]
    # Split once, inside a one-row generator. Filters on the fields cannot be
    # pushed below a generator, so they read the split result; through a plain
    # projection Catalyst would inline the split into every predicate and
    # split each line once per predicate (about 4x slower, measured).
    parsed = lines.select(F.inline(F.array(F.struct(
        line.alias("__line"), parts.alias("__p"), (count == n).alias("__ok")))))
    ok = F.col("__ok") & F.col("__p").isNotNull()
    rows = parsed.where(ok).select(*fields)
    rejects = parsed.where(~F.coalesce(ok, F.lit(False))).select(F.col("__line").alias("line"))
    return (rows, rejects) if with_rejects else rows


def lines_after_first(spark: SparkSession, path) -> DataFrame:
    """The lines of text files without the first line of each file, whatever its text.

    The CSV reader leaves out a header per file, also when a file is read in several
    splits. Each line is one field here: nothing is quoted, and the separator is a
    sequence that text does not hold; should a line hold it, the reader keeps the whole
    line as a record it could not parse, and that is taken. Blank lines are skipped.
    """
    read = spark.read.schema("value string, __raw string").options(
        header=True, enforceSchema=True, sep="\u0001\u0002\u0001", quote="", maxCharsPerColumn=-1,
        columnNameOfCorruptRecord="__raw")
    return read.csv(path).select(F.coalesce("__raw", "value").alias("value"))


def read_lines(spark: SparkSession, path, names, delimiter: str = ",",
               header: str | None = None, first_is_header: bool = False, **kw):
    """Landed payload files (text) parsed by :func:`parse_lines`. The header is skipped by its
    text (``header``) or as the first line of each file (``first_is_header``)."""
    lines = lines_after_first(spark, path) if first_is_header else spark.read.text(path)
    return parse_lines(lines, names, delimiter, header, "value", **kw)


def payload_lines(payloads: DataFrame, column: str = "value", with_rejects: bool = False):
    """The data lines of payloads: each is a JSON array of lines whose first element is the
    header, whatever its text, and is left out by its position. Line breaks inside an
    element stay. A payload is one response, so its array is bounded.

    A payload that is no JSON array (broken off, or not JSON) has no lines; with
    ``with_rejects`` such payloads come back too, whole, as a frame of one column ``line``. Blank ones are neither."""
    # Parsed once, inside a one-row generator (see parse_lines).
    parsed = payloads.select(F.inline(F.array(F.struct(F.col(column).alias("line"), F.from_json(F.col(column), "array<string>").alias("__all")))))
    lines = parsed.select(F.posexplode("__all").alias("__pos", "value")).where("__pos > 0").select("value")
    if not with_rejects:
        return lines
    return lines, parsed.where(F.col("__all").isNull() & F.col("line").rlike(r"\S")).select("line")


def read_payloads(spark: SparkSession, path, names, delimiter: str = ",", whole_files: bool = False, **kw):
    """Landed payloads, one JSON array per line (or per file), parsed by :func:`parse_lines`. Rejects
    are lines with another number of fields and whole payloads that do not parse."""
    lines, broken = payload_lines(spark.read.text(path, wholetext=whole_files), with_rejects=True)
    found = parse_lines(lines, names, delimiter, **kw)
    if not kw.get("with_rejects"):
        return found
    rows, rejects = found
    return rows, rejects.unionByName(broken)


def _re(delimiter: str) -> str:
    import re
    return re.escape(delimiter)

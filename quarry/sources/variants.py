"""Documents whose fields change their type from one document to the next.

A schema fixes one type per field, so a reader with a schema turns a field of another
type into NULL. Here each line is parsed as a VARIANT, once, on the executors, and each
field is looked for at several places in it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_END = "end of line"


def variant_field(value: Column, paths: Sequence[str], dtype: str) -> Column:
    """The first of ``paths`` at which ``value`` holds something that is a ``dtype``, else NULL.

    Objects and arrays are no text: they are passed over where text is asked for."""
    def at(path: str) -> Column:
        got = F.try_variant_get(value, path, dtype)
        if dtype.strip().lower() != "string":
            return got
        kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
        return F.when(~kind.rlike("^(OBJECT|ARRAY)"), got)

    return F.coalesce(*[at(p) for p in paths])


def read_mixed_documents(spark: SparkSession, path, fields: Mapping[str, tuple[Sequence[str], str]],
                         with_rejects: bool = False):
    """Documents, one per line, with ``fields``: column name to (paths, type), as in
    ``{"id": (["$._id.oid", "$._id"], "string")}``; a key with odd characters is written
    ``$["a.b"]``. A field that is missing, null or of no fitting type is NULL.

    Lines of white space are no documents. Lines that are no whole JSON object (broken off,
    two values, a key twice, over the size that a VARIANT may have) are rejects: with
    ``with_rejects`` returns (rows, rejects), the latter the column ``line``. Both read the input on their own."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"[^\x00-\x20]"))
    # The parser ignores what follows a whole value; as the first of two elements a line must end where it should.
    pair = F.when(F.ltrim("value").startswith("{"), F.try_parse_json(F.concat(F.lit("["), "value", F.lit(f',"{_END}"]'))))
    # A generator, so that each line is parsed once and not again in every filter and field.
    parsed = lines.select("value", F.explode(F.array(pair)).alias("pair"))
    whole = F.coalesce(F.try_variant_get(F.col("pair"), "$[1]", "string") == _END, F.lit(False))
    rows = parsed.where(whole).select(
        *[variant_field(F.col("pair"), ["$[0]" + p.removeprefix("$") for p in paths], dtype).alias(name)
          for name, (paths, dtype) in fields.items()])
    if not with_rejects:
        return rows
    return rows, parsed.where(~whole).select(F.col("value").alias("line"))

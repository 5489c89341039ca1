"""A bitmap of keys: tells which rows of a large table cannot have a key of a smaller one,
before any of them is shuffled.

Each key is hashed to one of 2^27 places. The places of the small side's keys make a
bitmap of at most 4,096 rows of 4 KB (16 MB, however many keys there are), which is broadcast.
A row whose place is empty has none of the keys, for certain. A row whose place is set may have one and goes on to
the exact join: about one in 2^27 / keys of the others goes with them.

The hash treats NULLs and keys that are equal as equal if their types are, so both sides must
have the same types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 27
_PER_ROW = 1 << 15  # places of one row of the bitmap, fixed by the function that builds it
MAX_KEYS = PLACES // 8  # beyond that too many places are set for the filter to be worth its pass
_BUCKET, _BITS, _PLACE = "__kf_bucket", "__kf_bits", "__kf_place"


def same_types(a: DataFrame, b: DataFrame, key: list[str]) -> bool:
    return all(a.schema[k].dataType == b.schema[k].dataType for k in key)


def _place(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*["`" + k.replace("`", "``") + "`" for k in key]), F.lit(PLACES))


def key_bitmap(df: DataFrame, key: list[str]) -> DataFrame:
    """The bitmap of the keys of ``df``: partial bitmaps are merged on the map side."""
    places = df.select(_place(key).alias(_PLACE))
    return (places.groupBy(F.floor(F.col(_PLACE) / _PER_ROW).cast("int").alias(_BUCKET))
            .agg(F.bitmap_construct_agg(F.pmod(F.col(_PLACE), F.lit(_PER_ROW))).alias(_BITS)))


def split_by_keys(df: DataFrame, other: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have a key of ``other``, and those that cannot. Together they are ``df``;
    neither is shuffled. Each is a scan of ``df`` of its own."""
    if not same_types(df, other, key):
        raise ValueError("keys of other types have other hashes")
    place = _place(key)
    marked = (df.withColumns({_PLACE: place, _BUCKET: F.floor(place / _PER_ROW).cast("int")})
              .join(F.broadcast(key_bitmap(other, key)), _BUCKET, "left"))  # at most 16 MB, see above
    spot = F.pmod(F.col(_PLACE), F.lit(_PER_ROW))
    byte = F.conv(F.hex(F.substr(_BITS, F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, F.pmod(spot, F.lit(8)).cast("int")) == 1, F.lit(False))
    return tuple(marked.where(c).select(*["`" + n.replace("`", "``") + "`" for n in df.columns]) for c in (hit, ~hit))

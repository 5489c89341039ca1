"""Number parsing from messy text, as Column expressions (JVM side, codegen).

Rules (one set for every source):

* listed characters (thousands commas, currency signs, line breaks) are removed;
* the rest must look like a plain decimal number within the double range,
  otherwise the value is NULL.
  That guard keeps ``'NaN'``, ``'Infinity'``, ``'1.5d'`` and ``''`` out, which
  Spark's own cast would accept or reject differently from other engines;
* ``try_cast`` is used throughout, so ANSI mode never fails a whole job on one
  bad cell;
* integers are parsed through double and truncated toward zero, so ``'12.7'``
  gives 12 and ``'3000000000'`` fits (bigint).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed before parsing.
THOUSANDS = ","
MONEY = "$"
LINE_BREAKS = "\r\n"

# A plain decimal number with optional sign and exponent, no other characters.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_class(chars: str) -> str:
    """Regex character class that matches any of ``chars`` literally."""
    return "[" + "".join("\\" + ch if ch in "]\\^-[" else ch for ch in chars) + "]"


def strip_chars(c, chars: str) -> Column:
    """Remove every occurrence of each character in ``chars``."""
    if not chars:
        return _col(c)
    return F.regexp_replace(_col(c), char_class(chars), "")


def parse_double(c, strip: str = "") -> Column:
    """Text to double; NULL for anything that is not a plain number."""
    s = F.trim(strip_chars(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                           strip))
    d = s.try_cast("double")
    # Digits beyond the double range parse to infinity: not a usable number either.
    return F.when(s.rlike(NUMBER_PATTERN) & (F.abs(d) < F.lit(float("inf"))), d)


def parse_bigint(c, strip: str = "") -> Column:
    """Text to bigint through double, truncating toward zero."""
    return parse_double(c, strip).try_cast("bigint")


def thousands_to_bigint(c) -> Column:
    """``'1,234,567'`` to 1234567."""
    return parse_bigint(c, THOUSANDS)


def money_to_double(c) -> Column:
    """``'$1.50\\n'`` to 1.5."""
    return parse_double(c, MONEY + LINE_BREAKS)

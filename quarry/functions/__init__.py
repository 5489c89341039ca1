from quarry.functions.numbers import (  # noqa: F401
    char_class, money_to_double, parse_bigint, parse_double, strip_chars,
    thousands_to_bigint,
)
from quarry.functions.predicates import all_of, all_present, any_of, present  # noqa: F401

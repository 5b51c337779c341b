"""Column expressions.  Everything here returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""
from .cleanse import (as_col, canonical, coerce, is_blank, null_out_of_range,
                      parse_date, title_case, try_double, try_int)
from .derive import band, day_diff
from .keys import hash_key, wide_key
from .money import cents, round_avg_cents
from .privacy import mask, restricted_flag

__all__ = [
    "as_col", "canonical", "coerce", "is_blank", "null_out_of_range", "parse_date",
    "title_case", "try_double", "try_int", "band", "day_diff",
    "hash_key", "wide_key", "cents", "round_avg_cents", "mask", "restricted_flag",
]

"""Column expressions: every function takes and returns ``Column``."""

from tablekit.functions.arrays import contains_member, decode_flags
from tablekit.functions.labels import bin_label, range_label
from tablekit.functions.numeric import nonneg, negative, rate_per_hour
from tablekit.functions.text import (
    cleanse,
    field_count,
    month_of,
    strip,
    token_at,
    year_of,
)

__all__ = [
    "bin_label",
    "cleanse",
    "contains_member",
    "decode_flags",
    "field_count",
    "month_of",
    "negative",
    "nonneg",
    "range_label",
    "rate_per_hour",
    "strip",
    "token_at",
    "year_of",
]

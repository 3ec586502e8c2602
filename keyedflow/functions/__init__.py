from .dates import calendar_buckets, today, valid_day
from .state import decode_state, encode_state
from .text import (
    count_blank_is_one,
    count_empty_is_zero,
    format_percent,
    md5_key,
    not_blank,
    random_surrogate,
    salted_surrogate,
    split_fields,
    strict_integer,
    strip_control,
    timed_surrogate,
)

__all__ = [name for name in dir() if not name.startswith("_")]

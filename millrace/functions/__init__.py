from millrace.functions.numeric import (
    flag,
    positive_part,
    rate,
    round_half_up,
    rounded_avg,
    rounded_ratio,
    rounded_sum,
    safe_ratio,
)
from millrace.functions.text import (
    cast_column,
    days_late,
    decode_utf8,
    file_name,
    is_late,
    labelled,
    parse_json,
    row_json,
)

__all__ = [
    "cast_column",
    "days_late",
    "decode_utf8",
    "file_name",
    "flag",
    "is_late",
    "labelled",
    "parse_json",
    "positive_part",
    "rate",
    "round_half_up",
    "rounded_avg",
    "rounded_ratio",
    "rounded_sum",
    "row_json",
    "safe_ratio",
]

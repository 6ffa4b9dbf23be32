"""Column expressions: cleaning, decoding, money, dates and row keys."""

from sedimenta.functions.dates import (
    age_calendar,
    age_days365,
    date_or_blank,
    timestamp_or_blank,
)
from sedimenta.functions.keys import row_key, row_key_for
from sedimenta.functions.values import (
    blank_if_null,
    decode_map,
    flag_from,
    flag_label,
    money,
    to_bigint,
)

__all__ = [
    "age_calendar",
    "age_days365",
    "blank_if_null",
    "date_or_blank",
    "decode_map",
    "flag_from",
    "flag_label",
    "money",
    "row_key",
    "row_key_for",
    "timestamp_or_blank",
    "to_bigint",
]

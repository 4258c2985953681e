from sedimenta.functions.columns import (
    clean_place,
    day_of,
    epoch_of,
    epoch_to_ntz,
    falsy_to_null,
    fill_text,
    micros_to_ntz,
    month_of,
    nan_to_null,
    null_outside,
    object_key,
    once_passed,
    reading_identity,
    round_to_bigint,
    sql_timestamp,
)

__all__ = [
    "clean_place",
    "day_of",
    "epoch_of",
    "epoch_to_ntz",
    "falsy_to_null",
    "fill_text",
    "micros_to_ntz",
    "month_of",
    "nan_to_null",
    "null_outside",
    "object_key",
    "once_passed",
    "reading_identity",
    "round_to_bigint",
    "sql_timestamp",
]

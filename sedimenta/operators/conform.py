"""Bronze -> silver: text cleaning, range rules, validity and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import (
    clean_place,
    fill_text,
    null_outside,
    reading_identity,
    round_to_bigint,
)
from sedimenta.operators.latest import latest_rows
from sedimenta.operators.partitions import inside_calendar
from sedimenta.schemas import BRONZE, RANGE_RULES, Range

NEWEST_FIRST = ("collected_at", "data_timestamp", "id")


def apply_ranges(df: DataFrame, rules: Mapping[str, Range] = RANGE_RULES) -> DataFrame:
    """Implausible values -> NULL, by one rule per column."""
    return df.withColumns({c: null_outside(F.col(c), rule) for c, rule in rules.items()})


def clean_text(df: DataFrame) -> DataFrame:
    """City and country folded into one place name; missing texts -> 'N/A'. Adds `identity`,
    by which copies of a reading are known, while name and country are still apart."""
    parts = [F.col(c) for c in ("city", "country", "latitude", "longitude")]
    return df.withColumns(
        {
            "identity": reading_identity(*parts),
            "city": clean_place(F.col("city"), F.col("country")),
            "weather_condition": fill_text(F.col("weather_condition")),
            "descriptions": fill_text(F.col("descriptions")),
        }
    ).drop("country")


def stored_identity() -> Column:
    """reading_identity() of rows whose name and country are folded into one."""
    parts = [F.lit(None).cast("string"), F.col("latitude"), F.col("longitude")]
    return reading_identity(F.col("city"), *parts)


def reject_reason(calendar: tuple[date, date] | None = None) -> Column:
    """Why a row is not valid, NULL when it is. A NULL coordinate is not valid."""
    checks = [
        (F.col("data_timestamp").isNull(), "data_timestamp missing"),
        (~F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)), "longitude"),
        (~F.coalesce(F.col("latitude").between(-90, 90), F.lit(False)), "latitude"),
        (F.col("timezone").isNull(), "timezone missing"),
        (F.length("city") > 100, "city too long"),
    ]
    if calendar is not None:
        outside = ~inside_calendar(F.col("data_timestamp"), *calendar)
        checks.append((outside, "outside calendar"))
    reason = F.lit(None).cast("string")
    for failed, name in reversed(checks):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    return reason


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNotNull())


def shift_wind_columns(df: DataFrame) -> DataFrame:
    """The historic silver layout, written by position with the wind columns out
    of step: wind_speed holds clouds, wind_deg holds wind_speed, clouds holds the
    rounded wind_deg. Only for comparing with tables loaded that way."""
    return df.withColumns(
        {
            "wind_speed": F.col("clouds").cast("decimal(5,2)"),
            "wind_deg": F.col("wind_speed"),
            "clouds": round_to_bigint(F.col("wind_deg")),
        }
    )


def conform(
    readings: DataFrame,
    dedupe_keys: Sequence[str] = ("id",),
    newest_first: Sequence[str] = NEWEST_FIRST,
    calendar: tuple[date, date] | None = None,
    shifted_wind: bool = False,
) -> DataFrame:
    """Cleaned newest copy of each reading, tagged with `reject_reason`.

    `dedupe_keys=("city", "data_timestamp")` treats a reading collected twice as
    one. Deduplication comes first: an invalid newest copy hides an older one.
    """
    newest = latest_rows(readings, dedupe_keys, newest_first) if dedupe_keys else readings
    cleaned = apply_ranges(clean_text(newest))
    if shifted_wind:
        cleaned = shift_wind_columns(cleaned)
    return cleaned.withColumns(
        {
            "source_table": F.lit(BRONZE.full_name),
            "reject_reason": reject_reason(calendar),
        }
    )

"""Scalar column expressions. All are built-in Spark expressions, none depends
on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.schemas import Range

# Seconds of 0001-01-01 and 9999-12-31 23:59:59: what a timestamp can hold.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def clean_place(city: Column, country: Column) -> Column:
    """'  hanoi ', ' vn ' -> 'hanoi, VN'; a NULL part is left out, both NULL give ''."""
    return F.concat_ws(", ", F.trim(city), F.upper(F.trim(country)))


def reading_identity(
    city: Column, country: Column, latitude: Column, longitude: Column
) -> Column:
    """Whose reading it is: the place by its name and country; where the name is missing, by
    country and coordinates. NULL for a nameless reading without coordinates, which is nobody's
    copy. A name never starts with a space, so the two kinds do not meet."""
    name = F.trim(city)
    land = F.coalesce(F.upper(F.trim(country)), F.lit(""))
    # concat() is NULL where a coordinate is
    at = F.concat(
        F.lit(" "), latitude.cast("string"), F.lit(" "), longitude.cast("string"), F.lit(" "), land
    )
    return F.when(F.length(name) > 0, clean_place(city, country)).otherwise(at)


def fill_text(value: Column, default: str = "N/A") -> Column:
    return F.coalesce(value, F.lit(default))


def null_outside(value: Column, rule: Range) -> Column:
    """NULL where the value breaks the rule, else the value (NULL stays NULL)."""
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (value < rule.low if rule.low_allowed else value <= rule.low)
    if rule.high is not None:
        bad = bad | (value > rule.high)
    return F.when(bad, F.lit(None)).otherwise(value)


def once_passed(moment: Column, now: Column) -> Column:
    """Keep `moment` only when `now` has reached it."""
    return F.when(now >= moment, moment)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    """'yyyy-MM' of a timestamp; goes through DATE, which has no time zone."""
    return F.date_format(F.to_date(ts), "yyyy-MM")


def epoch_to_ntz(seconds: Column) -> Column:
    """Epoch seconds -> UTC timestamp without zone; NULL when out of range."""
    seconds = F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)
    return sql_timestamp("1970-01-01 00:00:00") + F.expr("interval '1' second") * seconds


def micros_to_ntz(micros: Column) -> Column:
    """Epoch microseconds -> UTC timestamp without zone."""
    return sql_timestamp("1970-01-01 00:00:00") + F.expr("interval '0.000001' second") * micros


def epoch_of(ts: Column) -> Column:
    """UTC timestamp without zone -> epoch seconds."""
    return F.timestamp_diff("SECOND", sql_timestamp("1970-01-01 00:00:00"), ts)


def falsy_to_null(value: Column, dtype: str) -> Column:
    """0 or '' -> NULL (texts by '', all else by 0)."""
    empty = F.lit("") if dtype.startswith(("varchar", "string")) else F.lit(0)
    return F.nullif(value, empty)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def round_to_bigint(value: Column) -> Column:
    """Rounds half away from zero; a plain cast would cut the fraction off."""
    return F.round(value).cast("bigint")


def object_key(city: Column, collected_at: Column, dt: Column) -> Column:
    """Path of one raw document: city/year/month/day/dt.json, nothing zero-padded."""
    return F.concat_ws(
        "/",
        city,
        F.year(collected_at).cast("string"),
        F.month(collected_at).cast("string"),
        F.dayofmonth(collected_at).cast("string"),
        F.concat(dt.cast("string"), F.lit(".json")),
    )


def sql_timestamp(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal, folded at planning time so that filters push down."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")

"""Rows of the star schema and the daily summary over it.

Dimension joins carry no broadcast hint: Spark broadcasts a dimension whose size
is below its threshold, and otherwise sorts and merges, where adaptive execution
splits the hot cities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import day_of, once_passed
from sedimenta.operators.keys import day_key
from sedimenta.operators.latest import latest_rows, latest_values
from sedimenta.operators.merge import touched_rows, upsert, upsert_with_ids
from sedimenta.schemas import MEASURES, SILVER

_NEWEST_FIRST = ("collected_at", "data_timestamp", "id")


def latest_locations(silver: DataFrame) -> DataFrame:
    """Newest coordinates of each city."""
    return latest_values(silver, ["city"], ["latitude", "longitude"], _NEWEST_FIRST)


def merge_locations(
    dim: DataFrame, increment: DataFrame, null_safe: bool = True, whole: bool = True
) -> DataFrame:
    """The location dimension with the newest coordinates of the increment merged in."""
    return merge_newest(dim, latest_locations(increment), null_safe, whole)


def merge_newest(
    dim: DataFrame, newest: DataFrame, null_safe: bool = True, whole: bool = True
) -> DataFrame:
    """The location dimension with one row per city merged in."""
    return upsert_with_ids(
        dim,
        newest,
        ["city"],
        "location_id",
        update=["latitude", "longitude"],
        null_safe=null_safe,
        whole=whole,
    )


def changed_locations(dim: DataFrame, newest: DataFrame) -> DataFrame:
    """What merge_newest() would insert or update, tagged `_op`; inserted rows have no id yet."""
    merged = upsert(dim, newest, ["city"], update=["latitude", "longitude"], whole=False)
    return touched_rows(merged)


def with_day(silver: DataFrame, local_day: bool = False) -> DataFrame:
    """Adds `day`: the UTC date, or the date at the reading's own offset."""
    moment: Column = F.col("data_timestamp")
    if local_day:
        moment = moment + F.make_dt_interval(secs=F.coalesce("timezone", F.lit(0)))
    return silver.withColumn("day", day_of(moment))


def day_readings(silver: DataFrame, local_day: bool = False) -> DataFrame:
    """Last reading of each city and day; sunrise and sunset only once passed."""
    narrow = with_day(silver, local_day).select(
        "city", "day", "data_timestamp", "id", "sunrise", "sunset", "collected_at"
    )
    last = latest_rows(narrow, ["city", "day"], ["data_timestamp", "collected_at", "id"])
    return last.select(
        "city",
        "day",
        once_passed(F.col("sunrise"), F.col("data_timestamp")).alias("sunrise"),
        once_passed(F.col("sunset"), F.col("data_timestamp")).alias("sunset"),
        "collected_at",
    )


def day_source(silver: DataFrame, dim_location: DataFrame, local_day: bool = False) -> DataFrame:
    """Day rows with their location; location_id is NULL for an unknown city."""
    found = day_readings(silver, local_day).join(
        dim_location.select("city", "location_id"), "city", "left"
    )
    return found.withColumn("source_table", F.lit(SILVER.full_name))


def merge_days(fact_day: DataFrame, source: DataFrame, null_safe: bool = True) -> DataFrame:
    """fact_day after the day rows are merged; first collected_at and source stay."""
    merged = upsert(
        fact_day,
        source,
        ["location_id", "day"],
        update=["sunrise", "sunset"],
        insert_only=["collected_at", "source_table"],
        null_safe=null_safe,
        keep_old_for_null=True,
    )
    return merged.withColumn(
        "fact_day_id", F.coalesce("fact_day_id", day_key("location_id", "day"))
    )


def city_days(silver: DataFrame, local_day: bool = False) -> DataFrame:
    """All that dimensions and daily fact need of an increment, one row per city and day.

    Partial aggregates cut every task's rows to one per city and day before the
    shuffle. `conditions` holds the distinct conditions of that city and day.
    """
    newest = F.struct("collected_at", "data_timestamp", "id")
    last = F.struct("data_timestamp", "collected_at", "id")
    return (
        with_day(silver, local_day)
        .groupBy("city", "day")
        .agg(
            F.max_by(F.struct("latitude", "longitude"), newest).alias("place"),
            F.max(newest).alias("place_order"),
            F.max_by(
                F.struct(
                    once_passed(F.col("sunrise"), F.col("data_timestamp")).alias("sunrise"),
                    once_passed(F.col("sunset"), F.col("data_timestamp")).alias("sunset"),
                    "collected_at",
                ),
                last,
            ).alias("reading"),
            F.collect_set("weather_condition").alias("conditions"),
        )
    )


def locations_of(days: DataFrame) -> DataFrame:
    """Newest coordinates of each city, from city_days()."""
    best = F.max_by("place", "place_order").alias("place")
    return days.groupBy("city").agg(best).select("city", "place.*")


def conditions_of(days: DataFrame) -> DataFrame:
    return days.select(F.explode("conditions").alias("weather_condition"))


def day_source_of(days: DataFrame, dim_location: DataFrame) -> DataFrame:
    """The rows of day_source() from city_days()."""
    readings = days.select("city", "day", "reading.*")
    found = readings.join(dim_location.select("city", "location_id"), "city", "left")
    return found.withColumn("source_table", F.lit(SILVER.full_name))


def look_up(
    facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Facts with columns of the dimension row that has their key; others drop out."""
    return facts.join(dimension.select(key, *columns), key)


def hourly_rows(silver: DataFrame, dim_location: DataFrame, dim_condition: DataFrame) -> DataFrame:
    """Hourly fact rows: both dimension ids looked up on the natural keys.

    The reading's id is the row id: silver holds one row per id.
    """
    placed = look_up(silver, dim_location, "city", ["location_id"])
    joined = look_up(placed, dim_condition, "weather_condition", ["weather_condition_id"])
    return joined.select(
        "id",
        "location_id",
        *[c for c, _ in MEASURES],
        "weather_condition_id",
        "data_timestamp",
        "collected_at",
        F.lit(SILVER.full_name).alias("source_table"),
    )


def daily_state(hourly: DataFrame) -> DataFrame:
    """What hourly rows add to the summary, one row per location and day."""
    return (
        hourly.withColumn("day", day_of(F.col("data_timestamp")))
        .groupBy("location_id", "day")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.count("temperature").alias("measured"),
            F.sum("temperature").cast("decimal(25,2)").alias("total_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
        )
    )


def merged_states(states: DataFrame) -> DataFrame:
    """States of several loads added up, one row per location and day."""
    return states.groupBy("location_id", "day").agg(
        F.sum("readings").alias("readings"),
        F.sum("measured").alias("measured"),
        F.sum("total_temperature").cast("decimal(25,2)").alias("total_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
    )


def summary_of(states: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Readings, mean, lowest and highest temperature per city and day, from one state for each.

    The names are joined to the few summary rows."""
    mean = F.col("total_temperature").cast("double") / F.nullif(F.col("measured"), F.lit(0))
    return states.join(dim_location.select("location_id", "city"), "location_id").select(
        "city",
        "day",
        "readings",
        F.round(mean, 6).alias("avg_temperature"),
        "min_temperature",
        "max_temperature",
    )


def daily_summary(hourly: DataFrame, dim_location: DataFrame) -> DataFrame:
    """The summary computed from the hourly rows themselves."""
    return summary_of(daily_state(hourly), dim_location)

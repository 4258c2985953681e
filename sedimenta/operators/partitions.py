"""Partition calendar, routing of rows to months, rows outside the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import day_of, month_of, sql_timestamp
from sedimenta.schemas import MONTHLY_TABLES, YEARLY_TABLES


def bounds_of(df: DataFrame, ts: str) -> DataFrame:
    """One row (first_day, last_day) of a table's event time."""
    return df.agg(
        day_of(F.min(ts)).alias("first_day"),
        day_of(F.max(ts)).alias("last_day"),
    )


def year_bounds(spark: SparkSession, year: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(date(year, 1, 1)).alias("first_day"), F.lit(date(year, 12, 31)).alias("last_day")
    )


def next_year_bounds(df: DataFrame, ts: str) -> DataFrame:
    """The calendar year after the newest row: what is to be laid out ahead of it."""
    year = F.year(F.max(ts)) + 1
    return df.agg(
        F.make_date(year, F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("last_day"),
    )


def _ranges(bounds: DataFrame, unit: str, months: int) -> DataFrame:
    def start(day: str) -> Column:
        return F.trunc(F.col(day), unit)

    steps = F.sequence(start("first_day"), start("last_day"), F.expr(f"interval {months} month"))
    return bounds.select(F.explode(steps).alias("range_start")).withColumn(
        "range_end", F.add_months("range_start", months)
    )


def month_ranges(bounds: DataFrame) -> DataFrame:
    """Half-open [range_start, range_end) months that cover the bounds."""
    return _ranges(bounds, "month", 1)


def year_ranges(bounds: DataFrame) -> DataFrame:
    return _ranges(bounds, "year", 12)


def calendar(
    bounds: DataFrame,
    monthly: Sequence[str] = MONTHLY_TABLES,
    yearly: Sequence[str] = YEARLY_TABLES,
) -> DataFrame:
    """Named partitions per table: table_2026_07 for months, table_2026 for years."""

    def named(ranges: DataFrame, tables: Sequence[str], pattern: str) -> DataFrame:
        return ranges.select(
            F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"),
            "range_start",
            "range_end",
        ).withColumn(
            "partition_name",
            F.concat_ws("_", "table_name", F.date_format("range_start", pattern)),
        )

    return named(month_ranges(bounds), monthly, "yyyy_MM").unionByName(
        named(year_ranges(bounds), yearly, "yyyy")
    )


def with_month(df: DataFrame, ts: str) -> DataFrame:
    """Adds the month folder a row belongs to."""
    return df.withColumn("p_month", month_of(F.col(ts)))


def rows_per_month(df: DataFrame, ts: str) -> DataFrame:
    return with_month(df, ts).groupBy("p_month").agg(F.count(F.lit(1)).alias("row_count"))


def inside_calendar(ts: Column, first: date, end: date) -> Column:
    """Half-open test; false for NULL."""
    inside = (ts >= sql_timestamp(str(first))) & (ts < sql_timestamp(str(end)))
    return F.coalesce(inside, F.lit(False))


def out_of_calendar(df: DataFrame, ts: str, ranges: DataFrame) -> DataFrame:
    """Rows whose month is in none of the month ranges.

    The ranges hold one row per month, a few thousand at most, so they are
    broadcast and the rows stay where they are.
    """
    known = ranges.select(F.date_format("range_start", "yyyy-MM").alias("p_month")).distinct()
    routed = with_month(df, ts)
    return routed.join(F.broadcast(known), "p_month", "left_anti").drop("p_month")


def read_range(df: DataFrame, ts: str, first: date, end: date) -> DataFrame:
    """Rows of [first, end) from a table laid out by p_month: prunes the folders."""
    folders = F.col("p_month").between(first.strftime("%Y-%m"), end.strftime("%Y-%m"))
    return df.where(folders & inside_calendar(F.col(ts), first, end))

"""High-water marks and increments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import sql_timestamp
from sedimenta.schemas import FIRST_MARK


def high_water_mark(df: DataFrame, ts: str, default: str = FIRST_MARK) -> DataFrame:
    """One row with `mark`: the newest `ts`, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(ts), sql_timestamp(default)).alias("mark"))


def mark_value(df: DataFrame, ts: str, default: str = FIRST_MARK) -> datetime:
    return high_water_mark(df, ts, default).first()["mark"]


def newer_than(df: DataFrame, ts: str, mark: datetime | str | DataFrame) -> DataFrame:
    """Rows strictly newer than the mark; NULL times are left out.

    A literal mark reaches the Parquet scan as a pushed filter. A one-row
    DataFrame becomes a scalar subquery.
    """
    bound: Column = mark.scalar() if isinstance(mark, DataFrame) else sql_timestamp(mark)
    return df.where(F.col(ts) > bound)


def up_to(df: DataFrame, ts: str, mark: datetime | str) -> DataFrame:
    return df.where(F.col(ts) <= sql_timestamp(mark))

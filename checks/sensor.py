"""The supplied `events` table in the shape of bronze sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First load: collected up to here. Second load: the rest.
CUT = "2024-01-15 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; `k` (0..99) is taken from the event's props.

    A row group of the table is read by one task, and what a load writes has the tasks of what
    it reads. Events are therefore spread over all cores first, however few row groups they are in.
    A value that a measure's type cannot hold leaves that measure NULL; a checked cast would end the
    whole load for one such event, of which larger tables have more.
    """
    events = table(spark, sf_dir, "events").hint("rebalance", "event_id").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    return events.selectExpr(
        "event_id as id",
        "concat('  city ', cast(user_id as string), ' ') as city",
        "case when k % 7 = 0 then null else 'vn' end as country",
        "cast(k*2-95 as decimal(9,6)) as latitude",
        "cast(k*4-190 as decimal(9,6)) as longitude",
        "try_cast(value as decimal(5,2)) as temperature",
        "try_cast(try_cast(value as decimal(10,2)) - 5 as decimal(10,2)) as pressure",
        "cast(k*10-50 as bigint) as sea_level",
        "cast(k*9-30 as bigint) as grnd_level",
        "cast(k*2-20 as bigint) as humidity",
        "try_cast(try_cast(value as decimal(5,2)) - 1 as decimal(5,2)) as wind_speed",
        "cast(k*4 + 0.5 as decimal(5,2)) as wind_deg",
        "cast(k-3 as decimal(5,2)) as wind_gust",
        "cast(k+10 as bigint) as clouds",
        "case when event_type='error' then null else event_type end as weather_condition",
        "case when k % 5 = 0 then null else event_type end as descriptions",
        "cast(to_date(ts) as timestamp_ntz) + interval 6 hour as sunrise",
        "cast(to_date(ts) as timestamp_ntz) + interval 18 hour as sunset",
        "case when k % 10 = 0 then null else cast(k*360 as bigint) end as timezone",
        "ts as data_timestamp",
        "cast(to_date(ts) as timestamp_ntz) + make_dt_interval(0, hour(ts) + 1) as collected_at",
    )

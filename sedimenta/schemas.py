"""Table layouts, payload schema and cleaning rules of the sensor warehouse.

Column names, types, table names and range bounds are fixed values: stored data
and existing queries depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

# JSON numbers are read as DOUBLE, so that "87" and "87.0" both parse; flatten()
# casts them to the bronze types.
PAYLOAD_DDL = """
dt DOUBLE, timezone DOUBLE, name STRING,
coord STRUCT<lon: DOUBLE, lat: DOUBLE>,
main STRUCT<temp: DOUBLE, pressure: DOUBLE, humidity: DOUBLE, sea_level: DOUBLE, grnd_level: DOUBLE>,
wind STRUCT<speed: DOUBLE, deg: DOUBLE, gust: DOUBLE>,
clouds STRUCT<all: DOUBLE>,
weather ARRAY<STRUCT<main: STRING, description: STRING>>,
sys STRUCT<country: STRING, sunrise: DOUBLE, sunset: DOUBLE>,
_corrupt_record STRING
"""

MEASURES = (
    ("temperature", "decimal(5,2)"),
    ("pressure", "decimal(10,2)"),
    ("sea_level", "bigint"),
    ("grnd_level", "bigint"),
    ("humidity", "bigint"),
    ("wind_speed", "decimal(5,2)"),
    ("wind_deg", "decimal(5,2)"),
    ("wind_gust", "decimal(5,2)"),
    ("clouds", "bigint"),
)

_PLACE = (("latitude", "decimal(9,6)"), ("longitude", "decimal(9,6)"))
_SKY = (
    ("weather_condition", "varchar(100)"),
    ("descriptions", "varchar(200)"),
    ("sunrise", "timestamp_ntz"),
    ("sunset", "timestamp_ntz"),
    ("timezone", "bigint"),
    ("data_timestamp", "timestamp_ntz"),
)
# Every append-only table is laid out by the month of its event time, then by
# load: a month query prunes, and a repeated load replaces its own folders only.
MONTH_AND_LOAD = (("p_month", "string"), ("load_id", "bigint"))


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    table_column: str


@dataclass(frozen=True)
class Table:
    """One stored table with the constraints that quality checks enforce."""

    layer: str
    name: str
    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[tuple[str, str], ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def all_columns(self) -> tuple[tuple[str, str], ...]:
        extra = tuple(c for c in self.partition_by if c[0] not in dict(self.columns))
        return self.columns + extra


BRONZE = Table(
    "bronze",
    "raw_weather_data",
    (("id", "bigint"), ("city", "varchar(100)"), ("country", "varchar(50)"))
    + _PLACE
    + MEASURES
    + _SKY
    + (("collected_at", "timestamp_ntz"),),
    MONTH_AND_LOAD,
    unique=(("id", "data_timestamp"),),
    required=("data_timestamp",),
)

SILVER = Table(
    "silver",
    "transform_weather_data",
    (("id", "bigint"), ("city", "varchar(100)"))
    + _PLACE
    + MEASURES
    + _SKY
    + (
        ("source_table", "varchar(100)"),
        ("collected_at", "timestamp_ntz"),
        ("created_at", "timestamp_ntz"),
    ),
    MONTH_AND_LOAD,
    unique=(("id", "data_timestamp"),),
    required=("data_timestamp",),
)

SILVER_REJECTS = Table(
    "silver",
    "rejected_weather_data",
    tuple((c, "string" if t.startswith("varchar") else t) for c, t in SILVER.columns)
    + (("reject_reason", "string"),),
    (("load_id", "bigint"),),
)

BRONZE_REJECTS = Table(
    "bronze",
    "rejected_documents",
    (
        ("document", "string"),
        ("source_file", "string"),
        ("landed_at", "timestamp_ntz"),
        ("reject_reason", "string"),
    ),
    (("load_id", "bigint"),),
)

DIM_CONDITION = Table(
    "gold",
    "dim_weather_condition",
    (
        ("weather_condition_id", "bigint"),
        ("weather_condition", "varchar(100)"),
        ("created_at", "timestamp_ntz"),
    ),
    unique=(("weather_condition_id",), ("weather_condition",)),
)

DIM_LOCATION = Table(
    "gold",
    "dim_location",
    (("location_id", "bigint"), ("city", "varchar(100)"))
    + _PLACE
    + (("created_at", "timestamp_ntz"),),
    unique=(("location_id",), ("city",)),
)

FACT_HOURLY = Table(
    "gold",
    "fact_weather_hourly",
    (("id", "bigint"), ("location_id", "bigint"))
    + MEASURES
    + (
        ("weather_condition_id", "bigint"),
        ("data_timestamp", "timestamp_ntz"),
        ("created_at", "timestamp_ntz"),
        ("collected_at", "timestamp_ntz"),
        ("source_table", "varchar(100)"),
    ),
    MONTH_AND_LOAD,
    unique=(("id", "data_timestamp"),),
    required=("data_timestamp",),
    references=(
        Reference("location_id", "gold.dim_location", "location_id"),
        Reference("weather_condition_id", "gold.dim_weather_condition", "weather_condition_id"),
    ),
)

# Partitioned by day, so that an upsert rewrites the touched days only.
FACT_DAY = Table(
    "gold",
    "fact_day",
    (
        ("fact_day_id", "bigint"),
        ("location_id", "bigint"),
        ("sunrise", "timestamp_ntz"),
        ("sunset", "timestamp_ntz"),
        ("created_at", "timestamp_ntz"),
        ("collected_at", "timestamp_ntz"),
        ("source_table", "varchar(100)"),
        ("day", "date"),
    ),
    (("day", "date"),),
    unique=(("fact_day_id", "day"), ("location_id", "day")),
    required=("location_id", "day"),
    references=(Reference("location_id", "gold.dim_location", "location_id"),),
)

# What every load adds to the daily summary; summaries are sums and extremes over loads.
DAILY_STATE = Table(
    "gold",
    "daily_summary_state",
    (
        ("location_id", "bigint"),
        ("day", "date"),
        ("readings", "bigint"),
        ("measured", "bigint"),
        ("total_temperature", "decimal(25,2)"),
        ("min_temperature", "decimal(5,2)"),
        ("max_temperature", "decimal(5,2)"),
    ),
    MONTH_AND_LOAD,
)

LOAD_LOG = Table(
    "audit",
    "load_log",
    (
        ("load_id", "bigint"),
        ("step", "string"),
        ("table_name", "string"),
        ("batch_key", "string"),
        ("inserted", "bigint"),
        ("updated", "bigint"),
        ("rejected", "bigint"),
        ("mark_high", "timestamp_ntz"),
        ("scanned_high", "timestamp_ntz"),
        ("max_key", "bigint"),
        ("source_load", "bigint"),
        ("recorded_at", "timestamp_ntz"),
        ("copies", "bigint"),
        ("index_keys", "string"),
    ),
)

# The log's rows that have been folded.
LOAD_HISTORY = Table("audit", "load_history", LOAD_LOG.columns)

# Keys of the readings in silver, by event day and load; within a file by time, so that an
# increment opens the days it touches and in them the row groups of its times.
READING_INDEX = Table(
    "silver",
    "reading_index",
    (("reading_key", "string"), ("data_timestamp", "timestamp_ntz")),
    (("p_day", "date"), ("load_id", "bigint")),
    unique=(("reading_key", "data_timestamp"),),
    sort_by=("data_timestamp",),
)

# What each load of silver looks like, by column.
LOAD_PROFILE = Table(
    "audit",
    "load_profile",
    (
        ("table_name", "string"),
        ("column_name", "string"),
        ("row_count", "bigint"),
        ("null_count", "bigint"),
        ("null_rate", "double"),
        ("min_value", "double"),
        ("max_value", "double"),
        ("distinct_sketch", "binary"),
    ),
    (("load_id", "bigint"),),
)

TABLES = (
    BRONZE,
    BRONZE_REJECTS,
    SILVER,
    SILVER_REJECTS,
    DIM_CONDITION,
    DIM_LOCATION,
    FACT_HOURLY,
    FACT_DAY,
    DAILY_STATE,
    LOAD_LOG,
    LOAD_HISTORY,
    LOAD_PROFILE,
    READING_INDEX,
)

# Tables that the yearly partition calendar covers.
MONTHLY_TABLES = (BRONZE.full_name, SILVER.full_name, FACT_HOURLY.full_name)
YEARLY_TABLES = (FACT_DAY.full_name,)

# The mark used when a target table is still empty.
FIRST_MARK = "2000-01-01 00:00:00"


@dataclass(frozen=True)
class Range:
    """Values below `low` or above `high` are not plausible and become NULL."""

    low: int | None = None
    high: int | None = None
    low_allowed: bool = True


RANGE_RULES = {
    "pressure": Range(low=0, low_allowed=False),
    "sea_level": Range(low=0, low_allowed=False),
    "grnd_level": Range(low=0, low_allowed=False),
    "humidity": Range(low=0, high=100),
    "clouds": Range(low=0, high=100),
    "wind_speed": Range(low=0),
    "wind_gust": Range(low=0),
    "wind_deg": Range(low=0, high=360),
}

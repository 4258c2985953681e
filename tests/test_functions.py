from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta import functions as X
from sedimenta.schemas import Range


def values(spark, column, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


@pytest.mark.parametrize(
    ("city", "country", "expected"),
    [
        (" Hanoi ", " vn ", "Hanoi, VN"),
        (" Hanoi ", None, "Hanoi"),
        (None, "vn", "VN"),
        (None, None, ""),
    ],
)
def test_clean_place(spark, city, country, expected):
    column = X.clean_place(F.col("city"), F.col("country"))
    assert values(spark, column, [(city, country)], "city string, country string") == [expected]


def test_null_outside_keeps_bounds_and_nulls(spark):
    rows = [(v,) for v in (-1, 0, 100, 101, None)]
    closed = X.null_outside(F.col("v"), Range(low=0, high=100))
    assert values(spark, closed, rows, "v int") == [None, 0, 100, None, None]
    positive = X.null_outside(F.col("v"), Range(low=0, low_allowed=False))
    assert values(spark, positive, rows, "v int") == [None, None, 100, 101, None]


def test_once_passed(spark):
    six, seven = datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 7)
    column = X.once_passed(F.col("moment"), F.col("now"))
    rows = [(six, seven), (six, six), (seven, six), (None, six), (six, None)]
    ddl = "moment timestamp_ntz, now timestamp_ntz"
    assert values(spark, column, rows, ddl) == [six, six, None, None, None]


def test_round_to_bigint_rounds_half_away_from_zero(spark):
    rows = [(v,) for v in ("270.50", "270.49", "-0.50", "-1.49")]
    column = X.round_to_bigint(F.col("v").cast("decimal(5,2)"))
    assert values(spark, column, rows, "v string") == [271, 270, -1, -1]


def test_falsy_and_nan(spark):
    assert values(spark, X.falsy_to_null(F.col("v"), "bigint"), [(0,), (1,)], "v int") == [None, 1]
    texts = values(spark, X.falsy_to_null(F.col("v"), "varchar(9)"), [("",), ("0",)], "v string")
    assert texts == [None, "0"]
    nan = values(spark, X.nan_to_null(F.col("v")), [(float("nan"),), (0.0,)], "v double")
    assert nan == [None, 0.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    # 07:00 UTC on the day New York's clocks go forward; a second before the epoch.
    rows = [(1710054000,), (-1,), (0,), (10**15,), (None,)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = values(spark, X.epoch_to_ntz(F.col("s")), rows, "s bigint")
        back = values(spark, X.epoch_of(X.epoch_to_ntz(F.col("s"))), rows, "s bigint")
        months = values(spark, X.month_of(X.epoch_to_ntz(F.col("s"))), rows, "s bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert moments == [
        datetime(2024, 3, 10, 7),
        datetime(1969, 12, 31, 23, 59, 59),
        datetime(1970, 1, 1),
        None,
        None,
    ]
    assert back == [1710054000, -1, 0, None, None]
    assert months == ["2024-03", "1969-12", "1970-01", None, None]


def test_object_key_is_not_zero_padded(spark):
    column = X.object_key(F.col("city"), F.col("at"), F.col("dt"))
    rows = [("Hanoi", datetime(2024, 3, 5, 1), 7)]
    assert values(spark, column, rows, "city string, at timestamp_ntz, dt bigint") == [
        "Hanoi/2024/3/5/7.json"
    ]

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.operators import conform as clean
from sedimenta.operators import incremental, keys, latest, merge, partitions, quality, star
from sedimenta.schemas import BRONZE, FACT_DAY, FACT_HOURLY

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def reading(**changes):
    row = {
        "id": 1,
        "city": " Hanoi ",
        "country": " vn ",
        "latitude": Decimal("21.03"),
        "longitude": Decimal("105.85"),
        "timezone": 25200,
        "data_timestamp": datetime(2024, 3, 5, 10),
        "collected_at": datetime(2024, 3, 5, 11),
    }
    return row | changes


def ddl_of(spec):
    return ", ".join(f"{c} {'string' if 'varchar' in t else t}" for c, t in spec.columns)


def readings(spark, *rows):
    columns = [c for c, _ in BRONZE.columns]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ddl_of(BRONZE))


# ---- cleaning --------------------------------------------------------------


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        ("pressure", Decimal("0"), None),
        ("pressure", Decimal("0.01"), Decimal("0.01")),
        ("humidity", 100, 100),
        ("humidity", 101, None),
        ("clouds", -1, None),
        ("clouds", 0, 0),
        ("wind_deg", Decimal("360"), Decimal("360.00")),
        ("wind_deg", Decimal("360.5"), None),
        ("wind_speed", Decimal("-0.01"), None),
        ("wind_gust", Decimal("0"), Decimal("0.00")),
        ("sea_level", 0, None),
        ("grnd_level", 1, 1),
        ("temperature", Decimal("-99"), Decimal("-99.00")),
    ],
)
def test_range_rules(spark, column, value, expected):
    (row,) = clean.conform(readings(spark, reading(**{column: value}))).collect()
    assert row[column] == expected


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None),
        ({"latitude": Decimal("90.000000")}, None),
        ({"latitude": Decimal("90.000001")}, "latitude"),
        ({"latitude": None}, "latitude"),
        ({"longitude": Decimal("-180.000001")}, "longitude"),
        ({"timezone": None}, "timezone missing"),
        ({"timezone": 0}, None),
        ({"data_timestamp": None}, "data_timestamp missing"),
        ({"data_timestamp": datetime(2023, 12, 31, 23, 59, 59)}, "outside calendar"),
        ({"data_timestamp": datetime(2024, 1, 1)}, None),
        ({"data_timestamp": datetime(2025, 1, 1)}, "outside calendar"),
        ({"city": "x" * 97}, "city too long"),
        ({"city": "x" * 96}, None),
    ],
)
def test_rejects_say_why(spark, changes, reason):
    calendar = (date(2024, 1, 1), date(2025, 1, 1))
    (row,) = clean.conform(readings(spark, reading(**changes)), calendar=calendar).collect()
    assert row["reject_reason"] == reason


def test_every_row_is_valid_or_rejected(spark, sf_dir):
    from checks.sensor import sensor_readings

    bronze = sensor_readings(spark, sf_dir)
    tagged = clean.conform(bronze)
    good, bad = clean.valid_rows(tagged).count(), clean.rejected_rows(tagged).count()
    assert good + bad == bronze.count() and good and bad


def test_invalid_newest_copy_hides_an_older_valid_one(spark):
    later = reading(id=2, collected_at=datetime(2024, 3, 5, 12), timezone=None)
    both = readings(spark, reading(), later)
    by_key = clean.conform(both, ("city", "data_timestamp")).collect()
    assert [(r["id"], r["reject_reason"]) for r in by_key] == [(2, "timezone missing")]
    assert clean.conform(both, ("id",)).count() == 2


# ---- keys ------------------------------------------------------------------


@FEW
@given(st.sets(st.text(max_size=6), min_size=1, max_size=60), st.integers(0, 1000))
def test_dense_ids_are_dense_and_repeatable(spark, names, after):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    numbered = keys.dense_ids(df.repartition(5), ["name"], "id", after=after)
    found = {r["name"]: r["id"] for r in numbered.collect()}
    assert sorted(found.values()) == list(range(after + 1, after + 1 + len(names)))
    again = keys.dense_ids(df.repartition(3), ["name"], "id", after=after, digits=1)
    assert {r["name"]: r["id"] for r in again.collect()} == found


def test_day_key_is_unique_per_owner_and_day(spark):
    df = spark.sql(
        "select o.id as owner, d.day from range(1, 50) o, "
        "(select explode(sequence(date'1999-12-01', date'2001-02-01')) as day) d"
    )
    counted = df.select(keys.day_key("owner", "day").alias("k")).agg(
        F.count_distinct("k").alias("ids"), F.count("k").alias("rows")
    )
    row = counted.first()
    assert row["ids"] == row["rows"]
    one = spark.sql("select 12L as owner, date'2024-01-15' as day")
    assert one.select(keys.day_key("owner", "day")).first()[0] == 1220240115


# ---- merge -----------------------------------------------------------------

small = st.one_of(st.none(), st.integers(0, 2))
table = st.dictionaries(st.integers(0, 8), st.tuples(small, small), max_size=9)


def as_rows(spark, content):
    rows = [(k, a, b) for k, (a, b) in content.items()]
    return spark.createDataFrame(rows, "k int, a int, b int")


def expected_merge(target, source, null_safe, keep_old):
    result = {}
    for k in target.keys() | source.keys():
        old, new = target.get(k), source.get(k)
        if old is None:
            result[k] = (*new, "I")
            continue
        op, row = "K", old
        if new is not None:

            def changed(n, o):
                if keep_old and n is None:
                    return False
                return n != o if null_safe else None not in (n, o) and n != o

            if any(changed(n, o) for n, o in zip(new, old)):
                op = "U"
                row = tuple(o if keep_old and n is None else n for n, o in zip(new, old))
        result[k] = (*row, op)
    return result


@FEW
@given(table, table, st.booleans(), st.booleans())
def test_upsert_against_brute_force(spark, target, source, null_safe, keep_old):
    stored = as_rows(spark, target)
    merged = merge.upsert(
        stored,
        as_rows(spark, source),
        ["k"],
        ["a", "b"],
        null_safe=null_safe,
        keep_old_for_null=keep_old,
    )
    expected = expected_merge(target, source, null_safe, keep_old)
    found = {r["k"]: (r["a"], r["b"], r["_op"]) for r in merged.collect()}
    assert found == expected
    part = merge.upsert(
        stored,
        as_rows(spark, source),
        ["k"],
        ["a", "b"],
        null_safe=null_safe,
        keep_old_for_null=keep_old,
        whole=False,
    )
    changes = merge.touched_rows(part).drop("_op")
    applied = merge.apply_changes(stored, changes, ["k"]).collect()
    assert {r["k"]: (r["a"], r["b"]) for r in applied} == {k: v[:2] for k, v in expected.items()}


def test_upsert_twice_changes_nothing(spark):
    target, source = as_rows(spark, {1: (1, None)}), as_rows(spark, {1: (1, 2), 2: (0, 0)})
    once = merge.upsert(target, source, ["k"], ["a", "b"])
    assert merge.op_counts(once).first().asDict() == {"inserted": 1, "updated": 1}
    twice = merge.upsert(once.drop("_op"), source, ["k"], ["a", "b"])
    assert merge.op_counts(twice).first().asDict() == {"inserted": 0, "updated": 0}


def test_insert_if_absent_numbers_after_the_highest(spark):
    dim = spark.createDataFrame([(7, "Rain"), (9, "N/A")], "id bigint, name string")
    source = spark.createDataFrame([("Rain",), ("Mist",), ("Mist",), (None,)], "name string")
    new = merge.insert_if_absent(dim, source, "name", "id").collect()
    assert [(r["id"], r["name"]) for r in new] == [(10, "Mist")]


@pytest.mark.parametrize("left", [[1, 2, None], []])
@pytest.mark.parametrize("listed", [[], [2], [2, None], [None], [2, 2, 3]])
def test_not_in_has_sql_null_rules(spark, left, listed):
    df = spark.createDataFrame([(v,) for v in left], "x int")
    listing = spark.createDataFrame([(v,) for v in listed], "y int")
    found = [r["x"] for r in merge.not_in(df, "x", listing, "y").collect()]
    df.createOrReplaceTempView("lefts")
    listing.createOrReplaceTempView("listed")
    sql = spark.sql("select x from lefts where x not in (select y from listed)")
    assert sorted(found, key=str) == sorted([r["x"] for r in sql.collect()], key=str)


# ---- facts -----------------------------------------------------------------


def day_row(spark, sunrise, sunset=None, day=date(2024, 3, 5)):
    collected = datetime(2024, 3, 5, 8)
    ddl = (
        "location_id bigint, day date, sunrise timestamp_ntz, sunset timestamp_ntz, "
        "collected_at timestamp_ntz, source_table string"
    )
    return spark.createDataFrame([(1, day, sunrise, sunset, collected, "s")], ddl)


def test_day_seen_before_and_after_sunrise(spark):
    six = datetime(2024, 3, 5, 6)
    empty = spark.createDataFrame([], ddl_of(FACT_DAY))
    stored = star.merge_days(empty, day_row(spark, None)).drop("_op")
    filled = star.merge_days(stored, day_row(spark, six)).first()
    assert (filled["sunrise"], filled["_op"]) == (six, "U")
    assert filled["fact_day_id"] == 120240305
    strict = star.merge_days(stored, day_row(spark, six), null_safe=False).first()
    assert (strict["sunrise"], strict["_op"]) == (None, "K")
    # A NULL never replaces a stored value.
    kept = star.merge_days(
        star.merge_days(empty, day_row(spark, six)).drop("_op"), day_row(spark, None)
    ).first()
    assert (kept["sunrise"], kept["_op"]) == (six, "K")


def test_local_day_moves_late_readings(spark):
    row = reading(data_timestamp=datetime(2024, 3, 5, 20), timezone=25200)
    utc = star.with_day(readings(spark, row)).first()["day"]
    local = star.with_day(readings(spark, row), local_day=True).first()["day"]
    assert (utc, local) == (date(2024, 3, 5), date(2024, 3, 6))


def test_marks(spark):
    df = readings(spark, reading(), reading(id=2, collected_at=datetime(2024, 3, 5, 12)))
    assert incremental.mark_value(df, "collected_at") == datetime(2024, 3, 5, 12)
    assert incremental.mark_value(df.limit(0), "collected_at") == datetime(2000, 1, 1)
    newer = incremental.newer_than(df, "collected_at", datetime(2024, 3, 5, 11))
    assert [r["id"] for r in newer.collect()] == [2]


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 3)), max_size=30))
def test_latest_forms_agree(spark, content):
    rows = [(k, a, b, i) for i, (k, a, b) in enumerate(content)]
    df = spark.createDataFrame(rows, "k int, a int, b int, i int")
    expected = {}
    for k, a, b, i in rows:
        expected[k] = max(expected.get(k, (-1, -1, -1)), (a, b, i))
    window = latest.latest_rows(df.repartition(4), ["k"], ["a", "b", "i"]).collect()
    argmax = latest.latest_values(df.repartition(4), ["k"], ["i"], ["a", "b", "i"]).collect()
    assert {r["k"]: (r["a"], r["b"], r["i"]) for r in window} == expected
    assert {r["k"]: r["i"] for r in argmax} == {k: v[2] for k, v in expected.items()}


# ---- partitions ------------------------------------------------------------


def test_yearly_calendar(spark):
    rows = partitions.calendar(partitions.year_bounds(spark, 2027)).collect()
    assert len(rows) == 3 * 12 + 1
    december = [r for r in rows if r["partition_name"] == "gold.fact_weather_hourly_2027_12"]
    assert december[0]["range_start"] == date(2027, 12, 1)
    assert december[0]["range_end"] == date(2028, 1, 1)
    year = [r for r in rows if r["partition_name"] == "gold.fact_day_2027"]
    assert (year[0]["range_start"], year[0]["range_end"]) == (date(2027, 1, 1), date(2028, 1, 1))


def test_rows_outside_the_calendar(spark):
    moments = [datetime(2026, 12, 31, 23, 59), datetime(2027, 1, 1), datetime(2028, 1, 1), None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, ts timestamp_ntz")
    ranges = partitions.month_ranges(partitions.year_bounds(spark, 2027))
    outside = partitions.out_of_calendar(df, "ts", ranges)
    assert sorted(r["i"] for r in outside.collect()) == [0, 2, 3]


# ---- quality ---------------------------------------------------------------


def test_checks_find_what_was_broken(spark):
    columns = [c for c, _ in FACT_HOURLY.columns]

    def fact(**values):
        base = {"id": 1, "location_id": 1, "weather_condition_id": 1}
        row = base | {"data_timestamp": datetime(2024, 1, 1)} | values
        return tuple(row.get(c) for c in columns)

    rows = [fact(), fact(), fact(id=2, location_id=5), fact(id=3, location_id=None)]
    rows.append(fact(id=4, data_timestamp=None))
    df = spark.createDataFrame(rows, ddl_of(FACT_HOURLY))
    dims = {
        "gold.dim_location": spark.sql("select 1L as location_id"),
        "gold.dim_weather_condition": spark.sql("select 1L as weather_condition_id"),
    }
    found = {
        r["constraint_name"]: r["violations"]
        for r in quality.check_table(df, FACT_HOURLY, dims).collect()
    }
    assert found == {
        "unique(id, data_timestamp)": 1,
        "not null(data_timestamp)": 1,
        "references(location_id)": 1,
        "references(weather_condition_id)": 0,
    }


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b double")
    rows = quality.profile(df, ["a", "b"]).collect()
    assert [(r["column_name"], r["row_count"], r["null_rate"]) for r in rows] == [
        ("a", 0, None),
        ("b", 0, None),
    ]


@pytest.mark.parametrize("dtype", ["decimal(5,2)", "decimal(9,6)", "decimal(10,2)"])
def test_too_large_agrees_with_the_checked_cast(spark, dtype):
    whole = 10 ** {"decimal(5,2)": 3, "decimal(9,6)": 3, "decimal(10,2)": 8}[dtype]
    steps = [0.0, 0.004, 0.005, 0.006, 0.0000004, 0.0000005, 0.0000006, 0.5, -1.0]
    rows = [(sign * (whole - s),) for s in steps for sign in (1, -1)]
    df = spark.createDataFrame(rows, "v double").select(
        "v",
        quality.too_large("v", dtype).alias("large"),
        F.col("v").try_cast(dtype).isNull().alias("failed"),
    )
    assert [r["v"] for r in df.where("large <> failed").collect()] == []

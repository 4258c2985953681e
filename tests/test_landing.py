import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import conform as clean
from sedimenta.session import fresh_folder
from sedimenta.sources import landing

LANDED = "2024-03-05 10:00:00"


def payload(**changes):
    document = {
        "dt": 1709632800,
        "timezone": 25200,
        "name": "Hanoi",
        "coord": {"lon": 105.85, "lat": 21.03},
        "main": {
            "temp": 18.25,
            "pressure": 1016,
            "humidity": 87.0,
            "sea_level": 1016,
            "grnd_level": 1015,
        },
        "wind": {"speed": 2.5, "deg": 90, "gust": 4.1},
        "clouds": {"all": 75},
        "weather": [{"main": "Clouds", "description": "broken clouds"}, {"main": "Mist"}],
        "sys": {"country": "vn", "sunrise": 1709593200, "sunset": 1709636400},
    }
    for key, value in changes.items():
        if value is None:
            del document[key]
        elif isinstance(value, dict):
            document[key] = document[key] | value
        else:
            document[key] = value
    return json.dumps(document)


def documents(spark, texts, landed=LANDED):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return landing.as_documents(df, F.col("text"), landed)


def flat_rows(spark, *texts, **options):
    flat = landing.flatten(landing.parse(documents(spark, texts)), **options)
    return flat.collect()


def test_flatten_maps_every_field(spark):
    (row,) = flat_rows(spark, payload())
    assert row["reject_reason"] is None
    assert (row["city"], row["country"]) == ("Hanoi", "vn")
    assert (row["latitude"], row["longitude"]) == (Decimal("21.030000"), Decimal("105.850000"))
    assert (row["temperature"], row["pressure"]) == (Decimal("18.25"), Decimal("1016.00"))
    assert (row["humidity"], row["sea_level"], row["grnd_level"], row["clouds"]) == (
        87,
        1016,
        1015,
        75,
    )
    assert (row["wind_speed"], row["wind_deg"], row["wind_gust"]) == (
        Decimal("2.50"),
        Decimal("90.00"),
        Decimal("4.10"),
    )
    assert (row["weather_condition"], row["descriptions"]) == ("Clouds", "broken clouds")
    assert row["data_timestamp"] == datetime(2024, 3, 5, 10)
    assert row["sunrise"] == datetime(2024, 3, 4, 23)
    assert row["timezone"] == 25200


def test_zeros_are_kept_unless_falsy_counts_as_missing(spark):
    text = payload(timezone=0, main={"temp": 0}, clouds={"all": 0}, coord={"lon": 0}, name="")
    (kept,) = flat_rows(spark, text)
    assert (kept["timezone"], kept["temperature"], kept["clouds"]) == (0, Decimal("0.00"), 0)
    assert kept["longitude"] == Decimal("0.000000")
    assert kept["city"] == ""
    (falsy,) = flat_rows(spark, text, falsy_as_null=True)
    for column in ("timezone", "temperature", "clouds", "longitude", "city"):
        assert falsy[column] is None
    assert falsy["latitude"] == Decimal("21.030000")


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("{not json", "malformed"),
        ("", "data_timestamp missing"),
        ("[]", "malformed"),
        (payload(dt=None), "data_timestamp missing"),
        (payload(dt=10**17), "data_timestamp out of range"),
        (payload(dt="soon"), "malformed"),
        (payload(main={"temp": 999.995}), "overflow: temperature"),
        (payload(main={"temp": -1e30}), "overflow: temperature"),
        (payload(main={"temp": 999.994}), None),
        (payload(main={"humidity": 1e30}), "overflow: humidity"),
        (payload(name="x" * 101), "overflow: city"),
        (payload(name="x" * 100), None),
        (payload(wind=None), None),
        (payload(weather=[]), None),
        (payload(weather=None), None),
        (payload(sys=None), None),
    ],
)
def test_one_bad_document_is_rejected_alone(spark, text, reason):
    bad, good = flat_rows(spark, text, payload())
    assert bad["reject_reason"] == reason
    assert good["reject_reason"] is None


def test_missing_groups_become_nulls_and_texts_na(spark):
    flat = landing.flatten(landing.parse(documents(spark, [payload(wind=None, weather=[])])))
    (row,) = flat.collect()
    assert row["wind_speed"] is None and row["wind_deg"] is None and row["wind_gust"] is None
    assert row["weather_condition"] is None
    bronze = landing.bronze_rows(landing.latest_landed(landing.good_documents(flat)))
    (silver,) = clean.conform(bronze).collect()
    assert silver["weather_condition"] == "N/A" and silver["descriptions"] == "N/A"


def test_last_landed_copy_stays(spark):
    first = documents(spark, [payload(), payload(dt=1709632801)])
    second = documents(spark, [payload(main={"temp": 5.0})], "2024-03-05 11:00:00")
    next_day = documents(spark, [payload(main={"temp": 6.0})], "2024-03-06 11:00:00")
    union = first.union(second).union(next_day)
    newest = landing.latest_landed(landing.good_documents(landing.flatten(landing.parse(union))))
    found = sorted((r["ingest_date"], r["data_timestamp"].second, r["temperature"]) for r in newest.collect())
    assert found == [
        (date(2024, 3, 5), 0, Decimal("5.00")),
        (date(2024, 3, 5), 1, Decimal("18.25")),
        (date(2024, 3, 6), 0, Decimal("6.00")),
    ]
    bronze = landing.bronze_rows(newest, after=40)
    assert sorted(r["id"] for r in bronze.collect()) == [41, 42, 43]


def test_landed_documents_read_back_verbatim(spark):
    path = fresh_folder(spark, "landing")
    texts = [payload(), "{not\njson", 'quote " and \\ slash']
    landing.land(documents(spark, texts), path)
    landing.land(documents(spark, texts[:1], "2024-03-06 01:00:00"), path)
    back = landing.read_landed(spark, path)
    assert sorted(r["document"] for r in back.collect()) == sorted(texts + texts[:1])
    day = back.where("ingest_date = date'2024-03-06'").collect()
    assert [r["landed_at"] for r in day] == [datetime(2024, 3, 6, 1)]
    assert "ingest_date=2024-03-06" in day[0]["source_file"]
    landing.land(documents(spark, texts[:1], "2023-12-31 23:00:00"), path)
    assert landing.landing_months(spark, path) == [date(2023, 12, 1), date(2024, 3, 1)]


@pytest.mark.parametrize("layout", ["lines", "files"])
def test_foreign_layouts(spark, tmp_path, layout):
    if layout == "files":
        for dt in (1, 2):
            folder = tmp_path / "Hanoi" / "2024" / "3" / str(dt)
            os.makedirs(folder)
            (folder / f"{dt}.json").write_text(json.dumps(json.loads(payload(dt=dt)), indent=2))
    else:
        (tmp_path / "part.json").write_text(payload(dt=1) + "\n" + payload(dt=2) + "\n")
    read = landing.read_landed(spark, str(tmp_path), layout)
    flat = landing.good_documents(landing.flatten(landing.parse(read))).collect()
    assert sorted(r["data_timestamp"].second for r in flat) == [1, 2]
    assert all(r["landed_at"] is not None for r in flat)
    (month,) = landing.landing_months(spark, str(tmp_path), layout)
    assert month == flat[0]["ingest_date"].replace(day=1)


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        landing.read_landed(spark, "/nowhere", "zip")


def test_first_valid_landed_copy_stays(spark):
    bad = documents(spark, [payload(timezone=None), payload(dt=1709632801, timezone=None)])
    later = documents(spark, [payload(main={"temp": 5.0})], "2024-03-05 11:00:00")
    last = documents(spark, [payload(main={"temp": 6.0})], "2024-03-05 12:00:00")
    flat = landing.flatten(landing.parse(bad.union(later).union(last)))
    rows = landing.first_landed(landing.good_documents(flat)).collect()
    found = sorted((r["data_timestamp"].second, r["temperature"], r["timezone"] is None) for r in rows)
    assert found == [(0, Decimal("5.00"), False), (1, Decimal("18.25"), True)]

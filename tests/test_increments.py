"""Identity of readings, the reading index, the folded log, merged folders, broken moves."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import _documents, _two_loads
from checks.sensor import sensor_readings
from sedimenta.functions import reading_identity
from sedimenta.operators import star
from sedimenta.operators.quality import merged_profiles, profile
from sedimenta.plans import warehouse as plans
from sedimenta.plans.warehouse import Options, Warehouse
from sedimenta.schemas import (
    BRONZE,
    BRONZE_REJECTS,
    DAILY_STATE,
    DIM_LOCATION,
    FACT_HOURLY,
    LOAD_HISTORY,
    LOAD_PROFILE,
    MEASURES,
    READING_INDEX,
    SILVER,
)
from sedimenta.session import fresh_folder
from sedimenta.sources import intents, landing, merging
from sedimenta.sources.files import Folder, data_folders, list_names
from sedimenta.sources.storage import Load

LANDED = "2024-03-05 10:00:00"


def document(name, country, lat=21.0, lon=105.0, dt=1709632800, **main):
    found = {
        "dt": dt,
        "timezone": 3600,
        "coord": {"lat": lat, "lon": lon},
        "main": {"temp": 18.25} | main,
        "weather": [{"main": "Clouds", "description": "few clouds"}],
        "sys": {"country": country},
    }
    return json.dumps(found if name is None else found | {"name": name})


def documents(spark, texts, landed=LANDED):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return landing.as_documents(df, F.col("text"), landed)


def logged(warehouse, step):
    rows = warehouse.audit().where(F.col("step") == step).sort("load_id").collect()
    return [(r["inserted"], r["copies"], r["rejected"]) for r in rows]


# ---- identity ----------------------------------------------------------------


def test_identity(spark):
    rows = [
        (" Paris", "fr", 1.5, 2.0),
        ("Paris ", " FR", 9.0, 9.0),
        ("Paris", "us", 1.5, 2.0),
        ("Paris", None, 1.5, 2.0),
        (None, "fr", 1.5, 2.0),
        ("  ", "FR", 1.5, 2.0),
        ("", None, 1.5, 2.0),
        ("FR", None, 1.5, 2.0),
        (None, "fr", 1.5, 2.5),
        (None, "fr", None, 2.0),
    ]
    frame = spark.createDataFrame(rows, "city string, country string, lat double, lon double")
    own = reading_identity(
        F.col("city"), F.col("country"), F.col("lat").cast("decimal(9,6)"), F.col("lon").cast("decimal(9,6)")
    )
    found = [r[0] for r in frame.select(own).collect()]
    assert found[0] == found[1] == "Paris, FR"
    assert found[4] == found[5] and found[4] != found[8]
    assert found[9] is None
    assert len(set(found)) == 8


def test_namesakes_and_nameless_stations_stay_apart(spark, root):
    texts = [
        document("Paris", "FR"),
        document("Paris", "US"),
        document(None, "AA"),
        document(None, "BB"),
        document(" ", "AA", lat=22.0),
        *[document(None, None, lat=k, lon=-k) for k in range(1, 41)],
    ]
    again = [document("paris ".title(), " fr", temp=1.0), document(None, "aa", temp=2.0)]
    warehouse = Warehouse(spark, root, "names_")
    warehouse.run(documents(spark, texts + texts[:3]))
    warehouse.run(documents(spark, again, "2024-03-05 11:00:00"))
    assert logged(warehouse, "bronze") == [(45, 3, 0), (2, 0, 0)]
    assert logged(warehouse, "silver") == [(45, 0, 0), (0, 2, 0)]
    cities = warehouse.table(SILVER).groupBy("city").count().collect()
    assert {r["city"]: r["count"] for r in cities} == {
        "Paris, FR": 1, "Paris, US": 1, "AA": 1, ", AA": 1, "BB": 1, "": 40
    }
    warm = warehouse.table(SILVER).where("temperature <> 18.25")
    assert warm.count() == 0  # the copies collected first have stayed


def test_documents_of_nobody_are_copies_of_equal_ones_only(spark):
    texts = [document(None, "AA", lat=None), document(None, "AA", lat=None, temp=1.0)]
    flat = landing.flatten(landing.parse(documents(spark, texts + texts[:1])))
    for choose in (landing.first_landed, landing.latest_landed):
        newest = choose(landing.good_documents(flat))
        bronze = landing.bronze_rows(newest).collect()
        assert sorted(r["id"] for r in bronze) == [1, 2]


# ---- reading index -----------------------------------------------------------


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    return _two_loads(sensor_readings(spark, sf_dir))


def silver_rows(warehouse):
    columns = [c for c, _ in SILVER.columns if c != "created_at"]
    return sorted(map(tuple, warehouse.table(SILVER).select(*columns).collect()), key=repr)


def test_copies_are_found_in_every_earlier_load(spark, parts, root):
    """Late copies of all earlier loads, of many days and of one, in one increment."""
    warehouse = Warehouse(spark, root, "late_copies_")
    for k in range(3):
        warehouse.append_readings(parts[0].where(F.col("id") % 3 == k))
        warehouse.transform()
    before = silver_rows(warehouse)
    moved = {"id": F.col("id") + 10_000_000, "collected_at": F.expr("collected_at + interval 1 hour")}
    warehouse.append_readings(parts[0].withColumns(moved))
    warehouse.transform()
    assert silver_rows(warehouse) == before
    (*_, (inserted, copies, _)) = logged(warehouse, "silver")
    assert (inserted, copies) == (0, len(before))
    assert warehouse.table(READING_INDEX).count() == len(before)


def test_only_the_days_of_an_increment_are_opened(spark, root):
    """The index of a month fills by the hour; what an hour opens does not grow."""
    warehouse = Warehouse(spark, root, "hours_", Options(merge_every=0))
    opened = []
    for hour in range(0, 48, 3):
        first = datetime(2024, 5, 1 + hour // 24, hour % 24)
        times = F.lit(first).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, cast(id as int))")
        keys = spark.range(60).select(
            F.concat(F.lit("station "), "id").alias("reading_key"), times.alias("data_timestamp")
        )
        warehouse.store.write_load(
            READING_INDEX, keys.withColumn("p_day", F.to_date("data_timestamp")).coalesce(1), hour + 1
        )
        span = {"p_day": first.date(), "first": first, "last": first.replace(minute=59)}
        taken = warehouse.store.read(READING_INDEX).where(plans._within([span]))
        assert taken.count() == 60
        plan = taken._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(data_timestamp), GreaterThanOrEqual(data_timestamp" in plan
        opened.append(len(taken.inputFiles()))
    assert opened[:8] == opened[8:] == list(range(1, 9))
    (done,) = merging.merge_folders(warehouse.store, READING_INDEX, 45, least=2)
    assert done["rows"] == 15 * 60 and done["bins"] == 2
    taken = warehouse.store.read(READING_INDEX).where(plans._within([span]))
    assert len(taken.inputFiles()) == 2 and taken.count() == 60


def test_many_days_are_given_as_one_range(spark, root):
    warehouse = Warehouse(spark, root, "days_")
    days = F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(cast(id as int))")
    keys = spark.range(200).select(F.col("id").cast("string").alias("reading_key"), days.alias("data_timestamp"))
    warehouse.store.write_load(
        READING_INDEX, keys.withColumn("p_day", F.to_date("data_timestamp")).coalesce(1), 1
    )
    stored = [r["data_timestamp"] for r in warehouse.store.read(READING_INDEX).collect()]
    spans = [{"p_day": t.date(), "first": t, "last": t} for t in sorted(stored)[:100]]
    assert warehouse.store.read(READING_INDEX).where(plans._within(spans)).count() == 100
    assert warehouse.store.read(READING_INDEX).where(plans._within([])).count() == 0


def test_index_follows_a_change_of_keys_and_old_warehouses(spark, parts, root):
    copies = parts[0].withColumn("id", F.col("id") + 10_000_000)
    loose = Warehouse(spark, root, "rekey_", Options(dedupe_keys=("id",)))
    loose.append_readings(parts[0])
    loose.transform()
    assert loose.table(READING_INDEX).count() == 0
    for keys in (("identity", "data_timestamp"), ("city", "data_timestamp"), ("identity", "data_timestamp")):
        strict = Warehouse(spark, root, "rekey_", Options(dedupe_keys=keys))
        before = silver_rows(strict)
        strict.append_readings(copies.withColumn("id", F.col("id") + strict.table(BRONZE).count()))
        strict.transform()
        assert silver_rows(strict) == before
        assert strict.table(READING_INDEX).count() == len(before)


def test_a_failed_silver_load_leaves_no_keys(spark, parts, root, monkeypatch):
    warehouse = Warehouse(spark, root, "keys_crash_")
    warehouse.append_readings(parts[0])

    def fail(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "_commit", fail)
        with pytest.raises(RuntimeError):
            warehouse.transform()
    assert warehouse.store.count(SILVER) > 0
    assert warehouse.table(SILVER).count() == warehouse.table(READING_INDEX).count() == 0
    warehouse.transform()
    assert logged(warehouse, "silver")[0][1] == 0
    assert warehouse.table(SILVER).count() == warehouse.store.count(READING_INDEX) > 0


# ---- log ---------------------------------------------------------------------


def test_files_of_the_log_stay_bounded(spark, root):
    warehouse = Warehouse(spark, root, "long_log_")
    log, most = warehouse.log, 0
    for load in range(1, 41):
        row = {"table_name": SILVER.full_name, "inserted": load, "source_load": load}
        log.commit(Load(load), "silver", f"hour {load}", [row | {"index_keys": f"k{load // 20}"}])
        log.fold(most_files=8)
        most = max(most, log.n_files())
    log.refresh()
    assert most <= 9 and len(log.tail()) <= 9
    assert log.progress().of(SILVER, "load_id") == log.progress().of(SILVER, "source_load") == 40
    assert log.progress().newest(SILVER, "index_keys") == "k2"
    assert log.committed("silver", "hour 3") and log.committed("silver", "hour 40")
    assert not log.committed("silver", "hour 41") and not log.committed("gold", "hour 3")
    assert sorted(r["inserted"] for r in warehouse.audit().collect()) == list(range(1, 41))
    assert len(list_names(spark, warehouse.store.location(LOAD_HISTORY))) <= 4


def test_an_open_gold_load_is_not_folded(spark, parts, root, monkeypatch):
    warehouse = Warehouse(spark, root, "open_log_")
    warehouse.append_readings(parts[0])
    warehouse.transform()

    def fail(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "_load_hourly", fail)
        with pytest.raises(RuntimeError):
            warehouse.load_gold()
    assert not warehouse.log.fold(most_files=0)
    warehouse.load_gold()
    assert warehouse.log.fold(most_files=0)
    assert warehouse.table(FACT_HOURLY).count() == warehouse.table(SILVER).count()


class Break(RuntimeError):
    pass


def breaking(monkeypatch, after):
    """Moves and deletions of noted steps fail after so many."""
    done = [0]

    def limited(action):
        def take(*args):
            if done[0] >= after:
                raise Break
            done[0] += 1
            return action(*args)

        return take

    for name in ("move_path", "delete_path"):
        monkeypatch.setattr(intents, name, limited(getattr(intents, name)))


@pytest.mark.parametrize("after", [0, 1, 3, 5])
def test_a_fold_that_breaks_off_is_finished_by_the_next_opening(spark, root, monkeypatch, after):
    warehouse = Warehouse(spark, root, f"fold_{after}_")
    for load in range(1, 4):
        row = {"table_name": BRONZE.full_name, "inserted": load, "max_key": 10 * load}
        warehouse.log.commit(Load(load), "bronze", None, [row])
    with monkeypatch.context() as patch:
        breaking(patch, after)
        try:
            warehouse.log.fold(most_files=0)
        except Break:
            pass
    again = Warehouse(spark, root, f"fold_{after}_")
    assert sorted(r["inserted"] for r in again.audit().collect()) == [1, 2, 3]
    assert again.log.progress().of(BRONZE, "max_key") == 30
    assert [n for n in list_names(spark, root) if n.startswith(("_fold", "_intents/"))] == []
    assert again.log.n_files() == 1


# ---- merged folders ------------------------------------------------------------


def folder(month, load, size):
    return Folder(f"/{month}/{load}", (f"p_month={month}", f"load_id={load}"), size, 1)


def test_bins_hold_neighbours_up_to_the_target():
    small = [folder("2024-01", k, 10) for k in (3, 1, 2, 10, 11)]
    other = [folder("2024-02", k, 10) for k in (1, 2)]
    large = [folder("2024-01", 4, 60)]
    bins = merging.bins_of(small + other + large, taken=10, target=100, least=3)
    assert [[f.steps for f in one.folders] for one in bins] == [
        [("p_month=2024-01", f"load_id={k}") for k in (1, 2, 3, 10)]
    ]
    many = [folder("2024-01", k, 30) for k in range(1, 11)]
    bins = merging.bins_of(many, taken=99, target=100, least=3)
    assert [len(one.folders) for one in bins] == [3, 3, 3]


@pytest.fixture(scope="module")
def two_loads(spark, parts):
    warehouse = Warehouse(spark, fresh_folder(spark, "test"), "merge_")
    for k in range(2):
        warehouse.append_readings(parts[0].where(F.col("id") % 2 == k))
        warehouse.transform()
        warehouse.load_gold()
    return warehouse


@pytest.fixture
def three_loads(spark, parts, root):
    """Three loads of bronze, all of them taken over as far as the log says."""
    warehouse = Warehouse(spark, root, f"bronze_{root[-8:]}_")
    for k in range(3):
        warehouse.append_readings(parts[0].where(F.col("id") % 3 == k))
    taken = {"table_name": SILVER.full_name, "source_load": 3}
    warehouse.log.commit(Load(1), "silver", None, [taken])
    return warehouse


def bronze_ids(warehouse):
    return sorted(r["id"] for r in warehouse.table(BRONZE).select("id").collect())


@pytest.mark.parametrize("after", [0, 2, 4])
def test_a_merge_that_breaks_off_is_finished_by_the_next_opening(spark, three_loads, monkeypatch, after):
    store, before = three_loads.store, bronze_ids(three_loads)
    with monkeypatch.context() as patch:
        breaking(patch, after)
        try:
            merging.merge_folders(store, BRONZE, 3, least=2)
        except Break:
            pass
    again = Warehouse(spark, store.root, store.prefix)
    assert bronze_ids(again) == before
    assert {f.steps[-1] for f in data_folders(spark, store.location(BRONZE), 2)} == {"load_id=3"}
    assert [n for n in list_names(spark, store.root) if n.startswith("_merge")] == []


def test_a_merge_that_fails_before_its_moves_leaves_the_folders(spark, three_loads, monkeypatch):
    store, before = three_loads.store, bronze_ids(three_loads)
    folders = data_folders(spark, store.location(BRONZE), 2)

    def fail(*args):
        raise Break

    with monkeypatch.context() as patch:
        patch.setattr(merging, "carry_out", fail)
        with pytest.raises(Break):
            merging.merge_folders(store, BRONZE, 3, least=2)
    again = Warehouse(spark, store.root, store.prefix)
    assert data_folders(spark, store.location(BRONZE), 2) == folders
    assert bronze_ids(again) == before


def test_runs_merge_by_themselves(spark, three_loads, monkeypatch):
    warehouse = Warehouse(spark, three_loads.store.root, three_loads.store.prefix, Options(merge_every=3))
    before = bronze_ids(warehouse)
    monkeypatch.setattr(plans.Warehouse.merge_loads, "__defaults__", (merging.TARGET_BYTES, 2))
    warehouse.maintain()
    assert {f.steps[-1] for f in data_folders(spark, warehouse.store.location(BRONZE), 2)} == {"load_id=3"}
    assert bronze_ids(warehouse) == before


# ---- replay --------------------------------------------------------------------


@pytest.mark.parametrize("after", [0, 1, 7, 100])
def test_tables_that_break_off_while_moving_are_moved_by_the_next_opening(
    spark, parts, root, monkeypatch, after
):
    """As at the end of a replay, whose tables take the place of the old ones."""
    old = Warehouse(spark, root, f"moves_{after}_")
    old.append_readings(parts[0].where("id % 5 = 0"))
    new = Warehouse(spark, f"{root}/replay-x", f"beside_{after}_")
    new.append_readings(parts[1])
    with monkeypatch.context() as patch:
        breaking(patch, after)
        try:
            old.store.replace_with(new.store, "replay-x")
        except Break:
            pass
    again = Warehouse(spark, root, f"moves_{after}_")
    assert again.table(BRONZE).count() == parts[1].count()
    assert again.audit().first()["inserted"] == parts[1].count()
    assert [n for n in list_names(spark, root) if n.startswith("replay-")] == []


# ---- readers and profiles --------------------------------------------------------


def test_readers_see_committed_loads_only(spark, parts, root):
    warehouse = Warehouse(spark, root, "readers_")
    warehouse.append_readings(parts[0])
    shaped = warehouse.store.read(BRONZE).drop("load_id")
    warehouse.store.write_load(BRONZE, shaped.withColumn("id", -F.col("id")), 2)
    assert warehouse.store.count(BRONZE) == 2 * parts[0].count()
    assert warehouse.table(BRONZE).where("id < 0").count() == 0
    assert warehouse.table(BRONZE_REJECTS).count() == 0


def test_merged_profiles_equal_one_of_the_table(spark, two_loads):
    names = [c for c, _ in MEASURES]
    whole = {r["column_name"]: r for r in profile(two_loads.table(SILVER), names).collect()}
    merged = {r["column_name"]: r for r in two_loads.profile().collect()}
    assert whole.keys() == merged.keys()
    for name, row in whole.items():
        for field in ("row_count", "null_count", "null_rate", "min_value", "max_value"):
            assert merged[name][field] == row[field]
        exact = two_loads.table(SILVER).agg(F.count_distinct(name)).first()[0]
        assert abs(merged[name]["distinct_estimate"] - exact) <= 1 + 0.05 * exact
    plan = two_loads.profile()._jdf.queryExecution().executedPlan().toString()
    assert SILVER.name not in plan


def summary_rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_the_stored_summary_equals_one_of_the_fact(spark, two_loads):
    def computed():
        hourly = two_loads.table(FACT_HOURLY)
        return summary_rows(star.daily_summary(hourly, two_loads.store.read(DIM_LOCATION)))

    assert summary_rows(two_loads.daily_summary()) == computed()
    plan = two_loads.daily_summary()._jdf.queryExecution().executedPlan().toString()
    assert FACT_HOURLY.name not in plan
    # a warehouse from before there was a summary
    two_loads.store.drop_tables([DAILY_STATE], delete_files=True)
    two_loads.store.create_tables([DAILY_STATE])
    two_loads.load_gold()
    assert summary_rows(two_loads.daily_summary()) == computed()


def test_the_profile_of_an_empty_load(spark, parts, root):
    warehouse = Warehouse(spark, root, "empty_profile_")
    warehouse.append_readings(parts[0].limit(0))
    warehouse.transform()
    (row, *_) = warehouse.table(LOAD_PROFILE).collect()
    assert (row["row_count"], row["null_rate"], row["distinct_sketch"]) == (0, None, None)
    assert merged_profiles(warehouse.table(LOAD_PROFILE)).count() == len(MEASURES)


def test_merge_takes_over_loads_only(spark, two_loads, parts):
    warehouse, before = two_loads, bronze_ids(two_loads)
    warehouse.append_readings(parts[1])  # silver has not taken it over yet
    warehouse.merge_loads(least=2)
    loads = {f.steps[-1] for f in data_folders(spark, warehouse.store.location(BRONZE), 2)}
    assert loads == {"load_id=2", "load_id=3"}
    assert {r["load_id"] for r in warehouse.table(SILVER).select("load_id").distinct().collect()} == {2}
    warehouse.transform()
    warehouse.load_gold()
    assert [r for r in warehouse.check().collect() if r["violations"]] == []
    assert warehouse.table(FACT_HOURLY).count() == warehouse.table(SILVER).count()
    assert set(before) < set(bronze_ids(warehouse))
    names = {r["table_name"] for r in warehouse.log.merges().collect()}
    assert {BRONZE.full_name, SILVER.full_name, FACT_HOURLY.full_name, READING_INDEX.full_name} <= names


# ---- passes over an increment ------------------------------------------------


def test_an_increment_is_neither_cached_nor_its_keys_written_twice(spark, sf_dir, root, monkeypatch):
    """Silver, its rejects and the index come from stored bronze; scratch copies hold the narrow
    keys only, and the ids of copies where there are any."""
    kept, write, persist = [], plans.stored, type(spark.range(0)).persist

    def stored(df, purpose):
        kept.append(purpose)
        return write(df, purpose)

    def persisted(df, *args):
        kept.append("persist")
        return persist(df, *args)

    monkeypatch.setattr(plans, "stored", stored)
    monkeypatch.setattr(type(spark.range(0)), "persist", persisted)
    readings = sensor_readings(spark, sf_dir).where("id < 300")
    again = readings.where("id % 3 = 0").withColumn("id", F.col("id") + 1_000_000)
    warehouse = Warehouse(spark, root, "passes_")
    purposes = []
    for load in (readings, again):
        kept.clear()
        warehouse.append_readings(load)
        warehouse.transform()
        purposes.append(list(kept))
    assert purposes == [["reading-keys"], ["reading-keys", "reading-copies"]]
    (first, second) = logged(warehouse, "silver")
    assert second[0] == 0 and second[1] + second[2] == again.count()
    assert warehouse.table(READING_INDEX).count() == first[0]
    assert warehouse.table(SILVER).count() == first[0]

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import _documents, _two_loads
from checks.sensor import sensor_readings
from sedimenta.plans.warehouse import Options, Warehouse
from sedimenta.schemas import (
    BRONZE,
    BRONZE_REJECTS,
    DIM_CONDITION,
    DIM_LOCATION,
    FACT_DAY,
    FACT_HOURLY,
    SILVER,
    SILVER_REJECTS,
    TABLES,
)
from sedimenta.operators.partitions import read_range
from sedimenta.session import fresh_folder
from sedimenta.sources import landing
from sedimenta.streaming.stream import stream_increments

TIMES = ("created_at", "recorded_at", "load_id")


def content(warehouse, table, without=()):
    df = warehouse.table(table)
    columns = sorted(c for c in df.columns if c not in TIMES and c not in without)
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def hourly_by_name(warehouse, without=()):
    """The hourly fact with names instead of surrogate ids."""
    joined = (
        warehouse.table(FACT_HOURLY)
        .join(warehouse.table(DIM_LOCATION).select("location_id", "city"), "location_id")
        .join(
            warehouse.table(DIM_CONDITION).select("weather_condition_id", "weather_condition"),
            "weather_condition_id",
        )
        .drop("location_id", "weather_condition_id", *TIMES, *without)
    )
    return sorted(map(tuple, joined.select(*sorted(joined.columns)).collect()), key=repr)


def increments(warehouse, *parts):
    for part in parts:
        warehouse.append_readings(part)
        warehouse.transform()
        warehouse.load_gold()
    return warehouse


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    return _two_loads(sensor_readings(spark, sf_dir))


@pytest.fixture(scope="module")
def loaded(spark, parts):
    """A warehouse after two increments. Read only."""
    return increments(Warehouse(spark, fresh_folder(spark, "test"), "loaded_"), *parts)


def test_two_increments_are_one_full_load(spark, sf_dir, loaded, root):
    full = increments(Warehouse(spark, root, "full_"), sensor_readings(spark, sf_dir))
    assert hourly_by_name(full) == hourly_by_name(loaded)
    assert content(full, SILVER) == content(loaded, SILVER)
    names = lambda w: sorted(r["weather_condition"] for r in w.table(DIM_CONDITION).collect())
    assert names(full) == names(loaded)


def test_nothing_new_changes_nothing(spark, parts, root):
    warehouse = increments(Warehouse(spark, root, "again_"), parts[0])
    tables = (BRONZE, SILVER, SILVER_REJECTS, DIM_CONDITION, DIM_LOCATION, FACT_HOURLY, FACT_DAY)
    before = {t: content(warehouse, t) for t in tables}
    warehouse.transform()
    warehouse.load_gold()
    assert {t: content(warehouse, t) for t in tables} == before
    again = warehouse.audit().where("load_id > 1").collect()
    assert again and all(r["inserted"] == r["updated"] == r["rejected"] == 0 for r in again)


def test_every_reading_is_accounted_for(loaded):
    bronze = loaded.store.count(BRONZE)
    assert bronze == loaded.store.count(SILVER) + loaded.store.count(SILVER_REJECTS)
    assert loaded.store.count(SILVER) == loaded.store.count(FACT_HOURLY)


def test_constraints_hold_after_two_increments(loaded):
    found = loaded.check().collect()
    assert len({r["constraint_name"] for r in found}) >= 9
    assert [r for r in found if r["violations"]] == []


def test_a_new_session_finds_the_tables(loaded):
    other = loaded.spark.newSession()
    loaded.store.drop_tables([])  # nothing is dropped without a name
    again = Warehouse(other, loaded.store.root, "attached_")
    assert content(again, FACT_DAY) == content(loaded, FACT_DAY)
    assert again.store.list_tables("gold") == sorted(
        t.name for t in TABLES if t.layer == "gold"
    )


def failing_commit(warehouse, step):
    """The commit of one step fails; the log rows that open a load are written."""
    commit = warehouse._commit

    def fail(load, done, *rest):
        if done == step:
            raise RuntimeError("driver lost")
        commit(load, done, *rest)

    return fail


@pytest.mark.parametrize("step", ["locations", "conditions", "days", "hourly", "commit"])
def test_failed_load_is_repeated_without_loss_or_copies(spark, parts, loaded, root, step, monkeypatch):
    warehouse = increments(Warehouse(spark, root, f"crash_{step}_"), parts[0])
    warehouse.append_readings(parts[1])
    warehouse.transform()

    def fail(*args, **kwargs):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        if step == "commit":
            patch.setattr(warehouse, "_commit", failing_commit(warehouse, "gold"))
        else:
            patch.setattr(warehouse, f"_load_{step}", fail)
        with pytest.raises(RuntimeError):
            warehouse.load_gold()
    if step == "commit":
        # The publication broke off between deleting old files and moving in new ones.
        empty = spark.createDataFrame([], warehouse.table(DIM_LOCATION).schema)
        warehouse.store.overwrite(DIM_LOCATION, empty)
    warehouse.load_gold()
    for table in (DIM_LOCATION, DIM_CONDITION, FACT_DAY, FACT_HOURLY):
        assert content(warehouse, table) == content(loaded, table), table.name
    counts = lambda w: sorted(
        (r["table_name"], r["inserted"], r["updated"])
        for r in w.audit().where("step = 'gold' and load_id > 1").collect()
    )
    assert counts(warehouse) == counts(loaded)


@pytest.mark.parametrize("step", ["locations", "conditions", "days", "hourly", "commit"])
def test_silver_that_comes_between_attempts_is_the_next_load(spark, parts, root, step, monkeypatch):
    warehouse = increments(Warehouse(spark, root, f"between_{step}_"), parts[0])
    warehouse.append_readings(parts[1])
    warehouse.transform()
    with monkeypatch.context() as patch:
        if step == "commit":
            patch.setattr(warehouse, "_commit", failing_commit(warehouse, "gold"))
        else:

            def fail(*args):
                raise RuntimeError("executor lost")

            patch.setattr(warehouse, f"_load_{step}", fail)
        with pytest.raises(RuntimeError):
            warehouse.load_gold()
    later = parts[0].where("id % 2 = 0").withColumns(
        {"id": F.expr("id + 1000000"), "city": F.concat(F.lit("new "), F.trim("city"))}
    )
    warehouse.append_readings(later)
    warehouse.transform()
    for _ in range(2):
        warehouse.load_gold()
    assert warehouse.store.count(FACT_HOURLY) == warehouse.store.count(SILVER)
    assert [r for r in warehouse.check().collect() if r["violations"]] == []
    days = warehouse.table(SILVER).select("city", F.to_date("data_timestamp")).distinct().count()
    assert warehouse.store.count(FACT_DAY) == days


def by_month(readings, month):
    """The readings moved to another month."""
    moved = {c: F.expr(f"{c} + interval {month} months") for c in ("data_timestamp", "collected_at")}
    return readings.withColumns(moved)


@pytest.mark.parametrize("step", ["bronze", "silver", "gold"])
def test_nothing_of_a_failed_attempt_in_other_months_stays(spark, parts, root, step, monkeypatch):
    warehouse = Warehouse(spark, root, f"months_{step}_")
    first, other = by_month(parts[0], 0), by_month(parts[1], 3)

    def attempt(readings):
        if step == "bronze":
            warehouse.append_readings(readings)
            return
        rows = warehouse.store
        number = 7 if step == "silver" else 9
        table = SILVER if step == "silver" else FACT_HOURLY
        shaped = rows.read(table).limit(0)
        made = readings.select(
            *[
                (F.col(c) if c in readings.columns else F.lit(None)).cast(shaped.schema[c].dataType).alias(c)
                for c, _ in table.columns
            ]
        ).withColumn("p_month", F.date_format("data_timestamp", "yyyy-MM"))
        rows.write_load(table, made, number)

    with monkeypatch.context() as patch:
        if step == "bronze":
            patch.setattr(warehouse, "_commit", failing_commit(warehouse, "bronze"))
            with pytest.raises(RuntimeError):
                attempt(first)
        else:
            attempt(first)
    attempt(other)
    table = {"bronze": BRONZE, "silver": SILVER, "gold": FACT_HOURLY}[step]
    assert warehouse.store.count(table) == other.count()
    if step == "bronze":
        logged = warehouse.audit().where("step = 'bronze'").first()["inserted"]
        assert logged == warehouse.store.count(BRONZE)


def test_a_failed_replay_leaves_the_tables(spark, parts, root, monkeypatch):
    path = fresh_folder(spark, "landing")
    warehouse = Warehouse(spark, root, "safe_")
    for part in (parts[0], by_month(parts[1], 2)):
        landing.land(_documents(part), path)
    warehouse.run(_documents(parts[0]))
    before = content(warehouse, FACT_HOURLY)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.replay(path + "-missing")
    assert content(warehouse, FACT_HOURLY) == before
    run = Warehouse.run

    def fail_second(self, documents, batch_key=None, many_months=False):
        if batch_key == "replay 2024-03":
            raise RuntimeError("driver lost")
        return run(self, documents, batch_key, many_months)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "run", fail_second)
        with pytest.raises(RuntimeError):
            warehouse.replay(path)
    assert content(warehouse, FACT_HOURLY) == before
    warehouse.replay(path)
    assert warehouse.store.count(FACT_HOURLY) > len(before)


def test_landing_bounds_rows_per_file_and_streams_write_few_files(spark, parts, root):
    path, checkpoint = fresh_folder(spark, "landing"), fresh_folder(spark, "checkpoint")
    months = parts[0].limit(240).withColumn("_m", F.col("id") % 24)
    shifted = {
        c: F.expr(f"add_months({c}, cast(_m as int)) + make_dt_interval(0, hour({c}))")
        for c in ("data_timestamp", "collected_at")
    }
    readings = months.withColumns(shifted).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in shifted}
    )
    landing.land(_documents(readings).coalesce(1), path, rows_per_file=3)
    rows = landing.read_landed(spark, path).groupBy("source_file").count()
    assert rows.agg(F.max("count")).first()[0] <= 3
    warehouse = Warehouse(spark, root, "backlog_")
    stream_increments(warehouse, path, checkpoint, files_per_batch=10_000).awaitTermination()
    warehouse.refresh()
    files = warehouse.table(BRONZE).select("p_month", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("p_month").count().agg(F.max("count")).first()[0] == 1


def test_failed_silver_write_is_replaced(spark, parts, loaded, root, monkeypatch):
    warehouse = Warehouse(spark, root, "silver_crash_")
    warehouse.append_readings(parts[0])
    with monkeypatch.context() as patch:

        patch.setattr(warehouse, "_commit", failing_commit(warehouse, "silver"))
        with pytest.raises(RuntimeError):
            warehouse.transform()
    warehouse.transform()
    warehouse.load_gold()
    increments(warehouse, parts[1])
    assert content(warehouse, SILVER) == content(loaded, SILVER)
    assert content(warehouse, SILVER_REJECTS) == content(loaded, SILVER_REJECTS)


def test_documents_run_and_batch_key(spark, sf_dir, root):
    readings = sensor_readings(spark, sf_dir)
    broken = F.when(F.col("id") % 10 == 0, F.lit("{")).otherwise(landing.payload())
    documents = landing.as_documents(readings, broken, F.col("collected_at"))
    warehouse = Warehouse(spark, root, "docs_")
    first = warehouse.run(documents, batch_key="hour 1").count()
    assert first == 6
    total, bad = readings.count(), readings.where("id % 10 = 0").count()
    assert warehouse.store.count(BRONZE_REJECTS) == bad
    assert warehouse.store.count(BRONZE) == total - bad
    ids = sorted(r["id"] for r in warehouse.table(BRONZE).collect())
    assert ids == list(range(1, total - bad + 1))
    before = content(warehouse, FACT_HOURLY)
    warehouse.run(documents, batch_key="hour 1")
    assert content(warehouse, FACT_HOURLY) == before
    assert warehouse.audit().count() == 6


def test_options_reach_the_tables(spark, sf_dir, root):
    options = Options(
        calendar=(date(2024, 1, 1), date(2024, 1, 10)),
        shifted_wind=True,
        local_day=True,
        null_safe_days=False,
    )
    warehouse = Warehouse(spark, root, "options_", options)
    increments(warehouse, sensor_readings(spark, sf_dir))
    latest = warehouse.table(SILVER).agg(F.max("data_timestamp")).first()[0]
    assert latest < datetime(2024, 1, 10)
    reasons = {r["reject_reason"] for r in warehouse.table(SILVER_REJECTS).collect()}
    assert "outside calendar" in reasons
    clouds = warehouse.table(SILVER).select("clouds").distinct().count()
    assert clouds > 1


def test_months_are_pruned(loaded):
    hourly = read_range(
        loaded.table(FACT_HOURLY), "data_timestamp", date(2024, 1, 5), date(2024, 1, 6)
    )
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_month" in plan
    assert hourly.count() == loaded.table(FACT_HOURLY).where(
        "date(data_timestamp) = date'2024-01-05'"
    ).count()


def test_drop_tables_deletes_files_when_told(spark, parts, root):
    warehouse = Warehouse(spark, root, "drop_")
    warehouse.append_readings(parts[0])
    kept = warehouse.store.count(BRONZE)
    warehouse.store.drop_tables([BRONZE])
    assert not warehouse.store.exists(BRONZE)
    warehouse.store.create_tables()
    assert warehouse.store.count(BRONZE) == kept
    warehouse.store.drop_tables([BRONZE], delete_files=True)
    warehouse.store.create_tables()
    assert warehouse.store.count(BRONZE) == 0


def test_stream_equals_batch_and_takes_late_files(spark, parts, root):
    path, checkpoint = fresh_folder(spark, "landing"), fresh_folder(spark, "checkpoint")
    warehouse = Warehouse(spark, root, "stream_")

    def drain():
        stream_increments(warehouse, path, checkpoint, files_per_batch=50).awaitTermination()
        warehouse.refresh()

    # The newer half first: the older half then arrives below the mark.
    for part in (parts[1], parts[0]):
        landing.land(_documents(part).repartition(2), path)
        drain()
    batches = warehouse.audit().select("batch_key").distinct().count()
    assert batches >= 2
    batch = Warehouse(spark, fresh_folder(spark, "test"), "stream_batch_")
    batch.run(_documents(parts[0].unionByName(parts[1])))
    assert hourly_by_name(warehouse, ["id"]) == hourly_by_name(batch, ["id"])
    before = warehouse.audit().count()
    drain()
    assert warehouse.audit().count() == before


def test_replay_rebuilds_the_same_facts(spark, parts, root):
    path = fresh_folder(spark, "landing")
    warehouse = Warehouse(spark, root, "replay_")
    for part in parts:
        landing.land(_documents(part), path)
        warehouse.run(_documents(part))
    before = hourly_by_name(warehouse, ["id"])
    warehouse.replay(path)
    assert hourly_by_name(warehouse, ["id"]) == before


def test_replay_keeps_the_valid_copy_of_an_invalid_first_one(spark, parts, root):
    """Stepwise loads take the later valid copy; so does a replay, which loads both at once."""
    path = fresh_folder(spark, "landing")
    warehouse = Warehouse(spark, root, "replay_valid_")
    bad = F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("timezone"))
    hour = F.col("collected_at") + F.expr("interval 1 minute")
    for part in (parts[0].withColumn("timezone", bad), parts[0].withColumn("collected_at", hour)):
        landing.land(_documents(part), path)
        warehouse.run(_documents(part))
    before = hourly_by_name(warehouse, ["id"])
    warehouse.replay(path)
    assert before and hourly_by_name(warehouse, ["id"]) == before

"""Loads work on all cores, however few row groups their input is stored in, and end for no single value."""

from pyspark.sql import functions as F

from checks import queries
from checks.sensor import sensor_readings
from sedimenta.schemas import BRONZE, FACT_HOURLY

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def one_row_group(spark, folder):
    """Events in one file and one row group, with repeated and missing ids."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 3900).alias("event_id"),
        F.expr("timestamp_ntz'2024-01-14 00:00:00' + make_dt_interval(0, 0, cast(id as int))").alias("ts"),
        (F.col("id") % 37).alias("user_id"),
        F.lit("view").alias("event_type"),
        (F.col("id") % 90).cast("double").alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def test_one_row_group_is_read_by_one_task_and_loaded_by_many(spark, tmp_path):
    events = one_row_group(spark, str(tmp_path))
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(small, "1k")
    try:
        readings = sensor_readings(spark, str(tmp_path))
        tasks = readings.select(F.spark_partition_id().alias("task")).distinct().count()
        warehouse = queries._loaded_warehouse(spark, str(tmp_path))
    finally:
        spark.conf.unset(small)
    assert tasks > 1
    stored = warehouse.table(BRONZE).select("load_id", F.input_file_name().alias("file"))
    written = stored.groupBy("load_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files")
    )
    found = {row.load_id: row for row in written.collect()}
    assert len(found) == 2 and all(row.files > 1 for row in found.values())
    assert sum(row.rows for row in found.values()) == events.count()
    ids = [r.id for r in readings.select("id").collect()]
    assert sorted(ids, key=str) == sorted((r.event_id for r in events.select("event_id").collect()), key=str)


def test_a_value_beyond_its_type_ends_no_load(spark, tmp_path):
    """The reading stays, with NULL where the value does not fit and all else as it is."""
    rows = one_row_group(spark, str(tmp_path / "small")).where("event_id is not null").dropDuplicates(["event_id"])
    large = F.when(F.col("event_id") == 7, F.lit(1234.5)).when(F.col("event_id") == 11, F.lit(float("nan")))
    events = rows.withColumn("value", large.when(F.col("event_id") == 13, 999.99).otherwise(F.col("value")))
    events.write.parquet(f"{tmp_path}/events.parquet")
    readings = {r.id: r for r in sensor_readings(spark, str(tmp_path)).collect()}
    assert len(readings) == events.count()
    assert readings[7].temperature is None and readings[7].wind_speed is None and float(readings[7].pressure) == 1229.5
    assert readings[11].temperature is None and readings[11].pressure is None
    assert float(readings[13].temperature) == 999.99 and float(readings[13].wind_speed) == 998.99
    assert sum(r.temperature is None for r in readings.values()) == 2
    landed = queries.latest_landed(spark, str(tmp_path)).where("temperature is null").count()
    assert landed == 2
    warehouse = queries._loaded_warehouse(spark, str(tmp_path))
    assert warehouse.table(BRONZE).count() == len(readings)
    stored = {r.id: r.temperature for r in warehouse.table(FACT_HOURLY).where("id in (7, 11, 13)").collect()}
    assert stored == {i: readings[i].temperature for i in stored} and stored

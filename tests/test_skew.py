"""A third of all rows on one key: whole results, and no task that holds them all."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import keys, latest, merge, quality, star
from sedimenta.schemas import MEASURES


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# No broadcast, and small thresholds, so that small data behaves like large.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def facts(spark, sf_dir):
    """Rows of which a third is city 0, many to a source partition."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(8)
    for i in range(3):
        lineitem = lineitem.unionByName(lineitem) if i else lineitem
    city = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey") % 400)
    return lineitem.select(
        F.monotonically_increasing_id().alias("id"),
        F.concat(F.lit("city "), city.cast("string")).alias("city"),
        F.when(F.col("l_linenumber") == 1, "Rain").otherwise("Mist").alias("weather_condition"),
        F.col("l_shipdate").alias("data_timestamp"),
        F.col("l_shipdate").alias("collected_at"),
        F.col("l_orderkey").alias("latitude"),
        F.col("l_partkey").alias("longitude"),
        *[F.col("l_quantity").cast(t).alias(c) for c, t in MEASURES],
    ).persist()


def dims(spark, facts):
    locations = keys.dense_ids(facts.select("city").distinct(), ["city"], "location_id").persist()
    conditions = keys.dense_ids(
        facts.select("weather_condition").distinct(), ["weather_condition"], "weather_condition_id"
    ).persist()
    return locations, conditions


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_splits_the_hot_city(spark, facts):
    locations, conditions = dims(spark, facts)
    with settings(spark, **LARGE):
        hourly = star.hourly_rows(facts, locations, conditions)
        rows = hourly.collect()
        plan = final_plan(hourly)
    assert len(rows) == facts.count()
    assert "skew=true" in plan
    hot = locations.where("city = 'city 0'").first()["location_id"]
    assert sum(r["location_id"] == hot for r in rows) == facts.where("city = 'city 0'").count()


def test_latest_sends_one_row_per_key_and_task(spark, facts):
    with settings(spark, **LARGE):
        newest = latest.latest_rows(facts, ["city"], ["collected_at", "id"])
        rows = {r["city"]: r["id"] for r in newest.collect()}
        argmax = latest.latest_values(facts, ["city"], ["id"], ["collected_at", "id"])
        assert {r["city"]: r["id"] for r in argmax.collect()} == rows
    assert "row_number(), 1, Partial" in final_plan(newest)
    assert len(rows) == facts.select("city").distinct().count()


def test_orphans_of_one_hot_reference(spark, facts):
    known = facts.select("city").distinct().where("city <> 'city 0'")
    with settings(spark, **LARGE):
        orphans = quality.orphan_rows(facts, "city", known, "city")
        count = orphans.count()
    assert count == facts.where("city = 'city 0'").count() > facts.count() / 4


def test_not_in_with_a_hot_key(spark, facts):
    listing = facts.select("city").where("city <> 'city 0'")
    with settings(spark, **LARGE):
        left = merge.not_in(facts.select("id", "city"), "city", listing, "city")
        found = left.count()
    assert found == facts.where("city = 'city 0'").count()


def test_a_hot_month_is_split_when_written(spark, facts, root):
    hot = facts.select("id", F.lit("2024-01").alias("p_month"), "city", "latitude")
    with settings(spark, **LARGE):
        hot.hint("rebalance", "p_month").write.partitionBy("p_month").parquet(root)
    files = spark.read.parquet(root).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1
    assert spark.read.parquet(root).count() == facts.count()

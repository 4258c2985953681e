"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sensor import CUT, sensor_readings, table
from sedimenta import functions as X
from sedimenta.operators import conform as clean
from sedimenta.operators import incremental, keys, latest, merge, partitions, quality, star
from sedimenta.plans.warehouse import Options, Warehouse
from sedimenta.schemas import (
    BRONZE,
    DIM_CONDITION,
    DIM_LOCATION,
    FACT_DAY,
    FACT_HOURLY,
    LOAD_PROFILE,
    MEASURES,
    READING_INDEX,
    SILVER,
    SILVER_REJECTS,
)
from sedimenta.session import fresh_folder
from sedimenta.sources import landing
from sedimenta.sources.files import data_folders
from sedimenta.streaming.stream import dedupe_stream, stream_increments

BRONZE_COLUMNS = [c for c, _ in BRONZE.columns]
SILVER_COLUMNS = [c for c, _ in SILVER.columns if c != "created_at"]
MEASURE_COLUMNS = [c for c, _ in MEASURES]


# ---- shared steps ----------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    tagged = clean.conform(sensor_readings(spark, sf_dir), **options)
    return clean.valid_rows(tagged).select(*SILVER_COLUMNS)


def _stored(df: DataFrame) -> DataFrame:
    """Written once where several steps read it, as the warehouse's tables are."""
    spark = df.sparkSession
    path = fresh_folder(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_silver(spark, sf_dir))


def _two_loads(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = incremental.up_to(silver, "collected_at", CUT)
    return first, incremental.newer_than(silver, "collected_at", CUT)


def _empty(spark: SparkSession, spec) -> DataFrame:
    ddl = ", ".join(f"{c} {t}" for c, t in spec.columns if c != "created_at")
    return spark.createDataFrame([], ddl.replace("varchar(100)", "string"))


def _locations(spark: SparkSession, first: DataFrame) -> DataFrame:
    return _stored(star.merge_locations(_empty(spark, DIM_LOCATION), first).drop("_op"))


def _conditions(spark: SparkSession, increment: DataFrame) -> DataFrame:
    empty = _empty(spark, DIM_CONDITION)
    new = merge.insert_if_absent(empty, increment, "weather_condition", "weather_condition_id")
    return _stored(new)


def _merged_days(spark: SparkSession, silver: DataFrame, null_safe: bool) -> DataFrame:
    first, second = _two_loads(silver)
    dim_first = _locations(spark, first)
    dim_all = _stored(star.merge_locations(dim_first, second).drop("_op"))

    def rows(increment: DataFrame, dim: DataFrame) -> DataFrame:
        return star.day_source(increment, dim).drop("city")

    stored = star.merge_days(_empty(spark, FACT_DAY), rows(first, dim_first)).drop("_op")
    return star.merge_days(stored, rows(second, dim_all), null_safe)


def _hourly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    silver = _stored_silver(spark, sf_dir)
    locations = _locations(spark, silver)
    return star.hourly_rows(silver, locations, _conditions(spark, silver)), locations


def _scratch_warehouse(spark: SparkSession, **options) -> Warehouse:
    prefix = f"s{uuid.uuid4().hex[:10]}_"
    return Warehouse(spark, fresh_folder(spark, "warehouse"), prefix, Options(**options))


def _documents(readings: DataFrame) -> DataFrame:
    return landing.as_documents(readings, landing.payload(), F.col("collected_at"))


# ---- documents -------------------------------------------------------------


def flatten_payload(spark, sf_dir):
    documents = _documents(sensor_readings(spark, sf_dir))
    good = landing.good_documents(landing.flatten(landing.parse(documents)))
    columns = [c for c in BRONZE_COLUMNS if c not in ("id", "collected_at")]
    return good.select(*columns, F.col("landed_at").alias("collected_at"))


def flatten_falsy_as_null(spark, sf_dir):
    """0 counts as missing: every reading at offset or coordinate 0 shows NULL."""
    documents = _documents(sensor_readings(spark, sf_dir).withColumn("timezone", F.pmod("id", F.lit(3))))
    flat = landing.flatten(landing.parse(documents), falsy_as_null=True)
    return landing.good_documents(flat).select(
        "city", "data_timestamp", "timezone", "humidity", "wind_gust", "sea_level", "temperature"
    )


def rejected_documents(spark, sf_dir):
    """Every 13th document is cut short, every 17th has no reading time, every
    19th a temperature that does not fit."""
    readings = sensor_readings(spark, sf_dir)
    document = (
        F.when(F.col("id") % 13 == 0, F.substring(landing.payload(), 1, 40))
        .when(F.col("id") % 17 == 0, F.regexp_replace(landing.payload(), '"dt":', '"at":'))
        .when(
            F.col("id") % 19 == 0,
            F.regexp_replace(landing.payload(), '"temp":', '"temp":12345'),
        )
        .otherwise(landing.payload())
    )
    documents = landing.as_documents(readings, document, F.col("collected_at"))
    flat = landing.flatten(landing.parse(documents))
    reasons = F.coalesce("reject_reason", F.lit("accepted"))
    return flat.groupBy(reasons.alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


def latest_landed(spark, sf_dir):
    """Half of the readings are landed again with another temperature."""
    readings = sensor_readings(spark, sf_dir)
    again = readings.where("id % 2 = 0").withColumns(
        {
            "temperature": F.lit(1).cast("decimal(5,2)"),
            "collected_at": F.expr("collected_at + interval 1 minute"),
        }
    )
    flat = landing.flatten(landing.parse(_documents(readings.unionByName(again))))
    newest = landing.latest_landed(landing.good_documents(flat))
    return newest.select("city", "ingest_date", "data_timestamp", "temperature", "landed_at")


def bronze_ids(spark, sf_dir):
    flat = landing.flatten(landing.parse(_documents(sensor_readings(spark, sf_dir))))
    newest = landing.latest_landed(landing.good_documents(flat))
    return landing.bronze_rows(newest, after=1000).select("id", "city", "data_timestamp")


def object_keys(spark, sf_dir):
    flat = landing.flatten(landing.parse(_documents(sensor_readings(spark, sf_dir))))
    return landing.with_object_key(flat).select("object_key")


# ---- scalar functions ------------------------------------------------------


def falsy_to_null(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        X.falsy_to_null(F.col("event_id") % 3, "bigint").alias("number_or_null"),
        X.falsy_to_null(F.trim(F.regexp_replace("event_type", "view", " ")), "string").alias(
            "text_or_null"
        ),
    )


def nan_to_null(spark, sf_dir):
    ratio = F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", X.nan_to_null(ratio).alias("value"))


def epoch_to_timestamp(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    seconds = X.epoch_of(F.col("ts"))
    return events.select(
        "event_id", seconds.alias("epoch"), X.epoch_to_ntz(seconds).alias("second")
    )


def clean_text(spark, sf_dir):
    return clean.clean_text(sensor_readings(spark, sf_dir)).select(
        "id", "city", "weather_condition", "descriptions"
    )


def range_rules(spark, sf_dir):
    return clean.apply_ranges(sensor_readings(spark, sf_dir)).select("id", *MEASURE_COLUMNS)


def decimal_to_bigint(spark, sf_dir):
    return sensor_readings(spark, sf_dir).select(
        "id", X.round_to_bigint(F.col("wind_deg")).alias("wind_deg")
    )


# ---- silver ----------------------------------------------------------------


def valid_rows(spark, sf_dir):
    return clean.valid_rows(clean.conform(sensor_readings(spark, sf_dir), ())).select("id")


def rejected_rows(spark, sf_dir):
    tagged = clean.conform(sensor_readings(spark, sf_dir), ())
    return clean.rejected_rows(tagged).select("id", "reject_reason")


def high_water_mark(spark, sf_dir):
    return incremental.high_water_mark(sensor_readings(spark, sf_dir), "collected_at")


def increment_since(spark, sf_dir):
    readings = sensor_readings(spark, sf_dir)
    loaded = incremental.up_to(readings, "collected_at", CUT)
    mark = incremental.high_water_mark(loaded, "collected_at")
    return incremental.newer_than(readings, "collected_at", mark).select("id", "collected_at")


def dedupe_latest(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    order = [
        "l_shipdate",
        "l_extendedprice",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ]
    return latest.latest_rows(lineitem, ["l_orderkey", "l_linenumber"], order)


def latest_price(spark, sf_dir):
    """The argmax form: a few columns of the newest row."""
    return latest.latest_values(
        table(spark, sf_dir, "lineitem"),
        ["l_partkey"],
        ["l_extendedprice", "l_shipdate"],
        ["l_shipdate", "l_extendedprice"],
    )


def silver_full(spark, sf_dir):
    return _silver(spark, sf_dir)


def silver_business_key(spark, sf_dir):
    """A third of the readings is collected twice; one row per city and time."""
    readings = sensor_readings(spark, sf_dir)
    again = readings.where("id % 3 = 0").withColumns(
        {"id": F.expr("id + 1000000000"), "collected_at": F.expr("collected_at + interval 1 hour")}
    )
    tagged = clean.conform(readings.unionByName(again), ("city", "data_timestamp"))
    return clean.valid_rows(tagged).select(*SILVER_COLUMNS)


def silver_shifted_wind(spark, sf_dir):
    silver = _silver(spark, sf_dir, shifted_wind=True)
    return silver.select("id", "wind_speed", "wind_deg", "wind_gust", "clouds")


# ---- dimensions ------------------------------------------------------------


def latest_location(spark, sf_dir):
    return star.latest_locations(_silver(spark, sf_dir))


def location_upsert(spark, sf_dir):
    first, second = _two_loads(_stored_silver(spark, sf_dir))
    return star.merge_locations(_locations(spark, first), second)


def location_upsert_audit(spark, sf_dir):
    return merge.op_counts(location_upsert(spark, sf_dir))


def touched_locations(spark, sf_dir):
    return merge.touched_rows(location_upsert(spark, sf_dir)).select("city", "_op")


def location_refresh(spark, sf_dir):
    """All of silver against the dimension of the first load, compared with !=."""
    silver = _stored_silver(spark, sf_dir)
    first, _ = _two_loads(silver)
    return star.merge_locations(_locations(spark, first), silver, null_safe=False)


def _nullable_upsert(spark, sf_dir, null_safe):
    # Coordinates are missing for some cities, which silver would have rejected.
    missing = F.pmod(F.col("id"), F.lit(3)) == 0
    readings = sensor_readings(spark, sf_dir).withColumn(
        "latitude", F.when(missing, F.lit(None)).otherwise(F.col("latitude"))
    )
    first, second = _two_loads(_stored(readings))
    return star.merge_locations(_locations(spark, first), second, null_safe)


def location_upsert_nullable(spark, sf_dir):
    return _nullable_upsert(spark, sf_dir, True)


def location_refresh_nullable(spark, sf_dir):
    return _nullable_upsert(spark, sf_dir, False)


def condition_insert(spark, sf_dir):
    """The condition dimension after both loads."""
    first, second = _two_loads(_stored_silver(spark, sf_dir))
    dim = _conditions(spark, first)
    new = merge.insert_if_absent(dim, second, "weather_condition", "weather_condition_id")
    return dim.unionByName(new)


def key_insert_scale(spark, sf_dir):
    """Customers that order for the first time after January 1995, with new ids."""
    orders = table(spark, sf_dir, "orders").withColumn("customer", F.col("o_custkey"))
    known = orders.where("o_orderdate < timestamp_ntz'1995-02-01 00:00:00'")
    dim = _stored(keys.dense_ids(known.select("customer").distinct(), ["customer"], "customer_id"))
    later = orders.where("o_orderdate >= timestamp_ntz'1995-02-01 00:00:00'")
    return merge.insert_if_absent(dim, later, "customer", "customer_id")


def not_in_null_aware(spark, sf_dir):
    """Customers NOT IN three lists of orders: plain, holding a NULL, empty. Two thirds of
    the customers are moved out of the list by their sign."""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.expr("case when o_custkey % 3 = 0 then o_custkey else -o_custkey end")
    )
    plain = orders.select(F.col("o_custkey").alias("listed"))
    holed = orders.select(F.expr("nullif(o_custkey, 9)").alias("listed")).unionByName(
        plain.select(F.lit(None).cast("bigint").alias("listed"))
    )
    empty = plain.where("listed is null")
    nullable = customers.select(F.expr("nullif(c_custkey, 1)").alias("c_custkey"))

    def case(name, rows, listing):
        return merge.not_in(rows, "c_custkey", listing, "listed").withColumn("list", F.lit(name))

    return (
        case("plain", nullable, plain)
        .unionByName(case("holed", nullable, holed))
        .unionByName(case("empty", nullable, empty))
    )


def surrogate_keys(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_name").distinct()
    return keys.dense_ids(names, ["c_name"], "customer_id", after=100)


# ---- facts -----------------------------------------------------------------


def day_source(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir)
    return star.day_source(silver, _locations(spark, silver))


def day_readings_local(spark, sf_dir):
    return star.day_readings(_silver(spark, sf_dir), local_day=True)


def day_upsert(spark, sf_dir):
    return _merged_days(spark, _stored_silver(spark, sf_dir), True)


def day_upsert_strict(spark, sf_dir):
    return _merged_days(spark, _stored_silver(spark, sf_dir), False)


def _varied_days(spark, sf_dir, null_safe):
    # Sunrise moves by the reading's id, so that stored values differ from new ones.
    silver = _stored_silver(spark, sf_dir).withColumn(
        "sunrise", F.expr("sunrise + make_dt_interval(0, 0, 0, id % 600)")
    )
    return _merged_days(spark, silver, null_safe)


def day_upsert_varied(spark, sf_dir):
    return _varied_days(spark, sf_dir, True)


def day_upsert_varied_strict(spark, sf_dir):
    return _varied_days(spark, sf_dir, False)


def hourly_fact(spark, sf_dir):
    return _hourly(spark, sf_dir)[0]


def star_join_scale(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    with_part = star.look_up(lineitem, part, "l_partkey", ["p_brand"])
    return star.look_up(with_part, supplier, "l_suppkey", ["s_name"])


def daily_city_summary(spark, sf_dir):
    return star.daily_summary(*_hourly(spark, sf_dir))


# ---- partitions ------------------------------------------------------------

FIRST_DAY, END_DAY = date(1996, 3, 1), date(1999, 8, 1)


def partition_calendar(spark, sf_dir):
    return partitions.calendar(partitions.bounds_of(table(spark, sf_dir, "lineitem"), "l_shipdate"))


def partition_counts(spark, sf_dir):
    return partitions.rows_per_month(table(spark, sf_dir, "lineitem"), "l_shipdate")


def out_of_range_rows(spark, sf_dir):
    """Shipments in no month of the orders' calendar; every 11th part ships ten years late."""
    orders = table(spark, sf_dir, "orders")
    months = partitions.month_ranges(partitions.bounds_of(orders, "o_orderdate"))
    late = "case when l_partkey % 11 = 0 then l_shipdate + interval 10 years else l_shipdate end"
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.expr(late))
    return partitions.out_of_calendar(lineitem, "l_shipdate", months).select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )


def next_year_calendar(spark, sf_dir):
    """The partitions to be made for the year after the newest shipment."""
    return partitions.calendar(partitions.next_year_bounds(table(spark, sf_dir, "lineitem"), "l_shipdate"))


def month_range_read(spark, sf_dir):
    routed = partitions.with_month(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return partitions.read_range(routed, "l_shipdate", FIRST_DAY, END_DAY).select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )


# ---- quality ---------------------------------------------------------------


def unique_violations(spark, sf_dir):
    return quality.unique_violations(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def orphan_rows(spark, sf_dir):
    """Every 7th part's lines refer to orders that do not exist."""
    astray = F.expr("case when l_partkey % 7 = 0 then -l_orderkey else l_orderkey end")
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_orderkey", astray)
    return quality.orphan_rows(
        lineitem, "l_orderkey", table(spark, sf_dir, "orders"), "o_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey")


def missing_required(spark, sf_dir):
    return quality.missing_required(
        sensor_readings(spark, sf_dir), ["country", "weather_condition", "timezone"]
    ).select("id", "missing_columns")


def overflow_rows(spark, sf_dir):
    types = {"l_extendedprice": "decimal(6,2)", "l_quantity": "decimal(3,2)"}
    return quality.overflow_rows(table(spark, sf_dir, "lineitem"), types).select(
        "l_orderkey", "l_linenumber", "overflow_columns"
    )


def text_overflow_rows(spark, sf_dir):
    types = {"text": "varchar(2000)", "source": "varchar(100)", "lang": "varchar(2)"}
    return quality.overflow_rows(table(spark, sf_dir, "documents"), types).select(
        "doc_id", "overflow_columns"
    )


def profile(spark, sf_dir):
    return quality.profile(sensor_readings(spark, sf_dir), [*MEASURE_COLUMNS, "timezone"])


def constraint_checks(spark, sf_dir):
    hourly, locations = _hourly(spark, sf_dir)
    conditions = _conditions(spark, _silver(spark, sf_dir))
    parents = {DIM_LOCATION.full_name: locations, DIM_CONDITION.full_name: conditions}
    # Two copies of some rows and two missing references make violations to find.
    broken = hourly.unionByName(hourly.where("id % 100 = 0")).withColumn(
        "location_id", F.expr("case when id % 50 = 1 then -id else location_id end")
    )
    return quality.check_table(_stored(broken), FACT_HOURLY, parents)


# ---- whole runs ------------------------------------------------------------


def _loaded_warehouse(spark, sf_dir) -> Warehouse:
    warehouse = _scratch_warehouse(spark)
    for readings in _two_loads(sensor_readings(spark, sf_dir)):
        warehouse.append_readings(readings)
        warehouse.transform()
        warehouse.load_gold()
    return warehouse


def load_audit(spark, sf_dir):
    """Counters of two increments, per table."""
    audit = _loaded_warehouse(spark, sf_dir).audit()
    return audit.select(
        F.col("load_id").alias("increment"),
        "table_name",
        "inserted",
        "updated",
        "rejected",
        "mark_high",
    )


def stored_fact_day(spark, sf_dir):
    warehouse = _loaded_warehouse(spark, sf_dir)
    return warehouse.table(FACT_DAY).select(
        "fact_day_id", "location_id", "day", "sunrise", "sunset", "collected_at", "source_table"
    )


def stored_daily_summary(spark, sf_dir):
    warehouse = _loaded_warehouse(spark, sf_dir)
    return star.daily_summary(warehouse.table(FACT_HOURLY), warehouse.table(DIM_LOCATION))


def merged_daily_summary(spark, sf_dir):
    """The summary added up from three loads, which all have rows of every day, after their folders
    have been merged."""
    warehouse = _scratch_warehouse(spark)
    readings = sensor_readings(spark, sf_dir)
    for part in range(3):
        warehouse.append_readings(readings.where(F.col("id") % 3 == part))
        warehouse.transform()
        warehouse.load_gold()
    warehouse.merge_loads(least=2)
    return warehouse.daily_summary()


def stored_counts(spark, sf_dir):
    """Rows per stored table after two increments, and the listed tables."""
    warehouse = _loaded_warehouse(spark, sf_dir)
    tables = [t for t in (BRONZE, SILVER, SILVER_REJECTS, DIM_LOCATION, DIM_CONDITION, FACT_HOURLY, FACT_DAY)]
    listed = {f"{t.layer}.{n}" for t in tables for n in warehouse.store.list_tables(t.layer)}
    counted = [
        warehouse.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t.full_name).alias("table_name"), "row_count"
        )
        for t in tables
        if t.full_name in listed
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def _collected_twice(readings: DataFrame) -> DataFrame:
    """A third of the readings once more, an hour later and with another temperature."""
    return readings.where("id % 3 = 0").withColumns(
        {
            "id": F.expr("id + 1000000000"),
            "collected_at": F.expr("collected_at + interval 1 hour"),
            "temperature": F.lit(1).cast("decimal(5,2)"),
        }
    )


def silver_business_key_two_loads(spark, sf_dir):
    """The copies come in a load of their own; the stored readings stay."""
    readings = sensor_readings(spark, sf_dir)
    warehouse = _scratch_warehouse(spark)
    for load in (readings, _collected_twice(readings)):
        warehouse.append_readings(load)
        warehouse.transform()
    return warehouse.table(SILVER).select(*SILVER_COLUMNS)


def replay_landed_twice(spark, sf_dir):
    """A third of the readings is landed and loaded twice, in two increments; the rows of the
    increments and those of a replay, with the times that each has a row."""
    readings = sensor_readings(spark, sf_dir)
    path = fresh_folder(spark, "landing")
    warehouse = _scratch_warehouse(spark)
    for load in (readings, _collected_twice(readings)):
        landing.land(_documents(load), path)
        warehouse.run(_documents(load))
    columns = [c for c in SILVER_COLUMNS if c != "id"]
    stepwise = _stored(warehouse.table(SILVER).select(*columns))
    warehouse.replay(path)
    both = stepwise.unionByName(warehouse.table(SILVER).select(*columns))
    return both.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def _namesakes(readings: DataFrame) -> DataFrame:
    """A third of the readings from places called Paris in two countries, a third without a name;
    reading times cut to the hour, so that many stations report at one time."""
    name = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(" Paris"))
    country = F.when(F.col("humidity") % 4 == 0, F.lit("fr")).otherwise(F.lit(" us"))
    return readings.withColumns(
        {
            "city": name.otherwise(F.col("city")),
            "country": country,
            "data_timestamp": F.expr("collected_at - interval 1 hour"),
        }
    )


def namesake_cities(spark, sf_dir):
    """Readings in silver per place after two increments and after a replay, and the copies that
    each increment has counted."""
    path = fresh_folder(spark, "landing")
    warehouse = _scratch_warehouse(spark)
    for load in _two_loads(_namesakes(sensor_readings(spark, sf_dir))):
        landing.land(_documents(load), path)
        warehouse.run(_documents(load))

    def places(stage: str) -> DataFrame:
        counted = warehouse.table(SILVER).groupBy("city").agg(F.count(F.lit(1)).alias("readings"))
        return _stored(counted.select(F.lit(stage).alias("stage"), "city", "readings"))

    stepwise = places("stepwise")
    logged = warehouse.audit().where(F.col("step").isin("bronze", "silver"))
    copies = _stored(
        logged.select(
            F.concat_ws(" ", F.lit("copies"), "step", F.col("load_id").cast("string")).alias("stage"),
            F.lit("").alias("city"),
            F.col("copies").alias("readings"),
        )
    )
    warehouse.replay(path)
    return stepwise.unionByName(copies).unionByName(places("replayed"))


def repeated_loads(spark, sf_dir):
    """Six loads, each with half of what the load before it brought once more."""
    readings = sensor_readings(spark, sf_dir)
    warehouse = _scratch_warehouse(spark, merge_every=3)
    for part in range(6):
        again = (F.col("id") % 6 == part - 1) & (F.col("id") % 4 < 2)
        moved = F.when(again, F.col("id") + 1_000_000_000).otherwise(F.col("id"))
        load = readings.where((F.col("id") % 6 == part) | again)
        warehouse.append_readings(load.withColumn("id", moved))
        warehouse.transform()
    logged = warehouse.audit().where(F.col("step") == "silver")
    indexed = warehouse.table(READING_INDEX).agg(F.count(F.lit(1)).alias("indexed"))
    return logged.select("load_id", "inserted", "copies", "rejected").withColumn(
        "indexed", indexed.scalar()
    )


def reindexed_silver(spark, sf_dir):
    """The first load keeps copies; then readings collected twice count as one. The index is
    built from what is stored, and copies of it are found."""
    readings = sensor_readings(spark, sf_dir)
    loose = _scratch_warehouse(spark, dedupe_keys=("id",))
    loose.append_readings(readings)
    loose.transform()
    strict = Warehouse(spark, loose.store.root, loose.store.prefix)
    strict.append_readings(_collected_twice(readings))
    strict.transform()
    return strict.table(SILVER).select(*SILVER_COLUMNS)


_LOADED = (BRONZE, SILVER, SILVER_REJECTS, FACT_HOURLY, READING_INDEX)


def merged_loads(spark, sf_dir):
    """Rows of every append table before and after its load folders are merged, and after another
    load, which takes nothing twice."""
    warehouse = _scratch_warehouse(spark)
    for third in range(3):
        warehouse.append_readings(sensor_readings(spark, sf_dir).where(F.col("id") % 3 == third))
        warehouse.transform()
        warehouse.load_gold()
    parts = []

    def state(stage: str) -> None:
        for t in _LOADED:
            folders = data_folders(spark, warehouse.store.location(t), len(t.partition_by))
            months = len({f.steps[:-1] for f in folders})
            seen = warehouse.table(t).agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count_distinct("data_timestamp").alias("times"),
            )
            parts.append(
                _stored(
                    seen.select(
                        F.lit(stage).alias("stage"),
                        F.lit(t.full_name).alias("table_name"),
                        "row_count",
                        "times",
                        F.lit(len(folders) == months).alias("one_folder_a_month"),
                    )
                )
            )

    state("before")
    warehouse.merge_loads(least=2)
    state("after")
    warehouse.transform()
    warehouse.load_gold()
    state("next load")
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


def folded_log(spark, sf_dir):
    """Counters of two increments after the log has been folded twice, and a third run under the
    key of the first, which is in the history and does nothing."""
    warehouse = _scratch_warehouse(spark)
    loads = [_documents(part) for part in _two_loads(sensor_readings(spark, sf_dir))]
    for key, documents in (("a", loads[0]), ("b", loads[1]), ("a", loads[0])):
        warehouse.run(documents, batch_key=key)
        warehouse.log.fold(most_files=1)
    return warehouse.audit().select(
        F.col("load_id").alias("increment"), "table_name", "inserted", "updated", "rejected", "copies"
    ).withColumn("tail_files", F.lit(warehouse.log.n_files()).cast("bigint"))


def table_profile(spark, sf_dir):
    """Silver's profile merged from those of its loads; distinct values are estimated, and
    compared with their number."""
    warehouse = _loaded_warehouse(spark, sf_dir)
    columns = MEASURE_COLUMNS
    exact = warehouse.table(SILVER).agg(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]),
            F.array(*[F.count_distinct(c) for c in columns]),
        ).alias("n")
    )
    known = _stored(exact.select(F.explode("n").alias("column_name", "n_distinct")))
    off = F.abs(F.col("distinct_estimate") - F.col("n_distinct"))
    return warehouse.profile().join(known, "column_name").select(
        "column_name",
        "row_count",
        "null_count",
        "null_rate",
        "min_value",
        "max_value",
        "n_distinct",
        (off <= 1 + 0.05 * F.col("n_distinct")).alias("estimate_holds"),
    )


def late_rows(spark, sf_dir):
    """Rows per option when the newer half comes first and some rows have no or an old
    collection time: by load all valid ones arrive, by mark the late ones do not."""
    old = F.when(F.col("id") % 5 == 0, F.lit(None)).when(
        F.col("id") % 7 == 0, F.expr("timestamp_ntz'1999-06-01 00:00:00'")
    )
    first, second = _two_loads(sensor_readings(spark, sf_dir))
    parts = []
    for by_load in (True, False):
        warehouse = _scratch_warehouse(spark, by_load=by_load)
        for load in (second, first):
            untimely = old.otherwise(F.col("collected_at"))
            warehouse.append_readings(load.withColumn("collected_at", untimely))
            warehouse.transform()
        counted = warehouse.table(SILVER).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(counted.select(F.lit(by_load).alias("by_load"), "row_count"))
    return parts[0].unionByName(parts[1])


def gold_retry(spark, sf_dir):
    """Audit and hourly rows of gold when an attempt fails after its dimensions and more silver,
    with new cities, arrives before the retry."""
    readings = sensor_readings(spark, sf_dir)
    first, second = _two_loads(readings)
    fresh = _collected_twice(readings).withColumn("city", F.concat(F.lit("new "), F.trim("city")))
    warehouse = _scratch_warehouse(spark)
    warehouse.append_readings(first)
    warehouse.transform()
    warehouse.load_gold()
    warehouse.append_readings(second)
    warehouse.transform()
    attempt = _FailingHourly(spark, warehouse.store.root, warehouse.store.prefix)
    try:
        attempt.load_gold()
    except InterruptedError:
        pass
    warehouse.append_readings(fresh)
    warehouse.transform()
    for _ in range(3):
        warehouse.load_gold()
    hourly = warehouse.table(FACT_HOURLY).groupBy("load_id").agg(F.count(F.lit(1)).alias("stored"))
    logged = warehouse.audit().where(F.col("step") == "gold")
    return logged.join(hourly.where(F.col("load_id") > 0), "load_id", "left").select(
        F.col("load_id").alias("increment"), "table_name", "inserted", "updated", "stored"
    )


class _FailingHourly(Warehouse):
    """Stops where the hourly fact would be written."""

    def _load_hourly(self, *args):
        raise InterruptedError("stopped before the hourly fact")


def load_profile(spark, sf_dir):
    """What every load of silver has stored about its columns."""
    profiles = _loaded_warehouse(spark, sf_dir).table(LOAD_PROFILE).drop("distinct_sketch")
    return profiles.withColumnRenamed("load_id", "increment")


def stored_created_at(spark, sf_dir):
    """created_at has one value per load and is never NULL."""
    warehouse = _loaded_warehouse(spark, sf_dir)
    counted = [
        warehouse.table(t)
        .groupBy(F.lit(t.full_name).alias("table_name"), F.col("load_id").alias("increment"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("created_at").alias("times"),
            F.count_if(F.col("created_at").isNull()).alias("missing"),
        )
        for t in (SILVER, FACT_HOURLY)
    ]
    return counted[0].unionByName(counted[1])


def dropped_table(spark, sf_dir):
    """Rows of bronze after the table is dropped and made again, without and with its files."""
    warehouse = _scratch_warehouse(spark)
    warehouse.append_readings(sensor_readings(spark, sf_dir))
    parts = []
    for delete_files in (False, True):
        warehouse.store.drop_tables([BRONZE], delete_files)
        dropped = not warehouse.store.exists(BRONZE)
        warehouse.store.create_tables()
        counted = _stored(warehouse.table(BRONZE).agg(F.count(F.lit(1)).alias("row_count")))
        parts.append(
            counted.select(
                F.lit(delete_files).alias("files_deleted"), F.lit(dropped).alias("dropped"), "row_count"
            )
        )
    return parts[0].unionByName(parts[1])


def replay_equals_incremental(spark, sf_dir):
    """All documents are landed, then every table is rebuilt from them."""
    path = fresh_folder(spark, "landing")
    landing.land(_documents(sensor_readings(spark, sf_dir)), path)
    warehouse = _scratch_warehouse(spark)
    warehouse.replay(path)
    return warehouse.table(SILVER).select(*[c for c in SILVER_COLUMNS if c != "id"])


def stream_hourly_fact(spark, sf_dir):
    """Landed files loaded by a stream, two micro-batches or more."""
    path = fresh_folder(spark, "landing")
    for readings in _two_loads(sensor_readings(spark, sf_dir)):
        landing.land(_documents(readings), path)
    warehouse = _scratch_warehouse(spark)
    stream = stream_increments(
        warehouse, path, fresh_folder(spark, "checkpoint"), files_per_batch=100
    )
    stream.awaitTermination()
    warehouse.refresh()
    named = warehouse.table(FACT_HOURLY).join(warehouse.table(DIM_LOCATION), "location_id")
    named = named.join(warehouse.table(DIM_CONDITION), "weather_condition_id")
    return named.select("city", "weather_condition", *MEASURE_COLUMNS, "data_timestamp", "collected_at")


def stream_dedupe(spark, sf_dir):
    """A third of the events arrives twice; the stream keeps one of each."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    path, out = fresh_folder(spark, "events"), fresh_folder(spark, "unique")
    events.unionByName(events.where("event_id % 3 = 0")).write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    unique = dedupe_stream(stream, ["user_id", "ts"], "ts", "1 hour")
    (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", fresh_folder(spark, "checkpoint"))
        .option("path", out)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(events.schema).parquet(out)


ALL = (
    flatten_payload,
    flatten_falsy_as_null,
    rejected_documents,
    latest_landed,
    bronze_ids,
    object_keys,
    falsy_to_null,
    nan_to_null,
    epoch_to_timestamp,
    clean_text,
    range_rules,
    decimal_to_bigint,
    valid_rows,
    rejected_rows,
    high_water_mark,
    increment_since,
    dedupe_latest,
    latest_price,
    silver_full,
    silver_business_key,
    silver_shifted_wind,
    latest_location,
    location_upsert,
    location_upsert_audit,
    touched_locations,
    location_refresh,
    location_upsert_nullable,
    location_refresh_nullable,
    condition_insert,
    key_insert_scale,
    not_in_null_aware,
    surrogate_keys,
    day_source,
    day_readings_local,
    day_upsert,
    day_upsert_strict,
    day_upsert_varied,
    day_upsert_varied_strict,
    hourly_fact,
    star_join_scale,
    daily_city_summary,
    partition_calendar,
    next_year_calendar,
    partition_counts,
    out_of_range_rows,
    month_range_read,
    unique_violations,
    orphan_rows,
    missing_required,
    overflow_rows,
    text_overflow_rows,
    profile,
    constraint_checks,
    load_audit,
    stored_fact_day,
    stored_daily_summary,
    merged_daily_summary,
    stored_counts,
    stored_created_at,
    load_profile,
    dropped_table,
    silver_business_key_two_loads,
    replay_landed_twice,
    namesake_cities,
    repeated_loads,
    reindexed_silver,
    merged_loads,
    folded_log,
    table_profile,
    late_rows,
    gold_retry,
    replay_equals_incremental,
    stream_hourly_fact,
    stream_dedupe,
)

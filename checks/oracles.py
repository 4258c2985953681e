"""DuckDB SQL of the registered queries, over the same Parquet tables."""

from __future__ import annotations

from checks.sensor import CUT

_CUT = f"timestamp '{CUT}'"

_SENSOR = """
sensor as (
  select event_id as id,
    concat('  city ', cast(user_id as varchar), ' ') as city,
    case when k % 7 = 0 then null else 'vn' end as country,
    cast(k*2-95 as decimal(9,6)) as latitude, cast(k*4-190 as decimal(9,6)) as longitude,
    cast(value as decimal(5,2)) as temperature,
    cast(cast(value as decimal(10,2)) - 5 as decimal(10,2)) as pressure,
    cast(k*10-50 as bigint) as sea_level, cast(k*9-30 as bigint) as grnd_level,
    cast(k*2-20 as bigint) as humidity,
    cast(cast(value as decimal(5,2)) - 1 as decimal(5,2)) as wind_speed,
    cast(k*4 + 0.5 as decimal(5,2)) as wind_deg, cast(k-3 as decimal(5,2)) as wind_gust,
    cast(k+10 as bigint) as clouds,
    case when event_type='error' then null else event_type end as weather_condition,
    case when k % 5 = 0 then null else event_type end as descriptions,
    date_trunc('day',ts) + interval 6 hour as sunrise,
    date_trunc('day',ts) + interval 18 hour as sunset,
    case when k % 10 = 0 then null else cast(k*360 as bigint) end as timezone,
    ts as data_timestamp, date_trunc('hour',ts) + interval 1 hour as collected_at
  from (select *, cast(props->>'$.k' as integer) as k from events)
)"""

_MEASURES = (
    "temperature, pressure, sea_level, grnd_level, humidity, wind_speed, wind_deg, wind_gust, clouds"
)
_POSITIVE = ("pressure", "sea_level", "grnd_level")
_BETWEEN = {"humidity": 100, "clouds": 100, "wind_deg": 360}
_RANGED = ", ".join(
    ["temperature"]
    + [f"case when {c} > 0 then {c} end as {c}" for c in _POSITIVE]
    + [f"case when {c} between 0 and {top} then {c} end as {c}" for c, top in _BETWEEN.items()]
    + [f"case when {c} >= 0 then {c} end as {c}" for c in ("wind_speed", "wind_gust")]
)
_TEXTS = """concat_ws(', ', trim(city), upper(trim(country))) as city,
    coalesce(weather_condition, 'N/A') as weather_condition,
    coalesce(descriptions, 'N/A') as descriptions"""
_VALID = "longitude between -180 and 180 and latitude between -90 and 90 and timezone is not null"


def _silver(source: str = "sensor", name: str = "silver", keys: str = "id") -> str:
    return f"""
{name} as (
  select id, latitude, longitude, {_RANGED}, {_TEXTS}, sunrise, sunset, timezone, data_timestamp,
    'bronze.raw_weather_data' as source_table, collected_at
  from (select *, row_number() over (
      partition by {keys} order by collected_at desc, data_timestamp desc, id desc) as rn
    from {source})
  where rn = 1 and {_VALID}
)"""


def _loads(source: str) -> str:
    return f"""
first_load as (select * from {source} where collected_at <= {_CUT}),
second_load as (select * from {source} where collected_at > {_CUT})"""


def _latest_locations(source: str, name: str) -> str:
    return f"""
{name} as (
  select distinct on (city) city, latitude, longitude from {source}
  order by city, collected_at desc, data_timestamp desc, id desc
)"""


def _merged_locations(old: str, new: str, distinct: str = "is distinct from") -> str:
    """dim_one: ids of the first load; dim_two: after the second, with _op."""
    change = f"(n.latitude {distinct} o.latitude or n.longitude {distinct} o.longitude)"
    return f"""
dim_one as (
  select row_number() over (order by md5(city), city) as location_id, city, latitude, longitude
  from {old}
),
joined as (
  select o.location_id, coalesce(n.city, o.city) as city,
    o.latitude as old_latitude, o.longitude as old_longitude, n.latitude, n.longitude,
    case when o.city is null then 'I'
         when n.city is not null and coalesce({change}, false) then 'U' else 'K' end as _op
  from dim_one o full outer join {new} n on o.city = n.city
),
dim_two as (
  select coalesce(location_id, (select count(*) from dim_one)
      + row_number() over (partition by _op order by md5(city), city)) as location_id,
    city, case when _op = 'K' then old_latitude else latitude end as latitude,
    case when _op = 'K' then old_longitude else longitude end as longitude, _op
  from joined
)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


_LOCATIONS = (
    _SENSOR,
    _silver(),
    _loads("silver"),
    _latest_locations("first_load", "latest_one"),
    _latest_locations("second_load", "latest_two"),
    _merged_locations("latest_one", "latest_two"),
)

# Dimensions of one full load.
_DIMS = (
    _SENSOR,
    _silver(),
    _latest_locations("silver", "latest_all"),
    """
dim_location as (
  select row_number() over (order by md5(city), city) as location_id, * from latest_all
),
dim_condition as (
  select row_number() over (order by md5(weather_condition), weather_condition)
    as weather_condition_id, weather_condition
  from (select distinct weather_condition from silver)
),
hourly as (
  select s.id, l.location_id, """
    + _MEASURES
    + """, c.weather_condition_id, data_timestamp, collected_at,
    'silver.transform_weather_data' as source_table
  from silver s join dim_location l on s.city = l.city
    join dim_condition c on s.weather_condition = c.weather_condition
)""",
)

_SUMMARY = """
select city, day, readings, round(mean, 6) as avg_temperature, min_temperature, max_temperature
from (
  select city, cast(data_timestamp as date) as day, count(*) as readings,
    cast(sum(temperature) as double) / count(temperature) as mean,
    min(temperature) as min_temperature, max(temperature) as max_temperature
  from {hourly} group by city, cast(data_timestamp as date)
)"""


def _days(source: str, name: str, moment: str = "data_timestamp") -> str:
    return f"""
{name} as (
  select city, cast({moment} as date) as day,
    case when data_timestamp >= sunrise then sunrise end as sunrise,
    case when data_timestamp >= sunset then sunset end as sunset, collected_at
  from (select *, row_number() over (
      partition by city, cast({moment} as date)
      order by data_timestamp desc, collected_at desc, id desc) as rn from {source})
  where rn = 1
)"""


_DAY_KEY = "location_id * 100000000 + cast(strftime(day, '%Y%m%d') as bigint)"


def _merged_days(null_safe: bool) -> str:
    differs = "is distinct from" if null_safe else "!="
    change = " or ".join(
        f"(n.{c} is not null and n.{c} {differs} o.{c})" for c in ("sunrise", "sunset")
    )
    columns = """d.location_id, day, sunrise, sunset, collected_at,
    'silver.transform_weather_data' as source_table"""
    return f"""
old_days as (select {columns} from days_one s left join dim_two d on s.city = d.city),
new_days as (select {columns} from days_two s left join dim_two d on s.city = d.city),
merged_days as (
  select coalesce(o.location_id, n.location_id) as location_id, coalesce(o.day, n.day) as day,
    case when op = 'I' then n.sunrise when op = 'U' then coalesce(n.sunrise, o.sunrise)
      else o.sunrise end as sunrise,
    case when op = 'I' then n.sunset when op = 'U' then coalesce(n.sunset, o.sunset)
      else o.sunset end as sunset,
    case when op = 'I' then n.collected_at else o.collected_at end as collected_at,
    case when op = 'I' then n.source_table else o.source_table end as source_table, op as _op
  from (
    select o, n, case when o.location_id is null then 'I'
      when n.location_id is not null and coalesce({change}, false) then 'U' else 'K' end as op
    from old_days o full outer join new_days n
      on o.location_id = n.location_id and o.day = n.day)
)"""


def _day_upsert(null_safe: bool, sensor_days: str = "silver") -> str:
    return (
        _with(
            *_LOCATIONS[:2],
            f"""
varied as (
  select * replace (sunrise + to_seconds(id % 600) as sunrise) from silver
)""",
            _loads(sensor_days),
            *_LOCATIONS[3:],
            _days("first_load", "days_one"),
            _days("second_load", "days_two"),
            _merged_days(null_safe),
        )
        + f"select {_DAY_KEY} as fact_day_id, * from merged_days"
    )


# Epochs in a document are whole seconds; the last landed copy of a reading stays.
_SECONDS = """
landed as (select * replace (date_trunc('second', data_timestamp) as data_timestamp) from sensor)"""

_AGAIN = """
again as (
  select * from landed union all
  select * replace (cast(1 as decimal(5,2)) as temperature,
    collected_at + interval 1 minute as collected_at) from landed where id % 2 = 0
)"""


def _nullable_locations(distinct: str) -> str:
    return (
        _with(
            _SENSOR,
            """
holed as (
  select * replace (case when id % 3 = 0 then null else latitude end as latitude) from sensor
)""",
            _loads("holed"),
            _latest_locations("first_load", "latest_one"),
            _latest_locations("second_load", "latest_two"),
            _merged_locations("latest_one", "latest_two", distinct),
        )
        + "select * from dim_two"
    )


def _not_in(name: str, listing: str) -> str:
    return f"""
select c_custkey, '{name}' as list from (select nullif(c_custkey, 1) as c_custkey from customer)
where c_custkey not in ({listing})"""


_SIGNED_ORDERS = """from (
  select case when o_custkey % 3 = 0 then o_custkey else -o_custkey end as o_custkey from orders)"""

_CALENDAR = """
months as (
  select cast(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), interval 1 month))
    as date) as range_start from bounds
),
years as (
  select cast(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi), interval 1 year))
    as date) as range_start from bounds
)
select t as table_name, range_start, cast(range_start + interval 1 month as date) as range_end,
  t || '_' || strftime(range_start, '%Y_%m') as partition_name
from months, (values ('bronze.raw_weather_data'), ('silver.transform_weather_data'),
  ('gold.fact_weather_hourly')) as v(t)
union all
select 'gold.fact_day', range_start, cast(range_start + interval 1 year as date),
  'gold.fact_day_' || strftime(range_start, '%Y')
from years"""

_TWO_LOAD_COUNTS = _with(
    *_LOCATIONS,
    _days("first_load", "days_one"),
    _days("second_load", "days_two"),
    _merged_days(True),
    f"""
bronze_loads as (select *, case when collected_at <= {_CUT} then 1 else 2 end as part from sensor),
silver_loads as (select *, case when collected_at <= {_CUT} then 1 else 2 end as part from silver),
first_seen as (
  select weather_condition, min(part) as part from silver_loads group by weather_condition
)""",
)

ORACLES = {
    "flatten_payload": _with(_SENSOR, _SECONDS) + "select * exclude (id) from landed",
    "flatten_falsy_as_null": _with(_SENSOR, _SECONDS)
    + """select city, data_timestamp, nullif(id % 3, 0) as timezone,
  nullif(humidity, 0) as humidity, nullif(wind_gust, 0) as wind_gust,
  nullif(sea_level, 0) as sea_level, nullif(temperature, 0) as temperature from landed""",
    "rejected_documents": """
select case when event_id % 13 = 0 then 'malformed'
    when event_id % 17 = 0 then 'data_timestamp missing'
    when event_id % 19 = 0 then 'overflow: temperature' else 'accepted' end as reason,
  count(*) as documents
from events group by 1""",
    "latest_landed": _with(_SENSOR, _SECONDS, _AGAIN)
    + """
select city, cast(collected_at as date) as ingest_date, data_timestamp, temperature,
  collected_at as landed_at
from again
qualify row_number() over (
  partition by city, cast(collected_at as date), data_timestamp order by collected_at desc) = 1""",
    "bronze_ids": _with(_SENSOR, _SECONDS)
    + """
select 1000 + row_number() over (order by md5(concat_ws(chr(1), city,
    cast(cast(collected_at as date) as varchar), strftime(data_timestamp, '%Y-%m-%d %H:%M:%S')))) as id,
  city, data_timestamp
from (select distinct city, data_timestamp, collected_at from landed)""",
    "object_keys": _with(_SENSOR, _SECONDS)
    + """
select city || '/' || year(collected_at) || '/' || month(collected_at) || '/' || day(collected_at)
  || '/' || cast(epoch(data_timestamp) as bigint) || '.json' as object_key
from landed""",
    "falsy_to_null": """
select event_id, nullif(event_id % 3, 0) as number_or_null,
  nullif(trim(replace(event_type, 'view', ' ')), '') as text_or_null
from events""",
    "nan_to_null": """
select event_id, case when event_id % 4 = 0 then null else value end as value from events""",
    "epoch_to_timestamp": """
select event_id, epoch_us(ts) // 1000000 as epoch, date_trunc('second', ts) as second from events""",
    "clean_text": _with(_SENSOR) + f"select id, {_TEXTS} from sensor",
    "range_rules": _with(_SENSOR) + f"select id, {_RANGED} from sensor",
    "decimal_to_bigint": _with(_SENSOR)
    + "select id, cast(wind_deg as bigint) as wind_deg from sensor",
    "valid_rows": _with(_SENSOR) + f"select id from sensor where {_VALID}",
    "rejected_rows": _with(_SENSOR)
    + f"""
select id, case when not longitude between -180 and 180 then 'longitude'
    when not latitude between -90 and 90 then 'latitude' else 'timezone missing' end as reject_reason
from sensor where not ({_VALID})""",
    "high_water_mark": _with(_SENSOR)
    + "select coalesce(max(collected_at), timestamp '2000-01-01 00:00:00') as mark from sensor",
    "increment_since": _with(_SENSOR)
    + f"""
select id, collected_at from sensor
where collected_at > (select max(collected_at) from sensor where collected_at <= {_CUT})""",
    "dedupe_latest": """
select * from lineitem qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc, l_quantity desc,
    l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1""",
    "latest_price": """
select distinct on (l_partkey) l_partkey, l_extendedprice, l_shipdate from lineitem
order by l_partkey, l_shipdate desc, l_extendedprice desc""",
    "silver_full": _with(_SENSOR, _silver()) + "select * from silver",
    "silver_business_key": _with(
        _SENSOR,
        """
twice as (
  select * from sensor union all
  select * replace (id + 1000000000 as id, collected_at + interval 1 hour as collected_at)
  from sensor where id % 3 = 0
)""",
        _silver("twice", keys="city, data_timestamp"),
    )
    + "select * from silver",
    "silver_shifted_wind": _with(_SENSOR, _silver())
    + """
select id, cast(clouds as decimal(5,2)) as wind_speed, wind_speed as wind_deg, wind_gust,
  cast(wind_deg as bigint) as clouds from silver""",
    "latest_location": _with(_SENSOR, _silver(), _latest_locations("silver", "latest_all"))
    + "select * from latest_all",
    "location_upsert": _with(*_LOCATIONS) + "select * from dim_two",
    "location_upsert_audit": _with(*_LOCATIONS)
    + """select count(*) filter (where _op = 'I') as inserted,
  count(*) filter (where _op = 'U') as updated from dim_two""",
    "touched_locations": _with(*_LOCATIONS) + "select city, _op from dim_two where _op <> 'K'",
    "location_refresh": _with(
        *_LOCATIONS[:4],
        _latest_locations("silver", "latest_all"),
        _merged_locations("latest_one", "latest_all", "!="),
    )
    + "select * from dim_two",
    "location_upsert_nullable": _nullable_locations("is distinct from"),
    "location_refresh_nullable": _nullable_locations("!="),
    "condition_insert": _with(
        _SENSOR,
        _silver(),
        _loads("silver"),
        """
ids as (
  select row_number() over (order by md5(weather_condition), weather_condition)
    as weather_condition_id, weather_condition
  from (select distinct weather_condition from first_load)
)""",
    )
    + """
select * from ids union all
select (select count(*) from ids)
  + row_number() over (order by md5(weather_condition), weather_condition), weather_condition
from (select distinct weather_condition from second_load)
where weather_condition not in (select weather_condition from ids)""",
    "key_insert_scale": """
with known as (select distinct o_custkey from orders where o_orderdate < timestamp '1995-02-01 00:00:00')
select o_custkey as customer,
  (select count(*) from known) + row_number() over (order by md5(cast(o_custkey as varchar))) as customer_id
from (select distinct o_custkey from orders where o_orderdate >= timestamp '1995-02-01 00:00:00')
where o_custkey not in (select o_custkey from known)""",
    "not_in_null_aware": _not_in("plain", f"select o_custkey {_SIGNED_ORDERS}")
    + " union all "
    + _not_in(
        "holed",
        f"select nullif(o_custkey, 9) {_SIGNED_ORDERS} union all select null {_SIGNED_ORDERS}",
    )
    + " union all "
    + _not_in("empty", f"select o_custkey {_SIGNED_ORDERS} where o_custkey is null"),
    "surrogate_keys": """
select c_name, 100 + row_number() over (order by md5(c_name), c_name) as customer_id
from (select distinct c_name from customer)""",
    "day_source": _with(*_DIMS, _days("silver", "days"))
    + """
select s.city, day, sunrise, sunset, collected_at, d.location_id,
  'silver.transform_weather_data' as source_table
from days s left join dim_location d on s.city = d.city""",
    "day_readings_local": _with(
        _SENSOR,
        _silver(),
        _days("silver", "days", "(data_timestamp + to_seconds(coalesce(timezone, 0)))"),
    )
    + "select * from days",
    "day_upsert": _day_upsert(True),
    "day_upsert_strict": _day_upsert(False),
    "day_upsert_varied": _day_upsert(True, "varied"),
    "day_upsert_varied_strict": _day_upsert(False, "varied"),
    "hourly_fact": _with(*_DIMS) + "select * from hourly",
    "star_join_scale": """
select l_orderkey, l_partkey, l_suppkey, l_quantity, p_brand, s_name from lineitem
join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "daily_city_summary": _with(*_DIMS) + _SUMMARY.format(hourly="hourly join dim_location using (location_id)"),
    "partition_calendar": """
with bounds as (
  select cast(min(l_shipdate) as date) as lo, cast(max(l_shipdate) as date) as hi from lineitem
),"""
    + _CALENDAR,
    "next_year_calendar": """
with bounds as (
  select make_date(y, 1, 1) as lo, make_date(y, 12, 31) as hi
  from (select year(max(l_shipdate)) + 1 as y from lineitem)
),"""
    + _CALENDAR,
    "partition_counts": """
select strftime(l_shipdate, '%Y-%m') as p_month, count(*) as row_count from lineitem group by 1""",
    "out_of_range_rows": """
select l_orderkey, l_linenumber, l_shipdate from (
    select * replace (case when l_partkey % 11 = 0 then l_shipdate + interval 10 year
      else l_shipdate end as l_shipdate) from lineitem),
  (select date_trunc('month', min(o_orderdate)) as lo,
     date_trunc('month', max(o_orderdate)) + interval 1 month as hi from orders)
where not (l_shipdate >= lo and l_shipdate < hi)""",
    "month_range_read": """
select l_orderkey, l_linenumber, l_shipdate from lineitem
where l_shipdate >= timestamp '1996-03-01 00:00:00' and l_shipdate < timestamp '1999-08-01 00:00:00'""",
    "unique_violations": """
select l_orderkey, l_linenumber, count(*) as copies from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
    "orphan_rows": """
select l_orderkey, l_linenumber, l_partkey from (
  select * replace (case when l_partkey % 7 = 0 then -l_orderkey else l_orderkey end as l_orderkey)
  from lineitem) l
where not exists (select 1 from orders where o_orderkey = l.l_orderkey)""",
    "missing_required": _with(_SENSOR)
    + """
select * from (select id, concat_ws(',', case when country is null then 'country' end,
    case when weather_condition is null then 'weather_condition' end,
    case when timezone is null then 'timezone' end) as missing_columns from sensor)
where missing_columns <> ''""",
    "overflow_rows": """
select * from (select l_orderkey, l_linenumber, concat_ws(',',
    case when try_cast(l_extendedprice as decimal(6,2)) is null then 'l_extendedprice' end,
    case when try_cast(l_quantity as decimal(3,2)) is null then 'l_quantity' end) as overflow_columns
  from lineitem)
where overflow_columns <> ''""",
    "text_overflow_rows": """
select * from (select doc_id, concat_ws(',', case when length(text) > 2000 then 'text' end,
    case when length(source) > 100 then 'source' end,
    case when length(lang) > 2 then 'lang' end) as overflow_columns from documents)
where overflow_columns <> ''""",
    "profile": _with(_SENSOR)
    + " union all ".join(
        f"""
select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
  cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value,
  round((count(*) - count({c})) / count(*), 6) as null_rate from sensor"""
        for c in [*_MEASURES.split(", "), "timezone"]
    ),
    "constraint_checks": _with(
        *_DIMS,
        """
broken as (
  select * replace (case when id % 50 = 1 then -id else location_id end as location_id)
  from (select * from hourly union all select * from hourly where id % 100 = 0)
)""",
    )
    + """
select 'gold.fact_weather_hourly' as table_name, 'unique(id, data_timestamp)' as constraint_name,
  count(*) as violations
from (select id from broken group by id, data_timestamp having count(*) > 1)
union all
select 'gold.fact_weather_hourly', 'not null(data_timestamp)', count(*) from broken
where data_timestamp is null
union all
select 'gold.fact_weather_hourly', 'references(location_id)', count(*) from broken
where location_id not in (select location_id from dim_location)
union all
select 'gold.fact_weather_hourly', 'references(weather_condition_id)', count(*) from broken
where weather_condition_id not in (select weather_condition_id from dim_condition)""",
    "load_audit": _TWO_LOAD_COUNTS
    + """
select cast(part as bigint) as increment, 'bronze.raw_weather_data' as table_name,
  count(*) as inserted, cast(0 as bigint) as updated, cast(0 as bigint) as rejected,
  max(collected_at) as mark_high
from bronze_loads group by part
union all
select b.part, 'silver.transform_weather_data', count(s.id), 0, count(*) - count(s.id), max(s.collected_at)
from bronze_loads b left join silver_loads s on b.id = s.id group by b.part
union all
select 1, 'gold.dim_location', count(*), 0, 0, null from dim_one
union all
select 2, 'gold.dim_location', count(*) filter (where _op = 'I'),
  count(*) filter (where _op = 'U'), 0, null from dim_two
union all
select p, 'gold.dim_weather_condition', (select count(*) from first_seen where part = p), 0, 0, null
from (values (1), (2)) as v(p)
union all
select 1, 'gold.fact_day', count(*), 0, 0, null from old_days
union all
select 2, 'gold.fact_day', count(*) filter (where _op = 'I'),
  count(*) filter (where _op = 'U'), 0, null from merged_days
union all
select part, 'gold.fact_weather_hourly', count(*), 0, 0, max(collected_at)
from silver_loads group by part""",
    "stored_fact_day": _TWO_LOAD_COUNTS
    + f"select {_DAY_KEY} as fact_day_id, * exclude (_op) from merged_days",
    "stored_daily_summary": _with(*_DIMS)
    + _SUMMARY.format(hourly="hourly join dim_location using (location_id)"),
    "merged_daily_summary": _with(*_DIMS)
    + _SUMMARY.format(hourly="hourly join dim_location using (location_id)"),
    "stored_counts": _TWO_LOAD_COUNTS
    + f"""
select 'bronze.raw_weather_data' as table_name, count(*) as row_count from sensor
union all select 'silver.transform_weather_data', count(*) from silver
union all select 'silver.rejected_weather_data', count(*) from sensor where not ({_VALID})
union all select 'gold.dim_location', count(*) from dim_two
union all select 'gold.dim_weather_condition', count(*) from first_seen
union all select 'gold.fact_weather_hourly', count(*) from silver
union all select 'gold.fact_day', count(*) from merged_days""",
    "stored_created_at": _TWO_LOAD_COUNTS
    + """
select t as table_name, cast(part as bigint) as increment, count(*) as row_count,
  cast(1 as bigint) as times, cast(0 as bigint) as missing
from silver_loads, (values ('silver.transform_weather_data'), ('gold.fact_weather_hourly')) as v(t)
group by t, part""",
    "load_profile": _TWO_LOAD_COUNTS
    + " union all ".join(
        f"""
select cast(part as bigint) as increment, 'silver.transform_weather_data' as table_name,
  '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
  round((count(*) - count({c})) / count(*), 6) as null_rate,
  cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value
from silver_loads group by part"""
        for c in _MEASURES.split(", ")
    ),
    "dropped_table": """
select false as files_deleted, true as dropped, count(*) as row_count from events
union all select true, true, 0""",
    "silver_business_key_two_loads": _with(_SENSOR, _silver()) + "select * from silver",
    "replay_landed_twice": _with(_SENSOR, _SECONDS, _silver("landed"))
    + "select * exclude (id), cast(2 as bigint) as copies from silver",
    "namesake_cities": _with(
        _SENSOR,
        f"""
named as (
  select case when id % 3 = 0 then '' when id % 3 = 1 then 'Paris' else trim(city) end as name,
    case when humidity % 4 = 0 then 'FR' else 'US' end as land, latitude, longitude,
    collected_at - interval 1 hour as data_timestamp, cast(collected_at as date) as landed_on,
    case when collected_at <= {_CUT} then 1 else 2 end as part, {_VALID} as valid
  from sensor
),
landed_once as (
  select part, landed_on, data_timestamp, name, land, case when name = '' then latitude end as lat,
    case when name = '' then longitude end as lon, bool_or(valid) as valid, count(*) as documents
  from named group by all
),
known as (
  select name, land, lat, lon, data_timestamp, min(part) as part, count(*) as versions
  from landed_once where valid group by all
),
places as (
  select case when name = '' then land else name || ', ' || land end as city, count(*) as readings
  from known group by 1
)""",
    )
    + """
select 'stepwise' as stage, city, readings from places
union all select 'replayed', city, readings from places
union all
select 'copies bronze ' || part, '', cast(sum(documents) - count(*) as bigint)
from landed_once group by part
union all
select 'copies silver ' || part, '', cast(count(*) filter (where valid) as bigint)
    - (select count(*) from known k where k.part = l.part)
from landed_once l group by part""",
    "repeated_loads": _with(
        _SENSOR,
        f"""
judged as (select *, {_VALID} as valid from sensor),
loaded as (
  select id % 6 + 1 as load_id, valid, true as is_new from judged
  union all
  select id % 6 + 2, valid, false from judged where id % 4 < 2 and id % 6 < 5
)""",
    )
    + """
select cast(load_id as bigint) as load_id, count(*) filter (where valid and is_new) as inserted,
  count(*) filter (where valid and not is_new) as copies, count(*) filter (where not valid) as rejected,
  (select count(*) from judged where valid) as indexed
from loaded group by 1""",
    "reindexed_silver": _with(_SENSOR, _silver()) + "select * from silver",
    "merged_loads": _with(_SENSOR, _silver())
    + f"""
, counted as (
  select 'bronze.raw_weather_data' as table_name, data_timestamp from sensor
  union all select 'silver.transform_weather_data', data_timestamp from silver
  union all select 'silver.rejected_weather_data', data_timestamp from sensor where not ({_VALID})
  union all select 'gold.fact_weather_hourly', data_timestamp from silver
  union all select 'silver.reading_index', data_timestamp from silver
)
select stage, table_name, count(*) as row_count, count(distinct data_timestamp) as times,
  stage <> 'before' as one_folder_a_month
from counted, (values ('before'), ('after'), ('next load')) as v(stage)
group by stage, table_name""",
    "folded_log": _TWO_LOAD_COUNTS
    + """
select cast(part as bigint) as increment, 'bronze.raw_weather_data' as table_name,
  count(*) as inserted, cast(0 as bigint) as updated, cast(0 as bigint) as rejected,
  cast(0 as bigint) as copies, cast(1 as bigint) as tail_files
from bronze_loads group by part
union all
select b.part, 'silver.transform_weather_data', count(s.id), 0, count(*) - count(s.id), 0, 1
from bronze_loads b left join silver_loads s on b.id = s.id group by b.part
union all
select 1, 'gold.dim_location', count(*), 0, 0, null, 1 from dim_one
union all
select 2, 'gold.dim_location', count(*) filter (where _op = 'I'),
  count(*) filter (where _op = 'U'), 0, null, 1 from dim_two
union all
select p, 'gold.dim_weather_condition', (select count(*) from first_seen where part = p), 0, 0, null, 1
from (values (1), (2)) as v(p)
union all
select 1, 'gold.fact_day', count(*), 0, 0, null, 1 from old_days
union all
select 2, 'gold.fact_day', count(*) filter (where _op = 'I'),
  count(*) filter (where _op = 'U'), 0, null, 1 from merged_days
union all
select part, 'gold.fact_weather_hourly', count(*), 0, 0, null, 1 from silver_loads group by part""",
    "table_profile": _with(_SENSOR, _silver())
    + " union all ".join(
        f"""
select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
  round((count(*) - count({c})) / count(*), 6) as null_rate,
  cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value,
  count(distinct {c}) as n_distinct, true as estimate_holds
from silver"""
        for c in _MEASURES.split(", ")
    ),
    "late_rows": _with(_SENSOR, _silver())
    + f"""
select true as by_load, count(*) as row_count from silver
union all
select false, count(*) from silver where collected_at > {_CUT} and id % 5 <> 0 and id % 7 <> 0""",
    "gold_retry": _TWO_LOAD_COUNTS
    + """
, added as (
  select 'new ' || city as city, cast(data_timestamp as date) as day from silver where id % 3 = 0
), stored as (
  select cast(part as bigint) as increment, count(*) as stored from silver_loads group by part
  union all select 3, count(*) from added
), counts as (
  select cast(1 as bigint) as increment, 'gold.dim_location' as table_name, count(*) as inserted,
    cast(0 as bigint) as updated from dim_one
  union all
  select 2, 'gold.dim_location', count(*) filter (where _op = 'I'),
    count(*) filter (where _op = 'U') from dim_two
  union all select 3, 'gold.dim_location', count(distinct city), 0 from added
  union all
  select p, 'gold.dim_weather_condition', (select count(*) from first_seen where part = p), 0
  from (values (1), (2), (3)) as v(p)
  union all select 1, 'gold.fact_day', count(*), 0 from old_days
  union all
  select 2, 'gold.fact_day', count(*) filter (where _op = 'I'),
    count(*) filter (where _op = 'U') from merged_days
  union all select 3, 'gold.fact_day', count(*), 0 from (select distinct city, day from added)
  union all select increment, 'gold.fact_weather_hourly', stored, 0 from stored
  union all
  select p, t, 0, 0 from (values (4), (5)) as v(p), (values ('gold.dim_location'),
    ('gold.dim_weather_condition'), ('gold.fact_day'), ('gold.fact_weather_hourly')) as w(t)
)
select * from counts left join stored using (increment)""",
    "replay_equals_incremental": _with(_SENSOR, _SECONDS, _silver("landed"))
    + "select * exclude (id) from silver",
    "stream_hourly_fact": _with(_SENSOR, _SECONDS, _silver("landed"))
    + f"select city, weather_condition, {_MEASURES}, data_timestamp, collected_at from silver",
    "stream_dedupe": "select event_id, user_id, event_type, ts from events",
}

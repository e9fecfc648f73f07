"""Trip, station and weather tables derived from the whole test tables, in Spark and in SQL.

Each Spark view has a SQL text of the same name in ``SQL``; ``with_views`` puts the ones a
query needs (and those they build on) in front of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.fixed_values import (
    WEATHER_TOLERANCE_SECONDS,
)
from tripweave.functions import celsius, weather_class
from tripweave.operators import used_ids
from tripweave.plans import dense_station_panel, enrich_trips, joined_trips, station_hour_panel
from tripweave.plans.reconcile import used_stations
from tripweave.session import apply_defaults

SUMMARIES = (
    "clear", "scattered clouds", "overcast", "light rain", "heavy rain", "light snow",
    "ice pellets", "thunder", "haze", "thunder, light rain", "windy", None,
)


# ---------------------------------------------------------------- Spark

# Columns used here; with a declared schema planning reads no file footer.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def plain_times(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    zoned = [name for name, kind in rows.dtypes if kind == "timestamp"]
    if not zoned:
        return rows
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


_SUMMARY_TEXT = "element_at(array(" + ", ".join(
    "null" if s is None else f"'{s}'" for s in SUMMARIES) + "), cast(event_id % 12 + 1 as int))"


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "string(n_nationkey) as id", "n_name as name", "string(31000 + n_nationkey) as terminalName",
        "38e0 + n_nationkey * 37 % 250 / 100e0 as lat", "-78e0 + n_nationkey * 53 % 250 / 100e0 as long",
        "n_nationkey % 20 as nbBikes", "20 - n_nationkey % 20 as nbEmptyDocks",
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundredths = "lpad(string(s_suppkey * 37 % 100), 2, '0')"
    return table(spark, sf_dir, "supplier").selectExpr(
        "string(s_suppkey) as id", "s_name as name", "string(31000 + s_suppkey) as terminalName",
        f"if(s_suppkey % 13 = 7, 'n/a', 37 + s_suppkey % 4 || '.' || {hundredths}) as lat",
        f"'-' || (75 + s_suppkey % 5) || '.' || {hundredths} as long",
        "s_suppkey % 20 || if(s_suppkey % 7 = 0, '.5', '') as nbBikes",
        "if(s_suppkey % 11 = 3, '', string(20 - s_suppkey % 20)) as nbEmptyDocks",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = "cast(floor(value * 10) as int)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{seconds} as duration",
        "date_trunc('second', ts) as start_date",
        f"date_trunc('second', ts) + make_dt_interval(0, 0, 0, {seconds}) as end_date",
        "string(31000 + user_id % 27) as start_station_id",
        "'Station ' || (31000 + user_id % 27) as start_station_name",
        "string(31000 + event_id % 27) as end_station_id",
        "'Station ' || (31000 + event_id % 27) as end_station_name",
        "'W' || user_id as bike_number",
        "if(event_type in ('signup', 'purchase'), 'Member', 'Casual') as member_type",
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).selectExpr(
        "event_id",
        "if(event_id % 97 = 0, 'bad', string(duration)) as Duration",
        "if(event_id % 89 = 0, '13/45/2024 01:00', string(start_date)) as `Start date`",
        "string(end_date) as `End date`",
        """case when event_id % 101 = 0 then '00000' when event_id % 103 = 0 then '32031'
           else start_station_id end as `Start station number`""",
        "start_station_name as `Start station`",
        "if(event_id % 107 = 0, '31008', end_station_id) as `End station number`",
        "end_station_name as `End station`", "bike_number as `Bike number`", "member_type as `Member type`",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per hour: the last event of the hour."""
    last = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts")).agg(
        F.max_by("ts", "event_id").alias("ts"), F.max_by("value", "event_id").alias("value"),
        F.max("event_id").alias("event_id"),
    )
    readings = last.selectExpr(
        "date_trunc('minute', ts) as date_time", "double(floor(value)) as fahrenheit",
        "double(event_id * 3 % 40) as wind_speed", "double(event_id % 11) as visibility",
        f"{_SUMMARY_TEXT} as weather_summary",
    )
    return readings.select(
        "date_time", celsius(F.col("fahrenheit")).alias("air_temp"), "wind_speed", "visibility",
        "weather_summary", F.upper("weather_summary").alias("weather_condition"),
        weather_class(F.col("weather_summary")).alias("weather_class"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 83 <> 0, 'ST1', null) as Station_ID",
        """if(event_id % 53 = 0, '13/45/2024 01:00', date_format(ts, 'MM/dd/yyyy HH:mm') || ' UTC')
           as Date_Time""",
        "if(event_id % 5 <> 0, string(floor(value)), null) as air_temp_set_1",
        "if(event_id % 41 = 0, 'calm', string(event_id * 3 % 40)) as wind_speed_set_1",
        "if(event_id % 3 <> 0, string(event_id % 11), null) as visibility_set_1",
        f"{_SUMMARY_TEXT} as weather_summary_set_1d",
        f"upper({_SUMMARY_TEXT}) as weather_condition_set_1d",
    )


def known_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations that trips use and the station table holds."""
    return used_stations(used_ids(trips(spark, sf_dir)), stations(spark, sf_dir)).drop("station_id")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_trips(trips(spark, sf_dir), stations(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_trips(trips(spark, sf_dir), stations(spark, sf_dir), weather(spark, sf_dir))


def observed_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_hour_panel(joined(spark, sf_dir)).withColumnRenamed("start_station_id", "station")


def dense_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_station_panel(joined(spark, sf_dir))


# ---------------------------------------------------------------- SQL

# Fixed values, written apart from the library's so that a wrong one there shows. Steps overwrite each other
# in this order: the first four look at the summary, the next four at the class so far.
_SUMMARY_STEPS = (
    ("clear|scattered|sunny|obscured", "clear"),
    ("broken|overcast|cloudy", "cloudy"),
    ("rain|drizzle", "light rain"),
    ("heavy (drizzle|rain)|heavy_rain", "heavy rain"),
)
_CLASS_STEPS = (
    ("snow", "snowy"),
    ("ice", "icy"),
    ("thunder|squalls", "stormy"),
    ("haze|mist|fog", "foggy"),
)


def class_case(summary: str) -> str:
    """The ninth step comes first in the text, as it overwrites all others."""
    found = summary
    for pattern, label in _SUMMARY_STEPS:
        found = f"case when regexp_matches({summary}, '{pattern}') then '{label}' else {found} end"
    for pattern, label in _CLASS_STEPS:
        found = f"(select case when regexp_matches(x, '{pattern}') then '{label}' else x end from (select {found} as x))"
    return f"case when {summary} is null then 'clear' else {found} end"


def code_case(label: str) -> str:
    return (
        f"case {label} when 'clear' then 0e0 when 'cloudy' then 1e0 when 'light rain' then 2e0 when 'heavy rain' then 3e0"
        f" when 'snowy' then 4e0 when 'icy' then 5e0 when 'stormy' then 6e0 when 'foggy' then 7e0"
        f" else case when {label} is not null then 8e0 end end"
    )


def haversine(long_a: str, lat_a: str, long_b: str, lat_b: str) -> str:
    chord = (
        f"pow(sin((radians({lat_b}) - radians({lat_a})) / 2), 2) + cos(radians({lat_a}))"
        f" * cos(radians({lat_b})) * pow(sin((radians({long_b}) - radians({long_a})) / 2), 2)"
    )
    return (
        f"cast(abs(round_even(2 * asin(sqrt(case when {chord} > 1 then 1e0 else {chord} end)) * 6371e0 * 1000, 0))"
        f" as bigint)"
    )


_SUMMARY_LIST = "[" + ", ".join("null" if s is None else f"'{s}'" for s in SUMMARIES) + "]"
_SUMMARY = f"({_SUMMARY_LIST})[cast(event_id % 12 + 1 as int)]"
_SECONDS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_HOUR_KEYS = (
    "cast(hour(time) as int) as hour, cast(dayofyear(time) as int) as dayofyear,"
    " cast(month(time) as int) as month"
)


def _mode_join(keys: str) -> str:
    """Most frequent class per key of ``keyed``, the lowest on ties."""
    return (
        f"(select {keys}, weather_class from (select {keys}, weather_class, row_number() over"
        f" (partition by {keys} order by count(*) desc, weather_class) as rn from keyed"
        f" where weather_class is not null group by {keys}, weather_class) where rn = 1)"
    )


SQL: dict[str, str] = {
    "stations": """
        select cast(n_nationkey as varchar) as id, n_name as name,
               cast(31000 + n_nationkey as varchar) as "terminalName",
               38e0 + ((n_nationkey * 37) % 250) / 100e0 as lat,
               -78e0 + ((n_nationkey * 53) % 250) / 100e0 as long,
               n_nationkey % 20 as "nbBikes", 20 - n_nationkey % 20 as "nbEmptyDocks"
        from nation""",
    "raw_stations": """
        select cast(s_suppkey as varchar) as id, s_name as name,
               cast(31000 + s_suppkey as varchar) as "terminalName",
               case when s_suppkey % 13 = 7 then 'n/a' else cast(37 + s_suppkey % 4 as varchar) || '.'
                    || lpad(cast(s_suppkey * 37 % 100 as varchar), 2, '0') end as lat,
               '-' || cast(75 + s_suppkey % 5 as varchar) || '.'
                    || lpad(cast(s_suppkey * 37 % 100 as varchar), 2, '0') as long,
               cast(s_suppkey % 20 as varchar) || case when s_suppkey % 7 = 0 then '.5' else '' end as "nbBikes",
               case when s_suppkey % 11 = 3 then '' else cast(20 - s_suppkey % 20 as varchar) end as "nbEmptyDocks"
        from supplier""",
    "trips": """
        select event_id, cast(floor(value * 10) as int) as duration,
               date_trunc('second', ts) as start_date,
               date_trunc('second', ts) + to_seconds(cast(floor(value * 10) as int)) as end_date,
               cast(31000 + user_id % 27 as varchar) as start_station_id,
               'Station ' || cast(31000 + user_id % 27 as varchar) as start_station_name,
               cast(31000 + event_id % 27 as varchar) as end_station_id,
               'Station ' || cast(31000 + event_id % 27 as varchar) as end_station_name,
               'W' || cast(user_id as varchar) as bike_number,
               case when event_type in ('signup', 'purchase') then 'Member' else 'Casual' end as member_type
        from events""",
    "raw_trips": f"""
        select event_id,
               case when event_id % 97 = 0 then 'bad' else cast(duration as varchar) end as "Duration",
               case when event_id % 89 = 0 then '13/45/2024 01:00'
                    else {_SECONDS.format('start_date')} end as "Start date",
               {_SECONDS.format('end_date')} as "End date",
               case when event_id % 101 = 0 then '00000' when event_id % 103 = 0 then '32031'
                    else start_station_id end as "Start station number",
               start_station_name as "Start station",
               case when event_id % 107 = 0 then '31008' else end_station_id end as "End station number",
               end_station_name as "End station", bike_number as "Bike number", member_type as "Member type"
        from trips""",
    "weather": f"""
        select date_trunc('minute', ts) as date_time,
               (floor(value) - 32) * 5e0 / 9e0 as air_temp,
               cast(event_id * 3 % 40 as double) as wind_speed,
               cast(event_id % 11 as double) as visibility,
               {_SUMMARY} as weather_summary, upper({_SUMMARY}) as weather_condition,
               {class_case(_SUMMARY)} as weather_class
        from (select *, row_number() over (partition by date_trunc('hour', ts) order by event_id desc) as rn
              from events) where rn = 1""",
    "raw_weather": f"""
        select event_id,
               case when event_id % 83 <> 0 then 'ST1' end as "Station_ID",
               case when event_id % 53 = 0 then '13/45/2024 01:00'
                    else strftime(ts, '%m/%d/%Y %H:%M') || ' UTC' end as "Date_Time",
               case when event_id % 5 <> 0 then cast(cast(floor(value) as bigint) as varchar) end as air_temp_set_1,
               case when event_id % 41 = 0 then 'calm' else cast(event_id * 3 % 40 as varchar) end as wind_speed_set_1,
               case when event_id % 3 <> 0 then cast(event_id % 11 as varchar) end as visibility_set_1,
               {_SUMMARY} as weather_summary_set_1d, upper({_SUMMARY}) as weather_condition_set_1d
        from events""",
    "used": """
        select start_station_id as station_id from trips union select end_station_id from trips""",
    "known_stations": """
        select s.* from stations s where "terminalName" in (select station_id from used)""",
    "enriched": f"""
        select t.*, a.lat as lat_start, a.long as long_start, b.lat as lat_end, b.long as long_end,
               {haversine('a.long', 'a.lat', 'b.long', 'b.lat')} as abs_distance
        from trips t join stations a on t.start_station_id = a."terminalName"
                     join stations b on t.end_station_id = b."terminalName" """,
    "latest": """
        select e.event_id, e.start_date, w.date_time
        from enriched e asof left join weather w on e.start_date >= w.date_time""",
    "joined": f"""
        select e.*, e.start_date as time, w.*
        from enriched e join latest l using (event_id)
        left join weather w on w.date_time = l.date_time
             and epoch_us(l.start_date) - epoch_us(l.date_time) <= {WEATHER_TOLERANCE_SECONDS * 1_000_000}""",
    "keyed": f"select *, {_HOUR_KEYS} from joined",
    "hours": f"""
        select k.*, m.weather_class from
        (select hour, dayofyear, month, avg(air_temp) as air_temp, avg(visibility) as visibility,
                avg(wind_speed) as wind_speed, count(time) as count
         from keyed group by hour, dayofyear, month) k
        left join {_mode_join('hour, dayofyear, month')} m using (hour, dayofyear, month)""",
    "observed": f"""
        select k.*, m.weather_class from
        (select hour, dayofyear, month, start_station_id as station,
                cast(sum(duration) as bigint) as total_duration, count(time) as count,
                avg(air_temp) as air_temp, avg(visibility) as visibility, avg(wind_speed) as wind_speed,
                avg(abs_distance) as abs_distance, avg(lat_start) as lat, avg(long_start) as long
         from keyed group by hour, dayofyear, month, start_station_id) k
        left join (select * rename (start_station_id as station) from
                   {_mode_join('hour, dayofyear, month, start_station_id')}) m
        using (hour, dayofyear, month, station)""",
    "filler": """
        select h.hour, h.dayofyear, h.month, s.station, cast(0 as bigint) as count,
               h.air_temp, h.visibility, h.wind_speed, h.weather_class
        from hours h, (select distinct station from observed) s""",
    "dense": """
        select f.hour, f.dayofyear, f.month, f.station, coalesce(o.count, 0) as count,
               case when o.count is null then f.air_temp else o.air_temp end as air_temp,
               case when o.count is null then f.visibility else o.visibility end as visibility,
               case when o.count is null then f.wind_speed else o.wind_speed end as wind_speed,
               case when o.count is null then f.weather_class else o.weather_class end as weather_class
        from filler f left join observed o using (hour, dayofyear, month, station)""",
}

_BUILT_ON: dict[str, tuple[str, ...]] = {
    "raw_trips": ("trips",),
    "used": ("trips",),
    "known_stations": ("stations", "used"),
    "enriched": ("trips", "stations"),
    "latest": ("enriched", "weather"),
    "joined": ("enriched", "weather", "latest"),
    "keyed": ("joined",),
    "hours": ("keyed",),
    "observed": ("keyed",),
    "filler": ("hours", "observed"),
    "dense": ("filler", "observed"),
}


def with_views(query: str, *names: str) -> str:
    """The query with the named views, and what they build on, as common table expressions."""
    needed: list[str] = []

    def add(name: str) -> None:
        for base in _BUILT_ON.get(name, ()):
            add(base)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    if not needed:
        return query
    views = ", ".join(f"{name} as ({SQL[name]})" for name in needed)
    return f"with {views} {query}"

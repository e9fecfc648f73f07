"""Batch queries over the whole test tables, each next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views
from checks.views import class_case, code_case, haversine, plain_times, with_views
from tripweave import operators as op
from tripweave import plans
from tripweave.fixed_values import (
    MISSING_STATION, STATION_CODE_REMAP, STATION_CODES_REMOVED, STATION_CODES_UNDEFINED,
    TRIP_TIME_FORMAT, WEATHER_TIME_FORMAT, WEATHER_TIME_LENGTH,
)
from tripweave.functions import (
    calendar_parts as calendar_part_columns, haversine_metres, parse_double, parse_int, parse_time, remap_code, weather_class,
)
from tripweave.schemas import STATIONS, TRIP_MESSAGE
from tripweave.session import shared_folder
from tripweave.sinks import json_messages, keyed_json_messages, write_bucketed, write_by_day, write_parquet
from tripweave.sources import append_rows, read_csv, read_parquet
from tripweave.streaming import decode_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *needed: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with SQL over the named views."""
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(function(spark, sf_dir))
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = with_views(sql, *needed)
        return function
    return register


def rounded(rows: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return rows.withColumns({name: F.round(name, places).alias(name) for name in columns})


# ---------------------------------------------------------------- sources and sinks

_RAW_TRIP_FIELDS = ("event_id", "Duration", "Start date", "End date", "Start station number",
                    "Start station", "End station number", "End station", "Bike number", "Member type")
_RAW_TRIP_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in _RAW_TRIP_FIELDS])
_RAW_TRIPS_AS_TEXT = """
    select cast(event_id as varchar) as event_id, * exclude (event_id) from raw_trips"""


@query(_RAW_TRIPS_AS_TEXT, "raw_trips")
def scan_csv(spark, sf_dir):
    folder = shared_folder(spark, "csv")
    views.raw_trips(spark, sf_dir).write.option("header", True).csv(folder)
    return read_csv(spark, folder, _RAW_TRIP_SCHEMA)


@query(_RAW_TRIPS_AS_TEXT, "raw_trips")
def scan_csv_glob(spark, sf_dir):
    folder = shared_folder(spark, "csv-days")
    days = views.raw_trips(spark, sf_dir).withColumn("day", F.substring("End date", 1, 10))
    days.hint("rebalance", "day").write.option("header", True).partitionBy("day").csv(folder)
    return read_csv(spark, f"{folder}/day=*/*.csv")


@query("select event_id, ts, user_id, event_type, value from events")
def scan_parquet(spark, sf_dir):
    views.apply_defaults(spark)
    events = read_parquet(spark, f"{sf_dir}/events.parquet")
    return events.select("event_id", "ts", "user_id", "event_type", "value")


_STATION_NAMES = ", ".join(f'"{name}"' for name in STATIONS.names)
_MISSING_SQL = (
    f"select '{MISSING_STATION[0]}', '{MISSING_STATION[1]}', '{MISSING_STATION[2]}',"
    f" {MISSING_STATION[3]}e0, {MISSING_STATION[4]}e0, {MISSING_STATION[5]}, {MISSING_STATION[6]}"
)


@query(f"select {_STATION_NAMES} from known_stations union all {_MISSING_SQL}", "known_stations")
def literal_rows_union(spark, sf_dir):
    known = views.known_stations(spark, sf_dir).select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in STATIONS])
    return append_rows(known, [MISSING_STATION])


@query("select * from trips", "trips")
def parquet_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "trips")
    trips = views.trips(spark, sf_dir).withColumn("day", F.dayofmonth("start_date"))
    write_parquet(trips, folder, partition_by=["day"])
    return read_parquet(spark, folder).drop("day")


@query("""
    select event_id, duration, start_date, start_station_id, member_type from trips""", "trips")
def json_encode_rows(spark, sf_dir):
    value = json_messages(views.trips(spark, sf_dir))
    schema = "event_id bigint, duration int, start_date timestamp, start_station_id string, member_type string"
    return value.select(F.from_json("value", schema).alias("row")).select("row.*")


@query("""
    select strftime(start_date, '%Y-%m-%d %H:%M:%S') as key, cast(duration as varchar) as duration,
           member_type from trips""", "trips")
def json_key_value(spark, sf_dir):
    messages = keyed_json_messages(views.trips(spark, sf_dir), "start_date", ["duration", "member_type"])
    return messages.select(
        "key", F.get_json_object("value", "$.duration").alias("duration"),
        F.get_json_object("value", "$.member_type").alias("member_type"))


@query("""
    select event_id, start_date, duration from trips order by start_date, event_id limit 10""", "trips")
def preview_limit(spark, sf_dir):
    trips = views.trips(spark, sf_dir).select("event_id", "start_date", "duration")
    return op.preview(trips, ["start_date", "event_id"], 10)


# ---------------------------------------------------------------- cleaning

_START_REMAPPED = """
    case when "Start station number" = '00000' then '31127'
         when "Start station number" in ('31008', '32031') then null else "Start station number" end"""
_END_REMAPPED = _START_REMAPPED.replace("Start", "End")


@query(f"""
    select * from (
      select event_id, try_cast("Duration" as int) as duration,
             try_strptime("Start date", '%Y-%m-%d %H:%M:%S') as start_date,
             try_strptime("End date", '%Y-%m-%d %H:%M:%S') as end_date,
             {_START_REMAPPED} as start_station_id, "Start station" as start_station_name,
             {_END_REMAPPED} as end_station_id, "End station" as end_station_name,
             "Bike number" as bike_number, "Member type" as member_type
      from raw_trips)
    where duration is not null and start_date is not null and end_date is not null
      and start_station_id is not null and end_station_id is not null""", "raw_trips")
def clean_trips(spark, sf_dir):
    return plans.clean_trips(views.raw_trips(spark, sf_dir), carry=["event_id"])


@query(f"""
    select event_id, try_strptime("Date_Time"[1:16], '%m/%d/%Y %H:%M') as date_time,
           round((try_cast(air_temp_set_1 as double) - 32) * 5e0 / 9e0, 6) as air_temp,
           try_cast(wind_speed_set_1 as double) as wind_speed,
           weather_summary_set_1d as weather_summary, weather_condition_set_1d as weather_condition,
           try_cast(visibility_set_1 as double) as visibility,
           {class_case('weather_summary_set_1d')} as weather_class
    from raw_weather
    where "Station_ID" is not null and "Date_Time" is not null
      and air_temp_set_1 is not null and wind_speed_set_1 is not null""", "raw_weather")
def clean_weather(spark, sf_dir):
    return rounded(plans.clean_weather(views.raw_weather(spark, sf_dir), carry=["event_id"]), "air_temp")


@query(f"""
    select id, name, "terminalName", try_cast(lat as double) as lat, try_cast(long as double) as long,
           cast(floor(try_cast("nbBikes" as double)) as int) as "nbBikes",
           coalesce(cast(floor(try_cast("nbEmptyDocks" as double)) as int), -1) as "nbEmptyDocks"
    from raw_stations union all {_MISSING_SQL}""", "raw_stations")
def clean_stations(spark, sf_dir):
    return plans.clean_stations(views.raw_stations(spark, sf_dir)).fillna(-1, ["nbEmptyDocks"])


@query("""
    select event_id, coalesce(try_cast("Duration" as int), -1) as as_int, try_cast("Duration" as double) as as_double,
           try_cast("Start station number" as int) as station_no from raw_trips""", "raw_trips")
def parse_numeric(spark, sf_dir):
    return views.raw_trips(spark, sf_dir).select(
        "event_id", F.coalesce(parse_int(F.col("Duration")), F.lit(-1)).alias("as_int"),
        parse_double(F.col("Duration")).alias("as_double"),
        parse_int(F.col("Start station number")).alias("station_no"))


@query("""
    select cast(event_id as double) as event_id, try_cast("Duration" as double) as "Duration",
           try_cast("Member type" as double) as "Member type" from raw_trips""", "raw_trips")
def cast_all_double(spark, sf_dir):
    return op.cast_all_double(views.raw_trips(spark, sf_dir).select("event_id", "Duration", "Member type"))


@query("""
    select event_id, try_strptime("Date_Time"[1:16], '%m/%d/%Y %H:%M') as date_time
    from raw_weather""", "raw_weather")
def parse_timestamp_prefix(spark, sf_dir):
    time = parse_time(F.col("Date_Time"), WEATHER_TIME_FORMAT, WEATHER_TIME_LENGTH)
    return views.raw_weather(spark, sf_dir).select("event_id", time.alias("date_time"))


@query("""
    select event_id, try_strptime("Start date", '%Y-%m-%d %H:%M:%S') as start_date
    from raw_trips""", "raw_trips")
def parse_trip_time(spark, sf_dir):
    time = parse_time(F.col("Start date"), TRIP_TIME_FORMAT)
    return views.raw_trips(spark, sf_dir).select("event_id", time.alias("start_date"))


@query(f"""
    select event_id, {class_case('weather_summary_set_1d')} as weather_class from raw_weather""", "raw_weather")
def classify_weather(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select(
        "event_id", weather_class(F.col("weather_summary_set_1d")).alias("weather_class"))


@query(f"""
    select event_id, {_START_REMAPPED} as start_no, {_END_REMAPPED} as end_no from raw_trips""", "raw_trips")
def remap_codes(spark, sf_dir):
    fixed = [
        remap_code(F.col(f"{end} station number"), STATION_CODE_REMAP, STATION_CODES_REMOVED).alias(f"{end.lower()}_no")
        for end in ("Start", "End")]
    return views.raw_trips(spark, sf_dir).select("event_id", *fixed)


@query("""
    select event_id, cast(hour(start_date) as int) as hour, cast(dayofyear(start_date) as int) as dayofyear,
           cast(month(start_date) as int) as month from trips""", "trips")
def calendar_parts(spark, sf_dir):
    parts = calendar_part_columns(F.col("start_date"))
    return views.trips(spark, sf_dir).select("event_id", *[part.alias(name) for name, part in parts.items()])


# ---------------------------------------------------------------- filters

@query("""
    select event_id, start_date from trips
    where start_date > timestamp '2024-01-05' and start_date < timestamp '2024-01-20'""", "trips")
def filter_date_range(spark, sf_dir):
    trips = views.trips(spark, sf_dir).select("event_id", "start_date")
    return op.between_dates(trips, "start_date", "01/05/2024", "01/20/2024")


@query("""
    select id, "terminalName", lat, long from (
      select id, "terminalName", try_cast(lat as double) as lat, try_cast(long as double) as long from raw_stations)
    where lat > 38 and lat < 40 and long > -78 and long < -76""", "raw_stations")
def filter_bbox(spark, sf_dir):
    stations = plans.clean_stations(views.raw_stations(spark, sf_dir), extra_rows=())
    return op.inside_box(stations).select("id", "terminalName", "lat", "long")


_IN_BOX = '(select "terminalName" from stations where lat > 38 and lat < 40 and long > -78 and long < -76)'


@query(f"""
    select event_id, start_station_id, end_station_id from trips
    where start_station_id in {_IN_BOX} and end_station_id in {_IN_BOX}""", "trips", "stations")
def semi_join_both_ends(spark, sf_dir):
    trips = views.trips(spark, sf_dir).select("event_id", "start_station_id", "end_station_id")
    return op.with_both_ends_in(trips, op.inside_box(views.stations(spark, sf_dir)))


@query("""
    select event_id, "Duration" from raw_trips
    where "Start station number" = '31014' and "End station number" = '31020' and "Member type" = 'Casual'""", "raw_trips")
def filter_equality(spark, sf_dir):
    return views.raw_trips(spark, sf_dir).where(
        (F.col("Start station number") == "31014") & (F.col("End station number") == "31020")
        & (F.col("Member type") == "Casual")).select("event_id", "Duration")


@query("""
    select event_id, weather_summary_set_1d from raw_weather
    where regexp_matches(weather_summary_set_1d, 'rain')""", "raw_weather")
def filter_regex(spark, sf_dir):
    rows = views.raw_weather(spark, sf_dir).select("event_id", "weather_summary_set_1d")
    return op.matching(rows, "weather_summary_set_1d", "rain")


_UNDEFINED = ", ".join(f"'{code}'" for code in STATION_CODES_UNDEFINED)


@query(f"""
    select event_id, "Start station number" as start_no from raw_trips
    where "Start station number" in ({_UNDEFINED})""", "raw_trips")
def filter_in_list(spark, sf_dir):
    rows = views.raw_trips(spark, sf_dir).select("event_id", F.col("Start station number").alias("start_no"))
    return op.in_list(rows, "start_no", STATION_CODES_UNDEFINED)


# ---------------------------------------------------------------- joins and distance

@query(f"""
    select t.event_id, {haversine('a.long', 'a.lat', 'b.long', 'b.lat')} as abs_distance
    from trips t join stations a on t.start_station_id = a."terminalName"
                 join stations b on t.end_station_id = b."terminalName" """, "trips", "stations")
def haversine_distance(spark, sf_dir):
    rows = views.enriched(spark, sf_dir).drop("abs_distance")
    distance = haversine_metres(F.col("long_start"), F.col("lat_start"), F.col("long_end"), F.col("lat_end"))
    return rows.select("event_id", distance.alias("abs_distance"))


@query('select u.station_id, s.* from used u join stations s on u.station_id = s."terminalName"', "used", "stations")
def join_used_stations(spark, sf_dir):
    ids = op.used_ids(views.trips(spark, sf_dir))
    return plans.reconcile.used_stations(ids, views.stations(spark, sf_dir))


@query("select * from enriched", "enriched")
def enrich_trips(spark, sf_dir):
    return views.enriched(spark, sf_dir)


@query("select * from enriched", "enriched")
def enrich_trips_bucketed(spark, sf_dir):
    """Trips bucketed by both ends, so that the look-ups leave them in place."""
    path = shared_folder(spark, "bucketed-trips")
    name = "trips_" + path.rsplit("-", 1)[1]
    trips = write_bucketed(views.trips(spark, sf_dir), name, ["start_station_id", "end_station_id"], 8, path)
    return plans.enrich_by_pairs(trips, views.stations(spark, sf_dir))


@query(f"""
    select a.id as "id_A", a.lat as "lat_A", a.long as "long_A", b.id as "id_B", b.lat as "lat_B", b.long as "long_B",
           {haversine('a.long', 'a.lat', 'b.long', 'b.lat')} as abs_distance
    from known_stations a, known_stations b where a.id <> b.id""", "known_stations")
def station_pair_distances(spark, sf_dir):
    return plans.station_pair_distances(views.known_stations(spark, sf_dir))


@query(f"""
    select * from (
      select a.id as "id_A", a.lat as "lat_A", a.long as "long_A", b.id as "id_B", b.lat as "lat_B", b.long as "long_B",
             {haversine('a.long', 'a.lat', 'b.long', 'b.lat')} as abs_distance
      from places a, places b where a.id <> b.id) where abs_distance <= 40000""".replace("places", """(
        select id, try_cast(lat as double) as lat, try_cast(long as double) as long from raw_stations
        union all select '597', 38.826213e0, -77.05864e0)"""), "raw_stations")
def station_neighbours(spark, sf_dir):
    stations = plans.clean_stations(views.raw_stations(spark, sf_dir))
    return plans.station_neighbours(stations, 40_000)


@query("""
    select start_station_id, end_station_id, count(*) as count, lat_start, long_start, lat_end, long_end, abs_distance
    from enriched group by all""", "enriched")
def trip_pair_distances(spark, sf_dir):
    return plans.trip_pair_distances(views.trips(spark, sf_dir), views.stations(spark, sf_dir))


_ASOF_OUTPUT = ["event_id", "start_date", "date_time", "air_temp", "wind_speed", "visibility", "weather_class"]


def _asof_sql(tolerance: int) -> str:
    return f"""
        select l.event_id, l.start_date, w.date_time, round(w.air_temp, 6) as air_temp, w.wind_speed,
               w.visibility, w.weather_class
        from (select t.event_id, t.start_date, r.date_time
              from trips t asof left join weather r on t.start_date >= r.date_time) l
        left join weather w on w.date_time = l.date_time
             and epoch_us(l.start_date) - epoch_us(l.date_time) <= {tolerance * 1_000_000}"""


def _asof(spark, sf_dir, tolerance: int, strategy: str) -> DataFrame:
    trips = views.trips(spark, sf_dir).select("event_id", "start_date")
    matched = plans.add_weather(trips, views.weather(spark, sf_dir), tolerance, strategy)
    return rounded(matched.select(*_ASOF_OUTPUT), "air_temp")


@query(_asof_sql(360_000), "trips", "weather")
def asof_join(spark, sf_dir):
    return _asof(spark, sf_dir, 360_000, "interval")


@query(_asof_sql(360_000), "trips", "weather")
def asof_join_merge(spark, sf_dir):
    return _asof(spark, sf_dir, 360_000, "merge")


@query(_asof_sql(1_200), "trips", "weather")
def asof_join_short_tolerance(spark, sf_dir):
    return _asof(spark, sf_dir, 1_200, "interval")


@query(_asof_sql(1_200), "trips", "weather")
def asof_join_short_tolerance_merge(spark, sf_dir):
    return _asof(spark, sf_dir, 1_200, "merge")


# ---------------------------------------------------------------- counts and profiles

@query("""
    select weather_class, count(*) as count from (
      select *, """ + class_case("weather_summary_set_1d") + """ as weather_class from raw_weather
      where "Station_ID" is not null and air_temp_set_1 is not null)
    group by weather_class""", "raw_weather")
def class_counts(spark, sf_dir):
    return op.counts_by(plans.clean_weather(views.raw_weather(spark, sf_dir)), "weather_class")


@query("""
    select weather_class, count(*) as count, round(count(*) / sum(count(*)) over (), 6) as share from (
      select *, """ + class_case("weather_summary_set_1d") + """ as weather_class from raw_weather
      where "Station_ID" is not null and air_temp_set_1 is not null)
    group by weather_class""", "raw_weather")
def class_shares(spark, sf_dir):
    cleaned = plans.clean_weather(views.raw_weather(spark, sf_dir))
    return rounded(op.class_shares(cleaned, "weather_class"), "share")


def _slice(spark, sf_dir) -> DataFrame:
    trips = op.between_dates(views.trips(spark, sf_dir), "start_date", "01/05/2024", "01/20/2024")
    return op.with_both_ends_in(trips, op.inside_box(views.stations(spark, sf_dir)))


def _usage_sql(key: str) -> str:
    return f"""
        select {key}, count(*) as count from trips
        where start_date > timestamp '2024-01-05' and start_date < timestamp '2024-01-20'
          and start_station_id in {_IN_BOX} and end_station_id in {_IN_BOX}
        group by {key} order by count desc, {key}"""


@query(_usage_sql("member_type"), "trips", "stations")
def usage_by_member(spark, sf_dir):
    return op.usage_counts(_slice(spark, sf_dir), "member_type")


@query(_usage_sql("bike_number"), "trips", "stations")
def usage_by_bike(spark, sf_dir):
    return op.usage_counts(_slice(spark, sf_dir), "bike_number")


@query(_usage_sql("start_station_id"), "trips", "stations")
def usage_by_start_station(spark, sf_dir):
    return op.usage_counts(_slice(spark, sf_dir), "start_station_id")


@query(_usage_sql("end_station_id"), "trips", "stations")
def usage_by_end_station(spark, sf_dir):
    return op.usage_counts(_slice(spark, sf_dir), "end_station_id")


_USAGE_KEYS = ("member_type", "bike_number", "start_station_id", "end_station_id")


@query(" union all ".join(
    f"select '{key}' as attribute, {key} as category, count(*) as count from enriched group by {key}"
    for key in _USAGE_KEYS), "enriched")
def usage_profile(spark, sf_dir):
    return plans.trip_profile(views.enriched(spark, sf_dir))["usage"]


def _profile_sql(source: str, *columns: str) -> str:
    return " union all ".join(
        f"select '{c}' as attribute, cast(min({c}) as double) as min, cast(max({c}) as double) as max,"
        f" round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev_samp from {source}" for c in columns)


@query(_profile_sql("enriched", "duration", "abs_distance"), "enriched")
def numeric_profile(spark, sf_dir):
    return rounded(plans.trip_profile(views.enriched(spark, sf_dir))["numeric"], "mean", "stddev_samp")


@query(f"""
    with cleaned as (
      select round((try_cast(air_temp_set_1 as double) - 32) * 5e0 / 9e0, 6) as air_temp,
             try_cast(wind_speed_set_1 as double) as wind_speed, try_cast(visibility_set_1 as double) as visibility
      from raw_weather where "Station_ID" is not null and air_temp_set_1 is not null)
    select attribute, round(min, 6) as min, round(max, 6) as max, mean, stddev_samp from (
    {_profile_sql('cleaned', 'air_temp', 'wind_speed', 'visibility')})""".replace("with cleaned as", ", cleaned as", 1),
    "raw_weather")
def weather_numeric_profile(spark, sf_dir):
    cleaned = rounded(plans.clean_weather(views.raw_weather(spark, sf_dir)), "air_temp")
    profile = plans.weather_profile(cleaned)["numeric"]
    return rounded(profile, "min", "max", "mean", "stddev_samp")


@query("select max(abs_distance) as max_distance from enriched", "enriched")
def max_distance(spark, sf_dir):
    return views.enriched(spark, sf_dir).agg(F.max("abs_distance").alias("max_distance"))


@query("select count(*) as count from joined", "joined")
def row_count(spark, sf_dir):
    return op.row_count(views.joined(spark, sf_dir))


@query("""
    select cast(dayofyear(time) as int) as dayofyear, cast(sum(duration) as bigint) as total_duration,
           round(avg(month(time)), 6) as month, count(time) as count from joined group by 1""", "joined")
def daily_totals(spark, sf_dir):
    return rounded(op.daily_totals(views.joined(spark, sf_dir)), "month").orderBy("dayofyear")


@query("select cast(dayofyear(time) as int) as dayofyear, count(*) as count from joined group by 1", "joined")
def daily_counts(spark, sf_dir):
    return op.daily_counts(views.joined(spark, sf_dir)).orderBy("dayofyear")


@query(f"""
    select weather_class, count(*) as count from joined
    where date_time > timestamp '2024-01-05' and date_time < timestamp '2024-01-20'
      and start_station_id in {_IN_BOX} and end_station_id in {_IN_BOX}
    group by weather_class""", "joined", "stations")
def joined_class_counts(spark, sf_dir):
    allowed = op.inside_box(views.stations(spark, sf_dir))
    return plans.joined_class_counts(views.joined(spark, sf_dir), allowed, "01/05/2024", "01/20/2024")


@query(f"""
    select weather_class, count(*) as count from joined
    where date_time > timestamp '2024-01-05' and date_time < timestamp '2024-01-08'
      and start_station_id in {_IN_BOX} and end_station_id in {_IN_BOX}
    group by weather_class""", "joined", "stations")
def joined_class_counts_by_day(spark, sf_dir):
    """The same over trips that are stored by day; days that can have no such reading aren't read."""
    path = shared_folder(spark, "trips-by-day")
    write_by_day(views.trips(spark, sf_dir), "start_date", path)
    stations = views.stations(spark, sf_dir)
    joined = plans.joined_trips(spark.read.parquet(path), stations, views.weather(spark, sf_dir))
    return plans.joined_class_counts(joined, op.inside_box(stations), "01/05/2024", "01/08/2024", day="start_day")


_BY_PLACE_SQL = """
    with placed as (
      select *, cast(event_id % 7 as int) as place from (select event_id, start_date from trips)),
    seen as (
      select distinct on (place, date_time) cast(event_id % 7 as int) as place, date_trunc('minute', ts) as date_time,
             {value} as reading
      from events order by {order}),
    latest as (
      select t.event_id, t.place, t.start_date, r.date_time
      from placed t asof left join seen r on t.place = r.place and t.start_date >= r.date_time)
    select l.event_id, l.place, l.start_date, r.date_time, r.reading
    from latest l left join seen r on r.place = l.place and r.date_time = l.date_time
         and epoch_us(l.start_date) - epoch_us(l.date_time) <= 1200000000"""


def _by_place(spark, sf_dir, tie_break=()) -> DataFrame:
    """Trips and readings of seven places; several readings of a place fall into a minute."""
    trips = views.trips(spark, sf_dir).selectExpr("event_id", "start_date", "int(event_id % 7) as place")
    readings = views.table(spark, sf_dir, "events").selectExpr(
        "int(event_id % 7) as place", "date_trunc('minute', ts) as date_time", "value as reading", "event_id as number")
    found = op.asof_join(
        trips, readings.select("place", "date_time", "reading", *tie_break), "start_date", "date_time", 1200, by=["place"], tie_break=tie_break)
    return found.drop(*tie_break)


@query(_BY_PLACE_SQL.format(value="value", order="place, date_time, value desc").replace("with placed as", ", placed as", 1), "trips")
def asof_join_by_key(spark, sf_dir):
    return _by_place(spark, sf_dir)


@query(_BY_PLACE_SQL.format(value="value", order="place, date_time, event_id desc").replace("with placed as", ", placed as", 1), "trips")
def asof_join_tie_break(spark, sf_dir):
    return _by_place(spark, sf_dir, ["number"])


@query("""
    select start_station_id, weather_summary from (
      select start_station_id, weather_summary, row_number() over (
        partition by start_station_id order by count(*) desc, weather_summary) as rn
      from joined where weather_summary is not null group by 1, 2) where rn = 1""", "joined")
def group_mode(spark, sf_dir):
    return op.group_mode(views.joined(spark, sf_dir), ["start_station_id"], "weather_summary")


# ---------------------------------------------------------------- sorts, top-n, sets

@query("select event_id, start_date, duration from trips order by start_date, event_id", "trips")
def sorted_by_time(spark, sf_dir):
    return views.trips(spark, sf_dir).select("event_id", "start_date", "duration").orderBy("start_date", "event_id")


def _top_sql(order: str) -> str:
    return f"""
        select start_station_id, count(*) as count from trips
        group by 1 order by count {order}, start_station_id limit 10"""


@query(_top_sql("asc"), "trips")
def top_n_stations_asc(spark, sf_dir):
    return op.top_counts(views.trips(spark, sf_dir), "start_station_id", 10, "asc")


@query(_top_sql("desc"), "trips")
def top_n_stations_desc(spark, sf_dir):
    return op.top_counts(views.trips(spark, sf_dir), "start_station_id", 10, "desc")


_RAW_IDS = {"start_id": "Start station number", "end_id": "End station number"}
_RAW_USED_SQL = """
    select "Start station number" as station_id from raw_trips union select "End station number" from raw_trips"""


@query(_RAW_USED_SQL, "raw_trips")
def union_distinct_ids(spark, sf_dir):
    return op.used_ids(views.raw_trips(spark, sf_dir), **_RAW_IDS)


@query("""
    select "Start station number" as station_id from raw_trips
    except select "End station number" from raw_trips""", "raw_trips")
def except_station_ids(spark, sf_dir):
    return op.start_ids_never_ended(views.raw_trips(spark, sf_dir), **_RAW_IDS)


@query(f'select * from ({_RAW_USED_SQL}) except select "terminalName" from stations', "raw_trips", "stations")
def missing_dimension_ids(spark, sf_dir):
    ids = op.used_ids(views.raw_trips(spark, sf_dir), **_RAW_IDS)
    return op.ids_missing_from(ids, views.stations(spark, sf_dir))


@query(f"""
    select distinct "Start station number" as start_no, "Start station" as start_name from raw_trips
    where "Start station number" in ({_UNDEFINED})""", "raw_trips")
def undefined_names(spark, sf_dir):
    rows = views.raw_trips(spark, sf_dir).select(
        F.col("Start station number").alias("start_no"), F.col("Start station").alias("start_name"))
    return op.names_of(rows, "start_no", "start_name", STATION_CODES_UNDEFINED)


@query(f"""
    select 'start' as "end", start_no as station_id, start_name as station_name, count(*) as count
    from (select "Start station number" as start_no, "Start station" as start_name from raw_trips)
    where start_no in ({_UNDEFINED}) group by 2, 3
    union all
    select 'end', end_no, end_name, count(*)
    from (select "End station number" as end_no, "End station" as end_name from raw_trips)
    where end_no in ({_UNDEFINED}) group by 2, 3""", "raw_trips")
def undefined_usage(spark, sf_dir):
    named = {f"{end} station{part}": f"{end.lower()}_station_{name}"
             for end in ("Start", "End") for part, name in ((" number", "id"), ("", "name"))}
    trips = views.raw_trips(spark, sf_dir).withColumnsRenamed(named)
    return plans.reconcile_stations(trips, views.stations(spark, sf_dir))["undefined_names"]


_RAW_ENDS_SQL = """
    select 'start' as "end", "Start station number" as station_id, "Start station" as station_name from raw_trips
    union all select 'end', "End station number", "End station" from raw_trips"""


@query(f"""
    select 'used' as part, station_id, null as "end", null as station_name, 0 as count from ({_RAW_USED_SQL})
    union all select 'known', station_id, null, null, 0 from ({_RAW_USED_SQL})
        where station_id in (select "terminalName" from stations)
    union all select 'missing', station_id, null, null, 0 from
        (select station_id from ({_RAW_USED_SQL}) except select "terminalName" from stations)
    union all select 'start_only', station_id, null, null, 0 from
        (select station_id from ({_RAW_ENDS_SQL}) where "end" = 'start'
         except select station_id from ({_RAW_ENDS_SQL}) where "end" = 'end')
    union all select 'undefined_names', station_id, "end", station_name, count(*) from ({_RAW_ENDS_SQL})
        where station_id in ({_UNDEFINED}) group by station_id, "end", station_name""", "raw_trips", "stations")
def reconciliation(spark, sf_dir):
    """All five tables of the reconciliation, one below the other; a count of 0 where a table has none."""
    named = {f"{end} station{part}": f"{end.lower()}_station_{name}"
             for end in ("Start", "End") for part, name in ((" number", "id"), ("", "name"))}
    trips = views.raw_trips(spark, sf_dir).withColumnsRenamed(named)
    found = plans.reconcile_stations(trips, views.stations(spark, sf_dir))
    parts = [rows.select(F.lit(part).alias("part"), *rows.columns) if part == "undefined_names"
             else rows.select(F.lit(part).alias("part"), "station_id") for part, rows in found.items()]
    whole = parts[0]
    for rows in parts[1:]:
        whole = whole.unionByName(rows, allowMissingColumns=True)
    return whole.fillna(0, ["count"])


@query("select distinct weather_summary_set_1d as weather_summary from raw_weather", "raw_weather")
def distinct_values(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select(F.col("weather_summary_set_1d").alias("weather_summary")).distinct()


# ---------------------------------------------------------------- panels

_PANEL_MEANS = ("air_temp", "visibility", "wind_speed")


def _round_sql(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


@query(f"""
    select hour, dayofyear, month, station as start_station_id, total_duration, count,
           {_round_sql(*_PANEL_MEANS, 'abs_distance', 'lat', 'long')}, weather_class from observed""", "observed")
def station_hour_panel(spark, sf_dir):
    panel = plans.station_hour_panel(views.joined(spark, sf_dir))
    return rounded(panel, *_PANEL_MEANS, "abs_distance", "lat", "long")


@query(f"""
    select hour, dayofyear, month, {_round_sql(*_PANEL_MEANS)}, weather_class from hours""", "hours")
def hour_panel(spark, sf_dir):
    return rounded(plans.hour_panel(views.joined(spark, sf_dir)), *_PANEL_MEANS)


@query(f"""
    select hour, dayofyear, month, count, {_round_sql(*_PANEL_MEANS)},
           {code_case('weather_class')} as weather_class from hours""", "hours")
def city_hour_panel(spark, sf_dir):
    return rounded(plans.city_hour_panel(views.joined(spark, sf_dir)), *_PANEL_MEANS)


@query("""
    select year(time) as year, hour(time) as hour, dayofyear(time) as dayofyear, month(time) as month, count(*) as count,
           round(avg(air_temp), 6) as air_temp
    from joined group by 1, 2, 3, 4""", "joined")
def city_hour_panel_by_year(spark, sf_dir):
    panel = plans.city_hour_panel(views.joined(spark, sf_dir), with_year=True)
    return rounded(panel.select("year", "hour", "dayofyear", "month", "count", "air_temp"), "air_temp")


_DENSE_SQL = f"select hour, dayofyear, month, station, count, {_round_sql(*_PANEL_MEANS)}, weather_class from dense"


@query(f"""
    select hour, dayofyear, month, station, {_round_sql(*_PANEL_MEANS)}, weather_class from filler""", "filler")
def explode_keys(spark, sf_dir):
    observed, hours = plans.observed_cells_and_hours(views.joined(spark, sf_dir))
    return rounded(op.all_combinations(hours, observed.select("station").distinct()), *_PANEL_MEANS)


@query(_DENSE_SQL, "dense")
def densify_panel(spark, sf_dir):
    return rounded(views.dense_panel(spark, sf_dir), *_PANEL_MEANS)


@query(_DENSE_SQL, "dense")
def dedupe_keep_max(spark, sf_dir):
    observed, hours = plans.observed_cells_and_hours(views.joined(spark, sf_dir))
    filler = op.all_combinations(hours, observed.select("station").distinct())
    filler = filler.withColumn("count", F.lit(0).cast("bigint")).withColumn("is_observed", F.lit(0))
    both = observed.withColumn("is_observed", F.lit(1)).select(*filler.columns).unionByName(filler)
    kept = op.keep_largest(both, ["hour", "dayofyear", "month", "station"], "count", ["is_observed"])
    return rounded(kept.drop("is_observed"), *_PANEL_MEANS)


@query("select hour, dayofyear, month, cast(count as double) as label from hours", "hours")
def ml_label(spark, sf_dir):
    panel = plans.city_hour_panel(views.joined(spark, sf_dir))
    return op.label_from_count(panel.select("hour", "dayofyear", "month", "count"))


# ---------------------------------------------------------------- messages

_MESSAGE_COLUMNS = ", ".join(
    f"round(cast({name} as double), 6) as {name}" if kind == "double" else name
    for name, kind in ((f.name, f.dataType.typeName()) for f in TRIP_MESSAGE))


@query(f"select event_id, false as is_corrupt, {_MESSAGE_COLUMNS} from joined", "joined")
def json_decode(spark, sf_dir):
    joined = views.joined(spark, sf_dir)
    messages = joined.select("event_id", F.to_json(F.struct(*joined.columns)).alias("value"))
    decoded = decode_messages(messages, TRIP_MESSAGE, kept=("event_id",))
    numbers = [f.name for f in TRIP_MESSAGE if f.dataType == T.DoubleType()]
    return rounded(decoded, *numbers)

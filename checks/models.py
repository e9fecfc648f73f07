"""Model queries over panels of the whole test tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from checks import batch, views
from checks.batch import query, rounded
from checks.views import code_case
from tripweave import ml
from tripweave import operators as op
from tripweave import plans
from tripweave.fixed_values import CITY_FEATURES, STATION_NUMERIC_FEATURES
from tripweave.session import shared_folder
from tripweave.sinks import store

SEED = 7


def labelled_city(spark, sf_dir):
    """City panel with a label; hours without any weather reading cannot be model input."""
    panel = plans.city_hour_panel(views.joined(spark, sf_dir))
    return op.label_from_count(panel).na.drop("any")


def _labelled_stations(spark, sf_dir):
    return op.label_from_count(views.dense_panel(spark, sf_dir)).na.drop("any")


def in_training_part():
    """Seven of ten hours of the year, by arithmetic that SQL can repeat."""
    return (F.col("dayofyear") * 24 + F.col("hour")) * 7919 % 10 < 7


@query("""
    select hour, dayofyear, cast(count as double) as label,
           case when (dayofyear * 24 + hour) * 7919 % 10 < 7 then 'train' else 'test' end as part
    from hours where air_temp is not null""", "hours")
def ml_split(spark, sf_dir):
    panel = labelled_city(spark, sf_dir).select("hour", "dayofyear", "label")
    train, test = ml.split_where(panel, in_training_part())
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


_INDEX_SQL = """
    select station, row_number() over (order by count(*) desc, station) - 1 as station_index,
           count(*) over () as stations
    from observed where air_temp is not null group by station"""


def _indexed_stations(spark, sf_dir):
    """Observed cells with station and class indices and the station vector."""
    observed = store(views.observed_panel(spark, sf_dir).na.drop("any"), "observed-cells")  # the fit reads it several times
    *encode, assemble = ml.station_stages()
    return observed, Pipeline(stages=encode), assemble


@query(f"select station, cast(station_index as double) as station_index from ({_INDEX_SQL})", "observed")
def ml_string_index(spark, sf_dir):
    observed = store(views.observed_panel(spark, sf_dir).na.drop("any").select("station", "hour", "dayofyear"), "observed-cells")
    cells = ml.apply_index(observed, ml.fit_index(observed, "station"), "station", "station_index")
    return cells.groupBy("station").agg(F.max("station_index").alias("station_index"))


@query(f"""
    select station, cast(stations as int) as vector_size, cast(station_index as int) as set_at
    from ({_INDEX_SQL})""", "observed")
def ml_one_hot(spark, sf_dir):
    observed, encode, _ = _indexed_stations(spark, sf_dir)
    vector = vector_to_array("station_vector")
    return (
        encode.fit(observed).transform(observed)
        .select("station", F.size(vector).alias("vector_size"),
                (F.array_position(vector, 1.0) - 1).cast("int").alias("set_at"))
        .distinct()
    )


@query("""
    select hour, dayofyear, cast(hour as double) as f0, cast(dayofyear as double) as f1,
           cast(month as double) as f2, round(air_temp, 6) as f3, round(wind_speed, 6) as f4,
           round(visibility, 6) as f5, """ + code_case("weather_class") + """ as f6
    from hours where air_temp is not null""", "hours")
def ml_features_city(spark, sf_dir):
    assembled = ml.assemble_city(labelled_city(spark, sf_dir))
    values = vector_to_array("features")
    return assembled.select(
        "hour", "dayofyear",
        *[F.round(values[i], 6).alias(f"f{i}") for i in range(len(CITY_FEATURES))])


@query(f"""
    with_index as (select * from ({_INDEX_SQL})),
    closed as (select *, case when weather_class in ('clear', 'cloudy', 'light rain', 'heavy rain', 'snowy', 'icy',
                    'stormy', 'foggy') then weather_class else 'other' end as weather_known
               from observed where air_temp is not null),
    class_index as (select weather_known, row_number() over (order by count(*) desc, weather_known) - 1
                    as weather_index from closed group by weather_known)
    select o.hour, o.dayofyear, o.station, cast(7 + i.stations as int) as vector_size,
           round(o.hour + o.dayofyear + o.month + o.air_temp + o.wind_speed + o.visibility, 4) as numeric_sum,
           cast(c.weather_index as double) as weather_index, cast(i.station_index as int) as station_at
    from closed o join with_index i using (station) join class_index c using (weather_known)
    """.replace("with_index as", ", with_index as", 1), "observed")
def ml_features_station(spark, sf_dir):
    observed, encode, assemble = _indexed_stations(spark, sf_dir)
    numbers = len(STATION_NUMERIC_FEATURES)
    values = vector_to_array("features")
    numeric_sum = F.aggregate(F.slice(values, 1, numbers), F.lit(0.0), lambda total, x: total + x)
    station_part = F.slice(values, numbers + 2, F.size(values) - numbers - 1)
    cells = assemble.transform(encode.fit(observed).transform(observed))
    return cells.select(
        "hour", "dayofyear", "station", F.size(values).alias("vector_size"),
        F.round(numeric_sum, 4).alias("numeric_sum"), values[numbers].alias("weather_index"),
        (F.array_position(station_part, 1.0) - 1).cast("int").alias("station_at"))


@query("""
    select count(*) as n, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) as r2,
           round(sqrt(avg((y - p) * (y - p))), 6) as rmse
    from (select cast(count as double) as y, 10e0 + 0.5e0 * hour as p,
                 avg(cast(count as double)) over () as m from hours where air_temp is not null)""", "hours")
def ml_metrics(spark, sf_dir):
    predicted = labelled_city(spark, sf_dir).withColumn("prediction", 10.0 + 0.5 * F.col("hour"))
    return rounded(ml.regression_metrics(predicted), "r2", "rmse")


def _city_parts(spark, sf_dir):
    return ml.split_where(store(labelled_city(spark, sf_dir), "city-panel"), in_training_part())


@query()
def ml_train_city(spark, sf_dir):
    train, _ = _city_parts(spark, sf_dir)
    model = ml.fit_city_model(train, seed=SEED)
    return rounded(ml.regression_metrics(ml.score(model, train)), "r2", "rmse")


@query()
def ml_score(spark, sf_dir):
    train, test = _city_parts(spark, sf_dir)
    path = shared_folder(spark, "city-model")
    ml.save_model(ml.fit_city_model(train, seed=SEED), path)
    scored = ml.score(ml.load_model(path), test)
    return rounded(scored.select("hour", "dayofyear", "label", "prediction"), "prediction")


def _station_model(spark, sf_dir):
    panel = store(_labelled_stations(spark, sf_dir), "station-panel")
    train, test = ml.hash_split(panel, "hour", "dayofyear", "station", seed=SEED)
    return ml.fit_station_model(train, seed=SEED), train, test


@query()
def ml_train_station(spark, sf_dir):
    model, train, test = _station_model(spark, sf_dir)
    parts = {"train": train, "test": test}
    metrics = [
        ml.regression_metrics(ml.score(model, rows)).withColumn("part", F.lit(part))
        for part, rows in parts.items()]
    return rounded(metrics[0].unionByName(metrics[1]), "r2", "rmse")


@query()
def ml_scenarios(spark, sf_dir):
    """What if every cell of the panel had mild, dry weather?"""
    model, train, test = _station_model(spark, sf_dir)
    mild = train.unionByName(test).select(
        "hour", "dayofyear", "month", F.lit(14.0).alias("air_temp"), F.lit(10.0).alias("wind_speed"),
        F.lit(10.0).alias("visibility"), F.lit("clear").alias("weather_class"), "station")
    return ml.score_scenarios(model, mild)


# Planted labels: one split of the hour reproduces them, so a right fit must return them whole, and
# the rounds after the first have nothing left to learn.
_PLANTED_SQL = "case when hour >= 12 then 30e0 else 10e0 end"
_PLANTED_ROUNDS = 3


def _planted(rows):
    return rows.withColumn("label", F.when(F.col("hour") >= 12, 30.0).otherwise(10.0))


def _planted_city(spark, sf_dir):
    panel = _planted(labelled_city(spark, sf_dir))
    train, test = ml.split_where(store(panel, "planted-city"), in_training_part())
    return ml.fit_city_model(train, rounds=_PLANTED_ROUNDS, seed=SEED), test


def _planted_station(spark, sf_dir):
    cells = _planted(views.observed_panel(spark, sf_dir).na.drop("any"))
    train, test = ml.split_where(store(cells, "planted-cells"), in_training_part())
    return ml.fit_station_model(train, rounds=_PLANTED_ROUNDS, seed=SEED), train, test


@query(f"""
    select hour, dayofyear, {_PLANTED_SQL} as label, {_PLANTED_SQL} as prediction from hours
    where air_temp is not null and (dayofyear * 24 + hour) * 7919 % 10 >= 7""", "hours")
def ml_score_planted(spark, sf_dir):
    """Fit, save, load and score the city model: held-out hours get back the planted labels."""
    model, test = _planted_city(spark, sf_dir)
    path = shared_folder(spark, "planted-model")
    ml.save_model(model, path)
    scored = ml.score(ml.load_model(path), test)
    return rounded(scored.select("hour", "dayofyear", "label", "prediction"), "prediction")


@query(f"""
    select hour, dayofyear, {_PLANTED_SQL} as prediction from hours
    where air_temp is not null and (dayofyear * 24 + hour) * 7919 % 10 >= 7""", "hours")
def ml_tree_walk(spark, sf_dir):
    """The same by a walk of the saved trees, without the model's scorer."""
    model, test = _planted_city(spark, sf_dir)
    path = shared_folder(spark, "planted-model")
    ml.save_model(model, path)
    return rounded(ml.walk_trees(ml.assemble_city(test), path, "hour", "dayofyear"), "prediction")


@query("""
    select case when (dayofyear * 24 + hour) * 7919 % 10 < 7 then 'train' else 'test' end as part, count(*) as n,
           1e0 as r2, 0e0 as rmse
    from observed where air_temp is not null group by part""", "observed")
def ml_train_station_planted(spark, sf_dir):
    model, train, test = _planted_station(spark, sf_dir)
    parts = [ml.regression_metrics(ml.score(model, rows)).withColumn("part", F.lit(part))
             for part, rows in (("train", train), ("test", test))]
    return rounded(parts[0].unionByName(parts[1]), "r2", "rmse")


@query(f"""
    select hour, dayofyear, month, 14e0 as air_temp, 10e0 as wind_speed, 10e0 as visibility, 'clear' as weather_class,
           station, cast({_PLANTED_SQL} as int) as predicted_count
    from observed where air_temp is not null""", "observed")
def ml_scenarios_planted(spark, sf_dir):
    """Scenarios of every cell, one row for each: the planted labels don't ask for the weather."""
    model, train, test = _planted_station(spark, sf_dir)
    mild = train.unionByName(test).select(
        "hour", "dayofyear", "month", F.lit(14.0).alias("air_temp"), F.lit(10.0).alias("wind_speed"),
        F.lit(10.0).alias("visibility"), F.lit("clear").alias("weather_class"), "station")
    return ml.score_scenarios(model, mild)


QUERIES, ORACLES = batch.QUERIES, batch.ORACLES

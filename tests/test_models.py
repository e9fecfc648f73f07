"""Splits, features, training, persistence, scoring."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tripweave import ml
from tripweave.schemas import SCENARIO

PANEL = ("hour int, dayofyear int, month int, station string, air_temp double, visibility double,"
         " wind_speed double, weather_class string, label double")


@pytest.fixture()
def panel(rows):
    draw = random.Random(4)
    def row():
        hour, station = draw.randrange(24), draw.choice("abc")
        label = 10.0 * (8 <= hour <= 18) + 5.0 * (station == "a") + draw.random()
        return hour, draw.randrange(1, 366), draw.randrange(1, 13), station, 10.0, 5.0, 2.0, draw.choice(["clear", "foggy"]), label
    return rows.of(PANEL, *[row() for _ in range(600)], (1, 1, 1, "a", None, 5.0, 2.0, "clear", 1.0))


def test_hash_split_is_stable_and_whole(panel):
    train, test = ml.hash_split(panel, seed=1)
    again, _ = ml.hash_split(panel.repartition(7), seed=1)
    assert train.count() + test.count() == panel.count()
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    assert 0.6 < train.count() / panel.count() < 0.8
    other, _ = ml.hash_split(panel, seed=2)
    assert not train.exceptAll(other).isEmpty()


def test_random_split_keeps_all_rows(panel):
    train, test = ml.random_split(panel, seed=3)
    assert train.count() + test.count() == panel.count()


def test_station_model_learns_saves_and_scores(spark, panel, tmp_path):
    train, test = ml.hash_split(panel.na.drop(), seed=1)
    model = ml.fit_station_model(train, seed=5)
    scored = ml.score(model, test)
    metrics = ml.regression_metrics(scored).first()
    assert metrics.r2 > 0.9
    for name in ("r2", "rmse"):
        assert metrics[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(scored))
    ml.save_model(model, str(tmp_path / "m"))
    ml.save_model(model, str(tmp_path / "m"))
    loaded = ml.load_model(str(tmp_path / "m"))
    same_seed = ml.fit_station_model(train, seed=5)
    for other in (loaded, same_seed):
        pairs = scored.select("hour", "dayofyear", "label", "prediction").exceptAll(
            ml.score(other, test).select("hour", "dayofyear", "label", "prediction"))
        assert pairs.isEmpty()
    scenarios = spark.createDataFrame(
        [(8, 110, 4, 14.0, 10.0, 10.0, "clear", "a"), (3, 110, 4, 14.0, 10.0, 10.0, "hail", "never seen")], SCENARIO)
    counts = {r.station: r.predicted_count for r in ml.score_scenarios(loaded, scenarios).collect()}
    assert counts["a"] >= 12 and 0 <= counts["never seen"] < 8
    assert ml.score_scenarios(loaded, scenarios).schema["predicted_count"].dataType.typeName() == "integer"


def test_city_model_takes_text_codes_and_skips_nulls(panel):
    city = panel.drop("station").withColumn("weather_class", F.lit("3"))
    model = ml.fit_city_model(city, rounds=3)
    numeric = city.withColumn("weather_class", F.col("weather_class").cast("double")).na.drop()
    assert ml.regression_metrics(ml.score(model, numeric)).first().r2 > 0.5


def test_metrics_without_spread_or_rows(rows):
    flat = rows.of("label double, prediction double", (1.0, 2.0), (1.0, 2.0), (None, 1.0))
    assert tuple(ml.regression_metrics(flat).first()) == (2, None, 1.0)
    assert ml.regression_metrics(flat.limit(0)).first().n == 0


def test_station_model_takes_free_weather_texts(rows):
    draw = random.Random(8)
    cells = [(draw.randrange(24), 5, 1, draw.choice("ab"), 10.0, 5.0, 2.0, f"text {i % 40}", float(i % 3)) for i in range(200)]
    model = ml.fit_station_model(rows.of(PANEL, *cells), rounds=1)
    assert ml.score(model, rows.of(PANEL, (1, 5, 1, "a", 10.0, 5.0, 2.0, "never seen", None))).count() == 1


def test_mean_encoding_has_one_feature_for_any_number_of_stations(rows):
    widths = []
    for stations in (3, 60):
        cells = [(i % 24, 5, 1, f"s{i % stations}", 10.0, 5.0, 2.0, "clear", float(i % stations)) for i in range(600)]
        panel = rows.of(PANEL, *cells)
        model = ml.fit_station_model(panel, rounds=5, encoding="mean")
        widths.append(ml.score(model, panel).first().features.size)
        assert ml.regression_metrics(ml.score(model, panel)).first().r2 > 0.9
        unseen = rows.of(PANEL, (1, 5, 1, "unseen", 10.0, 5.0, 2.0, "clear", None))
        assert 0 <= ml.score(model, unseen).first().prediction < stations
    assert widths == [8, 8]
    with pytest.raises(ValueError):
        ml.station_stages(encoding="other")


def test_width_of_the_station_model_is_checked(spark):
    panel = spark.range(10_000).selectExpr(
        "cast(id % 24 as int) hour", "5 dayofyear", "1 month", "concat('s', id % 5000) station", "10.0D air_temp", "5.0D visibility",
        "2.0D wind_speed", "'clear' weather_class", "cast(id % 3 as double) label").select(*[c.split()[0] for c in PANEL.split(", ")])
    wide = ml.fit_station_model(panel, rounds=1)
    assert ml.score(wide, panel).first().features.size == 8
    few = panel.where("station in ('s1', 's2', 's3')")
    assert ml.score(ml.fit_station_model(few, rounds=1, most_one_hot=3), few).first().features.size == 7 + 3
    assert ml.score(ml.fit_station_model(few, rounds=1, most_one_hot=2), few).first().features.size == 8


def test_index_of_a_million_labels(spark):
    from pyspark.sql import functions as F

    labels = spark.range(1_000_000).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("station"))
    rows = labels.unionByName(labels.where("station >= 's0999000'")).unionByName(spark.createDataFrame([(None,)], "station string"))
    index = ml.fit_index(rows, "station")
    found = ml.apply_index(rows.select("station").distinct(), index, "station", "number")
    first = F.when(F.col("station") >= "s0999000", F.substring("station", 2, 7).cast("int") - 999_000).otherwise(F.substring("station", 2, 7).cast("int") + 1000)
    assert found.where("station is not null").where(F.col("number") != first).isEmpty() and found.count() == 1_000_001
    assert [r["number"] for r in found.where("station is null").collect()] == [1_000_000.0]
    assert ml.apply_index(rows.limit(3), ml.fit_index(rows.limit(0), "station"), "station", "n").select("n").distinct().collect()[0][0] == 0.0


def test_walk_of_saved_trees_equals_the_models_scores(spark, panel, tmp_path):
    key = ["hour", "dayofyear", "month", "station", "label"]
    rows = panel.na.drop().dropDuplicates(key)
    labelled = rows.withColumn("label", F.col("label") + 20.0 * (F.col("weather_class") == "foggy").cast("int"))
    path = str(tmp_path / "trees")
    model = ml.fit_station_model(labelled, rounds=4, seed=2)
    ml.save_model(model, path)
    scored = ml.score(model, labelled)
    walked = ml.walk_trees(scored, path, *key).withColumnRenamed("prediction", "walked")
    both = scored.join(walked, key)
    assert both.count() == labelled.count() > 500
    assert both.where(F.abs(F.col("prediction") - F.col("walked")) > 1e-9).isEmpty()
    nodes = ml.tree_nodes(spark, path)
    assert nodes.where("categories is not null").count() > 0 and nodes.where("threshold is not null").count() > 0
    assert nodes.where("left is null and (feature is not null or right is not null)").isEmpty()
    use = {r.feature: r.splits for r in ml.feature_use(spark, path, ["hour"]).collect()}
    assert use["hour"] > 0 and sum(use.values()) == nodes.where("left is not null").count()
    assert ml.walk_trees(scored.limit(0), path, *key).count() == 0

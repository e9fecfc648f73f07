"""Gradient-boosted traffic models: fit, save, load, score, evaluate."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import BOOSTING_ROUNDS
from tripweave.ml.features import ModelColumns, city_stages, station_stages
from tripweave.session import ensure_checkpoint_dir


def _fit(
    stages: list, train: DataFrame, columns: ModelColumns, rounds: int, seed: int,
    cache_node_ids: bool,
) -> PipelineModel:
    # The residuals of earlier rounds are checkpointed, so that a lost executor does not
    # replay all rounds. Caching node ids pays off for deep trees only.
    ensure_checkpoint_dir(train.sparkSession)
    boosting = GBTRegressor(
        featuresCol=columns.features, labelCol=columns.label, predictionCol=columns.prediction,
        maxIter=rounds, seed=seed, cacheNodeIds=cache_node_ids, checkpointInterval=5,
    )
    return Pipeline(stages=[*stages, boosting]).fit(train)


def fit_city_model(
    train: DataFrame, rounds: int = BOOSTING_ROUNDS, seed: int = 0,
    columns: ModelColumns = ModelColumns(), cache_node_ids: bool = False,
) -> PipelineModel:
    """Model of trips per hour over a city panel with a numeric weather class and a label;
    rows with any null are left out of training.
    """
    numeric = train.withColumn("weather_class", F.col("weather_class").try_cast("double"))
    return _fit(city_stages(columns), numeric.na.drop("any"), columns, rounds, seed, cache_node_ids)


def fit_station_model(
    train: DataFrame, rounds: int = BOOSTING_ROUNDS, seed: int = 0,
    columns: ModelColumns = ModelColumns(), cache_node_ids: bool = False, encoding: str | None = None,
    most_one_hot: int = 1_000,
) -> PipelineModel:
    """Model of trips per station and hour; rows with any null are left out of training.

    With no ``encoding`` named, stations are one-hot up to ``most_one_hot`` of them in the training rows and
    beyond that their mean label (see ``station_stages``), as trees hold all features of a row densely.
    """
    known = train.na.drop("any")
    if encoding is None:
        stations = known.select("station").distinct().limit(most_one_hot + 1).count()
        encoding = "one_hot" if stations <= most_one_hot else "mean"
    return _fit(station_stages(columns, encoding), known, columns, rounds, seed, cache_node_ids)


def save_model(model: PipelineModel, path: str) -> None:
    """Save with all feature stages, replacing an earlier model."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with a ``prediction``; works on batch and streaming frames alike."""
    return model.transform(rows)


def score_scenarios(model: PipelineModel, scenarios: DataFrame) -> DataFrame:
    """Expected trips (cut to a whole number) for each row of a table of what-if scenarios."""
    predicted = score(model, scenarios)
    return predicted.select(
        *scenarios.columns, F.col("prediction").cast("int").alias("predicted_count"),
    )


def regression_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
) -> DataFrame:
    """R2, RMSE and row count of predictions, in one pass.

    The spread of the labels comes from their population variance, which Spark merges
    stably over partitions.
    """
    error = F.col(label) - F.col(prediction)
    both = predictions.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    sums = both.agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("variance"),
    )
    return sums.select(
        "n",
        (1 - F.col("mse") / F.nullif(F.col("variance"), F.lit(0.0))).alias("r2"),
        F.sqrt("mse").alias("rmse"),
    )

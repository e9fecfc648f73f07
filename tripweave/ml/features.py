"""Feature stages for the city and the station model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.sql import DataFrame

from tripweave.fixed_values import CITY_FEATURES, OTHER_WEATHER_CLASS, STATION_NUMERIC_FEATURES, WEATHER_CLASS_CODES


@dataclass(frozen=True)
class ModelColumns:
    features: str = "features"
    label: str = "label"
    prediction: str = "prediction"


def city_stages(columns: ModelColumns = ModelColumns()) -> list[Transformer]:
    return [VectorAssembler(inputCols=list(CITY_FEATURES), outputCol=columns.features)]


def assemble_city(panel: DataFrame, columns: ModelColumns = ModelColumns()) -> DataFrame:
    return city_stages(columns)[0].transform(panel)


def closed_weather_class() -> SQLTransformer:
    """``weather_known``: the class, or one common class for text outside the fixed list.

    The classifier passes unknown text through, so without this the number of classes, and with
    it the bins of a tree split, would grow with the texts.
    """
    known = ", ".join(f"'{name}'" for name in WEATHER_CLASS_CODES)
    return SQLTransformer(statement=(
        f"SELECT *, CASE WHEN weather_class IN ({known}) THEN weather_class"
        f" WHEN weather_class IS NOT NULL THEN '{OTHER_WEATHER_CLASS}' END AS weather_known FROM __THIS__"))


def station_stages(
    columns: ModelColumns = ModelColumns(), encoding: str = "one_hot", smoothing: float = 10.0,
) -> list[Estimator | Transformer]:
    """Close the weather classes, index station and class (most frequent first), encode the
    station, assemble.

    ``one_hot`` gives every station a feature of its own. Boosted trees hold all features of a
    row densely, so that form is for networks of hundreds of stations. ``mean`` replaces the
    station by its smoothed mean label in the training rows: one feature for any number.

    Being stages of the model's own pipeline they are fitted on training rows only and saved
    with it; a station or class never seen in training gets an index of its own.
    """
    if encoding not in ("one_hot", "mean"):
        raise ValueError("encoding is 'one_hot' or 'mean'")
    index = StringIndexer(
        inputCols=["station", "weather_known"], outputCols=["station_index", "weather_index"],
        handleInvalid="keep",
    )
    if encoding == "one_hot":
        encode = [OneHotEncoder(inputCols=["station_index"], outputCols=["station_vector"])]
    else:
        mean = TargetEncoder(
            inputCols=["station_index"], outputCols=["station_mean"], labelCol=columns.label,
            targetType="continuous", smoothing=smoothing, handleInvalid="keep")
        # The encoder hands on the index's metadata, by which trees would take means for categories.
        plain = SQLTransformer(statement="SELECT *, station_mean + 0.0D AS station_vector FROM __THIS__")
        encode = [mean, plain]
    assemble = VectorAssembler(
        inputCols=[*STATION_NUMERIC_FEATURES, "weather_index", "station_vector"],
        outputCol=columns.features,
    )
    return [closed_weather_class(), index, *encode, assemble]

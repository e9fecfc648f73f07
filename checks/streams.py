"""Streaming queries. The joined trips arrive as JSON message files in three parts by date;
after each arrival the query runs on from its checkpoint, so every part is one micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from checks import views
from checks.batch import query, rounded
from checks.models import SEED, in_training_part, labelled_city
from tripweave import ml
from tripweave.fixed_values import STREAM_CATEGORY_ATTRIBUTES, STREAM_NUMERIC_ATTRIBUTES
from tripweave.operators import message_box
from tripweave.schemas import TRIP_MESSAGE
from tripweave.session import shared_folder
from tripweave.sinks import json_messages, store, write_batch, write_message_files
from tripweave.streaming import (
    current_windows, decode_messages, run_batches, start_scoring, start_summaries, start_windowed_summary, text_stream, wait,
)

_ARRIVALS = 3
_FILE_ROWS = 250_000
_STATION_CUT = 10
_KEPT_SQL = "lat_start >= 38 and lat_start < 40 and long_start > -78 and long_start < -76 and abs_distance > -1"
_ARRIVED_SQL = """
    select *, case when day(start_date) <= 10 then 0 when day(start_date) <= 20 then 1 else 2 end
    as batch_id from joined"""


def _arrival(time: str):
    day = F.dayofmonth(time)
    return F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)


def _deliver(
    spark: SparkSession, rows: DataFrame, start: Callable[[DataFrame, str], StreamingQuery],
    broken: Column | None = None, runs: int = 1,
) -> None:
    """Write the rows of each ``arrival`` as message files and let the stream work them off.
    Rows with ``broken`` arrive as text that is not JSON. Several runs read the same messages,
    each with a checkpoint of its own."""
    broken = F.lit(False) if broken is None else broken
    table, messages = (shared_folder(spark, purpose) for purpose in ("arrivals", "messages"))
    checkpoints = [shared_folder(spark, "stream-checkpoint") for _ in range(runs)]
    # No row moves, and files of a bounded length let many tasks read an arrival.
    rows.write.option("maxRecordsPerFile", _FILE_ROWS).partitionBy("arrival").parquet(table)
    arrived = spark.read.parquet(table)
    for number in range(_ARRIVALS):
        part = arrived.where(F.col("arrival") == number).drop("arrival")
        cut_off = part.where(broken).select(F.lit('{"hour": ').alias("value"))
        write_message_files(json_messages(part.where(~broken)).unionByName(cut_off), messages)
        for checkpoint in checkpoints:
            wait(start(text_stream(spark, messages), checkpoint))


def _joined_arrivals(spark, sf_dir) -> DataFrame:
    return views.joined(spark, sf_dir).withColumn("arrival", _arrival("start_date"))


@query(f"""
    select event_id, start_station_id, abs_distance from joined where {_KEPT_SQL}""", "joined")
def stream_filter(spark, sf_dir):
    output = shared_folder(spark, "filtered")
    schema = StructType(list(TRIP_MESSAGE.fields)).add("event_id", LongType())

    def start(messages, checkpoint):
        kept = decode_messages(messages, schema).where(message_box())
        rows = kept.select("event_id", "start_station_id", F.col("abs_distance").cast("bigint").alias("abs_distance"))
        return run_batches(rows, lambda batch, number: write_batch(batch, output, number), checkpoint)

    _deliver(spark, _joined_arrivals(spark, sf_dir), start)
    return spark.read.parquet(output).drop("run_id", "batch_id")


def _summaries(spark, sf_dir, order: str = "asc") -> tuple[DataFrame, DataFrame]:
    numbers, categories = shared_folder(spark, "numeric-summary"), shared_folder(spark, "category-summary")
    _deliver(spark, _joined_arrivals(spark, sf_dir), lambda messages, checkpoint: start_summaries(
        messages, numbers, categories, checkpoint, station_cut=_STATION_CUT, order=order))
    return spark.read.parquet(numbers), spark.read.parquet(categories)


_NUMERIC_SQL = " union all ".join(f"""
    select batch_id, '{name}' as attribute, max(elements) as elements, count(*) as elements_after_filter,
           round(cast(min({name}) as double), 6) as min, round(cast(max({name}) as double), 6) as max,
           round(avg({name}), 6) as mean, round(stddev_pop({name}), 6) as stddev_pop
    from (select *, count(*) over (partition by batch_id) as elements from ({_ARRIVED_SQL}))
    where {_KEPT_SQL} group by batch_id""" for name in STREAM_NUMERIC_ATTRIBUTES)


@query(_NUMERIC_SQL, "joined")
def stream_numeric_summary(spark, sf_dir):
    numbers, _ = _summaries(spark, sf_dir)
    return rounded(numbers.drop("timestamp", "corrupt", "run_id"), "min", "max", "mean", "stddev_pop")


_CATEGORY_SQL = " union all ".join(f"""
    select batch_id, '{name}' as attribute, max(elements) as elements,
           string_agg(category, '|' order by n, category) as categories,
           string_agg(cast(n as varchar), '|' order by n, category) as counts
    from (select batch_id, category, n, elements,
                 row_number() over (partition by batch_id order by n, category) as rn
          from (select batch_id, {name} as category, count(*) as n, max(elements) as elements
                from (select *, count(*) over (partition by batch_id) as elements from ({_ARRIVED_SQL}))
                where {_KEPT_SQL} group by batch_id, {name}))
    where '{name}' <> 'start_station_id' or rn <= {_STATION_CUT}
    group by batch_id""" for name in STREAM_CATEGORY_ATTRIBUTES)


@query(_CATEGORY_SQL, "joined")
def stream_categorical_summary(spark, sf_dir):
    _, categories = _summaries(spark, sf_dir)
    counts = F.transform("values", lambda n: n.cast("bigint").cast("string"))
    return categories.select(
        "batch_id", "attribute", "elements", F.array_join("categories", "|").alias("categories"),
        F.array_join(counts, "|").alias("counts"))


_COUNTS_SQL = " union all ".join(f"""
    select batch_id, '{name}' as attribute, {name} as category, count(*) as count
    from ({_ARRIVED_SQL}) where {_KEPT_SQL} group by batch_id, {name}""" for name in STREAM_CATEGORY_ATTRIBUTES)


@query(_COUNTS_SQL, "joined")
def stream_category_counts(spark, sf_dir):
    """The long table: every category of every attribute, without a cut."""
    numbers, categories, counts = (shared_folder(spark, f"{name}-summary") for name in ("numeric", "category", "long"))
    _deliver(spark, _joined_arrivals(spark, sf_dir), lambda messages, checkpoint: start_summaries(
        messages, numbers, categories, checkpoint, station_cut=_STATION_CUT, counts_path=counts))
    return spark.read.parquet(counts).select("batch_id", "attribute", "category", "count")


@query(" union all ".join(f"""
    select time_bucket(interval '6 hours', start_date) as window_start, '{name}' as attribute, count(*) as elements_after_filter,
           round(cast(min({name}) as double), 6) as min, round(cast(max({name}) as double), 6) as max,
           round(avg({name}), 6) as mean, round(stddev_pop({name}), 6) as stddev_pop
    from joined where {_KEPT_SQL} group by 1""" for name in STREAM_NUMERIC_ATTRIBUTES), "joined")
def stream_windowed_summary(spark, sf_dir):
    """Windows of event time over all micro-batches; the state goes on from the checkpoint."""
    output = shared_folder(spark, "windows")
    _deliver(spark, _joined_arrivals(spark, sf_dir), lambda messages, checkpoint: start_windowed_summary(
        messages, output, checkpoint, size="6 hours", mode="complete"))
    windows = current_windows(spark.read.parquet(output)).drop("run_id", "window_end")
    return rounded(windows, "min", "max", "mean", "stddev_pop")


@query(f"""
    select batch_id, attribute, elements_after_filter, cast(2 as bigint) as runs from ({_NUMERIC_SQL})""", "joined")
def stream_summary_two_runs(spark, sf_dir):
    """Two streams with checkpoints of their own add to the same tables."""
    numbers, categories = shared_folder(spark, "numeric-summary"), shared_folder(spark, "category-summary")
    _deliver(spark, _joined_arrivals(spark, sf_dir), lambda messages, checkpoint: start_summaries(
        messages, numbers, categories, checkpoint, station_cut=_STATION_CUT), runs=2)
    return spark.read.parquet(numbers).groupBy("batch_id", "attribute", "elements_after_filter").agg(
        F.count_distinct("run_id").alias("runs"))


@query("""
    select case when dayofyear <= 10 then 0 when dayofyear <= 20 then 1 else 2 end as batch_id,
           count(*) filter (where hour % 8 not in (1, 3, 5)) as n,
           count(*) filter (where hour % 8 = 1) as unlabelled, count(*) filter (where hour % 8 = 3) as corrupt,
           count(*) filter (where hour % 8 = 5) as incomplete, true as rmse_agrees
    from hours where air_temp is not null and (dayofyear * 24 + hour) * 7919 % 10 >= 7 group by 1""", "hours")
def stream_score(spark, sf_dir):
    """Messages of some hours come without a label, cut off, or without a temperature."""
    panel = store(labelled_city(spark, sf_dir), "city-panel")
    train, test = ml.split_where(panel, in_training_part())
    model = ml.fit_city_model(train, seed=SEED)
    predictions, metrics = shared_folder(spark, "predictions"), shared_folder(spark, "metrics")
    day, eighth = F.col("dayofyear"), F.col("hour") % 8
    arrivals = test.withColumn("arrival", F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2))
    sent = arrivals.withColumns({
        "label": F.when(eighth != 1, F.col("label")), "air_temp": F.when(eighth != 5, F.col("air_temp"))})
    _deliver(spark, sent, lambda messages, checkpoint: start_scoring(
        messages, model, predictions, metrics, checkpoint), broken=eighth == 3)
    scored = ml.score(model, arrivals.where(~eighth.isin(1, 3, 5)))
    error = F.col("label") - F.col("prediction")
    at_once = scored.groupBy(F.col("arrival").alias("batch_id")).agg(F.sqrt(F.avg(error * error)).alias("_rmse"))
    return spark.read.parquet(metrics).join(at_once, "batch_id", "left").select(
        "batch_id", "n", "unlabelled", "corrupt", "incomplete",
        (F.abs(F.col("rmse") - F.col("_rmse")) <= 1e-9 * F.col("_rmse")).alias("rmse_agrees"))

"""As-of left join: each left row with the latest right row at or before it, within a tolerance.

Two plans give the same rows:

* ``interval``, if the caller names it (as a streaming left side needs): every right row becomes the
  time interval in which it is the latest one, cut at bucket borders, and the left side joins by
  bucket. Spark broadcasts the intervals while they are under its own size threshold. A reading's
  successor matters only within the tolerance, so it is looked for inside a segment of that length, and
  for a segment's last reading in the segment after it: no window orders all readings.
* ``merge``, the default: for any size and skew. Distinct left times are resolved against right times in
  three levels (minute, day, whole history), so that no window ever holds more than one
  minute of distinct times, one day of minutes or the history's days; then the left side joins
  its resolved times by equality. The left side is read twice: its time column, and the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SECOND = 1_000_000
_MINUTE = 60 * _SECOND
_MINUTES_PER_DAY = 1440
_NEVER = 2**63 - 1


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    tolerance_seconds: int,
    by: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    strategy: str = "merge",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Left rows with the columns of their match, or nulls.

    A match holds ``0 <= left_time - right_time <= tolerance`` and, if given, equal ``by``
    columns. Of right rows at one time, the largest by ``tie_break`` and then by the remaining
    columns counts. Either plan runs no job when it is built. A streaming left side cannot be
    merged and needs ``interval``.
    """
    clash = (set(left.columns) & set(right.columns)) - set(by)
    if clash:
        raise ValueError(f"rename columns on one side first: {sorted(clash)}")
    if strategy not in ("interval", "merge"):
        raise ValueError("strategy is 'interval' or 'merge'")

    by = list(by)
    tolerance, bucket = tolerance_seconds * _SECOND, bucket_seconds * _SECOND
    readings = _one_row_per_time(right, right_time, by, tie_break)
    output = left.columns + [name for name in right.columns if name not in by]

    if strategy == "merge" and left.isStreaming:
        raise ValueError("a streaming left side needs strategy='interval'")
    if strategy == "interval":
        joined = _interval_join(left, readings, left_time, by, tolerance, bucket)
    else:
        joined = _merge_join(left, readings, left_time, by, tolerance)
    return joined.select(*[F.col(f"`{name}`") for name in output])


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _one_row_per_time(
    right: DataFrame, right_time: str, by: list[str], tie_break: Sequence[str],
) -> DataFrame:
    """Right rows with their time as ``_r``; copies of one time collapse on the map side."""
    first = list(tie_break)
    order = first + [name for name in right.columns if name not in by and name not in first]
    best = (
        right.where(F.col(right_time).isNotNull())
        .groupBy(*by, _micros(F.col(right_time)).alias("_r"))
        .agg(F.max(F.struct(*order)).alias("_best"))
    )
    return best.select(*by, "_r", *[F.col("_best")[name].alias(name) for name in order])


def _with_interval(
    readings: DataFrame, by: list[str], tolerance: int, bucket: int,
) -> DataFrame:
    """Each reading with its interval ``[_r, _end)`` and the buckets the interval touches."""
    segment = F.floor(F.col("_r") / max(tolerance + 1, bucket))
    first = _renamed_keys(
        readings.groupBy(*by, (segment - 1).alias("_before")).agg(F.min("_r").alias("_first_after")), by)
    within = Window.partitionBy(*by, "_segment").orderBy("_r")
    in_segment = readings.withColumn("_segment", segment).withColumn("_later", F.lead("_r").over(within))
    rows = in_segment.join(first, _with_keys(F.col("_segment") == F.col("_before"), by), "left")
    later = F.coalesce("_later", "_first_after", F.lit(_NEVER))
    end = F.least(later, F.col("_r") + tolerance + 1)
    return rows.select(*readings.columns, end.alias("_end")).withColumns({
        "_first": F.floor(F.col("_r") / bucket), "_last": F.floor((F.col("_end") - 1) / bucket),
    })


def _interval_join(
    left: DataFrame, readings: DataFrame, left_time: str, by: list[str], tolerance: int,
    bucket: int,
) -> DataFrame:
    cut = _with_interval(readings, by, tolerance, bucket)
    pieces = cut.withColumn("_bucket", F.explode(F.sequence("_first", "_last")))
    intervals = _renamed_keys(pieces.drop("_first", "_last"), by)
    time = _micros(F.col(left_time))
    condition = (
        (F.floor(time / bucket) == F.col("_bucket"))
        & (time >= F.col("_r")) & (time < F.col("_end"))
    )
    return left.join(intervals, _with_keys(condition, by), "left")


def _merge_join(
    left: DataFrame, readings: DataFrame, left_time: str, by: list[str], tolerance: int,
) -> DataFrame:
    left_times = left.select(
        *by, _micros(F.col(left_time)).alias("_t"), F.lit(None).cast("bigint").alias("_r"),
    ).where(F.col("_t").isNotNull())
    both = left_times.unionByName(readings.select(*by, F.col("_r").alias("_t"), "_r"))
    both = both.withColumn("_minute", F.floor(F.col("_t") / _MINUTE))

    # Distinct times; ``_r`` is set where a reading has that very time. Hot instants collapse
    # on the map side, so a crowded moment is one row here.
    times = both.groupBy(*by, "_minute", "_t").agg(F.max("_r").alias("_r"))

    # Latest reading of all earlier minutes: within the day, else of earlier days. Counted
    # from the distinct times, whose shuffle Spark reuses, so neither side is read again.
    minutes = (
        times.groupBy(*by, "_minute").agg(F.max("_r").alias("_newest"))
        .withColumn("_day", F.floor(F.col("_minute") / _MINUTES_PER_DAY))
    )
    before_day = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        minutes.groupBy(*by, "_day").agg(F.max("_newest").alias("_newest"))
        .select(*by, "_day", F.max("_newest").over(before_day).alias("_from_days"))
    )
    before_minute = (
        Window.partitionBy(*by, "_day").orderBy("_minute")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        minutes.withColumn("_from_minutes", F.max("_newest").over(before_minute))
        .join(days, [*by, "_day"])
        .select(*by, "_minute", F.coalesce("_from_minutes", "_from_days").alias("_carried"))
    )

    so_far = (
        Window.partitionBy(*by, "_minute").orderBy("_t")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = F.coalesce(F.max("_r").over(so_far), F.col("_carried"))
    resolved = (
        times.join(carried, [*by, "_minute"], "left")
        .select(*by, "_t", latest.alias("_latest"))
        .where(F.col("_t") - F.col("_latest") <= tolerance)
    )
    matches = resolved.join(
        readings.withColumnRenamed("_r", "_latest"), [*by, "_latest"],
    ).drop("_latest")
    matches = _renamed_keys(matches, by)
    condition = _micros(F.col(left_time)) == F.col("_t")
    return left.join(matches, _with_keys(condition, by), "left")


def _renamed_keys(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.withColumnsRenamed({name: f"_right_{name}" for name in by})


def _with_keys(condition: Column, by: list[str]) -> Column:
    for name in by:
        condition = condition & (F.col(name) == F.col(f"_right_{name}"))
    return condition

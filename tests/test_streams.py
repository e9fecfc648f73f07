"""Micro-batches: summaries equal batch results, restarts add nothing, empty input is quiet."""

from __future__ import annotations

import json
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripweave import ml
from tripweave.schemas import TIMED_TRIP_MESSAGE, TRIP_MESSAGE
from tripweave.sinks import read_committed
from tripweave.streaming import (
    category_counts, category_lists, current_windows, decode_messages, late_rows, run_batches, start_scoring, start_summaries,
    start_windowed_summary, text_stream, wait, windowed_summary,
)


def message(draw):
    return {
        "duration": draw.randrange(100), "start_station_id": f"s{draw.randrange(5)}",
        "member_type": draw.choice(["Member", "Casual"]), "lat_start": draw.choice([37.0, 38.0, 38.5]),
        "long_start": -77.0, "abs_distance": str(draw.randrange(1000)), "air_temp": draw.uniform(-5, 30),
        "wind_speed": 3, "visibility": 1.5, "weather_class": draw.choice(["clear", "foggy"]), "extra": 1,
    }


@pytest.fixture()
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return {name: str(tmp_path / name) for name in ("in", "numbers", "categories", "checkpoint")}


def deliver(folders, number, messages, broken=()):
    lines = [json.dumps(m) for m in messages] + list(broken)
    with open(f"{folders['in']}/{number}.txt", "w") as file:
        file.write("".join(f"{line}\n" for line in lines))


def summarise(spark, folders, **options):
    query = start_summaries(text_stream(spark, folders["in"], 1), folders["numbers"], folders["categories"],
                            folders["checkpoint"], **{"station_cut": 9, **options})
    assert wait(query, 120)


def test_summaries_per_batch_and_restart(spark, folders):
    draw = random.Random(5)
    batches = [[message(draw) for _ in range(size)] for size in (30, 50)]
    for number, batch in enumerate(batches):
        deliver(folders, number, batch, broken=["not json"] * number)
        summarise(spark, folders, station_cut=2)
        summarise(spark, folders, station_cut=2)  # nothing new: nothing added
    numbers = spark.read.parquet(folders["numbers"]).collect()
    lists = {(r.batch_id, r.attribute): r for r in spark.read.parquet(folders["categories"]).collect()}
    assert len(numbers) == 2 * 5 and len(lists) == 2 * 3
    for r in numbers:
        kept = [m for m in batches[r.batch_id] if m["lat_start"] >= 38]
        values = [float(m[r.attribute]) for m in kept]
        assert (r.elements, r.elements_after_filter, r.corrupt) == (len(batches[r.batch_id]), len(kept), r.batch_id)
        assert (r["min"], r["max"]) == (min(values), max(values))
        assert r["mean"] == pytest.approx(statistics.fmean(values))
        assert r.stddev_pop == pytest.approx(statistics.pstdev(values))
    for (number, attribute), r in lists.items():
        counts = Counter(m[attribute] for m in batches[number] if m["lat_start"] >= 38)
        expected = sorted(((n, c) for c, n in counts.items()))[: 2 if attribute == "start_station_id" else None]
        assert list(zip(r["values"], r.categories)) == expected and r.elements == len(batches[number])


def test_empty_and_fully_filtered_batches_add_no_rows(spark, folders):
    far = dict(message(random.Random(1)), lat_start=10.0)
    deliver(folders, 0, [])
    summarise(spark, folders)
    deliver(folders, 1, [far])
    summarise(spark, folders)
    for table in ("numbers", "categories"):
        assert spark.read.parquet(folders[table]).count() == 0


def test_most_used_stations_first(spark, rows):
    counts = rows.of("attribute string, category string, count bigint",
                     *[("start_station_id", f"s{i}", i % 3) for i in range(7)], ("member_type", "Member", 4))
    got = {r.attribute: r for r in category_lists(counts, {"start_station_id": 3}, "desc").collect()}
    assert got["start_station_id"].categories == ["s2", "s5", "s1"] and got["start_station_id"]["values"] == [2.0, 2.0, 1.0]
    assert got["member_type"].categories == ["Member"]
    with pytest.raises(ValueError):
        category_lists(counts, order="up")


def test_category_cut_is_applied_before_the_shuffle(spark, rows):
    decoded = decode_messages(rows.of("value string", ("{}",)), TRIP_MESSAGE)
    lists = category_lists(category_counts(decoded, F.lit(True)), {"start_station_id": 3})
    assert "WindowGroupLimit" in lists._jdf.queryExecution().executedPlan().toString()


def test_timed_trigger_runs_until_stopped(spark, folders):
    deliver(folders, 0, [message(random.Random(2))])
    seen = []
    query = run_batches(text_stream(spark, folders["in"]), lambda batch, number: seen.append(batch.count()),
                        folders["checkpoint"], every_seconds=0.2)
    try:
        assert not wait(query, 0.1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(seen) == 1


def test_scoring_stream_equals_batch_scoring(spark, rows, folders):
    draw = random.Random(9)
    def row():
        hour = draw.randrange(24)
        return hour, draw.randrange(365), draw.randrange(12), draw.uniform(0, 30), 3.0, 9.0, 1.0, float(hour * 3)
    schema = "hour int, dayofyear int, month int, air_temp double, wind_speed double, visibility double, weather_class double, label double"
    train = rows.of(schema, *[row() for _ in range(200)])
    model = ml.fit_city_model(train, rounds=2)
    batch = [row() for _ in range(20)]
    names = [part.split()[0] for part in schema.split(", ")]
    deliver(folders, 0, [dict(zip(names, values)) for values in batch], broken=["{"])
    query = start_scoring(text_stream(spark, folders["in"]), model, folders["numbers"], folders["categories"], folders["checkpoint"])
    assert wait(query, 120)
    expected = ml.score(model, rows.of(schema, *batch))
    metrics = spark.read.parquet(folders["categories"]).first()
    batch_metrics = ml.regression_metrics(expected).first()
    assert metrics.n == 20 and metrics.rmse == pytest.approx(batch_metrics.rmse) and metrics.r2 == pytest.approx(batch_metrics.r2)
    assert [r[0] for r in rows.back(spark.read.parquet(folders["numbers"]), "prediction")] == pytest.approx(
        [r[0] for r in rows.back(expected, "prediction")])


def test_two_checkpoints_add_up_in_one_table(spark, folders, tmp_path):
    deliver(folders, 0, [message(random.Random(3)) for _ in range(20)])
    for checkpoint in ("a", "a", "b"):  # the second run of "a" finds nothing new
        summarise(spark, dict(folders, checkpoint=str(tmp_path / checkpoint)))
    numbers = spark.read.parquet(folders["numbers"])
    assert numbers.select("run_id").distinct().count() == 2 and numbers.count() == 2 * 5
    stamps = [spark.read.parquet(path).select("run_id", "timestamp").distinct() for path in
              (folders["numbers"], folders["categories"], folders["categories"] + "-counts")]
    assert all(s.count() == 2 and s.exceptAll(stamps[0]).isEmpty() for s in stamps)


def test_lists_are_cut_and_counts_are_whole(spark, folders):
    deliver(folders, 0, [dict(message(random.Random(i)), weather_class=f"text {i:03}", lat_start=38.5) for i in range(50)])
    summarise(spark, folders, other_cut=7)
    lists = {r.attribute: r.categories for r in spark.read.parquet(folders["categories"]).collect()}
    counts = spark.read.parquet(folders["categories"] + "-counts").where("attribute = 'weather_class'")
    assert lists["weather_class"] == [f"text {i:03}" for i in range(7)] and counts.count() == 50


def test_unlabelled_messages_are_predicted_and_the_rest_is_counted(spark, rows, folders):
    schema = "hour int, dayofyear int, month int, air_temp double, wind_speed double, visibility double, weather_class double, label double"
    row = lambda hour, label, temp=5.0: (hour, 3, 1, temp, 3.0, 9.0, 1.0, label)
    model = ml.fit_city_model(rows.of(schema, *[row(h % 24, float(h % 24)) for h in range(96)]), rounds=1)
    names = [part.split()[0] for part in schema.split(", ")]
    sent = [row(1, 1.0), row(2, 2.0), row(3, None), row(4, None), row(5, None), row(6, 6.0, None), row(7, None, None)]
    deliver(folders, 0, [dict(zip(names, values)) for values in sent], broken=["{", "no"])
    query = start_scoring(text_stream(spark, folders["in"]), model, folders["numbers"], folders["categories"], folders["checkpoint"])
    assert wait(query, 120)
    assert [r[0] for r in rows.back(spark.read.parquet(folders["numbers"]), "hour")] == [1, 2, 3, 4, 5]
    assert tuple(spark.read.parquet(folders["categories"]).select("n", "unlabelled", "corrupt", "incomplete").first()) == (2, 3, 2, 2)


def timed(draw, minute):
    return message(draw) | {"start_date": f"2019-05-01T{minute // 60 % 24:02}:{minute % 60:02}:00", "lat_start": 38.5}


def windows(spark, folders, mode, **options):
    query = start_windowed_summary(
        text_stream(spark, folders["in"], 1), folders["numbers"], folders["checkpoint"], size="1 hour", delay="2 hours", mode=mode, **options)
    assert wait(query, 120)
    return query


def counted(spark, folders):
    rows = current_windows(spark.read.parquet(folders["numbers"])).where("attribute = 'duration'").collect()
    return {r["window_start"].hour: (r["elements_after_filter"], r["min"], r["max"]) for r in rows}


def by_hour(messages):
    hours = {}
    for m in messages:
        hours.setdefault(int(m["start_date"][11:13]), []).append(float(m["duration"]))
    return {h: (len(v), min(v), max(v)) for h, v in hours.items()}


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_windows_go_on_after_a_restart(spark, folders, mode):
    draw, sent = random.Random(8), []
    for number, minutes in enumerate([range(0, 200, 7), range(100, 300, 9), range(150, 320, 11)]):
        batch = [timed(draw, m) for m in minutes]
        sent += batch
        deliver(folders, number, [*batch, message(draw)], broken=["not json"])  # one without a time
        windows(spark, folders, mode)
        assert counted(spark, folders) == by_hour(sent)
    at_once = windowed_summary(
        decode_messages(spark.read.text(folders["in"]), TIMED_TRIP_MESSAGE), F.lit(True)).where("attribute = 'duration'")
    assert {r["window_start"].hour: r["elements_after_filter"] for r in at_once.collect()} == {h: v[0] for h, v in by_hour(sent).items()}


def test_final_windows_leave_late_messages_out(spark, folders):
    draw = random.Random(9)
    batches = [[timed(draw, m) for m in minutes] for minutes in ([10, 20, 70], [600], [15, 610], [900])]
    dropped = 0
    for number, batch in enumerate(batches):
        deliver(folders, number, batch)
        dropped += late_rows(windows(spark, folders, "append"))
    # Hours 0 and 1 were final two hours before 10:00; the message of 0:15 came after that.
    got = counted(spark, folders)
    assert dropped == 1 and got == by_hour(batches[0] + batches[1] + [batches[2][1]])
    assert spark.read.parquet(folders["numbers"]).groupBy("window_start", "attribute").count().where("count > 1").isEmpty()


def test_half_a_batch_is_not_shown(spark, folders, monkeypatch):
    from tripweave.streaming import summaries

    draw = random.Random(6)
    deliver(folders, 0, [message(draw) for _ in range(20)])
    summarise(spark, folders)
    tables = [folders["numbers"], folders["categories"], folders["categories"] + "-counts"]
    shown = lambda: [{r["batch_id"] for r in read_committed(spark, t, folders["numbers"] + "-commits").collect()} for t in tables]
    assert shown() == [{0}] * 3
    deliver(folders, 1, [message(draw) for _ in range(20)])
    write = summaries.write_batch

    def fails(rows, path, *more):
        if path == folders["categories"]:
            raise RuntimeError("lost")
        write(rows, path, *more)

    monkeypatch.setattr(summaries, "write_batch", fails)
    with pytest.raises(Exception):
        summarise(spark, folders)
    assert {r["batch_id"] for r in spark.read.parquet(folders["numbers"]).collect()} == {0, 1}  # written, not committed
    assert shown() == [{0}] * 3
    monkeypatch.setattr(summaries, "write_batch", write)
    summarise(spark, folders)
    assert shown() == [{0, 1}] * 3


def test_two_runs_read_one_set_of_messages(spark, tmp_path, monkeypatch):
    from checks import streams

    written, tasks = [], []
    add = streams.write_message_files

    def counted(messages, path):
        written.append(messages.count())
        tasks.append(messages.select(F.spark_partition_id()).distinct().count())
        add(messages, path)

    monkeypatch.setattr(streams, "write_message_files", counted)
    monkeypatch.setattr(streams, "_FILE_ROWS", 50, raising=False)
    per_row = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(per_row)
    spark.conf.set(per_row, str(64 << 20))
    try:
        rows = spark.range(0, 1200, 1, 1).select("id", (F.col("id") % 3).alias("arrival"))
        seen = {}

        def start(messages, checkpoint):
            def handle(batch, number):
                seen.setdefault(checkpoint, []).append((number, batch.count()))
            return run_batches(messages, handle, checkpoint)

        streams._deliver(spark, rows, start, runs=2)
    finally:
        spark.conf.set(per_row, old)
    assert written == [400, 400, 400] and min(tasks) > 1
    assert list(seen.values()) == [[(0, 400), (1, 400), (2, 400)]] * 2

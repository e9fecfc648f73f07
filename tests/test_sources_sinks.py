"""Files, literal rows, messages."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tripweave import schemas, session
from tripweave.sinks import json_messages, keyed_json_messages, store, write_batch, write_parquet
from tripweave.sources import append_rows, kafka_batch, kafka_stream, read_csv, read_declared, read_parquet
from tripweave.streaming import decode_messages


def test_csv_header_comments_and_glob(spark, rows, tmp_path):
    for month, line in (("201901", "1,A"), ("201902", "2,#B")):
        folder = tmp_path / f"{month}-tripdata"
        folder.mkdir()
        (folder / f"{month}-tripdata.csv").write_text(f"# made by hand\nid,name\n# note\n{line}\n")
    frame = read_csv(spark, f"{tmp_path}/*-tripdata/*-tripdata.csv")
    assert frame.dtypes == [("id", "string"), ("name", "string")]
    assert rows.back(frame) == [("1", "A"), ("2", "#B")]
    declared = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    assert rows.back(read_csv(spark, f"{tmp_path}/*-tripdata/*.csv", declared)) == rows.back(frame)


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,A\n")
    (tmp_path / "b.csv").write_text("name,id\nB,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_declared_columns_of_a_wider_file(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("extra,nbEmptyDocks,nbBikes,long,lat,terminalName,name,id\nx,2,1,-77,38,31000,A,7\n")
    assert rows.back(read_declared(spark, str(tmp_path), schemas.RAW_STATIONS)) == [("7", "A", "31000", "38", "-77", "1", "2")]
    assert rows.back(read_declared(spark, str(tmp_path), schemas.STATIONS)) == [("7", "A", "31000", 38.0, -77.0, 1, 2)]
    with pytest.raises(ValueError, match="Duration"):
        read_declared(spark, str(tmp_path), schemas.RAW_TRIPS)


def test_csv_without_comments(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n#1;A\n")
    assert rows.back(read_csv(spark, str(tmp_path / "a.csv"), separator=";", comment=None)) == [("#1", "A")]


def test_parquet_write_refuses_an_existing_path(spark, rows, tmp_path):
    frame, path = rows.of("k int, m int", (1, 1), (2, 2)), str(tmp_path / "t")
    write_parquet(frame, path, partition_by=["m"])
    assert rows.back(read_parquet(spark, path)) == [(1, 1), (2, 2)]
    with pytest.raises(AnalysisException):
        write_parquet(frame, path)
    write_parquet(frame.limit(0), path, mode="overwrite")
    assert rows.back(store(frame, "t")) == [(1, 1), (2, 2)]


def test_batch_folder_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for _ in range(2):
        write_batch(rows.of("k int", (1,)), path, 0)
    write_batch(rows.of("k int", (2,)), path, 1)
    assert rows.back(spark.read.parquet(path), "k", "batch_id") == [(1, 0), (2, 1)]


def test_literal_rows_follow_the_schema(spark, rows):
    stations = spark.createDataFrame([], schemas.STATIONS)
    assert rows.back(append_rows(stations, [("1", "A", "31000", 1.0, 2.0, 3, 4)])) == [("1", "A", "31000", 1.0, 2.0, 3, 4)]


def test_messages(rows):
    frame = rows.of("time timestamp, duration int, visibility double, other string",
                    (datetime(2019, 1, 1, 2, 3, 4), 5, 1.5, 'a "b"'))
    assert json.loads(json_messages(frame).first().value)["other"] == 'a "b"'
    message = keyed_json_messages(frame).first()
    assert message.key == "2019-01-01 02:03:04" and json.loads(message.value) == {"duration": 5, "visibility": 1.5}


def test_decode_quoted_bare_missing_and_broken(rows):
    schema = T.StructType([T.StructField("n", T.DoubleType()), T.StructField("s", T.StringType()),
                           T.StructField("at", T.TimestampType())])
    texts = ['{"n": "1.5", "s": 7, "at": "2019-01-01T00:00:00.000Z"}', '{"n": 2, "at": 1546300800000}',
             '{"n": "x"}', "{}", "not json", '{"n": 1', None]
    got = decode_messages(rows.of("value string", *[(t,) for t in texts]), schema).collect()
    new_year = datetime(2019, 1, 1)
    assert [tuple(r) for r in got[:4]] == [
        (False, 1.5, "7", new_year), (False, 2.0, None, new_year), (False, None, None, None), (False, None, None, None)]
    assert [r.is_corrupt for r in got[4:]] == [True, True, True]


def test_kafka_needs_its_connector(spark):
    # The connector package is not installed here: the calls must reach it and say so.
    for read in (kafka_batch, kafka_stream):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            read(spark, "localhost:1", "topic")


def test_shared_folder_uses_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(root) and first != second

"""From raw CSV files to a dense panel and a model, as the README shows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from tripweave import ml, plans
from tripweave import operators as op
from tripweave.sources import read_csv


def write(path, header, lines):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def test_raw_files_to_model(spark, tmp_path):
    draw, start = random.Random(8), datetime(2019, 5, 1)
    write(tmp_path / "weather.csv",
          "# station data\nStation_ID,Date_Time,unused,air_temp_set_1,wind_speed_set_1,visibility_set_1,"
          "weather_summary_set_1d,weather_condition_set_1d",
          [f"KDCA,{start + timedelta(hours=h):%m/%d/%Y %H:%M} EDT,x,{50 + h % 20},3,10,{'light rain' if h % 5 else ''},RA"
           for h in range(72)])
    write(tmp_path / "stations.csv", "id,name,extra,terminalName,lat,long,nbBikes,nbEmptyDocks",
          [f"{i},S{i},x,3100{i},38.{i + 1},-77.{i + 1},4,5" for i in range(4)] + ["9,Far,x,31009,50,10,1,1"])
    for month, days in (("201905a", (0, 1)), ("201905b", (2,))):
        lines = []
        for _ in range(150):
            begin = start + timedelta(days=draw.choice(days), seconds=draw.randrange(86_400))
            lines.append(f"{draw.randrange(60, 3000)},{begin:%Y-%m-%d %H:%M:%S},{begin + timedelta(minutes=9):%Y-%m-%d %H:%M:%S},"
                         f"3100{draw.randrange(4)},A,3100{draw.choice([0, 1, 2, 3, 9])},B,W{draw.randrange(20)},Member")
        write(tmp_path / f"{month}-tripdata" / f"{month}-tripdata.csv",
              "Duration,Start date,End date,Start station number,Start station,End station number,End station,"
              "Bike number,Member type", lines)

    weather = plans.clean_weather(read_csv(spark, str(tmp_path / "weather.csv")))
    stations = plans.clean_stations(read_csv(spark, str(tmp_path / "stations.csv")))
    trips = plans.clean_trips(read_csv(spark, f"{tmp_path}/*-tripdata/*.csv"))
    assert (weather.count(), stations.count(), trips.count()) == (72, 6, 300)

    kept = op.with_both_ends_in(op.between_dates(trips, "start_date", "04/01/2019", "09/30/2019"),
                                op.inside_box(stations))
    joined = plans.joined_trips(kept, stations, weather)
    assert joined.count() == kept.count() < 300
    assert joined.where("date_time is null or date_time > start_date").isEmpty()
    assert joined.where("start_date - date_time >= interval 1 hour").isEmpty()
    usage = plans.trip_profile(joined)["usage"]
    assert usage.where("attribute = 'member_type'").first()["count"] == joined.count()
    shares = plans.weather_profile(weather)["classes"].collect()
    assert {r.weather_class for r in shares} == {"light rain", "clear"} and abs(sum(r.share for r in shares) - 1) < 1e-9

    panel = op.label_from_count(plans.dense_station_panel(joined))
    assert panel.agg({"label": "sum"}).first()[0] == joined.count()
    train, test = ml.hash_split(panel, "hour", "dayofyear", "station")
    model = ml.fit_station_model(train, rounds=2)
    assert ml.score(model, test.na.drop()).count() == test.na.drop().count()

from tripweave.plans.clean import clean_stations, clean_trips, clean_weather
from tripweave.plans.enrich import (
    add_weather, enrich_by_pairs, enrich_trips, joined_trips, station_neighbours, station_pair_distances, trip_pair_distances,
)
from tripweave.plans.panels import (
    city_hour_panel, dense_station_panel, densify, hour_panel, observed_cells_and_hours,
    station_hour_panel,
)
from tripweave.plans.profiles import joined_class_counts, trip_profile, weather_profile
from tripweave.plans.reconcile import reconcile_stations

__all__ = [
    "add_weather", "city_hour_panel", "clean_stations", "clean_trips", "clean_weather",
    "dense_station_panel", "densify", "enrich_by_pairs", "enrich_trips", "hour_panel", "joined_class_counts", "joined_trips",
    "observed_cells_and_hours",
    "reconcile_stations", "station_hour_panel", "station_neighbours", "station_pair_distances", "trip_pair_distances", "trip_profile",
    "weather_profile",
]

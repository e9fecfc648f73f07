from tripweave.functions.calendar import calendar_parts, trip_hour_keys
from tripweave.functions.distance import haversine_metres
from tripweave.functions.text import parse_double, parse_int, parse_time
from tripweave.functions.weather import celsius, weather_class, weather_code
from tripweave.functions.codes import remap_code

__all__ = [
    "calendar_parts", "celsius", "haversine_metres", "parse_double", "parse_int", "parse_time",
    "remap_code", "trip_hour_keys", "weather_class", "weather_code",
]

"""Formats, bounds, codes, word lists and column lists that decide results."""

# Text formats of the raw files and of user-given date bounds.
WEATHER_TIME_FORMAT = "MM/dd/yyyy HH:mm"
WEATHER_TIME_LENGTH = 16
TRIP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_BOUND_FORMAT = "MM/dd/yyyy"

# Default bounds of the filters.
DEFAULT_START_DATE = "12/31/2018"
DEFAULT_END_DATE = "12/31/2019"
DEFAULT_MIN_LAT = 38.0
DEFAULT_MIN_LONG = -78.0
DEFAULT_MAX_LAT = 40.0
DEFAULT_MAX_LONG = -76.0
DEFAULT_MIN_DISTANCE = -1.0

# Station codes that mean another station, and codes of stations that left the network.
STATION_CODE_REMAP = {"00000": "31127"}
STATION_CODES_REMOVED = ("31008", "32031")
STATION_CODES_UNDEFINED = ("31086", "00000", "31008", "32031")

# The one station missing from the station file:
# id, name, terminalName, lat, long, nbBikes, nbEmptyDocks.
MISSING_STATION = (
    "597", "Mount Vernon Ave & E Del Ray Ave", "31086", 38.826213, -77.058640, 5, 10,
)

# Mean earth radius in kilometres, as used by the distance formula.
EARTH_RADIUS_KM = 6371

# Oldest weather reading a trip may be matched with: 100 hours.
WEATHER_TOLERANCE_SECONDS = 360_000

# Weather classes: the first pattern found in the summary text decides.
CLEAR_CLASS = "clear"
WEATHER_CLASS_PATTERNS = (
    ("heavy (drizzle|rain)|heavy_rain", "heavy rain"),
    ("rain|drizzle", "light rain"),
    ("broken|overcast|cloudy", "cloudy"),
    ("clear|scattered|sunny|obscured", CLEAR_CLASS),
    ("snow", "snowy"),
    ("ice", "icy"),
    ("thunder|squalls", "stormy"),
    ("haze|mist|fog", "foggy"),
)

# Numeric code of each weather class in the city panel; any other class gets the last code.
WEATHER_CLASS_CODES = {
    "clear": 0, "cloudy": 1, "light rain": 2, "heavy rain": 3,
    "snowy": 4, "icy": 5, "stormy": 6, "foggy": 7,
}
OTHER_WEATHER_CODE = 8
OTHER_WEATHER_CLASS = "other"

# Attributes summarised per micro-batch.
STREAM_NUMERIC_ATTRIBUTES = ("air_temp", "wind_speed", "visibility", "duration", "abs_distance")
STREAM_CATEGORY_ATTRIBUTES = ("member_type", "weather_class", "start_station_id")

# Model inputs.
CITY_FEATURES = (
    "hour", "dayofyear", "month", "air_temp", "wind_speed", "visibility", "weather_class",
)
STATION_NUMERIC_FEATURES = ("hour", "dayofyear", "month", "air_temp", "wind_speed", "visibility")
BOOSTING_ROUNDS = 10
TRAIN_SHARE = 0.7

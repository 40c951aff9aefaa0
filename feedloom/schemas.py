"""Feed schemas, payload schemas, the wide-table contract and column naming."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# Column names of the feeds, bound by name on read.
TS = "call_timestamp"
REGIONS = ("west", "east", "central", "south", "north")
PERIODS = (1, 2, 3)
DAYS = (1, 2, 3, 4)

RAINFALL = _struct([
    ("timestamp", _S), ("station_id", _S), ("station_loc", _S), ("station_name", _S),
    ("rainfall_realtime", _D), (TS, _S),
])
NON_RAINFALL = _struct([
    ("timestamp", _S), ("station_id", _S), ("station_loc", _S), ("station_name", _S),
    ("wind_speed_realtime", _D), ("wind_dir_realtime", _D), ("RH%_realtime", _D),
    ("air_temp_realtime", _D), (TS, _S),
])
FORECAST_2HR = _struct([
    ("2hr_forecast_area", _S), ("2hr_forecast_area_loc", _S), ("2hr_forecast_value", _S),
    ("2hr_start", _S), ("2hr_end", _S), (TS, _S),
])
FORECAST_24HR = _struct(
    [("24hr_start", _S), ("24hr_end", _S), ("24hr_general_forecast", _S)]
    + [(f"24hr_general_{m}_{b}", _D)
       for m in ("relative_humidity", "temperature", "wind_speed") for b in ("low", "high")]
    + [("24hr_general_wind_direction", _S)]
    + [(f"24hr_period_{p}_{x}", _S) for p in PERIODS
       for x in ("start", "end", *[f"forecast_{r}" for r in REGIONS])]
    + [(TS, _S)]
)
FORECAST_4DAY = _struct(
    [("4day_date", _S), ("4day_forecast", _S)]
    + [(f"4day_{m}_{b}", _D)
       for m in ("temperature", "relative_humidity", "wind_speed") for b in ("low", "high")]
    + [("4day_wind_direction", _S), ("4day_update_timestamp", _S), (TS, _S)]
)
ROUTES = _struct([
    ("camera_id", _L), ("direction", _L), ("cam_loc", _S), ("remarks", _S),
    ("dir_start", _S), ("dir_finish", _S),
])
CONGESTION = _struct([
    ("camera_id", _L), ("direction", _L), ("trafficCongestion", _S),
    ("travelDistance", _D), ("travelDuration", _D), ("travelDurationTraffic", _D),
    ("distanceUnit", _S), ("durationUnit", _S), (TS, _S),
    ("cam_loc", _S), ("remarks", _S), ("dir_start", _S), ("dir_finish", _S),
])

# Columns of the three seed files and the readings of the stations.
SEED_AREAS = _struct([("region", _S), ("coord", _S)])
SEED_MAPPING = _struct([
    ("cam_id", _L), ("not_rainfall", _S), ("rainfall", _S), ("region", _S), ("compass", _S),
])
SEED_CAMERAS = _struct(
    [("camera_id", _L), ("cam_loc", _S), ("remarks", _S)]
    + [(f"dir_{end}_{i}", _S) for i in range(1, 6) for end in ("start", "finish")]
)
READING_KINDS = ("air_temp", "rainfall", "RH%", "wind_dir", "wind_speed")

# The wide table, 65 columns in warehouse order.
WAREHOUSE = _struct(
    [(TS, _S), ("cam_id", _I), ("direction", _I), ("compass", _S),
     ("two_hr_forecast_area", _S), ("non_rainfall_station_id", _S),
     ("rainfall_station_id", _S), ("rainfall_realtime", _D), ("wind_speed_realtime", _D),
     ("wind_dir_realtime", _D), ("humidity_realtime", _D), ("air_temp_realtime", _D),
     ("two_hr_forecast_value", _S)]
    + [(f"four_day_{m}_{d}", t) for d in DAYS for m, t in (
        ("wind_speed_low", _I), ("wind_direction", _S), ("relative_humidity_high", _I),
        ("temperature_high", _I), ("wind_speed_high", _I), ("temperature_low", _I),
        ("forecast", _S), ("relative_humidity_low", _I))]
    + [("twenty_four_hr_start", _S), ("twenty_four_hr_end", _S),
       ("twenty_four_hr_general_forecast", _S),
       ("twenty_four_hr_general_relative_humidity_low", _I),
       ("twenty_four_hr_general_relative_humidity_high", _I),
       ("twenty_four_hr_general_temperature_low", _I),
       ("twenty_four_hr_general_temperature_high", _I),
       ("twenty_four_hr_general_wind_speed_low", _I),
       ("twenty_four_hr_general_wind_speed_high", _I),
       ("twenty_four_hr_general_wind_direction", _S)]
    + [(f"twenty_four_hr_period_{p}{x}", _S) for p in PERIODS for x in ("_start", "_end", "")]
    + [("trafficcongestion", _S)]
)
WAREHOUSE_KEY = (TS, "cam_id", "direction")
LABEL = "trafficcongestion"

# The 35 measures of the profile and the model, in their usual order.
REALTIME = ("rainfall_realtime", "wind_speed_realtime", "wind_dir_realtime",
            "humidity_realtime", "air_temp_realtime")
MEASURES = (
    *REALTIME,
    *[f"four_day_{m}_{b}_{d}" for m in ("temperature", "relative_humidity", "wind_speed")
      for b in ("low", "high") for d in DAYS],
    *[f"twenty_four_hr_general_{m}_{b}"
      for m in ("relative_humidity", "temperature", "wind_speed") for b in ("low", "high")],
)
FEATURES = (*MEASURES, "cam_id", "direction")
IDENTIFIERS = ("rainfall_station_id", "non_rainfall_station_id", "two_hr_forecast_area",
               "compass")
TIME_COLUMNS = (TS, "twenty_four_hr_start", "twenty_four_hr_end",
                *[f"twenty_four_hr_period_{p}_{x}" for p in PERIODS for x in ("start", "end")])

# Column order of the range report.
REPORT_ORDER = (
    TS, "cam_id", "direction", "compass", "two_hr_forecast_area", "non_rainfall_station_id",
    "rainfall_station_id", *REALTIME, "two_hr_forecast_value",
    *[f"four_day_{m}_{d}" for d in DAYS for m in (
        "forecast", "wind_speed_low", "wind_speed_high", "wind_direction",
        "relative_humidity_low", "relative_humidity_high", "temperature_low",
        "temperature_high")],
    *[n for n in WAREHOUSE.fieldNames() if n.startswith("twenty_four_")], LABEL,
)

# Digit prefixes of the feeds and the words the warehouse uses for them.
PREFIX_WORDS = (("24hr_", "twenty_four_hr_"), ("4day_", "four_day_"), ("2hr_", "two_hr_"))
RENAMED = {"RH%_realtime": "humidity_realtime", "trafficCongestion": LABEL}


def to_warehouse_name(name: str) -> str:
    """Feed column name as the warehouse spells it."""
    if name in RENAMED:
        return RENAMED[name]
    for short, word in PREFIX_WORDS:
        if name.startswith(short):
            return word + name[len(short):]
    return name


def to_feed_name(name: str) -> str:
    """Inverse of :func:`to_warehouse_name` as the reports show it."""
    if name == LABEL:
        return "trafficCongestion"
    for short, word in PREFIX_WORDS:
        if name.startswith(word):
            return short + name[len(word):]
    return name


def captured_name(name: str) -> str:
    """``3_first(x)`` to ``x_3``: a pivot column named after value and aggregate."""
    m = re.fullmatch(r"(\w+?)_\w+\((\w+)\)", name)
    return f"{m.group(2)}_{m.group(1)}" if m else name


def strip_suffix(name: str) -> str:
    """``dir_start_3`` to ``dir_start``."""
    return re.sub(r"_\d+$", "", name)


# Payload schemas (one JSON document per file).
_LOC = _struct([("latitude", _D), ("longitude", _D)])
_SPAN = _struct([("start", _S), ("end", _S)])
_RANGE = _struct([("low", _D), ("high", _D)])
_WIND = _struct([("speed", _RANGE), ("direction", _S)])


def _items(fields) -> tuple[str, T.DataType]:
    return "items", T.ArrayType(_struct(fields))


PAYLOAD_READINGS = _struct([
    _items([("timestamp", _S),
            ("readings", T.ArrayType(_struct([("station_id", _S), ("value", _D)])))]),
    ("metadata", _struct([("stations", T.ArrayType(_struct([
        ("id", _S), ("name", _S), ("location", _LOC)])))])),
])
PAYLOAD_2HR = _struct([
    _items([("valid_period", _SPAN),
            ("forecasts", T.ArrayType(_struct([("area", _S), ("forecast", _S)])))]),
    ("area_metadata", T.ArrayType(_struct([("name", _S), ("label_location", _LOC)]))),
])
PAYLOAD_24HR = _struct([
    _items([("valid_period", _SPAN),
            ("general", _struct([("forecast", _S), ("relative_humidity", _RANGE),
                                 ("temperature", _RANGE), ("wind", _WIND)])),
            ("periods", T.ArrayType(_struct([
                ("time", _SPAN), ("regions", T.MapType(_S, _S))])))]),
])
PAYLOAD_4DAY = _struct([
    _items([("update_timestamp", _S),
            ("forecasts", T.ArrayType(_struct([
                ("timestamp", _S), ("date", _S), ("forecast", _S), ("temperature", _RANGE),
                ("relative_humidity", _RANGE), ("wind", _WIND)])))]),
])
PAYLOAD_ROUTE = _struct([
    ("resourceSets", T.ArrayType(_struct([("resources", T.ArrayType(_struct([
        ("trafficCongestion", _S), ("travelDistance", _D), ("travelDuration", _D),
        ("travelDurationTraffic", _D), ("distanceUnit", _S), ("durationUnit", _S)])))]))),
])
PAYLOAD_CAMERAS = _struct([
    ("api_info", _struct([("status", _S)])),
    _items([("timestamp", _S), ("cameras", T.ArrayType(_struct([
        ("camera_id", _S), ("image", _S), ("location", _LOC)])))]),
])

"""Payloads to feed rows. Input: ``(call_timestamp, payload)``, one row per payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions.points import parse_point, point_text
from feedloom.functions.timetext import canonical
from feedloom.operators.joins import accumulate, outer_merge
from feedloom.operators.reshape import paired_unpivot, prefix
from feedloom.schemas import TS
from feedloom.sources.payloads import flatten


def _items(payloads: DataFrame, *more) -> DataFrame:
    """A row per item of a payload; a payload over a period holds several. One without an item
    keeps a row, its metadata may still tell of stations."""
    return payloads.select(TS, *more, F.explode_outer("payload.items").alias("item"))


def _loc(c):
    return point_text(c["latitude"], c["longitude"])


# Readings beside the stations of the same document, then stations without a reading.
_BESIDE = """inline(concat(
  flatten(transform(readings, r -> if(exists(stations, s -> s.id = r.station_id),
    transform(filter(stations, s -> s.id = r.station_id),
              s -> named_struct('station_id', r.station_id, 'value', r.value, 'station', s)),
    array(named_struct('station_id', r.station_id, 'value', r.value, 'station', nothing))))),
  transform(filter(stations, s -> NOT exists(readings, r -> r.station_id = s.id)),
            s -> named_struct('station_id', s.id, 'value', CAST(NULL AS DOUBLE), 'station', s))))
"""


def readings(payloads: DataFrame, kind: str) -> DataFrame:
    """Values of one reading kind beside their stations; neither side drops a row.

    Both sides sit in the same document, so the outer join stays inside the row.
    """
    item = _items(payloads, F.col("payload.metadata.stations").alias("stations"))
    both = item.select(
        TS, canonical(F.col("item.timestamp")).alias("timestamp"),
        F.coalesce("item.readings", F.array()).alias("readings"),
        F.coalesce("stations", F.array()).alias("stations"),
    ).withColumn("nothing", F.lit(None).cast(_station_type()))
    rows = both.selectExpr(TS, "timestamp", _BESIDE)
    located = F.when(F.col("station").isNotNull(), _loc(F.col("station.location")))
    return rows.select(
        "timestamp", "station_id", located.alias("station_loc"),
        F.col("station.name").alias("station_name"), F.col("value").alias(f"{kind}_realtime"), TS)


def _station_type():
    return S.PAYLOAD_READINGS["metadata"].dataType["stations"].dataType.elementType


def rainfall(payloads: DataFrame) -> DataFrame:
    return readings(payloads, "rainfall").select(*S.RAINFALL.fieldNames())


def non_rainfall(by_kind: dict[str, DataFrame]) -> DataFrame:
    """Rows for stations that every kind saw at the same reading time."""
    kinds = [k for k in S.READING_KINDS if k != "rainfall"]
    frames = [readings(by_kind[k], k) for k in kinds]
    joined = accumulate(frames, [TS, "timestamp", "station_id"])
    return joined.select(*[f"`{c}`" for c in S.NON_RAINFALL.fieldNames()])


def forecast_2hr(payloads: DataFrame) -> DataFrame:
    """Forecast per area; an area needs both a forecast and a location."""
    base = _items(payloads, F.col("payload.area_metadata").alias("area_metadata")).select(
        TS, canonical(F.col("item.valid_period.start")).alias("2hr_start"),
        canonical(F.col("item.valid_period.end")).alias("2hr_end"),
        F.explode("item.forecasts").alias("f"), "area_metadata")
    pairs = base.select("*", F.explode(F.filter(
        "area_metadata", lambda a: a["name"] == F.col("f.area"))).alias("a"))
    return pairs.select(
        F.col("f.area").alias("2hr_forecast_area"),
        _loc(F.col("a.label_location")).alias("2hr_forecast_area_loc"),
        F.col("f.forecast").alias("2hr_forecast_value"), "2hr_start", "2hr_end", TS)


def _general(item) -> list:
    """Measures and texts that the day forecasts share, in feed order."""
    g = item
    out = [g["forecast"].alias("forecast")]
    for m, field in (("relative_humidity", g["relative_humidity"]),
                     ("temperature", g["temperature"]), ("wind_speed", g["wind"]["speed"])):
        out += [field["low"].alias(f"{m}_low"), field["high"].alias(f"{m}_high")]
    return [*out, g["wind"]["direction"].alias("wind_direction")]


def forecast_24hr(payloads: DataFrame) -> DataFrame:
    """One row per item: the general block and three periods with five regions."""
    item = _items(payloads)
    general = [c.alias(n) for c, n in zip(
        _general(F.col("item.general")),
        [n for n in S.FORECAST_24HR.fieldNames() if n.startswith("24hr_general_")])]
    periods = []
    for p in S.PERIODS:
        period = F.try_element_at(F.col("item.periods"), F.lit(p))
        periods += [canonical(period["time"][x]).alias(f"24hr_period_{p}_{x}")
                    for x in ("start", "end")]
        periods += [F.try_element_at(period["regions"], F.lit(r)).alias(
            f"24hr_period_{p}_forecast_{r}") for r in S.REGIONS]
    valid = [canonical(F.col(f"item.valid_period.{x}")).alias(f"24hr_{x}")
             for x in ("start", "end")]
    return item.select(*valid, *general, *periods, TS)


def periods_long(payloads: DataFrame) -> DataFrame:
    """Every period and region of a 24-hour payload as a row, however many there are."""
    period = _items(payloads).select(TS, F.posexplode("item.periods").alias("pos", "p"))
    # Times are worked out once per period, before its regions become rows.
    timed = period.select(
        TS, (F.col("pos") + 1).alias("period"), canonical(F.col("p.time.start")).alias("start"),
        canonical(F.col("p.time.end")).alias("end"), F.col("p.regions").alias("regions"))
    return timed.select(TS, "period", "start", "end",
                        F.explode("regions").alias("region", "forecast"))


def forecast_4day(payloads: DataFrame) -> DataFrame:
    """One row per forecast day; nested fields flattened, the day's own stamp dropped."""
    day = _items(payloads).select(
        TS, canonical(F.col("item.update_timestamp")).alias("4day_update_timestamp"),
        F.explode("item.forecasts").alias("f"))
    flat = prefix(flatten(day, "f"), "4day_", keep=(TS, "4day_update_timestamp"))
    return (flat.withColumn("4day_date", canonical("4day_date"))
            .select(*S.FORECAST_4DAY.fieldNames()))


def route_fields(payloads: DataFrame) -> DataFrame:
    """First resource of a route payload; an absent level or field gives NULL.

    Input also holds ``camera_id`` and ``direction``.
    """
    first_set = F.try_element_at(F.col("payload.resourceSets"), F.lit(1))
    resource = F.try_element_at(first_set["resources"], F.lit(1))
    fields = ("trafficCongestion", "travelDistance", "travelDuration",
              "travelDurationTraffic", "distanceUnit", "durationUnit")
    return payloads.select("camera_id", "direction",
                           *[resource[f].alias(f) for f in fields], TS)


def congestion(payloads: DataFrame, routes: DataFrame) -> DataFrame:
    """Route fields beside the route table; neither side drops a row."""
    merged = outer_merge(route_fields(payloads), routes, ["camera_id", "direction"])
    return merged.select(*S.CONGESTION.fieldNames())


def cameras(payloads: DataFrame) -> DataFrame:
    cam = _items(payloads).select(F.explode("item.cameras").alias("c"))
    return cam.select(F.col("c.camera_id").cast("long").alias("cam_id"),
                      F.col("c.location.latitude").alias("lat"),
                      F.col("c.location.longitude").alias("lon"))


def route_table(seed: DataFrame, slots=range(1, 6)) -> DataFrame:
    """Camera seed with up to five direction pairs to one row per complete pair."""
    long = paired_unpivot(seed, ["camera_id", "cam_loc", "remarks"],
                          ["dir_start", "dir_finish"], slots)
    points = {c: _point_text(c) for c in ("cam_loc", "dir_start", "dir_finish")}
    return long.withColumns(points).select(*S.ROUTES.fieldNames()) \
        .orderBy("camera_id", "direction")


def _point_text(c: str):
    p = parse_point(c)
    return point_text(p["lat"], p["lon"])

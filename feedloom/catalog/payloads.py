"""Payload tabulation on JSON documents that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog.base import READINGS, label_of, query, readings, table
from feedloom.functions import timetext
from feedloom.operators import reshape as R
from feedloom.plans import tabulate as T
from feedloom.sources.images import image_name, parse_names
from feedloom.sources.payloads import flatten, parse_payloads


def _documents(df, body, schema, *keep):
    """One JSON text per row, parsed again."""
    text = df.select(F.col("canon").alias(S.TS), *keep, F.to_json(body).alias("text"))
    return parse_payloads(text, "text", schema)


def _s(**fields):
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _iso(c):
    """Canonical text as the ISO text a payload carries."""
    return F.concat(F.substring(c, 1, 13), F.lit(":"), F.substring(c, 14, 2), F.lit(":"),
                    F.substring(c, 16, 2), F.lit("+08:00"))


@query("json_flatten", f"""WITH {READINGS} SELECT event_id, k AS props_k, event_type AS props_meta_type,
  cents AS props_meta_deep_cents FROM ev""")
def json_flatten(spark, sf):
    ev = readings(spark, sf)
    schema = "struct<k:bigint,meta:struct<type:string,deep:struct<cents:bigint>>>"
    body = _s(k=F.col("k"), meta=_s(type=F.col("event_type"), deep=_s(cents=F.col("cents"))))
    doc = ev.select("event_id", F.from_json(F.to_json(body), schema).alias("props"))
    return flatten(doc, "props", "props_")


def _reading_documents(ev, value, time=None, key="user_id"):
    """A reading of station ``u<key>``, and a station ``x<key>`` without one."""
    station = F.concat(F.lit("u"), F.col(key).cast("string"))
    extra = F.concat(F.lit("x"), F.col(key).cast("string"))
    loc = _s(latitude=F.col("k") / 8, longitude=F.col("user_id") / 4)
    body = _s(
        items=F.array(_s(timestamp=_iso(F.col("canon")) if time is None else time,
                         readings=F.array(_s(station_id=station, value=value.cast("double"))))),
        metadata=_s(stations=F.array(_s(id=station, name=F.col("event_type"), location=loc),
                                     _s(id=extra, name=F.lit("spare"), location=loc))))
    return _documents(ev, body, S.PAYLOAD_READINGS)


@query("payload_rainfall", f"""WITH {READINGS}, l AS (SELECT *, '(' || CAST(k / 8 AS DOUBLE) || ', '
  || CAST(user_id / 4 AS DOUBLE) || ')' AS loc FROM ev)
SELECT canon AS timestamp, 'u' || event_id AS station_id, loc AS station_loc,
  event_type AS station_name, CAST(cents AS DOUBLE) AS rainfall_realtime, canon AS call_timestamp FROM l
UNION ALL SELECT canon, 'x' || event_id, loc, 'spare', NULL, canon FROM l""")
def payload_rainfall(spark, sf):
    return T.rainfall(_reading_documents(readings(spark, sf), F.col("cents"), key="event_id"))


_NR = ("air_temp", "RH%", "wind_dir", "wind_speed")


@query("payload_non_rainfall", f"""WITH {READINGS}, m AS (
  SELECT canon, user_id, max(k) AS k, max(cents) AS cents, max(event_type) AS event_type FROM ev GROUP BY ALL)
SELECT canon AS timestamp, 'u' || user_id AS station_id,
  '(' || CAST(k / 8 AS DOUBLE) || ', ' || CAST(user_id / 4 AS DOUBLE) || ')' AS station_loc,
  event_type AS station_name, CAST(cents * 4 AS DOUBLE) AS wind_speed_realtime,
  CAST(cents * 3 AS DOUBLE) AS wind_dir_realtime, CAST(cents * 2 AS DOUBLE) AS "RH%_realtime",
  CAST(cents AS DOUBLE) AS air_temp_realtime, canon AS call_timestamp FROM m WHERE k % 5 <> 0
UNION ALL SELECT canon, 'x' || user_id, '(' || CAST(k / 8 AS DOUBLE) || ', ' || CAST(user_id / 4 AS DOUBLE) || ')',
  'spare', NULL, NULL, NULL, NULL, canon FROM m WHERE k % 5 <> 0""")
def payload_non_rainfall(spark, sf):
    ev = readings(spark, sf).groupBy("canon", "user_id").agg(
        F.max("k").alias("k"), F.max("cents").alias("cents"),
        F.max("event_type").alias("event_type"))
    late = F.when(F.col("k") % 5 == 0, "2000-01-01T00:00:00+08:00").otherwise(
        _iso(F.col("canon")))
    kinds = {kind: _reading_documents(ev, F.col("cents") * (i + 1),
                                      late if kind == "wind_dir" else None)
             for i, kind in enumerate(_NR)}
    return T.non_rainfall(kinds)


@query("payload_2hr", f"""WITH {READINGS} SELECT 'A' || event_id AS "2hr_forecast_area",
  '(' || CAST(k / 8 AS DOUBLE) || ', ' || CAST(user_id / 4 AS DOUBLE) || ')' AS "2hr_forecast_area_loc",
  event_type AS "2hr_forecast_value", canon AS "2hr_start", call_timestamp AS "2hr_end",
  canon AS call_timestamp FROM ev""")
def payload_2hr(spark, sf):
    area = F.concat(F.lit("A"), F.col("event_id").cast("string"))
    body = _s(
        items=F.array(_s(
            valid_period=_s(start=_iso(F.col("canon")), end=_iso(F.col("call_timestamp"))),
            forecasts=F.array(_s(area=area, forecast=F.col("event_type")),
                              _s(area=F.lit("no such area"), forecast=F.lit("none"))))),
        area_metadata=F.array(_s(name=area, label_location=_s(
            latitude=F.col("k") / 8, longitude=F.col("user_id") / 4))))
    return T.forecast_2hr(_documents(readings(spark, sf), body, S.PAYLOAD_2HR))


def _general(k):
    span = lambda n: _s(low=(k + n).cast("double"), high=(k + 2 * n).cast("double"))
    return dict(forecast=F.col("event_type"), relative_humidity=span(1), temperature=span(2),
                wind=_s(speed=span(3), direction=F.concat(F.lit("d"), k.cast("string"))))


_GENERAL_SQL = ", ".join(
    f'CAST(k + {n} AS DOUBLE) AS "{{p}}{m}_low", CAST(k + {2 * n} AS DOUBLE) AS "{{p}}{m}_high"'
    for n, m in ((1, "relative_humidity"), (2, "temperature"), (3, "wind_speed")))


def _periods(k, n: int):
    regions = lambda p: F.create_map(*[
        x for r in S.REGIONS for x in (F.lit(r), F.concat(F.lit(f"{r}{p}-"), k.cast("string")))])
    return F.array(*[_s(time=_s(start=_iso(F.col("canon")), end=_iso(F.col("call_timestamp"))),
                        regions=regions(p)) for p in range(1, n + 1)])


def _day_documents(ev):
    k = F.col("k")
    item = _s(valid_period=_s(start=_iso(F.col("canon")), end=_iso(F.col("call_timestamp"))),
              general=_s(**_general(k)),
              periods=F.when(k % 2 == 0, _periods(k, 4)).otherwise(_periods(k, 3)))
    return _documents(ev, _s(items=F.array(item)), S.PAYLOAD_24HR)


@query("payload_24hr", f"""WITH {READINGS} SELECT canon AS "24hr_start", call_timestamp AS "24hr_end",
  event_type AS "24hr_general_forecast", {_GENERAL_SQL.format(p="24hr_general_")},
  'd' || k AS "24hr_general_wind_direction", """ + ", ".join(
    f"""canon AS "24hr_period_{p}_start", call_timestamp AS "24hr_period_{p}_end", """ + ", ".join(
        f"""'{r}{p}-' || k AS "24hr_period_{p}_forecast_{r}\"""" for r in S.REGIONS)
    for p in S.PERIODS) + ", canon AS call_timestamp FROM ev")
def payload_24hr(spark, sf):
    return T.forecast_24hr(_day_documents(readings(spark, sf)))


@query("payload_24hr_long", f"WITH {READINGS} " + " UNION ALL ".join(
    f"""SELECT canon AS call_timestamp, {p} AS period, canon AS start, call_timestamp AS "end",
  '{r}' AS region, '{r}{p}-' || k AS forecast FROM ev {'WHERE k % 2 = 0' if p == 4 else ''}"""
    for p in (1, 2, 3, 4) for r in S.REGIONS))
def payload_24hr_long(spark, sf):
    return T.periods_long(_day_documents(readings(spark, sf)))


@query("payload_4day", f"WITH {READINGS} " + " UNION ALL ".join(
    f"""SELECT substr(canon, 1, 10) || 'T000000' AS "4day_date", event_type AS "4day_forecast",
  {_GENERAL_SQL.format(p="4day_").replace("k +", f"k + {i} +")}, 'd' || (k + {i}) AS "4day_wind_direction",
  call_timestamp AS "4day_update_timestamp", canon AS call_timestamp FROM ev""" for i in (0, 1)))
def payload_4day(spark, sf):
    day = F.substring("canon", 1, 10)
    days = [_s(timestamp=_iso(F.col("canon")), date=day, **_general(F.col("k") + i))
            for i in (0, 1)]
    item = _s(update_timestamp=_iso(F.col("call_timestamp")), forecasts=F.array(*days))
    docs = _documents(readings(spark, sf), _s(items=F.array(item)), S.PAYLOAD_4DAY)
    return T.forecast_4day(docs)


@query("payload_congestion", f"""WITH {READINGS}, c AS (SELECT event_id AS camera_id, user_id % 2 + 1 AS direction,
  CASE WHEN k % 10 = 0 THEN NULL WHEN k % 4 = 0 THEN 'None' WHEN k % 4 = 1 THEN 'Mild'
    WHEN k % 4 = 2 THEN 'Medium' ELSE 'Heavy' END AS "trafficCongestion",
  CAST(cents AS DOUBLE) AS "travelDistance", canon AS call_timestamp, k FROM ev),
r AS (SELECT c_custkey AS camera_id, c_custkey % 3 + 1 AS direction, c_name AS remarks FROM customer)
SELECT camera_id, direction, CASE WHEN k % 6 <> 0 THEN "trafficCongestion" END AS "trafficCongestion",
  CASE WHEN k % 6 <> 0 THEN "travelDistance" END AS "travelDistance", call_timestamp, remarks
FROM c FULL JOIN r USING (camera_id, direction)""")
def payload_congestion(spark, sf):
    k = F.col("k")
    resource = _s(trafficCongestion=label_of(k), travelDistance=F.col("cents").cast("double"))
    sets = F.array(_s(resources=F.when(k % 6 != 0, F.array(resource))))
    ev = readings(spark, sf).withColumns({
        "camera_id": F.col("event_id"), "direction": F.col("user_id") % 2 + 1})
    docs = _documents(ev, _s(resourceSets=sets), S.PAYLOAD_ROUTE, "camera_id", "direction")
    key = F.col("c_custkey")
    text = F.lit(None).cast("string")
    routes = table(spark, sf, "customer").select(
        key.alias("camera_id"), (key % 3 + 1).alias("direction"), text.alias("cam_loc"),
        F.col("c_name").alias("remarks"), text.alias("dir_start"), text.alias("dir_finish"))
    return T.congestion(docs, routes).select(
        "camera_id", "direction", "trafficCongestion", "travelDistance", S.TS, "remarks")


@query("payload_cameras", """SELECT c_custkey AS cam_id, c_acctbal AS lat,
  CAST(c_nationkey AS DOUBLE) AS lon FROM customer""")
def payload_cameras(spark, sf):
    camera = _s(camera_id=F.col("c_custkey").cast("string"), image=F.col("c_name"),
                location=_s(latitude=F.col("c_acctbal"),
                            longitude=F.col("c_nationkey").cast("double")))
    body = _s(api_info=_s(status=F.lit("healthy")),
              items=F.array(_s(timestamp=F.lit("2024-01-01T00:00:00"), cameras=F.array(camera))))
    docs = table(spark, sf, "customer").withColumn("canon", F.lit("2024-01-01T000000"))
    return T.cameras(_documents(docs, body, S.PAYLOAD_CAMERAS))


@query("image_catalog", f"""WITH {READINGS} SELECT event_id, canon AS call_timestamp, user_id AS cam_id,
  canon || '_' || user_id || '.jpg' AS file_name, canon || '.zip' AS archive_name
FROM ev WHERE event_type <> 'error'""")
def image_catalog(spark, sf):
    name = F.when(F.col("event_type") == "error", F.lit("notes.txt")).otherwise(
        image_name("canon", "user_id"))
    files = readings(spark, sf).select(
        "event_id", F.concat(F.lit("/landing/images/"), name).alias("path"))
    return parse_names(files).drop("path")


@query("melt_flattened", f"""WITH {READINGS} SELECT event_id, 'props_k' AS field, k AS amount FROM ev
UNION ALL SELECT event_id, 'props_cents', cents FROM ev""")
def melt_flattened(spark, sf):
    doc = readings(spark, sf).select("event_id", F.from_json(
        F.to_json(F.struct("k", "cents")), "struct<k:bigint,cents:bigint>").alias("props"))
    return R.melt(flatten(doc, "props", "props_"), ["event_id"], ["props_k", "props_cents"],
                  name="field", value="amount")


@query("previous_day", f"""WITH {READINGS} SELECT event_id, strftime(
  CAST(substr(canon, 1, 10) AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS previous FROM ev""")
def previous_day(spark, sf):
    return readings(spark, sf).select(
        "event_id", F.date_sub(timetext.day("canon"), 1).cast("string").alias("previous"))

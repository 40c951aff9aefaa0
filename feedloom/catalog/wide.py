"""The wide table over feeds that Spark derives from events, customers and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog.base import LABEL_SQL, READINGS, label_of, query, readings, table
from feedloom.operators import align
from feedloom.plans import closed_days, reports
from feedloom.plans import feeds as N
from feedloom.plans.wide_table import Feeds, build_wide_table, complete_snapshots
from feedloom.session import cut_lineage, scratch_dir
from feedloom.sinks import versions

AS_OF = "2024-01-15"


def _text(head: str, c):
    return F.concat(F.lit(head), c.cast("string"))


def rainfall_feed(ev):
    u = F.col("user_id")
    return ev.filter("event_type = 'view'").select(
        F.col("canon").alias("timestamp"), _text("R", u % 10).alias("station_id"),
        F.lit("(1.0, 2.0)").alias("station_loc"), F.lit("name").alias("station_name"),
        F.col("cents").cast("double").alias("rainfall_realtime"), S.TS)


def non_rainfall_feed(ev):
    u = F.col("user_id")
    return ev.filter("event_type = 'click'").select(
        F.col("canon").alias("timestamp"), _text("N", u % 3).alias("station_id"),
        F.lit("(1.0, 2.0)").alias("station_loc"), F.lit("name").alias("station_name"),
        F.col("cents").cast("double").alias("wind_speed_realtime"),
        F.col("k").cast("double").alias("wind_dir_realtime"),
        (F.col("event_id") % 101).cast("double").alias("RH%_realtime"),
        u.cast("double").alias("air_temp_realtime"), S.TS)


def forecast_2hr_feed(ev):
    return ev.filter("event_type = 'signup'").select(
        _text("A", F.col("user_id") % 5).alias("2hr_forecast_area"),
        F.lit("(1.0, 2.0)").alias("2hr_forecast_area_loc"),
        _text("F", F.col("k") % 40).alias("2hr_forecast_value"),
        F.col("canon").alias("2hr_start"), F.col("canon").alias("2hr_end"), S.TS)


def forecast_24hr_feed(ev):
    k = F.col("k")
    measures = [n for n in S.FORECAST_24HR.fieldNames() if n.endswith(("_low", "_high"))]
    return ev.filter("event_type = 'error'").select(
        F.col("canon").alias("24hr_start"), F.col(S.TS).alias("24hr_end"),
        _text("G", k).alias("24hr_general_forecast"),
        *[(k + i).cast("double").alias(m) for i, m in enumerate(measures)],
        _text("D", k % 8).alias("24hr_general_wind_direction"),
        *[c for p in S.PERIODS for c in (
            F.col("canon").alias(f"24hr_period_{p}_start"),
            F.col(S.TS).alias(f"24hr_period_{p}_end"),
            *[_text(f"{r}{p}-", k).alias(f"24hr_period_{p}_forecast_{r}") for r in S.REGIONS])],
        S.TS)


def forecast_4day_feed(ev):
    k, c = F.col("k"), F.col("cents")
    day = F.date_add(F.substring("canon", 1, 10).cast("date"), (k % 9).cast("int"))
    measures = [n for n in S.FORECAST_4DAY.fieldNames() if n.endswith(("_low", "_high"))]
    return ev.filter("event_type = 'purchase'").select(
        F.concat(day.cast("string"), F.lit("T000000")).alias("4day_date"),
        _text("W", F.col("event_id")).alias("4day_forecast"),
        *[(c + i).cast("double").alias(m) for i, m in enumerate(measures)],
        _text("D", k % 8).alias("4day_wind_direction"),
        F.concat(F.substring(S.TS, 1, 13), F.lit("0"), (k % 2).cast("string"),
                 F.lit("00")).alias("4day_update_timestamp"), S.TS)


def congestion_feed(ev):
    return ev.select(
        (F.lit(1000) + F.col("user_id") % 20).alias("camera_id"),
        (F.col("event_id") % 3 + 1).alias("direction"),
        label_of(F.col("k")).alias("trafficCongestion"), S.TS)


def dims(spark, sf):
    key = F.col("c_custkey")
    routes = table(spark, sf, "customer").select(
        (F.lit(1000) + key % 25).alias("camera_id"),
        (F.col("c_nationkey") % 3 + 1).cast("long").alias("direction"))
    s = F.col("s_suppkey")
    regions = F.array(*[F.lit(r) for r in S.REGIONS])
    cams = table(spark, sf, "supplier").select(
        (F.lit(1000) + s).alias("cam_id"), _text("N", s % 4).alias("not_rainfall"),
        _text("R", s % 12).alias("rainfall"), _text("A", s % 6).alias("region"),
        F.element_at(regions, (F.col("s_nationkey") % 5 + 1).cast("int")).alias("compass"))
    return routes, cams


def feeds(spark, sf) -> Feeds:
    ev = readings(spark, sf)
    routes, cams = dims(spark, sf)
    return Feeds(rainfall_feed(ev), non_rainfall_feed(ev), forecast_2hr_feed(ev),
                 forecast_24hr_feed(ev), forecast_4day_feed(ev), congestion_feed(ev),
                 routes, cams)


# SQL of the same table, written from the meaning of each column.
_M24 = ("relative_humidity_low", "relative_humidity_high", "temperature_low",
        "temperature_high", "wind_speed_low", "wind_speed_high")
_M4 = ("temperature_low", "temperature_high", "relative_humidity_low",
       "relative_humidity_high", "wind_speed_low", "wind_speed_high")
_FOUR = ", ".join(
    [f"max(CASE WHEN rn = {d} THEN CAST(cents + {i} AS INTEGER) END) AS four_day_{m}_{d}"
     for d in S.DAYS for i, m in enumerate(_M4)]
    + [f"max(CASE WHEN rn = {d} THEN 'W' || event_id END) AS four_day_forecast_{d}, "
       f"max(CASE WHEN rn = {d} THEN 'D' || (k % 8) END) AS four_day_wind_direction_{d}"
       for d in S.DAYS])
# Of a day that landed again the last row counts; without a landing order values decide.
_FOUR_LAST = "'W' || event_id DESC"
_REGION_SQL = "['west', 'east', 'central', 'south', 'north']"

WIDE_CTES = f"""{READINGS},
complete AS (SELECT call_timestamp FROM ev GROUP BY call_timestamp
             HAVING count(DISTINCT event_type) = 5),
rain AS (SELECT call_timestamp, 'R' || (user_id % 10) AS rainfall_station_id,
  max(CAST(cents AS DOUBLE)) AS rainfall_realtime FROM ev WHERE event_type = 'view' GROUP BY ALL),
nonrain AS (SELECT call_timestamp, 'N' || (user_id % 3) AS non_rainfall_station_id,
  CAST(cents AS DOUBLE) AS wind_speed_realtime, CAST(k AS DOUBLE) AS wind_dir_realtime,
  CAST(event_id % 101 AS DOUBLE) AS humidity_realtime, CAST(user_id AS DOUBLE) AS air_temp_realtime
  FROM ev WHERE event_type = 'click' QUALIFY row_number() OVER (
    PARTITION BY call_timestamp, user_id % 3
    ORDER BY cents DESC, k DESC, event_id % 101 DESC, user_id DESC) = 1),
two AS (SELECT call_timestamp, 'A' || (user_id % 5) AS two_hr_forecast_area,
  max('F' || (k % 40)) AS two_hr_forecast_value FROM ev WHERE event_type = 'signup' GROUP BY ALL),
day1 AS (SELECT call_timestamp, canon AS twenty_four_hr_start, call_timestamp AS twenty_four_hr_end,
  'G' || k AS twenty_four_hr_general_forecast, {", ".join(
    f"CAST(k + {i} AS INTEGER) AS twenty_four_hr_general_{m}" for i, m in enumerate(_M24))},
  'D' || (k % 8) AS twenty_four_hr_general_wind_direction, {", ".join(
    f"canon AS twenty_four_hr_period_{p}_start, call_timestamp AS twenty_four_hr_period_{p}_end"
    for p in S.PERIODS)}, k
  FROM ev WHERE event_type = 'error' QUALIFY row_number() OVER (
    PARTITION BY call_timestamp ORDER BY canon DESC, 'G' || k DESC) = 1),
day AS (SELECT * EXCLUDE (k), {", ".join(
    f"compass || '{p}-' || k AS twenty_four_hr_period_{p}" for p in S.PERIODS)}
  FROM day1, (SELECT unnest({_REGION_SQL}) AS compass)),
four0 AS (SELECT *, CAST(canon[1:10] AS DATE) + CAST(k % 9 AS INTEGER) AS d, k % 2 AS upd
  FROM ev WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY call_timestamp, upd, d ORDER BY {_FOUR_LAST}) = 1),
four1 AS (SELECT *, row_number() OVER (PARTITION BY call_timestamp
    ORDER BY d, 'W' || event_id) AS rn FROM (
  SELECT *, max(upd) OVER (PARTITION BY call_timestamp) AS last FROM four0) WHERE upd = last),
four AS (SELECT call_timestamp, {_FOUR} FROM four1 GROUP BY call_timestamp),
label AS (SELECT call_timestamp, 1000 + user_id % 20 AS cam_id, event_id % 3 + 1 AS direction,
  max({LABEL_SQL}) AS trafficcongestion FROM ev GROUP BY ALL),
routes AS (SELECT DISTINCT 1000 + c_custkey % 25 AS cam_id,
  CAST(c_nationkey % 3 + 1 AS BIGINT) AS direction FROM customer),
cams AS (SELECT 1000 + s_suppkey AS cam_id, 'N' || (s_suppkey % 4) AS non_rainfall_station_id,
  'R' || (s_suppkey % 12) AS rainfall_station_id, 'A' || (s_suppkey % 6) AS two_hr_forecast_area,
  {_REGION_SQL}[CAST(s_nationkey % 5 + 1 AS INTEGER)] AS compass FROM supplier),
wide AS (SELECT {", ".join(
    f"CAST({n} AS INTEGER) AS {n}" if n in ("cam_id", "direction") else n
    for n in S.WAREHOUSE.fieldNames())}
  FROM (SELECT call_timestamp FROM complete) JOIN label USING (call_timestamp)
  JOIN routes USING (cam_id, direction) JOIN cams USING (cam_id)
  LEFT JOIN rain USING (call_timestamp, rainfall_station_id)
  LEFT JOIN nonrain USING (call_timestamp, non_rainfall_station_id)
  LEFT JOIN two USING (call_timestamp, two_hr_forecast_area)
  JOIN four USING (call_timestamp) JOIN day USING (call_timestamp, compass))"""


@query("wide_table", f"WITH {WIDE_CTES} SELECT * FROM wide")
def wide_table(spark, sf):
    return build_wide_table(feeds(spark, sf))


@query("wide_table_today", f"""WITH {WIDE_CTES} SELECT * FROM wide
WHERE substr(call_timestamp, 1, 10) = '{AS_OF}'""")
def wide_table_today(spark, sf):
    return build_wide_table(feeds(spark, sf), "today", AS_OF)


@query("wide_table_latest", f"""WITH {WIDE_CTES} SELECT * FROM wide
WHERE call_timestamp = (SELECT max(call_timestamp) FROM complete)""")
def wide_table_latest(spark, sf):
    return build_wide_table(feeds(spark, sf), "latest")


@query("complete_snapshots", f"WITH {WIDE_CTES} SELECT * FROM complete")
def complete_snapshots_query(spark, sf):
    return complete_snapshots(feeds(spark, sf))


@query("camera_directions", f"WITH {WIDE_CTES} SELECT * FROM cams JOIN routes USING (cam_id)")
def camera_directions(spark, sf):
    routes, cams = dims(spark, sf)
    return N.camera_map(cams).join(N.route_keys(routes), "cam_id")


@query("missing_rows", f"""WITH {WIDE_CTES} SELECT call_timestamp, cam_id, direction
FROM complete, (SELECT cam_id, direction FROM cams JOIN routes USING (cam_id))
EXCEPT SELECT call_timestamp, cam_id, direction FROM label""")
def missing_rows(spark, sf):
    """Cameras and directions without a congestion record in a complete snapshot."""
    f = feeds(spark, sf)
    members = f.camera_map.select("cam_id").join(N.route_keys(f.routes), "cam_id")
    have = N.congestion(f.congestion, unique=False).select(S.TS, "cam_id", "direction")
    return align.missing_members(have, members, complete_snapshots(f))


def _feed_query(name: str, cte: str, how):
    @query(name, f"WITH {WIDE_CTES} SELECT * FROM {cte}")
    def run(spark, sf):
        return how(readings(spark, sf))


_feed_query("feed_rainfall", "rain", lambda ev: N.rainfall(rainfall_feed(ev)))
_feed_query("feed_non_rainfall", "nonrain", lambda ev: N.non_rainfall(non_rainfall_feed(ev)))
_feed_query("feed_forecast_2hr", "two", lambda ev: N.forecast_2hr(forecast_2hr_feed(ev)))


def _as_int(df, words):
    return df.select(*[F.col(c).cast("int").alias(c) if any(w in c for w in words) else F.col(c)
                       for c in df.columns])


_feed_query("feed_forecast_24hr", "day", lambda ev: _as_int(
    N.forecast_24hr(forecast_24hr_feed(ev)), ("_low", "_high")))
_feed_query("feed_forecast_4day", "four", lambda ev: _as_int(
    N.forecast_4day(forecast_4day_feed(ev)), ("_low_", "_high_")))
_feed_query("feed_congestion", "label", lambda ev: N.congestion(congestion_feed(ev)))


def _landed_twice(feed, value: str, corrected):
    """A feed whose rows of every third day landed again in a later batch with another value."""
    again = feed.filter(F.substring(S.TS, 10, 1).cast("int") % 3 == 0)
    again = again.withColumn(value, corrected)
    return feed.withColumn("batch", F.lit(0)).unionByName(again.withColumn("batch", F.lit(1)))


@query("keep_last_landed", f"""WITH {READINGS}, r AS (SELECT call_timestamp,
  1000 + user_id % 20 AS cam_id, event_id % 3 + 1 AS direction,
  CASE WHEN CAST(call_timestamp[10:10] AS INTEGER) % 3 = 0 THEN 'Heavy' ELSE {LABEL_SQL} END
    AS label FROM ev)
SELECT call_timestamp, cam_id, direction, max(label) AS trafficcongestion FROM r GROUP BY ALL""")
def keep_last_landed(spark, sf):
    """The last landed row counts, though its value sorts before the first one."""
    feed = congestion_feed(readings(spark, sf))
    return N.congestion(_landed_twice(feed, "trafficCongestion", F.lit("Heavy")))


@query("forecast_4day_landed", f"""WITH {WIDE_CTES}, c AS (SELECT * FROM four)
SELECT call_timestamp, four_day_forecast_1 IS NOT NULL AS d1, four_day_forecast_2 IS NOT NULL AS d2,
  four_day_forecast_3 IS NOT NULL AS d3, four_day_forecast_4 IS NOT NULL AS d4,
  CASE WHEN CAST(call_timestamp[10:10] AS INTEGER) % 3 = 0 THEN 'A corrected'
       ELSE four_day_forecast_1 END AS first FROM c""")
def forecast_4day_landed(spark, sf):
    """Days that landed again take no second slot."""
    feed = forecast_4day_feed(readings(spark, sf))
    wide = N.forecast_4day(_landed_twice(feed, "4day_forecast", F.lit("A corrected")))
    return wide.select(S.TS, *[F.col(f"four_day_forecast_{d}").isNotNull().alias(f"d{d}")
                               for d in S.DAYS], F.col("four_day_forecast_1").alias("first"))


_REPORT = ", ".join(f'{n} AS "{S.to_feed_name(n)}"' for n in S.REPORT_ORDER)


_PART = f"""WITH {WIDE_CTES}, part AS (SELECT * FROM wide
  WHERE call_timestamp >= '2024-01-03T000000' AND call_timestamp <= '2024-01-28T120000')"""


@query("range_report", f"{_PART} SELECT {_REPORT} FROM part")
def range_report(spark, sf):
    return reports.range_report(build_wide_table(feeds(spark, sf)), "2024-01-03", "2024-01-28",
                                0, 12)


@query("range_first", f"""{_PART} SELECT {_REPORT} FROM (
  SELECT * FROM part ORDER BY call_timestamp, cam_id, direction LIMIT 1000)""")
def range_first(spark, sf):
    return reports.range_first(build_wide_table(feeds(spark, sf)), 1000, "2024-01-03",
                               "2024-01-28", 0, 12)


@query("range_blank", f"""WITH {WIDE_CTES}, part AS (SELECT * FROM wide WHERE call_timestamp <=
  (SELECT substr(max(call_timestamp), 1, 10) || 'T120000' FROM complete))
SELECT {_REPORT} FROM part""")
def range_blank(spark, sf):
    """Blank dates are looked up among the snapshots, not by a second run of the wide table."""
    f = feeds(spark, sf)
    return reports.range_report(build_wide_table(f), "", "", 0, 12,
                                snapshots=complete_snapshots(f))


_PROFILE = f"""WITH {WIDE_CTES} SELECT cam_id, direction,
  substr(call_timestamp, 12, 2) AS time_hr, """ + ", ".join(
    f"avg(coalesce({m}, 0)) AS {m}" for m in S.MEASURES) + " FROM wide GROUP BY ALL"


@query("wide_profile", _PROFILE)
def wide_profile(spark, sf):
    return reports.hourly_profile(build_wide_table(feeds(spark, sf)))


@query("closed_days_profile", _PROFILE)
def closed_days_profile(spark, sf):
    """The same profile from sums by day. The sums of the closed days are kept, then one of the days
    gets rows that were late and another corrected ones; their sums count no more."""
    table, sums = scratch_dir(spark, "wide"), scratch_dir(spark, "sums")
    wide = cut_lineage(build_wide_table(feeds(spark, sf)))
    day = F.substring(S.TS, 1, 10)
    wrong = F.when(day == "2024-01-12", F.lit(-1.0)).otherwise(F.col("rainfall_realtime"))
    versions.merge_days(wide.filter((day != "2024-01-10") | (F.col("cam_id") % 2 == 0)).withColumn(
        "rainfall_realtime", wrong), table)
    closed_days.keep_sums(spark, table, sums, AS_OF)
    versions.merge_days(wide, table)
    return closed_days.profile(spark, table, sums)

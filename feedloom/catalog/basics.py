"""Aggregates, slices, alignment, joins, dedupe, labels, nulls, time text."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.catalog.base import (LABEL_SQL, LIGHT_WIDE, READINGS, TYPES, label_of, light_wide,
                                   query, readings, table)
from feedloom.functions import labels, nulls, timetext
from feedloom.operators import aggregates as A
from feedloom.operators import align, joins
from feedloom.operators.dedupe import keep_last
from feedloom.operators.nearest_time import nearest_snapshot
from feedloom.plans import reports
from feedloom.sinks.append import union_new
from feedloom.sinks.files import key_violations
from feedloom.sources.images import image_name, parse_names

AS_OF = "2024-01-15"


@query("hourly_profile", f"""WITH {LIGHT_WIDE}
SELECT cam_id, direction, substr(call_timestamp, 12, 2) AS time_hr,
       avg(coalesce(rainfall_realtime, 0)) AS rainfall_realtime,
       avg(coalesce(wind_speed_realtime, 0)) AS wind_speed_realtime
FROM lw GROUP BY ALL""")
def hourly_profile(spark, sf):
    return reports.hourly_profile(light_wide(spark, sf),
                                  ["rainfall_realtime", "wind_speed_realtime"])


@query("profile_lookup", f"""WITH {LIGHT_WIDE},
p AS (SELECT cam_id, direction, substr(call_timestamp, 12, 2) AS time_hr,
             avg(wind_speed_realtime) AS wind_speed_realtime FROM lw GROUP BY ALL),
r AS (SELECT DISTINCT c_custkey AS cam_id,
        CASE WHEN c_custkey % 24 IN (0, 1) THEN '01'
             WHEN c_custkey % 24 IN (22, 23) THEN '22'
             WHEN c_custkey % 24 = 5 THEN '01'
             ELSE lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') END AS time_hr
      FROM customer)
SELECT cam_id, time_hr, direction, wind_speed_realtime FROM p JOIN r USING (cam_id, time_hr)""")
def profile_lookup(spark, sf):
    profile = reports.hourly_profile(light_wide(spark, sf), ["wind_speed_realtime"])
    hour = F.col("c_custkey") % 24
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cam_id"),
        F.when(hour == 5, "").otherwise(
            F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit("3000"))).alias("time"))
    return reports.profile_lookup(profile, requests)


_BY_TYPE = [f"SELECT call_timestamp FROM ev WHERE event_type = '{t}'" for t in TYPES]
_COMMON = f"WITH {READINGS} " + " INTERSECT ".join(_BY_TYPE)


def _feeds(spark, sf):
    ev = readings(spark, sf)
    return [ev.filter(F.col("event_type") == t) for t in TYPES]


@query("common_snapshots", _COMMON)
def common_snapshots(spark, sf):
    return align.common_keys_intersect(_feeds(spark, sf))


@query("common_snapshots_single_pass", _COMMON)
def common_snapshots_single_pass(spark, sf):
    return align.common_keys(_feeds(spark, sf))


def _slice_query(mode: str, where: str):
    @query(f"slice_{mode}", f"WITH {READINGS} SELECT event_id, canon FROM ev WHERE {where}")
    def run(spark, sf):
        ev = readings(spark, sf).select("event_id", "canon")
        return align.slice_snapshots(ev, mode, AS_OF, ts="canon")


_slice_query("today", f"substr(canon, 1, 10) = '{AS_OF}'")
_slice_query("yesterday", "substr(canon, 1, 10) = '2024-01-14'")
_slice_query("before_today", f"substr(canon, 1, 10) < '{AS_OF}'")
_slice_query("latest", "canon = (SELECT max(canon) FROM ev)")
_slice_query("all", "true")


_GRID = f"""WITH {READINGS}
SELECT * FROM (SELECT DISTINCT call_timestamp FROM ev), (SELECT n_nationkey, n_name FROM nation)"""


def _grid(spark, sf, **how):
    stamps = readings(spark, sf).select("call_timestamp").distinct()
    return align.expected_grid(stamps, table(spark, sf, "nation").select("n_nationkey", "n_name"),
                               **how)


@query("expected_grid", _GRID)
def expected_grid(spark, sf):
    return _grid(spark, sf)


@query("expected_grid_spread", _GRID)
def expected_grid_spread(spark, sf):
    return _grid(spark, sf, buckets=16)


@query("crosstab_wide", """SELECT coalesce(l_returnflag, 'Total') AS l_returnflag,
  count(*) FILTER (l_linestatus = 'F') AS "F", count(*) FILTER (l_linestatus = 'O') AS "O",
  count(*) AS "Total"
FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def crosstab_wide(spark, sf):
    return A.crosstab_wide(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus",
                           ["F", "O"])


@query("crosstab_long", """SELECT coalesce(l_returnflag, 'Total') AS l_returnflag,
  coalesce(l_linestatus, 'Total') AS l_linestatus, count(*) AS n
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def crosstab_long(spark, sf):
    return A.crosstab_long(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("accuracy", """SELECT count(*) FILTER (quality = 1 - toxic) AS n_correct,
  count(*) AS n_rows, avg(CASE WHEN quality = 1 - toxic THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
FROM labels""")
def accuracy(spark, sf):
    rows = table(spark, sf, "labels").withColumn("guess", 1 - F.col("toxic"))
    return A.accuracy(rows, "quality", "guess")


@query("correct_rows", "SELECT doc_id, quality FROM labels WHERE quality = 1 - toxic")
def correct_rows(spark, sf):
    rows = table(spark, sf, "labels").withColumn("guess", 1 - F.col("toxic"))
    return A.correct_rows(rows, "quality", "guess").select("doc_id", "quality")


@query("summarise", """SELECT l_linenumber, count(l_quantity) AS n, min(l_quantity) AS min_value,
  avg(l_quantity) AS avg_value, max(l_quantity) AS max_value FROM lineitem GROUP BY l_linenumber""")
def summarise(spark, sf):
    return A.summarise(table(spark, sf, "lineitem"), ["l_linenumber"], "l_quantity")


@query("time_domain", f"WITH {READINGS} SELECT min(canon) AS first, max(canon) AS last FROM ev")
def time_domain(spark, sf):
    return A.domain(readings(spark, sf), "canon")


@query("camera_list", "SELECT DISTINCT user_id AS cam_id FROM events ORDER BY cam_id")
def camera_list(spark, sf):
    return reports.cameras(light_wide(spark, sf))


@query("date_list", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events ORDER BY date")
def date_list(spark, sf):
    return reports.dates(light_wide(spark, sf))


@query("snapshot_times", f"""WITH {READINGS} SELECT DISTINCT canon AS call_timestamp,
  substr(canon, 1, 10) AS date, substr(canon, 12, 2) AS hour,
  CAST(substr(canon, 14, 2) AS INTEGER) AS minute FROM ev""")
def snapshot_times(spark, sf):
    return reports.snapshot_times(light_wide(spark, sf))


_SERIES = f"""WITH {LIGHT_WIDE}, series AS (
  SELECT call_timestamp, direction, substr(call_timestamp, 1, 10) AS date,
         substr(call_timestamp, 12, 4) AS time, trafficcongestion,
         CASE coalesce(trafficcongestion, 'NaN') WHEN 'None' THEN 1 WHEN 'Mild' THEN 2
              WHEN 'Medium' THEN 3 WHEN 'Heavy' THEN 4 WHEN 'NaN' THEN 1 END AS level
  FROM lw WHERE call_timestamp >= '2024-01-05T060000'
    AND call_timestamp <= (SELECT substr(max(call_timestamp), 1, 10) || 'T240000' FROM lw))"""


def _series(spark, sf):
    return reports.congestion_series(light_wide(spark, sf), "2024-01-05", "", 6, 24,
                                     camera=reports.ALL_CAMERAS)


@query("congestion_series", _SERIES + " SELECT * FROM series ORDER BY date, time, direction")
def congestion_series(spark, sf):
    return _series(spark, sf)


@query("series_size", _SERIES + """ SELECT count(DISTINCT direction) AS n_directions,
  count(DISTINCT call_timestamp) AS n_calls, count(DISTINCT date) AS n_dates FROM series""")
def series_size(spark, sf):
    return reports.series_size(_series(spark, sf))


@query("series_by_direction", _SERIES + """ SELECT direction, count(*) AS n,
  min(level) AS min_level, avg(level) AS avg_level, max(level) AS max_level,
  min(call_timestamp) AS first_call, max(call_timestamp) AS last_call
FROM series GROUP BY direction""")
def series_by_direction(spark, sf):
    return reports.series_by_direction(_series(spark, sf))


@query("range_of_camera", f"""WITH {LIGHT_WIDE} SELECT event_id, call_timestamp, cam_id FROM lw
WHERE call_timestamp >= (SELECT substr(min(call_timestamp), 1, 10) || 'T030000' FROM lw)
  AND call_timestamp <= '2024-01-20T180000' AND cam_id = 7""")
def range_of_camera(spark, sf):
    rows = light_wide(spark, sf)
    return reports.in_range(rows, "", "2024-01-20", 3, 18, camera="7").select(
        "event_id", "call_timestamp", "cam_id")


@query("keep_last", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def keep_last_query(spark, sf):
    orders = table(spark, sf, "orders")
    return keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("outer_merge", """SELECT c_custkey, c_name, n_orders, n_open FROM
  (SELECT c_custkey, c_name FROM customer) FULL JOIN
  (SELECT o_custkey * 2 AS c_custkey, count(*) AS n_orders,
          count(*) FILTER (o_orderstatus = 'O') AS n_open FROM orders GROUP BY 1)
  USING (c_custkey)""")
def outer_merge(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy(
        (F.col("o_custkey") * 2).alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.outer_merge(customers, per_customer, ["c_custkey"])


_ACC = ", ".join(
    f"{t} AS (SELECT user_id, call_timestamp, CAST(sum(cents) AS BIGINT) AS {t}, min(event_id) AS "
    f"{'first_id' if t == TYPES[0] else 'id_' + t} FROM ev WHERE event_type = '{t}' GROUP BY ALL)"
    for t in TYPES[:2])


@query("accumulate_readings", f"""WITH {READINGS}, {_ACC}
SELECT user_id, call_timestamp, view, first_id, click FROM view JOIN click
USING (user_id, call_timestamp)""")
def accumulate_readings(spark, sf):
    ev = readings(spark, sf)
    frames = [ev.filter(F.col("event_type") == t).groupBy("user_id", "call_timestamp").agg(
        F.sum("cents").alias(t), F.min("event_id").alias("first_id")) for t in TYPES[:2]]
    return joins.accumulate(frames, ["user_id", "call_timestamp"])


@query("spread_join", """SELECT l_orderkey, l_linenumber, l_partkey, s_name, s_nationkey
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def spread_join(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("s_suppkey"))
    side = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return joins.spread_join(items, side, ["s_suppkey"], "left",
                             by=["l_orderkey", "l_linenumber"]).drop("s_suppkey")


@query("idempotent_append", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderstatus = 'F' UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def idempotent_append(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = orders.filter(F.col("o_orderstatus") == "F")
    return union_new(target, orders.unionAll(orders), ["o_orderkey"])


@query("key_violations", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def key_violations_query(spark, sf):
    return key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("nearest_snapshot", f"""WITH {READINGS},
r AS (SELECT o_orderkey,
        '2024-01-' || lpad(CAST(1 + o_orderkey % 31 AS VARCHAR), 2, '0') AS date,
        lpad(CAST((o_orderkey * 7) % 24 AS VARCHAR), 2, '0')
          || lpad(CAST((o_orderkey * 13) % 60 AS VARCHAR), 2, '0') AS time FROM orders),
c AS (SELECT *, CASE substr(time, 1, 2) WHEN '00' THEN '01' WHEN '23' THEN '22'
                ELSE substr(time, 1, 2) END AS hour FROM r),
s AS (SELECT DISTINCT canon FROM ev)
SELECT o_orderkey, date, time, hour, canon AS nearest_ts FROM c LEFT JOIN s
  ON substr(canon, 1, 10) = date AND substr(canon, 12, 2) = hour
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY
  abs(CAST(substr(canon, 14, 2) AS INTEGER) - CAST(substr(time, 3, 2) AS INTEGER)), canon) = 1""")
def nearest_snapshot_query(spark, sf):
    key = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    requests = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("2024-01-"), two(1 + key % 31)).alias("date"),
        F.concat(two((key * 7) % 24), two((key * 13) % 60)).alias("time"))
    return nearest_snapshot(requests, readings(spark, sf), ts="canon")


@query("image_lookup", f"""WITH {READINGS},
r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE
        '2024-01-' || lpad(CAST(1 + o_orderkey % 31 AS VARCHAR), 2, '0') END AS date,
        CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE
        lpad(CAST((o_orderkey * 7) % 24 AS VARCHAR), 2, '0')
          || lpad(CAST((o_orderkey * 13) % 60 AS VARCHAR), 2, '0') END AS time,
        CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey % 100 AS VARCHAR) END AS cam_id
      FROM orders),
f AS (SELECT min(canon) AS c FROM ev),
b AS (SELECT o_orderkey, CASE WHEN date = '' OR time = '' THEN c[1:10] ELSE date END AS date,
        CASE WHEN date = '' OR time = '' THEN c[12:15] ELSE time END AS time,
        CASE WHEN cam_id = '' THEN '1001' ELSE cam_id END AS cam_id FROM r, f),
c AS (SELECT *, CASE substr(time, 1, 2) WHEN '00' THEN '01' WHEN '23' THEN '22'
                ELSE substr(time, 1, 2) END AS hour FROM b),
s AS (SELECT DISTINCT canon FROM ev),
n AS (SELECT o_orderkey, cam_id, canon FROM c LEFT JOIN s
        ON substr(canon, 1, 10) = date AND substr(canon, 12, 2) = hour
      QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY
        abs(CAST(substr(canon, 14, 2) AS INTEGER) - CAST(substr(time, 3, 2) AS INTEGER)), canon) = 1),
i AS (SELECT DISTINCT canon || '_' || (user_id % 100) || '.jpg' AS file_name, canon || '.zip' AS archive_name
      FROM ev)
SELECT o_orderkey, cam_id, canon AS nearest_ts, canon || '_' || cam_id || '.jpg' AS file_name, archive_name
FROM n LEFT JOIN i ON i.file_name = canon || '_' || cam_id || '.jpg'""")
def image_lookup(spark, sf):
    """From a request, blanks among them, to the row of the image catalog."""
    key = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    requests = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("2024-01-"), two(1 + key % 31)))
        .alias("date"),
        F.when(key % 13 == 0, "").otherwise(F.concat(two((key * 7) % 24), two((key * 13) % 60)))
        .alias("time"),
        F.when(key % 5 == 0, "").otherwise((F.col("o_custkey") % 100).cast("string"))
        .alias("cam_id"))
    ev = readings(spark, sf)
    images = parse_names(ev.select(F.concat(F.lit("/landing/"), image_name(
        "canon", F.col("user_id") % 100)).alias("path"))).drop("path")
    return reports.image_lookup(requests, ev, images, ts="canon").select(
        "o_orderkey", "cam_id", "nearest_ts", "file_name", "archive_name")


@query("label_codes", f"""WITH {READINGS}, l AS (SELECT event_id, {LABEL_SQL} AS label FROM ev)
SELECT event_id, coalesce(label, 'NaN') AS shown,
  CASE label WHEN 'None' THEN 0 WHEN 'Mild' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Heavy' THEN 3 END AS code,
  CASE coalesce(label, 'NaN') WHEN 'None' THEN 1 WHEN 'Mild' THEN 2 WHEN 'Medium' THEN 3
    WHEN 'Heavy' THEN 4 WHEN 'NaN' THEN 1 END AS level, label IS NOT NULL AS known FROM l""")
def label_codes(spark, sf):
    label = label_of(F.col("k"))
    return readings(spark, sf).select(
        "event_id", labels.show_missing(label).alias("shown"),
        labels.ordinal(label).alias("code"), labels.level(label).alias("level"),
        labels.is_known(label).alias("known"))


@query("null_model", f"""WITH {READINGS}, d AS (SELECT event_id,
  CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'NaN' ELSE event_type END AS t,
  CASE WHEN k % 3 = 0 THEN 'nan'::DOUBLE ELSE CAST(cents AS DOUBLE) END AS v FROM ev)
SELECT event_id, CASE WHEN t NOT IN ('', 'nan', 'NaN') THEN t END AS t,
  CASE WHEN NOT isnan(v) THEN v END AS v FROM d""")
def null_model(spark, sf):
    ev, k = readings(spark, sf), F.col("k")
    dirty = ev.select(
        "event_id",
        F.when(k % 5 == 0, "").when(k % 5 == 1, "nan").when(k % 5 == 2, "NaN")
        .otherwise(F.col("event_type")).alias("t"),
        F.when(k % 3 == 0, F.lit(float("nan"))).otherwise(F.col("cents").cast("double")).alias("v"))
    return nulls.normalise(dirty)


@query("complete_rows", f"""WITH {LIGHT_WIDE} SELECT event_id, rainfall_realtime FROM lw
WHERE trafficcongestion IS NOT NULL AND rainfall_realtime IS NOT NULL""")
def complete_rows(spark, sf):
    rows = light_wide(spark, sf).filter(labels.is_known("trafficcongestion"))
    return rows.dropna("any").select("event_id", "rainfall_realtime")


@query("canonical_time", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H%M%S') AS from_text,
  strftime(ts, '%Y-%m-%dT%H%M%S') AS from_time, strftime(ts, '%Y-%m-%d') AS date,
  strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, strftime(ts, '%H%M') AS hhmm,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
  strftime(ts, '%Y-%m-%d') || 'T' || lpad(CAST(event_id % 25 AS VARCHAR), 2, '0') || '0000' AS bound
FROM events""")
def canonical_time(spark, sf):
    events = table(spark, sf, "events")
    iso = F.concat(F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T"),
                   F.when(F.col("event_id") % 2 == 0, "+08:00").otherwise("Z"))
    canon = timetext.canonical("ts")
    return events.select(
        "event_id", timetext.canonical(iso).alias("from_text"), canon.alias("from_time"),
        timetext.date_part(canon).alias("date"), timetext.hour_part(canon).alias("hour"),
        timetext.minute_part(canon).alias("minute"), timetext.hhmm_part(canon).alias("hhmm"),
        timetext.to_ntz(canon).cast("string").alias("parsed"),
        timetext.bound_col(timetext.date_part(canon), F.col("event_id") % 25).alias("bound"))

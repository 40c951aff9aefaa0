"""Locations: parsing, distances, nearest anchors, boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.catalog.base import query, table
from feedloom.functions import points as P
from feedloom.operators.boxes import points_in_boxes
from feedloom.operators.nearest import nearest, nearest_descent
from feedloom.plans.cameras import COMPASS, camera_mapping, mapping_job
from feedloom.schemas import PAYLOAD_CAMERAS, SEED_AREAS, TS
from feedloom.session import scratch_dir
from feedloom.sinks.files import write_csv
from feedloom.sources.payloads import parse_payloads
from feedloom.sources.seeds import read_seed


def _spot(key: str, mult: int, lat0: float, step: float):
    """Scattered but exactly computable coordinates of a key."""
    k = F.col(key)
    lat = F.lit(lat0) + (((k * mult) % 9973).cast("double") * F.lit(step))
    lon = F.lit(103.6) + (((k * (mult + 60)) % 9967).cast("double") * F.lit(step))
    return lat.alias("lat"), lon.alias("lon")


def _spot_sql(key: str, mult: int, lat0: float, step: float) -> str:
    return (f"{lat0}::DOUBLE + (({key} * {mult}) % 9973)::DOUBLE * {step}::DOUBLE AS lat, "
            f"103.6::DOUBLE + (({key} * {mult + 60}) % 9967)::DOUBLE * {step}::DOUBLE AS lon")


def _points(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cam_id"), *_spot("c_custkey", 7919, 1.2, 0.00005))


def _anchors(spark, sf, out="station", mult=6151):
    """Two suppliers share each location, so every search has ties."""
    site = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(out), F.floor(F.col("s_suppkey") / 2).alias("g"))
    return site.select(out, *_spot("g", mult, 1.21, 0.0000537))


def _fixed(spark, sf, name, key, out, mult):
    return table(spark, sf, name).select(
        F.col(key).cast("long").alias(out),
        *_spot(key, mult, 1.22, 0.0000471))


_PTS = f"p AS (SELECT c_custkey AS cam_id, {_spot_sql('c_custkey', 7919, 1.2, 0.00005)} FROM customer)"


def _anchor_sql(name: str, out: str, mult: int) -> str:
    return (f"{name} AS (SELECT s_suppkey AS {out}, "
            f"{_spot_sql('(s_suppkey // 2)', mult, 1.21, 0.0000537)} FROM supplier)")


_KM = """2 * 6373.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))"""


def _near_sql(anchors: str, out: str) -> str:
    return f"""SELECT cam_id, {out}, km FROM (
  SELECT cam_id, {out}, {_KM} AS km, min({_KM}) OVER (PARTITION BY cam_id) AS best FROM (
    SELECT cam_id, {out},
      pow(sin((radians(a.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat))
        * cos(radians(a.lat)) * pow(sin((radians(a.lon) - radians(p.lon)) / 2), 2) AS h
    FROM p, {anchors} a)) WHERE km <= best * (1 + 1e-12)"""


_NEAREST = (f"WITH {_PTS}, {_anchor_sql('s', 'station', 6151)} "
            f"SELECT cam_id, station, round(km, 4) AS km FROM ({_near_sql('s', 'station')})")


def _rounded(df):
    return df.withColumn("km", F.round("km", 4))


@query("nearest_anchor", _NEAREST)
def nearest_anchor(spark, sf):
    return _rounded(nearest(_points(spark, sf), _anchors(spark, sf)))


_BAD = f"""WITH p AS (SELECT * FROM (SELECT c_custkey AS cam_id, {_spot_sql('c_custkey', 7919, 1.2, 0.00005)}
  FROM customer) WHERE cam_id % 5 > 1), s AS (SELECT * FROM (SELECT s_suppkey AS station,
  {_spot_sql('(s_suppkey // 2)', 6151, 1.21, 0.0000537)} FROM supplier) WHERE station % 3 > 0)
SELECT cam_id, station, round(km, 4) AS km FROM ({_near_sql('s', 'station')})"""


def _spoiled(df, key: str, every: int):
    """Some coordinates of ``df`` become NaN, and for an ``every`` above 3 others null."""
    k = F.col(key) % every
    lat = F.when(k == 0, F.lit(float("nan"))).otherwise(F.col("lat"))
    return df.withColumn("lat", F.when(k == 1, F.lit(None)).otherwise(lat) if every > 3 else lat)


def _bad_points(spark, sf, rows: int):
    return _rounded(nearest(_spoiled(_points(spark, sf), "cam_id", 5),
                            _spoiled(_anchors(spark, sf), "station", 3), small_rows=rows))


@query("nearest_bad_points", _BAD)
def nearest_bad_points(spark, sf):
    return _bad_points(spark, sf, 20_000)


@query("nearest_bad_points_descent", _BAD)
def nearest_bad_points_descent(spark, sf):
    return _bad_points(spark, sf, 0)


@query("nearest_descent", _NEAREST)
def nearest_descent_query(spark, sf):
    return _rounded(nearest_descent(_points(spark, sf), _anchors(spark, sf), leaf=8))


@query("camera_mapping", f"""WITH {_PTS}, {_anchor_sql('s1', 'non_rain', 6151)},
{_anchor_sql('s2', 'rain', 5167)},
s3 AS (SELECT n_nationkey::BIGINT AS area, {_spot_sql('n_nationkey', 911, 1.22, 0.0000471)} FROM nation),
s4 AS (SELECT r_regionkey::BIGINT AS compass, {_spot_sql('r_regionkey', 1847, 1.22, 0.0000471)} FROM region)
SELECT cam_id, non_rain, rain, area, compass FROM ({_near_sql('s1', 'non_rain')}) x1
JOIN ({_near_sql('s2', 'rain')}) x2 USING (cam_id) JOIN ({_near_sql('s3', 'area')}) x3 USING (cam_id)
JOIN ({_near_sql('s4', 'compass')}) x4 USING (cam_id)""")
def camera_mapping_query(spark, sf):
    return camera_mapping(
        _points(spark, sf), _anchors(spark, sf, "non_rain"), _anchors(spark, sf, "rain", 5167),
        _fixed(spark, sf, "nation", "n_nationkey", "area", 911),
        _fixed(spark, sf, "region", "r_regionkey", "compass", 1847))


_ONLY = ("S2", "S5")


@query("camera_mapping_job", f"""WITH p AS (SELECT c_custkey AS cam_id,
  {_spot_sql('c_custkey', 7919, 1.2, 0.00005)} FROM customer),
s2 AS (SELECT DISTINCT 'R' || (s_suppkey % 40) AS rain, {_spot_sql('(s_suppkey % 40)', 5167, 1.21, 0.0000537)}
  FROM supplier),
s1 AS (SELECT DISTINCT 'S' || (s_suppkey % 9) AS non_rain, {_spot_sql('(s_suppkey % 9)', 6151, 1.21, 0.0000537)}
  FROM supplier WHERE 'S' || (s_suppkey % 9) IN {_ONLY}),
s3 AS (SELECT n_name AS area, {_spot_sql('n_nationkey', 911, 1.22, 0.0000471)} FROM nation),
s4(compass, lat, lon) AS (VALUES {", ".join(f"('{n}', {a}::DOUBLE, {o}::DOUBLE)" for n, a, o in COMPASS)})
SELECT cam_id, non_rain AS non_rainfall_station_id, rain AS rainfall_station_id,
  area AS "2hr_forecast_area", compass FROM ({_near_sql('s1', 'non_rain')}) x1
JOIN ({_near_sql('s2', 'rain')}) x2 USING (cam_id) JOIN ({_near_sql('s3', 'area')}) x3 USING (cam_id)
JOIN ({_near_sql('s4', 'compass')}) x4 USING (cam_id)""")
def camera_mapping_job(spark, sf):
    """From camera payloads (one entry per camera, told twice), two feeds of repeated readings and the
    area seed's file."""
    text = lambda a, b, *pad: F.concat(*pad[:1], F.col(a).cast("string"), F.lit(", "),
                                       F.col(b).cast("string"), *pad[1:])
    brackets = (F.lit("("), F.lit(")"))

    def feed(head: str, n: int, mult: int):
        key = table(spark, sf, "supplier").withColumn("g", F.col("s_suppkey") % n)
        return key.select(F.concat(F.lit(head), F.col("g").cast("string")).alias("station_id"),
                          *_spot("g", mult, 1.21, 0.0000537)).select(
            "station_id", text("lat", "lon", *brackets).alias("station_loc"))

    cams = _points(spark, sf)
    camera = F.struct(F.col("cam_id").cast("string").alias("camera_id"),
                      F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
                      .alias("location"))
    docs = cams.select(F.lit("2024-01-01T000000").alias(TS), F.to_json(F.struct(
        F.array(F.struct(F.array(camera, camera).alias("cameras"))).alias("items"))).alias("text"))
    areas = table(spark, sf, "nation").select(
        F.col("n_name").alias("region"), *_spot("n_nationkey", 911, 1.22, 0.0000471))
    path = scratch_dir(spark, "seed")
    write_csv(areas.select(text("lat", "lon").alias("coord"), "region"), path)
    return mapping_job(parse_payloads(docs, "text", PAYLOAD_CAMERAS), feed("S", 9, 6151),
                       feed("R", 40, 5167), read_seed(spark, path, SEED_AREAS, glob="*.csv"),
                       only=list(_ONLY), expected=cams.count())


@query("point_parse", """SELECT o_orderkey, o_totalprice AS lat, CAST(o_custkey AS DOUBLE) AS lon FROM orders
WHERE o_orderkey % 4 <> 3 UNION ALL
SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 4 = 3""")
def point_parse(spark, sf):
    a, b = F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")
    which = F.col("o_orderkey") % 4
    text = (F.when(which == 0, F.concat(F.lit("("), a, F.lit(", "), b, F.lit(")")))
            .when(which == 1, F.concat(a, F.lit(", "), b))
            .when(which == 2, F.concat(a, F.lit(" "), b)).otherwise(F.concat(a, F.lit(" none"))))
    point = P.parse_point("text")
    return table(spark, sf, "orders").withColumn("text", text).select(
        "o_orderkey", point["lat"].alias("lat"), point["lon"].alias("lon"))


_BOX_SQL = f"""b AS (SELECT s.station, least(s.lat, t.lat) AS south, least(s.lon, t.lon) AS west,
  greatest(s.lat, t.lat) AS north, greatest(s.lon, t.lon) AS east
  FROM s JOIN (SELECT station, lat + ((station % 7) - 3) * 0.04::DOUBLE AS lat,
                      lon + ((station % 5) - 2) * 0.03::DOUBLE AS lon FROM s) t USING (station))"""


def _boxes(spark, sf):
    s = _anchors(spark, sf)
    here = F.struct("lat", "lon")
    there = F.struct(
        (F.col("lat") + ((F.col("station") % 7) - 3) * F.lit(0.04)).alias("lat"),
        (F.col("lon") + ((F.col("station") % 5) - 2) * F.lit(0.03)).alias("lon"))
    return s.select("station", P.bounding_box(here, there).alias("box"))


@query("bounding_boxes", f"WITH {_anchor_sql('s', 'station', 6151)}, {_BOX_SQL} "
       "SELECT station, south, west, north, east FROM b")
def bounding_boxes(spark, sf):
    return _boxes(spark, sf).select("station", "box.*")


@query("points_in_boxes", f"""WITH {_PTS}, {_anchor_sql('s', 'station', 6151)}, {_BOX_SQL}
SELECT cam_id, station FROM p JOIN b ON lat BETWEEN south AND north AND lon BETWEEN west AND east""")
def points_in_boxes_query(spark, sf):
    boxes = _boxes(spark, sf).select("station", "box.*")
    return points_in_boxes(_points(spark, sf), boxes).select("cam_id", "station")

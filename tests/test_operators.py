"""Operators against brute force on small, skewed inputs."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions import labels, nulls, points, timetext
from feedloom.operators import aggregates, joins, reshape
from feedloom.operators import nearest as nearest_by_cells
from feedloom.operators.boxes import points_in_boxes
from feedloom.operators.dedupe import keep_last
from feedloom.operators.nearest import nearest, nearest_descent
from feedloom.operators.nearest_time import nearest_snapshot
from feedloom.plans import reports
from feedloom.plans.cameras import camera_mapping, check_count, compass_anchors, located


def km(a, b):
    p1, q1, p2, q2 = map(math.radians, (*a, *b))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((q2 - q1) / 2) ** 2
    return 2 * 6373.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def scattered(kind, n, seed):
    """Spots over the globe, in one dense cluster, or mostly at one place."""
    r = random.Random(seed)
    globe = lambda: (r.uniform(-90, 90), r.uniform(-180, 180))
    near = lambda: (1.3 + r.uniform(-1e-4, 1e-4), 103.8 + r.uniform(-1e-4, 1e-4))
    if kind == "globe":
        return [globe() for _ in range(n)]
    if kind == "cluster":
        return [near() if i % 10 else globe() for i in range(n)]
    spot = near()
    return [spot if i % 3 else near() for i in range(n)]


@pytest.mark.parametrize("pk", ["globe", "cluster", "one_place"])
@pytest.mark.parametrize("ak", ["globe", "cluster", "one_place"])
def test_nearest_by_descent_is_exact(spark, pk, ak):
    pts, anchors = scattered(pk, 60, 1), scattered(ak, 150, 2)
    p = spark.createDataFrame([(i, *c) for i, c in enumerate(pts)], "p int, lat double, lon double")
    a = spark.createDataFrame([(i, *c) for i, c in enumerate(anchors)],
                              "a int, lat double, lon double")
    want = set()
    for i, c in enumerate(pts):
        ds = [km(c, x) for x in anchors]
        want |= {(i, j) for j, d in enumerate(ds) if d <= min(ds) + 1e-9}
    listed = {(r.p, r.a) for r in nearest(p, a).collect()}
    descent = {(r.p, r.a) for r in nearest_descent(p, a, leaf=4).collect()}
    assert descent == listed == want


@pytest.mark.parametrize("budget", [1_000_000, 60])
def test_cell_index_finds_what_all_distances_find(spark, monkeypatch, budget):
    """Anchors in a cluster, on a line, on a ring about the pole (more ties than a cell names), at
    both sides of the date line and twice in one place; points everywhere, some on anchors."""
    draw = random.Random(5)
    spots = [(1.3 + draw.random() / 9, 103.8 + draw.random() / 9) for _ in range(60)]
    spots += [(0.0, 0.001 * i) for i in range(40)] + [(80.0, 9.0 * i) for i in range(40)]
    spots += [(-20.0, 179.99), (-20.0, -179.99), spots[0], spots[3]]
    asked = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(150)]
    asked += [(1.3 + draw.random() / 9, 103.8 + draw.random() / 9) for _ in range(150)]
    asked += spots[::7] + [(90.0, 0.0), (-20.0, 180.0), (0.0, 0.0005), (-90.0, 5.0)]
    plain = nearest_by_cells.cell_index
    monkeypatch.setattr(nearest_by_cells, "cell_index", lambda s, x: plain(s, x, budget=budget))
    p = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)], "p int, lat double, lon double")
    a = spark.createDataFrame([(i, *x) for i, x in enumerate(spots)], "a int, lat double, lon double")
    pairs = p.withColumnsRenamed({"lat": "y", "lon": "x"}).crossJoin(a).withColumn(
        "km", points.great_circle_km("y", "x", "lat", "lon"))
    least = pairs.groupBy("p").agg(F.min("km").alias("km"))
    want = {tuple(r) for r in pairs.join(least, ["p", "km"]).select("p", "a", "km").collect()}
    got = [tuple(r) for r in nearest(p, a).select("p", "a", "km").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert nearest(p, a.limit(0)).count() == 0 == nearest(p.limit(0), a).count()


def test_nearest_listed_shuffles_no_point(spark):
    p = spark.range(1000).select("id", (F.col("id") / 100).alias("lat"), (F.col("id") / 90).alias("lon"))
    a = p.filter("id % 9 = 0").withColumnRenamed("id", "a")
    text = nearest(p, a)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text and "ArrowEval" not in text


def test_nearest_keeps_ties_and_drops_points_without_location(spark, rows):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "p int, lat double, lon double")
    a = spark.createDataFrame([("x", 0.0, 1.0), ("y", 0.0, 1.0), ("z", 0.0, 2.0), ("n", None, 0.0)],
                              "a string, lat double, lon double")
    assert rows(nearest(p, a), "p", "a") == [(1, "x"), (1, "y")]
    assert rows(nearest(p, a, small_rows=0), "p", "a") == [(1, "x"), (1, "y")]


def test_camera_mapping_keeps_combinations(spark, rows):
    cams = spark.createDataFrame([("7", 1.35, 103.82)], "cam_id string, lat double, lon double")
    spots = lambda name, *r: spark.createDataFrame(list(r), f"{name} string, lat double, lon double")
    non_rain = spots("non_rain", ("S1", 1.3, 103.8), ("S2", 1.3, 103.8))
    got = camera_mapping(cams, non_rain, spots("rain", ("R1", 1.0, 103.0)),
                         spots("area", ("A", 1.36, 103.82)), compass_anchors(spark))
    assert rows(got) == [(7, "S1", "R1", "A", "central"), (7, "S2", "R1", "A", "central")]


def test_located_stations(spark, rows):
    feed = spark.createDataFrame(
        [("S24", "(1.25, 103.5)"), ("S24", "(1.25, 103.5)"), ("S9", "(1.0, 103.0)")],
        "station_id string, station_loc string")
    assert rows(located(feed, "station_id", "station_loc", "s", only=["S24"])) == [
        ("S24", 1.25, 103.5)]


def test_camera_count_check(spark):
    cams = spark.range(3)
    assert check_count(cams, 3).count() == 3
    with pytest.raises(Exception, match="expected 4 cameras"):
        check_count(cams, 4).collect()


def test_points_in_boxes_is_exact(spark):
    r = random.Random(5)
    pts = [(i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(300)]
    pts += [(1000 + i, 1.3, 103.8) for i in range(100)]
    boxes = [(0, -90.0, -180.0, 90.0, 180.0), (1, 1.3, 103.8, 1.3, 103.8), (2, 5.0, 5.0, 4.0, 6.0)]
    for i in range(3, 80):
        s, w, size = r.uniform(-90, 80), r.uniform(-180, 170), 10 ** r.uniform(-4, 2)
        boxes.append((i, s, w, s + size, w + size * r.random()))
    got = points_in_boxes(
        spark.createDataFrame(pts, "p int, lat double, lon double"),
        spark.createDataFrame(boxes, "b int, south double, west double, north double, east double"))
    want = {(p, b) for p, y, x in pts for b, s, w, n, e in boxes if s <= y <= n and w <= x <= e}
    found = [(r_.p, r_.b) for r_ in got.collect()]
    assert set(found) == want and len(found) == len(want)


def test_nearest_snapshot_hours(spark, rows):
    stamps = ["2024-03-01T010500", "2024-03-01T011500", "2024-03-01T225900", "2024-03-01T120000"]
    snaps = spark.createDataFrame([(s,) for s in stamps], "call_timestamp string")
    asked = [("a", "2024-03-01", "0110"), ("b", "2024-03-01", "0059"), ("c", "2024-03-01", "2330"),
             ("d", "2024-03-01", "121500"), ("e", "2024-03-01", "0500"), ("f", "2024-03-02", "0110")]
    got = nearest_snapshot(spark.createDataFrame(asked, "id string, date string, time string"), snaps)
    assert rows(got, "id", "nearest_ts") == [
        ("a", stamps[0]),   # a tie goes to the earlier one
        ("b", stamps[1]),   # hour 00 looks in hour 01
        ("c", stamps[2]),   # hour 23 looks in hour 22
        ("d", stamps[3]), ("e", None), ("f", None)]


def test_keep_last_on_a_hot_key(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"), "id",
        F.lit("x").alias("v"))
    got = {r.key: r.id for r in keep_last(df, ["key"], ["id"]).collect()}
    assert got[0] == 9999 and len(got) == 6667


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-5, 5)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=20))
def test_melt_and_back(spark, data):
    rows_ = [(i, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(rows_, "i int, g int, a int, b int")
    long = reshape.melt(df, ["i", "g"], ["a", "b"])
    back = long.groupBy("i", "g").agg(*[
        F.max(F.when(F.col("variable") == c, F.col("value"))).alias(c) for c in ("a", "b")])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows_, key=repr)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_outer_merge_is_a_full_join(spark, left, right):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, x int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k int, y int")
    got = sorted(map(tuple, joins.outer_merge(a, b, ["k"]).select("k", "x", "y").collect()), key=repr)
    want = sorted(map(tuple, a.join(b, ["k"], "outer").select("k", "x", "y").collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_a_join(spark, rows, how):
    big = spark.range(300).selectExpr("id", "id % 7 * (id % 3) AS k")
    side = spark.range(5).selectExpr("id AS k", "id * 10 AS y")
    assert rows(joins.spread_join(big, side, ["k"], how)) == rows(big.join(side, ["k"], how))
    with pytest.raises(ValueError):
        joins.spread_join(big, side, ["k"], "outer")


def test_crosstab_margins(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 1), ("b", None)], "p string, t int")
    assert rows(aggregates.crosstab_wide(df, "p", "t", [1, 2])) == [
        ("Total", 1, 2, 3), ("a", 1, 1, 2), ("b", 0, 1, 1)]
    long = {(r[0], r[1]): r[2] for r in aggregates.crosstab_long(df, "p", "t").collect()}
    assert long[("Total", "Total")] == 3 and long[("a", "Total")] == 2 and long[("Total", "2")] == 2


def test_accuracy_counts_null_as_wrong(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (None, 1), (None, None)], "y int, p int")
    r = aggregates.accuracy(df, "y", "p").first()
    assert (r.n_correct, r.n_rows, r.accuracy) == (1, 4, 0.25)


def test_profile_treats_gaps_as_zero(spark):
    df = spark.createDataFrame([(1, 4.0), (1, None)], "k int, v double")
    assert aggregates.mean_profile(df, ["k"], ["v"]).first().v == 2.0


def test_points(spark):
    df = spark.createDataFrame([("(1.5, 103.25)",), ("1.5, 103.25",), ("1.5 103.25",), ("junk",),
                                ("1.5",), (None,)], "s string")
    got = [None if r[0] is None else tuple(r[0]) for r in df.select(points.parse_point("s")).collect()]
    assert got == [(1.5, 103.25)] * 3 + [None] * 3
    box = df.limit(1).select(points.box_text(points.bounding_box(
        F.struct(F.lit(2.5).alias("lat"), F.lit(1.5).alias("lon")),
        F.struct(F.lit(0.5).alias("lat"), F.lit(3.5).alias("lon"))))).first()[0]
    assert box == "0.5,1.5,2.5,3.5"


def test_time_text(spark):
    df = spark.createDataFrame([("2022-03-21T23:55:48+08:00",), ("2022-03-22",), ("soon",)], "s string")
    assert [r[0] for r in df.select(timetext.canonical("s")).collect()] == [
        "2022-03-21T235548", "2022-03-22T000000", None]
    assert timetext.bound("2022-03-21", 24) == "2022-03-21T240000"
    assert timetext.bound("2022-03-21", 24) > "2022-03-21T235959"
    with pytest.raises(ValueError):
        timetext.bound("2022-03-21", 25)
    now = spark.range(1).select(timetext.local_now(), F.current_timestamp().cast("timestamp_ntz"))
    local, utc = now.first()
    assert (int(local[11:13]) - utc.hour) % 24 == 8


def test_time_text_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10T02:30:00",)], "s string")   # skipped hour there
        c = timetext.canonical("s")
        assert df.select(c, timetext.to_ntz(c).cast("string")).first() == (
            "2024-03-10T023000", "2024-03-10 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_labels_and_nulls(spark):
    df = spark.createDataFrame([("Mild",), ("NaN",), (None,), ("Odd",)], "s string")
    got = df.select(labels.ordinal("s"), labels.level("s"), labels.is_known("s"),
                    labels.show_missing("s")).collect()
    assert [tuple(r) for r in got] == [
        (1, 2, True, "Mild"), (None, 1, False, "NaN"), (None, 1, False, "NaN"),
        (None, None, True, "Odd")]
    mixed = spark.createDataFrame([("nan", float("nan")), ("", 1.0)], "t string, v double")
    assert [tuple(r) for r in nulls.normalise(mixed).collect()] == [(None, None), (None, 1.0)]


def test_range_guards_and_defaults(spark):
    df = spark.createDataFrame([("2024-03-01T000500", 1), ("2024-03-02T235959", 2)],
                               "call_timestamp string, cam_id int")
    assert reports.in_range(df).count() == 2
    assert reports.in_range(df, "2024-03-02").count() == 1
    assert reports.in_range(df, "", "2024-03-01", 0, 24).count() == 1
    assert reports.in_range(df, "", "", 0, 0).count() == 1
    assert reports.in_range(df, camera="2").count() == 1
    with pytest.raises(ValueError):
        reports.in_range(df, "2024-03-02", "2024-03-01")


def test_profile_lookup_defaults(spark, rows):
    profile = spark.createDataFrame(
        [(1001, 1, "01", 1.0), (1001, 1, "22", 2.0), (5, 1, "07", 3.0)],
        "cam_id long, direction long, time_hr string, v double")
    asked = spark.createDataFrame([(None, ""), (1001, "000000"), (1001, "233000"), (5, "0730"), (5, "08")],
                                  "cam_id long, time string")
    assert rows(reports.profile_lookup(profile, asked), "cam_id", "time_hr", "v") == [
        (1001, "01", 1.0), (1001, "22", 2.0), (5, "07", 3.0)]

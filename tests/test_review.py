"""Cases that once gave wrong answers without failing."""

import pytest
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.operators import align, joins
from feedloom.operators.aggregates import crosstab_wide
from feedloom.operators.boxes import in_cells, points_in_boxes
from feedloom.operators.nearest import nearest
from feedloom.operators.nearest_time import nearest_snapshot
from feedloom.plans import feeds as N
from feedloom.plans import reports, tabulate
from tests import fixtures as X


def congestion(spark, rows, extra=""):
    return spark.createDataFrame(
        [(1, 1, label, "t1", *more) for label, *more in rows],
        f"camera_id long, direction long, trafficCongestion string, call_timestamp string{extra}")


@pytest.mark.parametrize("labels", [("None", "Heavy"), ("Heavy", "None"), ("Mild", None)])
def test_last_landed_label_counts(spark, labels):
    by_batch = congestion(spark, [(x, i) for i, x in enumerate(labels)], ", batch long")
    by_file = congestion(spark, [(x, i, f"f{i}") for i, x in enumerate(labels)],
                         ", landed_at long, landed_file string")
    for df in (by_batch, by_file):
        row = N.congestion(df.orderBy(F.rand(3))).first()
        assert row[S.LABEL] == labels[-1] and "batch" not in row


def test_corrected_day_takes_no_second_slot(spark):
    names = S.FORECAST_4DAY.fieldNames()
    day = lambda d, text, batch: tuple(
        {"4day_date": f"2024-03-0{d}T000000", "4day_forecast": text, "call_timestamp": "t",
         "4day_update_timestamp": "u"}.get(n, 1.0 if n.endswith(("low", "high")) else "x")
        for n in names) + (batch,)
    rows = [day(d, f"f{d}", 0) for d in (2, 3, 4, 5)] + [day(2, "a corrected", 1)]
    df = spark.createDataFrame(rows, ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in S.FORECAST_4DAY) + ", batch int")
    row = N.forecast_4day(df).first()
    assert [row[f"four_day_forecast_{i}"] for i in S.DAYS] == ["a corrected", "f3", "f4", "f5"]


def test_points_without_a_place_meet_nothing(spark, rows):
    nan = float("nan")
    p = spark.createDataFrame([(1, 1.0, 103.0), (2, nan, 103.0), (3, 1.0, None)],
                              "p long, lat double, lon double")
    a = spark.createDataFrame([("x", 1.1, 103.0), ("y", nan, 1.0), ("z", None, 1.0)],
                              "a string, lat double, lon double")
    for small in (0, 100):
        assert rows(nearest(p, a, small_rows=small), "p", "a") == [(1, "x")]


def test_every_item_of_a_payload_counts(spark):
    item = lambda t: {"timestamp": t, "readings": [{"station_id": "S1", "value": 1.0}]}
    doc = {"items": [item("2024-03-01T00:00:00+08:00"), item("2024-03-01T00:05:00+08:00")],
           "metadata": {"stations": []}}
    df = spark.createDataFrame([("t", doc)], _payload(S.PAYLOAD_READINGS))
    got = [r["timestamp"] for r in tabulate.rainfall(df).orderBy("timestamp").collect()]
    assert got == ["2024-03-01T000000", "2024-03-01T000500"]


def _payload(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField("call_timestamp", T.StringType()),
                         T.StructField("payload", schema)])


def test_blank_camera_means_the_default(spark, rows):
    profile = spark.createDataFrame([(1001, 1, "01", 5.0), (7, 1, "09", 6.0)],
                                    "cam_id long, direction int, time_hr string, v double")
    asked = spark.createDataFrame([("", ""), (" ", None), ("7", "0930"), ("x", "0930"), (None, "00")],
                                  "cam_id string, time string")
    assert rows(reports.profile_lookup(profile, asked), "cam_id", "time_hr") == [(1001, "01"), (7, "09")]
    wide = spark.createDataFrame([("2024-03-01T0%d0000" % h, c, 1, "Mild") for h in (1, 2) for c in (1001, 2)],
                                 "call_timestamp string, cam_id long, direction int, trafficcongestion string")
    assert reports.congestion_series(wide, camera="").count() == 2
    assert reports.congestion_series(wide, camera=reports.ALL_CAMERAS).count() == 4


def test_period_is_checked_once_its_ends_are_known(spark):
    wide = spark.createDataFrame([("2024-03-01T010000", 1), ("2024-03-05T010000", 1)],
                                 "call_timestamp string, cam_id long")
    assert reports.in_range(wide, "", "2024-03-01").count() == 1
    assert reports.in_range(wide.limit(0), "", "2024-03-01").count() == 0
    with pytest.raises(Exception, match="before its start"):
        reports.in_range(wide, "2024-03-06", "").collect() or reports.in_range(
            wide, "", "2024-02-01").collect()
    held = spark.createDataFrame([("2024-03-05T000000",)], "call_timestamp string")
    assert reports.in_range(wide, "", "", snapshots=held).count() == 1


def test_blank_image_request_means_the_first_snapshot(spark, rows):
    held = spark.createDataFrame([("2024-03-02T010500",), ("2024-03-01T020700",)], "call_timestamp string")
    asked = spark.createDataFrame([("", "0105"), ("2024-03-02", None), ("2024-03-02", "0000")],
                                  "date string, time string")
    assert rows(nearest_snapshot(asked, held), "nearest_ts") == [
        ("2024-03-01T020700",), ("2024-03-01T020700",), ("2024-03-02T010500",)]


def test_equal_rows_are_spread_over_the_salts(spark):
    big = spark.createDataFrame([(1, "x")] * 4000, "k long, v string")
    side = spark.createDataFrame([(1, "s")], "k long, s string")
    out = joins.spread_join(big, side, ["k"], salts=4)
    assert out.count() == 4000
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rand(7)" in text


def test_a_class_without_a_column_fails(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "r string, c string")
    assert rows(crosstab_wide(df, "r", "c", ["x", "y"])) == [("Total", 1, 1, 2), ("a", 1, 1, 2)]
    with pytest.raises(Exception, match="outside the classes: y"):
        crosstab_wide(df, "r", "c", ["x"]).collect()


def test_points_of_a_hot_cell_are_dealt(spark):
    points = spark.range(3000).selectExpr("id", "1.0D + id / 1e5 AS lat", "103.0D AS lon")
    boxes = spark.createDataFrame([(1, -90.0, -180.0, 90.0, 180.0), (2, 1.0, 102.9, 1.01, 103.1)],
                                  "b long, south double, west double, north double, east double")
    found = points_in_boxes(points, boxes)
    assert {r["b"]: r["count"] for r in found.groupBy("b").count().collect()} == {1: 3000, 2: 1001}
    assert "__salt" in found._jdf.queryExecution().optimizedPlan().toString()


def test_points_seldom_meet_boxes_that_do_not_hold_them(spark):
    points = spark.range(900).selectExpr("id", "1.0D + (id % 30) / 60 AS lat", "103.0D + floor(id / 30) / 60 AS lon")
    boxes = spark.range(200).selectExpr("id AS b", "1.0D + (id % 20) / 50 AS south", "103.0D + floor(id / 20) / 25 AS west") \
        .selectExpr("*", "south + 0.12D AS north", "west + 0.12D AS east")
    held = points_in_boxes(points, boxes).count()
    assert held > 5000 and in_cells(points, boxes, "lat", "lon", 16).count() < 2 * held


def test_missing_members_of_a_snapshot(spark, rows):
    held = spark.createDataFrame([("t1", 1, 1), ("t1", 1, 1), ("t2", 1, 2), ("t3", 9, 9)],
                                 "call_timestamp string, cam_id long, direction long")
    members = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "cam_id long, direction long")
    stamps = spark.createDataFrame([("t1",), ("t2",), ("t4",)], "call_timestamp string")
    assert rows(align.missing_members(held, members, stamps)) == [
        ("t1", 1, 2), ("t2", 1, 1), ("t4", 1, 1), ("t4", 1, 2)]


def test_today_is_the_feeds_day(spark):
    row = spark.range(1).select(F.to_date(F.convert_timezone(
        F.lit("UTC"), F.lit("Asia/Singapore"), F.current_timestamp().cast("timestamp_ntz"))).alias("d"),
        F.current_timezone().alias("z")).first()
    assert row["z"] == "UTC"
    df = spark.createDataFrame([(str(row["d"]) + "T000500",)], "call_timestamp string")
    assert align.slice_day(df, "today").count() == 1

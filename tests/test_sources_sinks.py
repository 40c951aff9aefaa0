"""Files in, files out."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.plans import tabulate
from feedloom.plans.feeds import camera_map
from feedloom.plans.wide_table import build_wide_table
from feedloom.session import scratch_dir, shared_root
from feedloom.sinks import append, compact, files
from feedloom.sources import csvfeeds, images, jdbc, payloads
from tests import fixtures as X


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


RAIN_A = ",timestamp,station_id,station_loc,station_name,rainfall_realtime,call_timestamp\n" \
         "0,2024-03-01T000000,S1,\"(1.3, 103.8)\",Alpha,0.2,2024-03-01T000500\n" \
         "1,2024-03-01T000000,S2,\"(1.4, 103.9)\",\"Be, ta\",,2024-03-01T000500\n"
RAIN_B = ",call_timestamp,rainfall_realtime,station_id,timestamp,station_loc,station_name,more\n" \
         "0,2024-03-01T001000,nan,S1,2024-03-01T000500,\"(1.3, 103.8)\",Alpha,z\n"


def test_csv_by_name_over_unlike_headers(spark, rows, tmp_path):
    put(f"{tmp_path}/rainfall-realtime_2024-03-01T000500.csv", RAIN_A)
    put(f"{tmp_path}/rainfall-realtime.csv", RAIN_B)
    put(f"{tmp_path}/rainfall-realtime-notes.csv", "a,b\n1,2\n")
    df = csvfeeds.read_csv_by_name(spark, str(tmp_path), S.RAINFALL,
                                   glob=compact.feed_glob("rainfall-realtime"))
    assert df.schema == S.RAINFALL
    assert rows(df, "call_timestamp", "station_id", "station_name", "rainfall_realtime") == [
        ("2024-03-01T000500", "S1", "Alpha", 0.2), ("2024-03-01T000500", "S2", "Be, ta", None),
        ("2024-03-01T001000", "S1", "Alpha", None)]


def test_csv_one_header_drops_index_and_casts(spark, rows, tmp_path):
    put(f"{tmp_path}/m.csv", "Unnamed: 0,cam_id,rainfall,not_rainfall,region,compass\n"
                             "1,1001.0,S1,N1,Kallang,south\n2,bad,S2,N1,Bedok,east\n")
    df = csvfeeds.read_csv(spark, str(tmp_path), S.SEED_MAPPING)
    assert rows(camera_map(df), "cam_id", "rainfall_station_id", "two_hr_forecast_area") == [
        (1001, "S1", "Kallang"), (None, "S2", "Bedok")]


def test_wide_files_are_read_and_bare_ones_fail(spark, tmp_path):
    more = ",".join(f"x{i}" for i in range(90))
    lines = RAIN_A.strip().split("\n")
    put(f"{tmp_path}/a.csv", RAIN_A)
    put(f"{tmp_path}/wide.csv", f"{more},{lines[0]}\n" + "".join(
        f"{',' * 89},{x}\n" for x in lines[1:]))
    df = csvfeeds.read_csv_by_name(spark, str(tmp_path), S.RAINFALL)
    assert df.count() == 2 * df.distinct().count()
    put(f"{tmp_path}/bare.csv", "1,2,3\n")
    with pytest.raises(ValueError, match="bare.csv"):
        csvfeeds.read_csv_by_name(spark, str(tmp_path), S.RAINFALL)


def test_one_header_reader_refuses_another_header(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "station_id,call_timestamp\nS1,2024-03-01T000500\n")
    put(f"{tmp_path}/b.csv", "call_timestamp,station_id\n2024-03-01T000500,S1\n")
    with pytest.raises(Exception, match="header"):
        csvfeeds.read_csv(spark, str(tmp_path), S.RAINFALL).collect()


def test_mixed_headers_are_read_without_a_join(spark, tmp_path):
    put(f"{tmp_path}/a.csv", RAIN_A)
    put(f"{tmp_path}/b.csv", "call_timestamp,rainfall_realtime\n2024-03-01T000500,1\n")
    df = csvfeeds.read_csv_by_name(spark, str(tmp_path), S.RAINFALL, landing=True)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    assert df.select("landed_file").distinct().count() == 2


def test_route_table_from_seed(spark, rows, tmp_path):
    head = ",".join(S.SEED_CAMERAS.fieldNames())
    put(f"{tmp_path}/c.csv", head + "\n"
        + '1002,1.5 103.5,TRUE,"1.25, 103.5","1.5, 103.75","1.0, 103.0",,,,,,,\n'
        + "2707,1.5 103.5,none" + "," * 10 + "\n"
        + '1001,1.25 103.25,x,,,"1.0, 103.0","1.5, 103.5",,,,,,\n')
    seed = csvfeeds.read_csv(spark, str(tmp_path), S.SEED_CAMERAS)
    assert [tuple(r) for r in tabulate.route_table(seed).drop("remarks").collect()] == [
        (1001, 2, "(1.25, 103.25)", "(1.0, 103.0)", "(1.5, 103.5)"),
        (1002, 1, "(1.5, 103.5)", "(1.25, 103.5)", "(1.5, 103.75)")]


def test_payload_files_with_gaps(spark, rows, tmp_path):
    doc = {"items": [{"timestamp": "2024-03-01T00:00:00+08:00",
                      "readings": [{"station_id": "S1", "value": 0.5}, {"station_id": "S8", "value": 2}]}],
           "metadata": {"stations": [
               {"id": s, "name": s.lower(), "location": {"latitude": 1.5, "longitude": 103.5}}
               for s in ("S1", "S2")]}}
    put(f"{tmp_path}/realtime-rainfall__2024-03-01T000500.json", json.dumps(doc, indent=5))
    docs = payloads.read_payloads(spark, str(tmp_path), S.PAYLOAD_READINGS)
    assert rows(tabulate.rainfall(docs)) == [
        ("2024-03-01T000000", "S1", "(1.5, 103.5)", "s1", 0.5, "2024-03-01T000500"),
        ("2024-03-01T000000", "S2", "(1.5, 103.5)", "s2", None, "2024-03-01T000500"),
        ("2024-03-01T000000", "S8", None, None, 2.0, "2024-03-01T000500")]


def test_route_without_resource_gives_nulls(spark, rows):
    texts = [(1, '{"resourceSets":[{"resources":[{"trafficCongestion":"Mild","travelDistance":1.5}]}]}'),
             (2, '{"resourceSets":[{"resources":[]}]}'), (3, '{"resourceSets":[]}'), (4, "{}"), (5, "oops")]
    df = spark.createDataFrame(texts, "camera_id long, text string").withColumns({
        "direction": F.lit(1).cast("long"), S.TS: F.lit(X.T1)})
    docs = payloads.parse_payloads(df, "text", S.PAYLOAD_ROUTE)
    got = rows(tabulate.route_fields(docs), "camera_id", "trafficCongestion", "travelDistance")
    assert got == [(1, "Mild", 1.5)] + [(i, None, None) for i in (2, 3, 4, 5)]
    routes = spark.createDataFrame([(1, 1, "a"), (9, 1, "b")], "camera_id long, direction long, remarks string")
    routes = routes.selectExpr("*", "null AS cam_loc", "null AS dir_start", "null AS dir_finish")
    assert tabulate.congestion(docs, routes).count() == 6


def test_fourth_period_is_left_out_of_the_wide_row(spark):
    period = {"time": {"start": "2024-03-01T06:00:00+08:00", "end": "2024-03-01T12:00:00+08:00"},
              "regions": {r: f"in {r}" for r in S.REGIONS}}
    item = {"valid_period": period["time"], "general": {"forecast": "Fair"}, "periods": [period] * 4}
    df = spark.createDataFrame([(X.T1, json.dumps({"items": [item]}))], "call_timestamp string, t string")
    docs = payloads.parse_payloads(df, "t", S.PAYLOAD_24HR)
    wide = tabulate.forecast_24hr(docs)
    assert wide.columns == S.FORECAST_24HR.fieldNames()
    assert wide.first()["24hr_period_3_forecast_west"] == "in west"
    assert tabulate.periods_long(docs).select("period").distinct().count() == 4


def test_image_catalog(spark, rows, tmp_path):
    for name in ("2024-03-01T000500_1001.jpg", "2024-03-01T000500_2707.jpg", "odd.jpg", "a.txt"):
        put(f"{tmp_path}/d/{name}", "abc")
    got = images.image_catalog(spark, str(tmp_path))
    assert rows(got, S.TS, "cam_id", "length", "archive_name") == [
        (X.T1, 1001, 3, "2024-03-01T000500.zip"), (X.T1, 2707, 3, "2024-03-01T000500.zip")]


def test_jdbc_predicates_cover_every_day_once():
    first, last = dt.date(2024, 2, 27), dt.date(2024, 3, 2)
    for days in (1, 2, 10):
        preds = jdbc.day_predicates(first, last, days=days)
        for text in ("2020-01-01T000000", "2024-02-27T000000", "2024-02-29T235959",
                     "2024-03-01T000000", "2030-01-01T000000", None):
            hits = 0
            for p in preds:
                tests = []
                for part in p.split(" OR "):
                    if "IS NULL" in part:
                        tests.append(text is None)
                    elif part == "1 = 1":
                        tests.append(True)
                    else:
                        ok = text is not None
                        for c in part.split(" AND "):
                            _, op, v = c.split(" ")
                            v = v.strip("'")
                            ok = ok and (text >= v if op == ">=" else text < v)
                        tests.append(ok)
                hits += any(tests)
            assert hits == 1, (days, text)
    with pytest.raises(ValueError):
        jdbc.day_predicates(last, first)


def test_append_twice_adds_nothing(spark):
    path = scratch_dir(spark, "t")
    wide = build_wide_table(X.feeds(spark))
    for _ in range(3):
        append.append_new(wide, path)
    table = spark.read.parquet(path)
    assert table.count() == wide.count() == 6
    more = wide.withColumn("call_timestamp", F.lit(X.T3))
    append.append_new(more.unionAll(wide), path)
    assert spark.read.parquet(path).count() == 9
    assert files.key_violations(spark.read.parquet(path), S.WAREHOUSE_KEY).count() == 0


def test_bulk_copy_text(spark):
    path = scratch_dir(spark, "t")
    files.write_bulk_copy(build_wide_table(X.feeds(spark)), path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert len(lines) == 6 and all(line.count(",") == 64 for line in lines)
    assert lines[1].startswith("2024-03-01T000500,1001,2,south,Kallang,N1,R1,0.5,5.0,90.0,80.0,27.0,Cloudy,")
    assert lines[1].endswith(",")       # the unknown label


def test_single_csv_is_one_file(spark):
    path = scratch_dir(spark, "t")
    files.write_single_csv(spark.range(1000).repartition(4), path)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert spark.read.option("header", True).csv(path).count() == 1000


def test_compaction(spark, rows, tmp_path):
    put(f"{tmp_path}/rainfall-realtime_2024-03-01T000500.csv", RAIN_A)
    put(f"{tmp_path}/rainfall-realtime.csv", RAIN_A + RAIN_A.split("\n", 1)[1])
    plain, once = scratch_dir(spark, "t"), scratch_dir(spark, "t")
    compact.compact(spark, str(tmp_path), plain, "rainfall-realtime")
    compact.compact(spark, str(tmp_path), once, "rainfall-realtime", dedupe=True)
    assert spark.read.parquet(plain).count() == 6
    assert rows(spark.read.parquet(once), "station_id", "rainfall_realtime") == [("S1", 0.2), ("S2", None)]
    assert len(os.listdir(tmp_path)) == 2       # inputs stay


def test_dedupe_within_or_across_snapshots(spark, rows):
    df = spark.createDataFrame([("k", X.T1, 1), ("k", X.T1, 2), ("k", X.T2, 1)],
                               "key string, call_timestamp string, v int")
    assert rows(compact.merge_snapshots(df, ("key",)), S.TS, "v") == [(X.T1, 2), (X.T2, 1)]
    assert rows(compact.merge_snapshots(df, ("key",), per_snapshot=False), S.TS, "v") == [(X.T2, 1)]
    assert compact.merge_snapshots(df).count() == 3


def test_snapshot_read_prunes_days(spark):
    path = scratch_dir(spark, "t")
    files.write_table(X.feeds(spark).rainfall, path)
    one = csvfeeds.read_snapshot(csvfeeds.read_table(spark, path), X.T3)
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_scratch_is_below_the_named_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") or shared_root(spark))

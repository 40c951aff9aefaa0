"""Streams end where the batch plans end."""

import json
import os

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.plans import tabulate
from feedloom.plans.wide_table import Feeds, build_wide_table
from feedloom.session import scratch_dir
from feedloom.sinks import compact, files, versions
from feedloom.streaming import fusing, landing
from tests import fixtures as X
from tests.test_sources_sinks import RAIN_A, RAIN_B, put


def test_csv_landing_picks_up_each_file_once(spark, rows, tmp_path):
    src, out, ck = f"{tmp_path}/in", scratch_dir(spark, "s"), scratch_dir(spark, "s")
    put(f"{src}/rainfall-realtime_2024-03-01T000500.csv", RAIN_A)
    run = lambda: landing.land_csv(spark, src, S.RAINFALL, out, ck).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 2
    put(f"{src}/rainfall-realtime_2024-03-01T001000.csv", RAIN_B)
    run()
    run()
    table = spark.read.parquet(out)
    assert rows(table, S.TS, "station_id", "rainfall_realtime") == [
        (X.T1, "S1", 0.2), (X.T1, "S2", None), (X.T2, "S1", None)]
    merged = scratch_dir(spark, "s")
    compact.compact_landed(spark, out, merged, "rainfall-realtime", dedupe=True)
    assert spark.read.parquet(merged).count() == 3


def test_json_landing_tabulates_payloads(spark, rows, tmp_path):
    src, out, ck = f"{tmp_path}/in", scratch_dir(spark, "s"), scratch_dir(spark, "s")
    run = lambda: landing.land_json(spark, src, S.PAYLOAD_READINGS, tabulate.rainfall, out,
                                    ck).awaitTermination()
    for i, value in ((1, 0.5), (2, 1.5)):
        doc = {"items": [{"timestamp": f"2024-03-0{i}T00:00:00+08:00",
                          "readings": [{"station_id": "S1", "value": value}]}],
               "metadata": {"stations": []}}
        put(f"{src}/realtime-rainfall__2024-03-0{i}T000500.json", json.dumps(doc, indent=2))
        run()
    assert rows(spark.read.parquet(out), S.TS, "timestamp", "station_id", "rainfall_realtime") == [
        ("2024-03-01T000500", "2024-03-01T000000", "S1", 0.5),
        ("2024-03-02T000500", "2024-03-02T000000", "S1", 1.5)]


def test_repeated_batch_replaces_itself(spark):
    out = scratch_dir(spark, "s")
    rain = X.feeds(spark).rainfall
    landing.write_batch(rain, out, "s", 0)
    landing.write_batch(rain, out, "s", 0)
    assert spark.read.parquet(out).count() == rain.count()
    landing.write_batch(rain, out, "s", 1)
    assert spark.read.parquet(out).count() == 2 * rain.count()


def test_archive_option(spark, tmp_path):
    src, arch = f"{tmp_path}/in", f"{tmp_path}/arch"
    out, ck = scratch_dir(spark, "s"), scratch_dir(spark, "s")
    for i in range(3):
        put(f"{src}/rainfall-realtime_2024-03-0{i + 1}T000500.csv", RAIN_A)
        landing.land_csv(spark, src, S.RAINFALL, out, ck, archive=arch, max_files=1).awaitTermination()
    assert spark.read.parquet(out).count() == 6
    moved = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert moved


def test_late_feed_holds_its_snapshot_back(spark, rows):
    base, f = scratch_dir(spark, "s"), X.feeds(spark)
    tables = {n: f"{base}/{n}" for n in Feeds.FACTS}
    target = f"{base}/target"
    fuse = lambda: fusing.fuse_stream(spark, tables, f.routes, f.camera_map, target,
                                      f"{base}/ck").awaitTermination()
    stamps = lambda: sorted({r[0] for r in versions.read(spark, target).select(S.TS).collect()})
    for n in Feeds.FACTS:
        part = getattr(f, n)
        files.write_table(part if n != "rainfall" else part.filter(F.col(S.TS) != X.T2), tables[n])
    fuse()
    assert stamps() == [X.T1]
    files.write_table(f.rainfall.filter(F.col(S.TS) == X.T2), tables["rainfall"])
    fuse()
    fuse()
    assert stamps() == [X.T1, X.T2]
    names = S.WAREHOUSE.fieldNames()
    assert rows(versions.read(spark, target), *names) == rows(build_wide_table(f), *names)


def test_stream_dedupe_spans_batches(spark):
    src, out = scratch_dir(spark, "s"), scratch_dir(spark, "s")
    df = spark.createDataFrame([(1, "2024-03-01 00:00:00"), (1, "2024-03-01 00:01:00"), (2, "2024-03-01 00:00:00")],
                               "k int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    run = lambda: landing.start(
        landing.dedupe_stream(spark.readStream.schema(df.schema).parquet(src), ["k"], "t", "1 hour"),
        lambda b, i: b.write.mode("append").parquet(out), f"{out}-ck").awaitTermination()
    df.write.parquet(src)
    run()
    df.filter("k = 1").write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(out).count() == 2


def test_streams_with_equal_batch_numbers_keep_each_other(spark, rows):
    out = scratch_dir(spark, "s")
    rain = X.feeds(spark).rainfall
    landing.write_batch(rain.filter(F.col(S.TS) == X.T1), out, "one", 0)
    landing.write_batch(rain.filter(F.col(S.TS) != X.T1), out, "two", 0)
    table = spark.read.parquet(out)
    assert rows(table, *rain.columns) == rows(rain, *rain.columns)
    order = {r.stream: r.batch for r in table.select("stream", "batch").distinct().collect()}
    assert order["one"] < order["two"]


def test_new_checkpoint_lands_beside_the_old_rows(spark, tmp_path):
    src, out = f"{tmp_path}/in", scratch_dir(spark, "s")
    put(f"{src}/rainfall-realtime_2024-03-01T000500.csv", RAIN_A)
    for _ in range(2):
        landing.land_csv(spark, src, S.RAINFALL, out, scratch_dir(spark, "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    assert spark.read.parquet(out).select("stream").distinct().count() == 2


def test_streamed_files_may_be_wide(spark, rows, tmp_path):
    src, out = f"{tmp_path}/in", scratch_dir(spark, "s")
    more = 300
    head = ",".join(["x%d" % i for i in range(more)] + ["station_id", S.TS, "rainfall_realtime"])
    put(f"{src}/a.csv", f"{head}\n" + ",".join(["1"] * more + ["S9", X.T1, "4.5"]) + "\n")
    landing.land_csv(spark, src, S.RAINFALL, out, scratch_dir(spark, "ck")).awaitTermination()
    assert rows(spark.read.parquet(out), S.TS, "station_id", "rainfall_realtime") == [(X.T1, "S9", 4.5)]


def test_corrected_snapshot_replaces_its_rows(spark, rows, monkeypatch):
    base, f = scratch_dir(spark, "s"), X.feeds(spark)
    tables, target = {n: f"{base}/{n}" for n in Feeds.FACTS}, f"{base}/target"
    built = []
    whole = fusing.build_wide_table
    monkeypatch.setattr(fusing, "build_wide_table", lambda *a, **b: built.append(1) or whole(*a, **b))

    def fuse():
        fusing.fuse_stream(spark, tables, f.routes, f.camera_map, target, f"{base}/ck").awaitTermination()
        return len(built)

    def same_as_full_build():
        feeds = Feeds(**{n: spark.read.parquet(tables[n]) for n in Feeds.FACTS}, routes=f.routes,
                      camera_map=f.camera_map)
        names = S.WAREHOUSE.fieldNames()
        return rows(versions.read(spark, target), *names) == rows(build_wide_table(feeds), *names)

    for n in Feeds.FACTS:
        part = getattr(f, n)
        if n == "congestion":
            part = part.limit(1).withColumn(S.TS, F.lit("2024-03-01T235500"))
        landing.write_batch(part, tables[n], "s", 0)
    assert fuse() == 0, "no feed is read for incomplete snapshots"
    landing.write_batch(f.congestion, tables["congestion"], "s", 1)
    assert fuse() == 1 and same_as_full_build()
    before = versions.current(spark, target)
    first = f.congestion.filter(F.col(S.TS) == X.T1).withColumn("trafficCongestion", F.lit("Heavy"))
    landing.write_batch(first, tables["congestion"], "s", 2)
    assert fuse() == 2 and same_as_full_build()
    labels = versions.read(spark, target).filter(F.col(S.TS) == X.T1).select(S.LABEL).distinct()
    assert [r[0] for r in labels.collect()] == ["Heavy"]
    now = versions.current(spark, target)
    assert now != before
    landing.write_batch(first, tables["congestion"], "s", 3)
    assert fuse() == 3 and versions.current(spark, target) == now, "an equal re-landing writes nothing"
    assert versions.vacuum(spark, target) and same_as_full_build()
    assert versions.vacuum(spark, target) == []

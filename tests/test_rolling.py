"""Days that get more readings after they were rolled."""

from pyspark.sql import functions as F

from feedloom.session import scratch_dir
from feedloom.sinks import compact, versions
from feedloom.streaming import landing


def test_late_batches_reach_rolled_days(spark):
    landed, rolled = scratch_dir(spark, "landed"), scratch_dir(spark, "rolled")
    first, second = "2024-01-01T080000", "2024-01-02T080000"

    def land(batch, *rows):
        df = spark.createDataFrame([(t, t, s, v) for t, s, v in rows], "call_timestamp string, "
                                   "timestamp string, station_id string, rainfall_realtime double")
        landing.write_batch(df, landed, "s", batch)

    def roll(before):
        days = compact.roll_closed_days(spark, landed, rolled, "rainfall-realtime", before)
        return [str(d) for d in days]

    def read():
        return sorted((r.call_timestamp, r.station_id, r.rainfall_realtime)
                      for r in compact.read_rolled(spark, landed, rolled).collect())

    land(0, (first, "a", 1.0), (first, "b", 2.0), (second, "a", 3.0))
    assert roll("2024-01-02") == ["2024-01-01"] and roll("2024-01-02") == []
    land(1, (first, "a", 0.5), (first, "c", 4.0))
    assert read() == [(first, "a", 0.5), (first, "a", 1.0), (first, "b", 2.0), (first, "c", 4.0),
                      (second, "a", 3.0)]
    assert roll("2024-01-02") == ["2024-01-01"] and roll("2024-01-02") == []
    want = [(first, "a", 0.5), (first, "b", 2.0), (first, "c", 4.0), (second, "a", 3.0)]
    assert read() == want
    land(2, (first, "c", 5.0))
    assert roll("2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert read() == [*want[:2], (first, "c", 5.0), want[3]]


def test_rolled_days_are_read_by_their_log(spark):
    landed, rolled = scratch_dir(spark, "landed"), scratch_dir(spark, "rolled")
    rain = spark.createDataFrame([(f"2024-01-0{d}T080000", f"2024-01-0{d}T080000", "a", float(d))
                                  for d in (1, 2, 3)], "call_timestamp string, timestamp string, "
                                 "station_id string, rainfall_realtime double")
    for k in range(3):
        landing.write_batch(rain.withColumn("rainfall_realtime", F.col("rainfall_realtime") + k), landed, "s", k)
        compact.roll_closed_days(spark, landed, rolled, "rainfall-realtime", "2024-01-03")
    now = compact.read_rolled(spark, landed, rolled)
    read = {f.rsplit("/", 1)[0] for f in now.inputFiles()}
    assert {f.split("/rolled-")[1].split("/", 1)[1] for f in read if "/rolled-" in f} == {
        "dt=2024-01-01/version=3", "dt=2024-01-02/version=3"}
    assert {f.split("dt=")[1].split("/")[0] for f in read if "/landed-" in f} == {"2024-01-03"}
    assert "took" not in now._jdf.queryExecution().toString()
    assert sorted((r.call_timestamp[:10], r.rainfall_realtime) for r in now.collect()) == [
        ("2024-01-01", 3.0), ("2024-01-02", 4.0), ("2024-01-03", 3.0), ("2024-01-03", 4.0), ("2024-01-03", 5.0)]
    assert len(versions.vacuum(spark, rolled)) == 4
    assert compact.read_rolled(spark, landed, rolled).count() == 5


def test_merge_replaces_rows_of_touched_days_only(spark):
    path = scratch_dir(spark, "t")
    make = lambda *r: spark.createDataFrame(r, "call_timestamp string, k int, v string")
    read = lambda: sorted((r[0] or "", r[1] or 0, r[2]) for r in versions.read(spark, path).drop("dt").collect())
    one, two = "2024-01-01T000000", "2024-01-02T000000"
    keys = ["call_timestamp", "k"]
    versions.merge_days(make((one, 1, "a"), (one, 2, "b"), (two, 1, "c"), (None, None, "d")), path, keys)
    assert [str(d) for d in versions.merge_days(make((one, 2, "B"), (one, 3, "e"), (two, 1, "c")), path, keys)] == ["2024-01-01"]
    assert versions.merge_days(make((None, None, "D")), path, keys) == [None]
    assert versions.merge_days(make((one, 1, "a")).limit(0), path, keys) == []
    assert read() == [("", 0, "D"), (one, 1, "a"), (one, 2, "B"), (one, 3, "e"), (two, 1, "c")]
    # A commit that died before its log row is not seen, and is written over.
    versions_log = versions.current(spark, path)
    make((one, 9, "lost")).withColumn("dt", F.to_date(F.lit("2024-01-01"))).withColumn("version", F.lit(4)).write.mode(
        "append").partitionBy("dt", "version").parquet(path)
    assert versions.current(spark, path) == versions_log and len(read()) == 5
    versions.merge_days(make((one, 1, "z")), path, keys)
    assert [r for r in read() if r[0] == one] == [(one, 1, "z"), (one, 2, "B"), (one, 3, "e")]

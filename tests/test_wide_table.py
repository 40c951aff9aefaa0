"""Edge cases of the fused table."""

import pytest
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.operators import align
from feedloom.plans import feeds as N
from feedloom.plans.wide_table import build_wide_table, complete_snapshots
from feedloom.sinks.files import conform, key_violations
from tests import fixtures as X

KEY = list(S.WAREHOUSE_KEY)


def test_incomplete_snapshot_is_left_out(spark, rows):
    assert rows(complete_snapshots(X.feeds(spark))) == [(X.T1,), (X.T2,)]


def test_contract(spark):
    wide = build_wide_table(X.feeds(spark))
    assert wide.schema.fieldNames() == S.WAREHOUSE.fieldNames()
    assert [f.dataType for f in wide.schema.fields] == [f.dataType for f in S.WAREHOUSE.fields]
    assert len(wide.columns) == 65
    assert key_violations(wide, KEY).count() == 0


def test_rows_and_gaps(spark, rows):
    wide = build_wide_table(X.feeds(spark))
    got = rows(wide.filter(F.col(S.TS) == X.T1), "cam_id", "direction", "rainfall_realtime",
               "wind_speed_realtime", "two_hr_forecast_value", "twenty_four_hr_period_2",
               "four_day_temperature_low_1", "four_day_temperature_low_4", S.LABEL)
    # Camera 2707 has no direction; station R2 has no value; N9 and Bedok have no reading.
    assert got == [
        (1001, 1, 0.5, 5.0, "Cloudy", "x2south", 20, 23, "Mild"),
        (1001, 2, 0.5, 5.0, "Cloudy", "x2south", 20, 23, None),
        (1002, 1, None, None, None, "x2east", 20, 23, "Heavy"),
    ]


def test_relanded_snapshot_does_not_multiply(spark, rows):
    f = X.feeds(spark)
    twice = f.map_facts(lambda df: df.unionAll(df))
    assert rows(build_wide_table(twice)) == rows(build_wide_table(f))
    assert build_wide_table(twice, unique=False).count() > build_wide_table(f).count()


def test_last_landed_row_wins(spark):
    feed = X.feeds(spark).rainfall.filter(f"call_timestamp = '{X.T1}' AND station_id = 'R1'")
    landed = feed.withColumn("batch", F.lit(0)).unionAll(
        feed.withColumn("rainfall_realtime", F.lit(0.25)).withColumn("batch", F.lit(1)))
    assert [tuple(r) for r in N.rainfall(landed).collect()] == [(X.T1, "R1", 0.25)]


@pytest.mark.parametrize("n, filled", [(3, 3), (4, 4), (6, 4)])
def test_number_of_forecast_days(spark, n, filled):
    dates = [f"2024-03-{d:02d}T000000" for d in range(2, 2 + n)]
    feed = spark.createDataFrame(X.day_rows(X.T1, reversed(dates)), S.FORECAST_4DAY)
    row = N.forecast_4day(feed).first()
    got = [row[f"four_day_forecast_{i}"] for i in S.DAYS]
    assert got == [f"f{dates[i][-2:]}" if i < filled else None for i in range(4)]


def test_latest_update_of_a_snapshot_wins(spark):
    old = X.day_rows(X.T1, X.DATES, update="2024-02-29T120000", base=1.0)
    new = X.day_rows(X.T1, X.DATES[:2], update="2024-03-01T000000", base=30.0)
    row = N.forecast_4day(spark.createDataFrame(old + new, S.FORECAST_4DAY)).first()
    assert [row[f"four_day_temperature_low_{i}"] for i in S.DAYS] == [30.0, 31.0, None, None]


@pytest.mark.parametrize("mode, as_of, stamps", [
    ("today", "2024-03-01", [X.T1, X.T2]), ("today", "2024-03-02", []),
    ("yesterday", "2024-03-02", [X.T1, X.T2]), ("before_today", "2024-03-02", [X.T1, X.T2]),
    ("before_today", "2024-03-01", []), ("latest", None, [X.T2]), ("all", None, [X.T1, X.T2]),
])
def test_slices(spark, mode, as_of, stamps):
    wide = build_wide_table(X.feeds(spark), mode, as_of)
    assert sorted({r[0] for r in wide.select(S.TS).collect()}) == stamps


def test_unknown_slice(spark):
    with pytest.raises(ValueError):
        align.slice_day(X.feeds(spark).rainfall, "tomorrow")


def test_missing_contract_column(spark):
    with pytest.raises(ValueError, match="trafficcongestion"):
        conform(build_wide_table(X.feeds(spark)).drop("trafficcongestion"))


def test_lead_by_congestion_equals_grid_join(spark, rows):
    """The plan without a grid gives what the grid and a join with congestion give."""
    f = X.feeds(spark)
    members = N.camera_map(f.camera_map).join(N.route_keys(f.routes), "cam_id")
    grid = align.expected_grid(complete_snapshots(f), members)
    via_grid = grid.join(N.congestion(f.congestion), KEY)
    assert rows(via_grid, *KEY, S.LABEL) == rows(build_wide_table(f).select(
        S.TS, F.col("cam_id").cast("long"), F.col("direction").cast("long"), S.LABEL))


def test_both_alignments_agree(spark, rows):
    facts = X.feeds(spark).facts()
    assert rows(align.common_keys(facts)) == rows(align.common_keys_intersect(facts))


def test_both_grids_agree(spark, rows):
    stamps = spark.createDataFrame([(X.T1,), (X.T2,)], "call_timestamp string")
    members = spark.range(50).withColumnRenamed("id", "cam_id")
    few, many = (align.expected_grid(stamps, members, buckets=n) for n in (None, 3))
    assert rows(few) == rows(many)
    assert few.count() == 100


def test_names_round_trip():
    for n in S.FORECAST_24HR.fieldNames() + S.FORECAST_4DAY.fieldNames():
        assert S.to_feed_name(S.to_warehouse_name(n)) == n
    assert S.captured_name("3_first(four_day_forecast)") == "four_day_forecast_3"
    assert S.captured_name("12_first(x)") == "x_12"
    assert S.strip_suffix("dir_start_4") == "dir_start"
    assert sorted(S.REPORT_ORDER) == sorted(S.WAREHOUSE.fieldNames())

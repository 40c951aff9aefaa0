"""Profiles from kept sums, and seeds."""

import pytest
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.plans import closed_days as C
from feedloom.plans import reports
from feedloom.sinks import versions
from feedloom.sources import seeds

MEASURES = ["a", "b"]


def _wide(spark, rows):
    return spark.createDataFrame(rows, f"{S.TS} string, cam_id int, direction int, a double, b int")


def test_profile_equals_the_full_scan_at_every_step(spark, tmp_path, rows):
    table, sums = str(tmp_path / "wide"), str(tmp_path / "sums")
    assert C.profile(spark, table, sums, MEASURES) is None
    assert C.keep_sums(spark, table, sums, "2024-03-03", MEASURES) == []
    first = [(f"2024-03-0{d}T0{h}0000", c, 1, float(d * h), None if c == 2 else h)
             for d in (1, 2, 3) for h in (1, 2) for c in (1, 2)] + [("bad", 1, 1, 4.0, 4)]
    steps = [first,
             [("2024-03-01T010000", 1, 1, 50.0, 5)],    # a corrected row of a closed day
             [("2024-03-02T030000", 7, 2, None, 8)],    # a late one, with a new hour
             [("2024-03-04T010000", 1, 1, 2.0, 2)]]     # a new day
    for step in steps:
        versions.merge_days(_wide(spark, step), table)
        want = rows(reports.hourly_profile(versions.read(spark, table), MEASURES))
        assert rows(C.profile(spark, table, sums, MEASURES)) == want
        C.keep_sums(spark, table, sums, "2024-03-03", MEASURES)
        assert rows(C.profile(spark, table, sums, MEASURES)) == want
    assert C.keep_sums(spark, table, sums, "2024-03-03", MEASURES) == []


def test_closed_days_are_not_scanned(spark, tmp_path):
    table, sums = str(tmp_path / "wide"), str(tmp_path / "sums")
    versions.merge_days(_wide(spark, [(f"2024-03-0{d}T010000", 1, 1, 1.0, 1) for d in (1, 2, 3)]), table)
    days = C.keep_sums(spark, table, sums, "2024-03-03", MEASURES)
    assert sorted(map(str, days)) == ["2024-03-01", "2024-03-02"]
    files = C.profile(spark, table, sums, MEASURES).inputFiles()
    assert [f for f in files if "/wide/" in f and "dt=2024-03-03" not in f] == []
    versions.merge_days(_wide(spark, [("2024-03-02T010000", 1, 1, 9.0, 1)]), table)
    assert list(map(str, C.keep_sums(spark, table, sums, "2024-03-03", MEASURES))) == ["2024-03-02"]


def _seed(tmp_path, text):
    (tmp_path / "seed.csv").write_text(text)
    return str(tmp_path / "seed.csv")


def test_seed_is_bound_by_name(spark, tmp_path, rows):
    path = _seed(tmp_path, "dir_finish_1,dir_start_1,camera_id,extra,dir_start_2\nB,A,1001,x,\nC,,1002,y,D\n")
    got = seeds.routes(seeds.read_seed(spark, path, S.SEED_CAMERAS))
    assert got.columns == S.ROUTES.fieldNames()
    assert rows(got) == [(1001, 1, None, None, "A", "B")]


@pytest.mark.parametrize("body", ["east,\"(1, 2)\"\neast,\"(3, 4)\"\n", ",\"(1, 2)\"\nwest,\"(3, 4)\"\n"])
def test_seed_without_or_with_equal_keys_fails(spark, tmp_path, body):
    path = _seed(tmp_path, "region,coord\n" + body)
    with pytest.raises(Exception, match="seed rows without or with equal region"):
        seeds.read_seed(spark, path, S.SEED_AREAS).collect()
    keyed = seeds.read_seed(spark, path, S.SEED_AREAS, keys=["coord"])
    assert keyed.filter(F.col("coord").isNotNull()).count() == 2

"""Shape of the physical plans."""

import re

import pytest

from feedloom.catalog import QUERIES
from feedloom.operators import align, dedupe, joins, reshape
from feedloom.plans.wide_table import Feeds, build_wide_table
from feedloom.session import scratch_dir
from feedloom.sinks import append, files
from feedloom.streaming import fusing
from tests import fixtures as X

SF = "/root/testdata/sf0.001"
# Iterating fits and streams have no single plan worth reading.
SKIP = {n for n in QUERIES if n.startswith(("forest_", "stream_", "profile_prediction", "one_hot"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_and_no_products(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|ArrowEval", text)


def test_columns_reach_the_scan(spark):
    text = plan(QUERIES["hourly_profile"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in text
    text = plan(QUERIES["crosstab_wide"](spark, SF))
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in text


def test_alignment_has_one_exchange(spark):
    feeds = [spark.range(10).selectExpr("cast(id AS string) AS call_timestamp") for _ in range(6)]
    assert plan(align.common_keys(feeds)).count("Exchange") == 1


def test_rank_limit_runs_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o", "id AS v")
    text = plan(reshape.ranked_pivot(df, ["k"], ["o"], ["v"], 4))
    below = text[text.index("Exchange"):]
    assert re.search(r"WindowGroupLimit.*4, Partial", below)
    assert text.count("Exchange") == 1


def test_dedupe_reduces_before_the_exchange_and_keeps_its_partitioning(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    other = spark.range(3).withColumnRenamed("id", "k")
    last = dedupe.keep_last(df, ["k"], ["o"])
    assert "partial_max_by" in plan(last)
    text = plan(last.hint("merge").join(other.hint("merge"), "k"))
    assert text.count("Exchange") == 2      # one per side, none after the aggregate


def test_reshapes_do_not_shuffle(spark):
    for name in ("melt_measures", "paired_unpivot", "period_region", "payload_rainfall",
                 "payload_24hr", "payload_2hr", "json_flatten", "point_parse"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF)), name


def test_first_rows_are_taken_without_a_global_sort(spark):
    assert "TakeOrderedAndProject(limit=1000" in plan(QUERIES["range_first"](spark, SF))
    assert "TakeOrdered" not in plan(QUERIES["range_report"](spark, SF))


def landed_feeds(spark):
    base, feeds = scratch_dir(spark, "p"), X.feeds(spark)
    for n in Feeds.FACTS:
        files.write_table(getattr(feeds, n), f"{base}/{n}")
    return Feeds(**{n: spark.read.parquet(f"{base}/{n}") for n in Feeds.FACTS},
                 routes=feeds.routes, camera_map=feeds.camera_map)


def test_wide_table_exchanges_each_feed_once(spark):
    """With broadcasts off; the list of complete snapshots has one exchange of its own."""
    feeds = landed_feeds(spark)
    snapshots = spark.createDataFrame([("2024-03-01T000500",)], "call_timestamp string")
    cost = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_wide_table(feeds, snapshots=snapshots))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", cost)
    by_snapshot = re.findall(r"Exchange hashpartitioning\(call_timestamp#\d+, \d+\)", text)
    assert len(by_snapshot) == 7  # six feeds and the snapshots
    facts = [x for x in re.findall(r"Exchange hashpartitioning\([^)]*\)", text)
             if "call_timestamp" in x]
    assert len(facts) == 7


def test_fusing_reads_only_touched_days(spark):
    feeds = landed_feeds(spark)
    touched = spark.createDataFrame([("2024-03-01T000500",)], "call_timestamp string")
    days = append.touched_days(touched)
    part = fusing.touched_feeds(feeds, touched, days)
    scans = [x for df in part.facts() for x in plan(df).split("\n") if "FileScan" in x]
    assert len(scans) == 6
    assert all(re.search(r"PartitionFilters: \[[^]]*2024-03-01", x) for x in scans)
    assert re.search(r"PartitionFilters: \[[^]]*2024-03-01",
                     plan(append.on_days(feeds.rainfall, days)))


def test_spread_join_reads_only_its_columns(spark):
    big = spark.read.parquet(f"{SF}/lineitem.parquet")
    side = spark.read.parquet(f"{SF}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey")
    text = plan(joins.spread_join(big, side, ["l_suppkey"]).select("l_orderkey", "s_name"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text


def test_day_slice_prunes_folders_of_every_feed(spark):
    text = plan(build_wide_table(landed_feeds(spark), "today", "2024-03-01"))
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert len(scans) == 12
    assert all(re.search(r"PartitionFilters: \[[^]]*2024-03-01", s) for s in scans)

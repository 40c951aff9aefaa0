"""Reshapes and renames."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog.base import READINGS, query, readings, table
from feedloom.operators import reshape as R
from feedloom.plans import tabulate

_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("melt_measures", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS measure, {m} AS amount FROM lineitem"
    for m in _MEASURES))
def melt_measures(spark, sf):
    return R.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], list(_MEASURES),
                  name="measure", value="amount")


def _pairs(part):
    """Part names as up to three (start, finish) pairs with gaps."""
    size = F.col("p_size")
    out = {}
    for i in (1, 2, 3):
        out[f"start_{i}"] = F.when(size % (i + 1) != 0, F.concat(F.col("p_name"), F.lit(f"/{i}")))
        out[f"finish_{i}"] = F.when(size % 5 != i, F.col("p_brand"))
    return part.withColumns(out)


@query("paired_unpivot", " UNION ALL ".join(f"""SELECT p_partkey,
  CAST({i} AS BIGINT) AS direction, p_name || '/{i}' AS start, p_brand AS finish
FROM part WHERE p_size % {i + 1} <> 0 AND p_size % 5 <> {i}""" for i in (1, 2, 3)))
def paired_unpivot(spark, sf):
    return R.paired_unpivot(_pairs(table(spark, sf, "part")), ["p_partkey"],
                            ["start", "finish"], (1, 2, 3))


@query("route_table", " UNION ALL ".join(f"""SELECT c_custkey AS camera_id,
  CAST({i} AS BIGINT) AS direction,
  '(' || CAST(c_custkey / 8 AS DOUBLE) || ', ' || CAST(100.5 AS DOUBLE) || ')' AS cam_loc,
  c_mktsegment AS remarks,
  '(' || CAST({i}.5 AS DOUBLE) || ', ' || CAST(c_custkey / 4 AS DOUBLE) || ')' AS dir_start,
  '(' || CAST({i}.25 AS DOUBLE) || ', ' || CAST(c_custkey / 2 AS DOUBLE) || ')' AS dir_finish
FROM customer WHERE c_custkey % {i + 2} <> 0""" for i in range(1, 6)))
def route_table(spark, sf):
    key = F.col("c_custkey")
    eighth = lambda n: (key / n).cast("string")
    cols = {}
    for i in range(1, 6):
        there = key % (i + 2) != 0
        cols[f"dir_start_{i}"] = F.when(there, F.concat(F.lit(f"{i}.5, "), eighth(4)))
        cols[f"dir_finish_{i}"] = F.concat(F.lit(f"{i}.25, "), eighth(2))
    seed = table(spark, sf, "customer").select(
        key.alias("camera_id"), F.concat(eighth(8), F.lit(" 100.5")).alias("cam_loc"),
        F.col("c_mktsegment").alias("remarks"), *[c.alias(n) for n, c in cols.items()])
    return tabulate.route_table(seed)


@query("ranked_pivot", """WITH r AS (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, """ + ", ".join(
    f"max(CASE WHEN rn = {i} THEN {c} END) AS {c}_{i}"
    for i in (1, 2, 3) for c in ("o_orderkey", "o_totalprice", "o_orderstatus"))
    + " FROM r GROUP BY o_custkey")
def ranked_pivot(spark, sf):
    return R.ranked_pivot(table(spark, sf, "orders"), ["o_custkey"],
                          ["o_orderdate", "o_orderkey"],
                          ["o_orderkey", "o_totalprice", "o_orderstatus"], 3)


@query("ranked_pivot_within", """WITH r AS (SELECT *,
  dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) AS g,
  row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderdate, o_orderkey) AS rn
  FROM orders)
SELECT o_custkey, """ + ", ".join(
    f"max(CASE WHEN rn = {i} THEN o_totalprice END) AS o_totalprice_{i}" for i in (1, 2, 3, 4))
    + " FROM r WHERE g = 1 GROUP BY o_custkey")
def ranked_pivot_within(spark, sf):
    return R.ranked_pivot(table(spark, sf, "orders"), ["o_custkey"],
                          ["o_orderdate", "o_orderkey"], ["o_totalprice"], 4,
                          within=[F.year("o_orderdate").desc()])


@query("period_region", f"WITH {READINGS} " + " UNION ALL ".join(
    f"""SELECT event_id, '{r}' AS compass, """ + ", ".join(
        f"'{r}' || CAST(k % {p + 3} AS VARCHAR) AS period_{p}" for p in (1, 2, 3)) + " FROM ev"
    for r in S.REGIONS))
def period_region(spark, sf):
    wide = readings(spark, sf).select("event_id", *[
        F.concat(F.lit(r), (F.col("k") % (p + 3)).cast("string")).alias(f"period_{p}_{r}")
        for p in (1, 2, 3) for r in S.REGIONS])
    return R.group_reshape(wide, ["event_id"], list(S.REGIONS), {
        f"period_{p}": (lambda r, p=p: f"period_{p}_{r}") for p in (1, 2, 3)}, name="compass")


@query("name_tail", """SELECT s_suppkey, split_part(s_name, '#', 2) AS tail FROM supplier""")
def name_tail(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", R.name_tail("s_name", "#").alias("tail"))


@query("bulk_rename", """SELECT n_nationkey AS twenty_four_hr_start, n_name AS four_day_forecast_1,
  n_regionkey AS two_hr_forecast_area FROM nation""")
def bulk_rename(spark, sf):
    feed = table(spark, sf, "nation").toDF("24hr_start", "4day_forecast_1", "2hr_forecast_area")
    return R.rename(feed, S.to_warehouse_name)


@query("prefix_and_place", """SELECT r_name AS "4day_r_name", r_regionkey AS r_regionkey FROM region""")
def prefix_and_place(spark, sf):
    return R.place(R.prefix(table(spark, sf, "region"), "4day_", keep=("r_regionkey",)),
                   "r_regionkey", 1)


@query("union_by_name", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(spark, sf):
    return R.stack_all([
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                            F.col("c_name").alias("name"),
                                            F.col("c_mktsegment").alias("segment")),
        table(spark, sf, "supplier").select(F.col("s_name").alias("name"),
                                            F.col("s_suppkey").alias("id")),
    ])

"""Features, splits and forests on the wide table and on line items."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog import wide as W
from feedloom.catalog.base import query, table
from feedloom.ml import features as M
from feedloom.ml import forest as R
from feedloom.plans import reports
from feedloom.plans.wide_table import build_wide_table
from feedloom.session import cut_lineage

_KEY = ("call_timestamp", "cam_id", "direction")
_CODE = """CASE trafficcongestion WHEN 'None' THEN 0.0::DOUBLE WHEN 'Mild' THEN 1.0::DOUBLE
  WHEN 'Medium' THEN 2.0::DOUBLE WHEN 'Heavy' THEN 3.0::DOUBLE END"""


def _wide(spark, sf):
    return build_wide_table(W.feeds(spark, sf))


@query("model_features", f"""WITH {W.WIDE_CTES} SELECT call_timestamp, cam_id, direction, {_CODE} AS label, """
       + ", ".join(f"CAST({f} AS DOUBLE) AS f{i}" for i, f in enumerate(S.FEATURES))
       + " FROM wide WHERE trafficcongestion IS NOT NULL AND "
       + " AND ".join(f"{f} IS NOT NULL" for f in S.FEATURES))
def model_features(spark, sf):
    rows = M.numeric_frame(_wide(spark, sf), keep=_KEY)
    vec = vector_to_array("features")
    return M.assembler(S.FEATURES).transform(rows).select(
        *_KEY, "label", *[vec[i].alias(f"f{i}") for i in range(len(S.FEATURES))])


@query("parsed_times", f"WITH {W.WIDE_CTES} SELECT cam_id, direction, " + ", ".join(
    f"substr({c}, 1, 10) || ' ' || substr({c}, 12, 2) || ':' || substr({c}, 14, 2) || ':' "
    f"|| substr({c}, 16, 2) AS {c}" for c in S.TIME_COLUMNS) + " FROM wide")
def parsed_times(spark, sf):
    rows = M.parse_times(_wide(spark, sf))
    return rows.select("cam_id", "direction",
                       *[F.col(c).cast("string").alias(c) for c in S.TIME_COLUMNS])


@query("key_split", """WITH b AS (SELECT o_orderkey, o_custkey,
  CAST('0x' || substr(md5(o_orderkey || '|' || o_custkey || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS b
  FROM orders)
SELECT o_orderkey, CASE WHEN b < 0.25 THEN 'test' WHEN b < 0.4375 THEN 'valid' ELSE 'train' END AS part
FROM b""")
def key_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return M.split(orders, ["o_orderkey", "o_custkey"]).select("o_orderkey", "part")


@query("category_slots", """SELECT CAST(o_custkey AS VARCHAR) AS category, row_number() OVER (
  ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS slot FROM orders GROUP BY o_custkey""")
def category_slots(spark, sf):
    """The dictionary of a column of many values, numbered where it lies."""
    return M.categories(table(spark, sf, "orders"), "o_custkey")


@query("one_hot", """WITH c AS (SELECT o_orderpriority, row_number() OVER (
    ORDER BY count(*) DESC, o_orderpriority) - 1 AS slot FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, o_orderpriority, CAST(slot AS BIGINT) AS slot,
  (SELECT CAST(count(*) AS BIGINT) + 1 FROM c) AS slots
FROM orders JOIN c USING (o_orderpriority)""")
def one_hot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    hot = vector_to_array("o_orderpriority_hot")
    rows = M.one_hot(orders, ["o_orderpriority"]).transform(orders)
    return rows.select("o_orderkey", "o_orderpriority",
                       (F.array_position(hot, 1.0) - 1).cast("long").alias("slot"),
                       F.size(hot).cast("long").alias("slots"))


_ITEM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _items(spark, sf):
    """Line items with a label their features decide, in three parts."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *_ITEM,
        (F.floor(F.col("l_quantity") / 13) % 4).cast("double").alias("label"))
    return M.split(rows, ["l_orderkey", "l_linenumber"])


def _parts(spark, sf):
    rows = _items(spark, sf)
    return [rows.filter(F.col("part") == p) for p in ("train", "valid", "test")]


@query("forest_accuracy")
def forest_accuracy(spark, sf):
    train, _, test = _parts(spark, sf)
    return R.evaluate(R.fit_once_read(train, _ITEM), test)


@query("forest_confusion")
def forest_confusion(spark, sf):
    train, _, test = _parts(spark, sf)
    return R.confusion(R.fit_once_read(train, _ITEM), test)


@query("forest_sweep")
def forest_sweep(spark, sf):
    """Every point up to 8 trees and depth 5 from one forest; the operator's default is the full
    grid of the searched ranges, whose forest is far larger."""
    train, valid, _ = _parts(spark, sf)
    grid = [(t, d) for t in range(1, 9) for d in range(1, 6)]
    return R.shared_sweep(train, valid, _ITEM, grid)


@query("profile_prediction")
def profile_prediction(spark, sf):
    """Forest on the wide table; a prediction per camera and hour that was asked for.

    The wide table is written once: the passes of the fit and the profile read it, so that neither
    their plans nor their tasks hold its joins again.
    """
    wide = cut_lineage(_wide(spark, sf).select(S.TS, S.LABEL, *S.FEATURES))
    rows = M.numeric_frame(wide, keep=M.CAMERA)
    model = R.fit_once_read(rows, S.FEATURES)
    profile = reports.hourly_profile(wide, [f for f in S.FEATURES if f not in M.CAMERA])
    hours = F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0")
    asked = table(spark, sf, "customer").select(
        (F.lit(1000) + F.col("c_custkey") % 25).alias("cam_id"), hours.alias("time"))
    return R.predict_profile(model, profile, asked)


@query("categorical_columns", "SELECT n_nationkey, n_name FROM nation")
def categorical_columns(spark, sf):
    nation = table(spark, sf, "nation")
    return nation.select("n_nationkey", *M.categorical_columns(nation))

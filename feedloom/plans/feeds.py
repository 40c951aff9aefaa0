"""Landed feeds to the columns the wide table takes from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions import timetext
from feedloom.operators.dedupe import LANDING, keep_last, landing_order
from feedloom.operators.reshape import group_reshape, ranked_pivot, rename
from feedloom.schemas import TS


def _landed(df: DataFrame, *columns) -> DataFrame:
    """Columns of a feed, and those that tell when its rows landed where it has them."""
    return df.select(*columns, *[c for c in LANDING if c in df.columns])


def _once(df: DataFrame, keys: list[str], unique: bool) -> DataFrame:
    """Last landed row per key; re-landed snapshots would otherwise multiply the joins.

    Rows are ordered by the stream batch, else by the time and path of their file; values decide
    only between rows of the same file.
    """
    if unique:
        df = keep_last(df, keys, landing_order(df, keys))
    return df.drop(*LANDING)


def _feed_columns(schema) -> list[str]:
    return [f"`{c}`" for c in schema.fieldNames()]


def rainfall(df: DataFrame, *, unique: bool = True) -> DataFrame:
    out = _landed(df, TS, F.col("station_id").alias("rainfall_station_id"), "rainfall_realtime")
    return _once(out, [TS, "rainfall_station_id"], unique)


def non_rainfall(df: DataFrame, *, unique: bool = True) -> DataFrame:
    out = _landed(rename(df, S.to_warehouse_name), TS,
                  F.col("station_id").alias("non_rainfall_station_id"), "wind_speed_realtime",
                  "wind_dir_realtime", "humidity_realtime", "air_temp_realtime")
    return _once(out, [TS, "non_rainfall_station_id"], unique)


def forecast_2hr(df: DataFrame, *, unique: bool = True) -> DataFrame:
    out = _landed(rename(df, S.to_warehouse_name), TS, "two_hr_forecast_area",
                  "two_hr_forecast_value")
    return _once(out, [TS, "two_hr_forecast_area"], unique)


def forecast_4day(df: DataFrame, *, unique: bool = True) -> DataFrame:
    """Days of the latest update of each snapshot side by side, four at most.

    Of a day that landed again the last landed row counts; a second one would take the place of
    a later day.
    """
    rows = rename(_landed(df, *_feed_columns(S.FORECAST_4DAY)), S.to_warehouse_name)
    rows = rows.withColumn("__day", timetext.day("four_day_date"))
    rows = _once(rows, [TS, "four_day_update_timestamp", "__day"], unique)
    values = [c for c in rows.columns
              if c not in (TS, "four_day_date", "four_day_update_timestamp", "__day")]
    return ranked_pivot(rows, [TS], ["__day", *values], values, len(S.DAYS),
                        within=[F.col("four_day_update_timestamp").desc()])


def forecast_24hr(df: DataFrame, *, unique: bool = True) -> DataFrame:
    """One row per snapshot and compass region with that region's three periods."""
    rows = _once(_landed(df, *_feed_columns(S.FORECAST_24HR)), [TS], unique)
    general = [c for c in S.FORECAST_24HR.fieldNames()
               if c.startswith(("24hr_start", "24hr_end", "24hr_general_"))
               or c.endswith(("_start", "_end"))]
    long = group_reshape(
        rows, [TS, *general], list(S.REGIONS),
        {f"24hr_period_{p}": (lambda r, p=p: f"24hr_period_{p}_forecast_{r}")
         for p in S.PERIODS}, name="compass")
    return rename(long, S.to_warehouse_name)


def congestion(df: DataFrame, *, unique: bool = True) -> DataFrame:
    out = _landed(df, TS, F.col("camera_id").alias("cam_id"), "direction",
                  F.col("trafficCongestion").alias(S.LABEL))
    return _once(out, [TS, "cam_id", "direction"], unique)


def route_keys(df: DataFrame) -> DataFrame:
    return df.select(F.col("camera_id").alias("cam_id"), "direction").distinct()


def camera_map(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({
        "rainfall": "rainfall_station_id", "not_rainfall": "non_rainfall_station_id",
        "region": "two_hr_forecast_area"})

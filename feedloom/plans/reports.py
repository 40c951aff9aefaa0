"""Analytics over the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions import labels, timetext
from feedloom.operators.aggregates import mean_profile
from feedloom.operators.nearest_time import clamp_hour, nearest_snapshot
from feedloom.operators.reshape import rename
from feedloom.schemas import TS
from feedloom.sources.images import image_name

# Fixed value: camera a blank entry stands for.
DEFAULT_CAMERA = 1001
ALL_CAMERAS = "all"


def hourly_profile(wide: DataFrame, measures=S.MEASURES) -> DataFrame:
    """Mean of every measure per camera, direction and hour of the day."""
    hour = timetext.hour_part(TS).alias("time_hr")
    return mean_profile(wide, ["cam_id", "direction", hour], list(measures))


def cameras(wide: DataFrame) -> DataFrame:
    return wide.select("cam_id").distinct().orderBy("cam_id")


def dates(wide: DataFrame) -> DataFrame:
    return wide.select(timetext.date_part(TS).alias("date")).distinct().orderBy("date")


def snapshot_times(wide: DataFrame) -> DataFrame:
    return wide.select(TS).distinct().select(
        TS, timetext.date_part(TS).alias("date"), timetext.hour_part(TS).alias("hour"),
        timetext.minute_part(TS).cast("int").alias("minute"))


def in_range(wide: DataFrame, start_date: str = "", end_date: str = "",
             start_hour: int = 0, end_hour: int = 24, *, camera=None,
             ts: str = TS, camera_column: str = "cam_id",
             snapshots: DataFrame | None = None) -> DataFrame:
    """Rows between two inclusive bounds; a blank date means the first or last one held.

    ``snapshots`` lists the timestamps of ``wide`` where the caller has them more cheaply; blank
    dates are looked up there. An end before the start fails, with blank dates once the job runs.
    """
    stamps = wide if snapshots is None else snapshots

    def bound(date, hour, pick):
        timetext.bound(date or "0", hour)
        if date:
            return F.lit(timetext.bound(date, hour))
        held = stamps.agg(pick(ts).alias("b")).select(
            timetext.bound_col(timetext.date_part("b"), F.lit(hour)))
        return held.scalar()

    low, high = bound(start_date, start_hour, F.min), bound(end_date, end_hour, F.max)
    if start_date and end_date:
        if timetext.bound(end_date, end_hour) < timetext.bound(start_date, start_hour):
            raise ValueError("the end of the period lies before its start")
        forward = F.lit(True)
    else:
        forward = F.assert_true(F.coalesce(low <= high, F.lit(True)), F.lit(
            "the end of the period lies before its start")).isNull()

    out = wide
    if "dt" in wide.columns:
        if start_date:
            out = out.filter(F.col("dt") >= F.lit(start_date).cast("date"))
        if end_date:
            out = out.filter(F.col("dt") <= F.lit(end_date).cast("date"))
    out = out.filter(forward & F.col(ts).between(low, high))
    if camera not in (None, ""):
        out = out.filter(F.col(camera_column) == int(camera))
    return out


def range_report(wide: DataFrame, start_date: str = "", end_date: str = "",
                 start_hour: int = 0, end_hour: int = 24, *, camera=None,
                 snapshots: DataFrame | None = None) -> DataFrame:
    """All rows of a period in time order, under feed names in display order."""
    part = in_range(wide, start_date, end_date, start_hour, end_hour, camera=camera,
                    snapshots=snapshots)
    return rename(by_snapshot(part).select(*S.REPORT_ORDER), S.to_feed_name)


def range_first(wide: DataFrame, n: int, *bounds, **how) -> DataFrame:
    """The first ``n`` rows of a report."""
    return range_report(wide, *bounds, **how).limit(n)


def by_snapshot(wide: DataFrame) -> DataFrame:
    """The table read in the order of snapshot, camera and direction."""
    return wide.orderBy(TS, "cam_id", "direction")


def congestion_series(wide: DataFrame, start_date: str = "", end_date: str = "",
                      start_hour: int = 0, end_hour: int = 24, *,
                      camera=DEFAULT_CAMERA) -> DataFrame:
    """Level per snapshot and direction of a camera, in time order.

    A blank camera means 1001; ``ALL_CAMERAS`` asks for every one.
    """
    camera = None if camera == ALL_CAMERAS else DEFAULT_CAMERA if camera in (None, "") else camera
    part = in_range(wide, start_date, end_date, start_hour, end_hour, camera=camera)
    return part.select(
        TS, "direction", timetext.date_part(TS).alias("date"),
        timetext.hhmm_part(TS).alias("time"), S.LABEL,
        labels.level(S.LABEL).alias("level"),
    ).orderBy("date", "time", "direction", TS)


def series_size(series: DataFrame) -> DataFrame:
    """Number of directions, snapshots and dates a series covers."""
    return series.agg(F.countDistinct("direction").alias("n_directions"),
                      F.countDistinct(TS).alias("n_calls"),
                      F.countDistinct("date").alias("n_dates"))


def series_by_direction(series: DataFrame) -> DataFrame:
    return series.groupBy("direction").agg(
        F.count(F.lit(1)).alias("n"), F.min("level").alias("min_level"),
        F.avg("level").alias("avg_level"), F.max("level").alias("max_level"),
        F.min(TS).alias("first_call"), F.max(TS).alias("last_call"))


def image_lookup(requests: DataFrame, snapshots: DataFrame, images: DataFrame,
                 ts: str = TS) -> DataFrame:
    """Catalog rows ``images`` for requests ``(date, time, cam_id)``.

    A request is answered by the image of its camera at the nearest snapshot of its hour; blanks
    mean camera 1001 and the first snapshot. Without such an image the catalog columns are NULL.
    """
    near = nearest_snapshot(requests, snapshots, ts=ts)
    text = F.trim(F.coalesce(F.col("cam_id").cast("string"), F.lit("")))
    near = near.withColumn("cam_id", F.when(text == "", str(DEFAULT_CAMERA)).otherwise(text))
    near = near.withColumn("file_name", image_name("nearest_ts", "cam_id"))
    rest = [c for c in images.columns if c not in (TS, "cam_id")]
    return near.join(images.select(*rest).distinct(), "file_name", "left")


def profile_lookup(profile: DataFrame, requests: DataFrame) -> DataFrame:
    """Profile rows for requests ``(cam_id, time)``; blanks mean camera 1001, hour 01."""
    hour = F.substring("time", 1, 2)
    hour = F.when(F.coalesce(hour, F.lit("")) == "", "01").otherwise(clamp_hour(hour))
    text = F.trim(F.coalesce(F.col("cam_id").cast("string"), F.lit("")))
    asked = requests.select(
        F.when(text == "", F.lit(DEFAULT_CAMERA)).otherwise(text.try_cast("long"))
        .cast("long").alias("cam_id"),
        hour.alias("time_hr")).distinct()
    return profile.join(asked, ["cam_id", "time_hr"])

"""Camera to nearest stations, forecast area and compass region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.points import parse_point
from feedloom.operators.nearest import nearest
from feedloom.plans import tabulate
from feedloom.session import SMALL_ROWS

# Anchor point of each compass region (name, latitude, longitude).
COMPASS = (
    ("north", 1.4171600757873817, 103.80906027423956),
    ("south", 1.2689570746680328, 103.82763148734753),
    ("east", 1.3474858448902267, 103.94089620103182),
    ("west", 1.3529774835842006, 103.70537681098106),
    ("central", 1.3569871019585316, 103.82099141380705),
)


def compass_anchors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COMPASS), "compass string, lat double, lon double")


def located(df: DataFrame, name: str, location: str, out: str, *,
            only: list[str] | None = None) -> DataFrame:
    """Distinct ``(out, lat, lon)`` of entities with a location text."""
    if only is not None:
        df = df.filter(F.col(name).isin(only))
    point = parse_point(location)
    return (df.select(F.col(name).alias(out), location).distinct()
            .select(out, point["lat"].alias("lat"), point["lon"].alias("lon")))


def camera_mapping(cameras: DataFrame, non_rain: DataFrame, rain: DataFrame,
                   areas: DataFrame, compass: DataFrame, *,
                   small_rows: int = SMALL_ROWS) -> DataFrame:
    """Four independent searches over ``(cam_id, lat, lon)``, joined by camera.

    Ties stay, so a camera has a row for each combination of equally near anchors.
    """
    def find(anchors: DataFrame) -> DataFrame:
        return nearest(cameras, anchors, small_rows=small_rows).drop("km")

    return (find(non_rain).join(find(rain), "cam_id").join(find(areas), "cam_id")
            .join(find(compass), "cam_id").withColumn("cam_id", F.col("cam_id").cast("long")))


def mapping_job(cameras: DataFrame, non_rain: DataFrame, rain: DataFrame, areas: DataFrame, *,
                only: list[str] | None = None, expected: int | None = None) -> DataFrame:
    """The camera map from the feeds themselves, in camera order.

    ``cameras`` are camera payloads, ``non_rain`` and ``rain`` landed feeds whose stations count
    once however often they report, ``areas`` the seed ``(region, coord)``. ``only`` lists the
    stations with full readings; ``expected`` fails the job on another number of cameras.
    """
    spots = tabulate.cameras(cameras).distinct()
    if expected is not None:
        spots = check_count(spots, expected)
    found = camera_mapping(
        spots, located(non_rain, "station_id", "station_loc", "non_rainfall_station_id", only=only),
        located(rain, "station_id", "station_loc", "rainfall_station_id"),
        located(areas, "region", "coord", "2hr_forecast_area"),
        compass_anchors(cameras.sparkSession))
    return found.orderBy("cam_id")


def check_count(cameras: DataFrame, expected: int) -> DataFrame:
    """Camera rows, failing the job if their number is not the expected one."""
    n = cameras.agg(F.count(F.lit(1))).scalar()
    ok = F.assert_true(n == expected, F.lit(f"expected {expected} cameras"))
    return cameras.filter(ok.isNull())

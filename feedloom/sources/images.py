"""Catalog of camera images named ``<call_timestamp>_<camera>.jpg``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import TS

NAME = r"(\d{4}-\d{2}-\d{2}T\d{6})_([^/_.]+)\.jpg$"


def image_name(ts, cam_id) -> Column:
    return F.concat(F.col(ts) if isinstance(ts, str) else ts, F.lit("_"),
                    (F.col(cam_id) if isinstance(cam_id, str) else cam_id).cast("string"),
                    F.lit(".jpg"))


def parse_names(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds snapshot time, camera, file and archive name; other files are left out."""
    stamp = F.regexp_extract(path, NAME, 1)
    cam = F.regexp_extract(path, NAME, 2)
    return df.filter(stamp != "").withColumns({
        TS: stamp,
        "cam_id": cam.try_cast("long"),
        "file_name": F.concat(stamp, F.lit("_"), cam, F.lit(".jpg")),
        "archive_name": F.concat(stamp, F.lit(".zip")),
    })


def image_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Lists image files; their content is not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg")
             .option("recursiveFileLookup", True).load(path).select("path", "length"))
    return parse_names(files)

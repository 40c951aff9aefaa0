"""Points inside boxes, as an equality join on grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import has_at_most

DEEPEST = 24
# Levels below the one whose cells are as large as the box: cells are 1/8 of that.
FINER = 3
# Below this level a cell is a tenth of a degree or more wide and may hold most points.
COARSE = 12
# Cells of boxes that every task may hold.
HELD = 200_000
CELL = ["__level", "__i", "__j", "__salt"]


def points_in_boxes(points: DataFrame, boxes: DataFrame, *, lat: str = "lat",
                    lon: str = "lon", salts: int = 16,
                    by: list[str] | None = None) -> DataFrame:
    """All (box, point) pairs with south <= lat <= north and west <= lon <= east.

    A box is filed in cells of a quarter to an eighth of its longer side, at most 81, so a point
    that meets it there seldom lies outside: what is compared follows the pairs that are found.
    A point looks in its one cell at each level that occurs. Boxes of the
    coarse levels are copied to ``salts`` places over which the points of a cell are dealt by a
    hash of the columns ``by``, else of all, so that a task that runs again deals them alike.
    The cells of boxes are counted first: a few go to every task, more meet the points by an
    exchange, as Spark takes them to be no more than the boxes.
    """
    inside = (F.col(lat).between(F.col("south"), F.col("north"))
              & F.col(lon).between(F.col("west"), F.col("east")))
    return in_cells(points, boxes, lat, lon, salts, by).filter(inside).drop(*CELL)


def in_cells(points: DataFrame, boxes: DataFrame, lat: str, lon: str, salts: int,
             by: list[str] | None = None) -> DataFrame:
    """The (box, point) pairs that meet in a cell, which hold all that ``points_in_boxes`` finds."""
    def cell(c, base, level):
        return F.floor((c - F.lit(base)) / (F.lit(360.0) / F.pow(F.lit(2.0), level))).cast("long")

    size = F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"))
    level = F.when(size <= 0, F.lit(DEEPEST)).otherwise(
        F.least(F.lit(DEEPEST), F.greatest(F.lit(0),
                F.floor(F.log2(F.lit(360.0) / size)).cast("int") + FINER)))
    valid = boxes.filter((F.col("south") <= F.col("north")) & (F.col("west") <= F.col("east")))
    filed = valid.withColumn("__level", level)
    rows = F.sequence(cell(F.col("south"), -180.0, F.col("__level")),
                      cell(F.col("north"), -180.0, F.col("__level")))
    cols = F.sequence(cell(F.col("west"), -180.0, F.col("__level")),
                      cell(F.col("east"), -180.0, F.col("__level")))
    filed = filed.withColumn("__i", F.explode(rows)).withColumn("__j", F.explode(cols))

    levels = valid.select(level.alias("l")).agg(F.collect_set("l").alias("s")).scalar()
    seen = points.withColumn("__level", F.explode(levels))
    seen = seen.withColumns({"__i": cell(F.col(lat), -180.0, F.col("__level")),
                             "__j": cell(F.col(lon), -180.0, F.col("__level"))})
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by or points.columns]), F.lit(salts))
    coarse, zero = F.col("__level") < COARSE, F.lit(0).cast("long")
    every = F.sequence(zero, F.lit(salts - 1).cast("long"))
    seen = seen.withColumn("__salt", F.when(coarse, deal).otherwise(zero))
    filed = filed.withColumn("__salt", F.explode(F.when(coarse, every).otherwise(F.array(zero))))
    few = has_at_most(filed, HELD)
    return seen.join(F.broadcast(filed), CELL) if few else seen.hint("merge").join(filed, CELL)

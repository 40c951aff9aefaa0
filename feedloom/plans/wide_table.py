"""One row per complete snapshot, camera and direction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.align import common_keys, slice_day, slice_latest
from feedloom.plans import feeds as N
from feedloom.schemas import TS, WAREHOUSE
from feedloom.session import has_at_most
from feedloom.sinks.files import conform


@dataclass
class Feeds:
    """Landed feeds and dimensions, in feed columns."""

    rainfall: DataFrame
    non_rainfall: DataFrame
    forecast_2hr: DataFrame
    forecast_24hr: DataFrame
    forecast_4day: DataFrame
    congestion: DataFrame
    routes: DataFrame
    camera_map: DataFrame

    FACTS = ("rainfall", "non_rainfall", "forecast_2hr", "forecast_24hr", "forecast_4day",
             "congestion")

    def facts(self) -> list[DataFrame]:
        return [getattr(self, n) for n in self.FACTS]

    def map_facts(self, how) -> "Feeds":
        """Same dimensions, every fact feed through ``how``."""
        rest = {n: getattr(self, n) for n in ("routes", "camera_map")}
        return Feeds(**{n: how(getattr(self, n)) for n in self.FACTS}, **rest)


def complete_snapshots(feeds: Feeds) -> DataFrame:
    """Timestamps every feed holds; a snapshot with a late feed waits."""
    return common_keys(feeds.facts(), TS)


def small_or_spread(cams: DataFrame) -> DataFrame:
    """The camera map with a broadcast hint if it is a few hundred cameras, as it should be."""
    return F.broadcast(cams) if has_at_most(cams) else cams


def build_wide_table(feeds: Feeds, mode: str = "all", as_of=None, *, unique: bool = True,
                     snapshots: DataFrame | None = None) -> DataFrame:
    """The 65-column table.

    The congestion feed leads: the table has no row without one, so the grid of snapshots
    and cameras never needs to exist. The day slice is applied to every feed, which prunes
    their folders. Each feed is dealt by snapshot once, and deduped and joined in that
    dealing: all keys hold the snapshot, so no side moves again. Narrow readings join before
    the wide forecasts. The complete snapshots restrict the four-day forecast, one row per
    snapshot, whose inner join restricts the rest.
    """
    spark = feeds.congestion.sparkSession
    # Lets joins on (snapshot, station) use sides that are both dealt by snapshot.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    feeds = feeds.map_facts(lambda df: slice_day(df, mode, as_of))
    if snapshots is None:
        snapshots = complete_snapshots(feeds)
    if mode == "latest":
        snapshots = slice_latest(snapshots)
        feeds = feeds.map_facts(lambda df: df.join(snapshots, TS, "left_semi"))

    cams = N.camera_map(feeds.camera_map).join(N.route_keys(feeds.routes), "cam_id")
    cams = small_or_spread(cams)
    feeds = feeds.map_facts(lambda df: df.repartition(TS))
    base = N.congestion(feeds.congestion, unique=unique).join(cams, ["cam_id", "direction"])
    days = N.forecast_4day(feeds.forecast_4day, unique=unique).join(snapshots, TS, "left_semi")
    out = (
        base.join(N.rainfall(feeds.rainfall, unique=unique), [TS, "rainfall_station_id"], "left")
        .join(N.non_rainfall(feeds.non_rainfall, unique=unique),
              [TS, "non_rainfall_station_id"], "left")
        .join(N.forecast_2hr(feeds.forecast_2hr, unique=unique),
              [TS, "two_hr_forecast_area"], "left")
        .join(N.forecast_24hr(feeds.forecast_24hr, unique=unique), [TS, "compass"])
        .join(days, TS)
    )
    return conform(out, WAREHOUSE)

"""Small feeds with known answers."""

from feedloom import schemas as S
from feedloom.plans.wide_table import Feeds

T1, T2, T3 = "2024-03-01T000500", "2024-03-01T001000", "2024-03-02T001500"


def day_rows(ts, dates, update="2024-03-01T000000", base=20.0):
    return [(d, f"f{d[-2:]}", base + i, base + i + 5, 60.0, 90.0, 10.0, 20.0, "NE", update, ts)
            for i, d in enumerate(dates)]


def region_row(ts, tag="x"):
    periods = []
    for p in S.PERIODS:
        periods += [f"start{p}", f"end{p}"] + [f"{tag}{p}{r}" for r in S.REGIONS]
    return ("s", "e", "Fair", 60.0, 90.0, 24.0, 33.0, 10.0, 20.0, "NE", *periods, ts)


DATES = ["2024-03-02T000000", "2024-03-03T000000", "2024-03-04T000000", "2024-03-05T000000"]


def feeds(spark, *, rain=None, four=None, congestion=None):
    """Three snapshots; the third lacks the two-hour forecast."""
    stamps = (T1, T2, T3)
    rain = rain if rain is not None else [
        (ts, sid, "(1.3, 103.8)", "n", v, ts)
        for ts in stamps for sid, v in (("R1", 0.5), ("R2", None))]
    non_rain = [(ts, "N1", "(1.3, 103.8)", "n", 5.0, 90.0, 80.0, 27.0, ts) for ts in stamps]
    two = [("Kallang", "(1.3, 103.8)", "Cloudy", ts, ts, ts) for ts in (T1, T2)]
    full = [region_row(ts) for ts in stamps]
    four = four if four is not None else [r for ts in stamps for r in day_rows(ts, DATES)]
    congestion = congestion if congestion is not None else [
        (cam, d, label, 1.0, 2.0, 3.0, "km", "s", ts, None, None, None, None)
        for ts in stamps for cam, d, label in
        ((1001, 1, "Mild"), (1001, 2, None), (1002, 1, "Heavy"), (2707, 1, "None"))]
    routes = [(1001, 1, None, None, None, None), (1001, 2, None, None, None, None),
              (1002, 1, None, None, None, None)]
    cams = [(1001, "N1", "R1", "Kallang", "south"), (1002, "N9", "R2", "Bedok", "east"),
            (2707, "N1", "R1", "Kallang", "west")]
    make = spark.createDataFrame
    return Feeds(make(rain, S.RAINFALL), make(non_rain, S.NON_RAINFALL),
                 make(two, S.FORECAST_2HR), make(full, S.FORECAST_24HR),
                 make(four, S.FORECAST_4DAY), make(congestion, S.CONGESTION),
                 make(routes, S.ROUTES), make(cams, S.SEED_MAPPING))

"""Nearest anchor of every point by great-circle distance; equal distances all stay."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.points import great_circle_km, unit_vector
from feedloom.session import SMALL_ROWS, count_up_to, cut_lineage

_STEP = 2          # grid levels per descent step: a cell has 4 x 4 x 4 children
_LEAF = 64         # anchors per cell at which the descent may end
_DEEPEST = 30      # cell edge of about a centimetre
_NAMED = 4         # anchors that a cell of the index names
_BUDGET = 1_000_000   # anchors named in all cells of a level of the index
_WORK = 16 * _BUDGET  # pairs of cell and anchor tried for a level


def nearest(points: DataFrame, anchors: DataFrame, *, small_rows: int = SMALL_ROWS,
            km: str = "km") -> DataFrame:
    """``points(.., lat, lon)`` and ``anchors(.., lat, lon)`` with further columns of their
    own. Returns the columns of both but the coordinates, and the distance.

    Points and anchors without a place, a coordinate being null or NaN, meet nothing.
    """
    points, anchors = placed(points), placed(anchors)
    n = count_up_to(anchors, small_rows)
    if n <= small_rows:
        return _nearest_listed(points, anchors, km)
    return nearest_descent(points, anchors, km=km)


def placed(df: DataFrame) -> DataFrame:
    """Rows that have both coordinates; ``dropna`` takes NaN for absent as well."""
    return df.dropna("any", subset=["lat", "lon"])


def _names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("lat", "lon")]


def _reachable(near, best):
    """Whether a squared distance can still be the least one, with a margin for rounding."""
    return near <= best * (1 + 1e-9) + 1e-14


def _nearest_listed(points: DataFrame, anchors: DataFrame, km: str) -> DataFrame:
    """Anchors known to be few: an index names, for every cell of space, the anchors that can be
    nearest somewhere in it. A point looks in its cell at each level of the index and measures
    the few anchors named there; nothing is shuffled.
    """
    own, x, y, z = _names(points), *unit_vector("lat", "lon")
    sites = [tuple(r) for r in anchors.select("lat", "lon", x, y, z).distinct().collect()]
    levels, index = cell_index(points.sparkSession, sites)
    seen = points.select(*own, "lat", "lon", x.alias("__x"), y.alias("__y"), z.alias("__z"),
                         F.explode(F.array(*[F.struct(
                             F.lit(lv).alias("l"), F.lit(float(2 ** (lv - 1))).alias("scale"),
                             F.lit(2 ** lv - 1).alias("last")) for lv in levels])).alias("__s"))
    seen = seen.select(*own, "lat", "lon", F.col("__s.l").alias("__l"), *[
        F.least(F.floor((F.col(f"__{c}") + 1.0) * F.col("__s.scale")),
                F.col("__s.last")).cast("long").alias(f"__{n}")
        for c, n in zip("xyz", "ijk")])
    met = seen.join(F.broadcast(index), ["__l", "__i", "__j", "__k"])

    def arc(slot):
        return great_circle_km("lat", "lon", F.get("__lats", slot), F.get("__lons", slot))

    # Cells name at most _NAMED anchors, but for those that the index could not split further.
    arcs = F.when(F.size("__lats") <= _NAMED, F.array(*[arc(F.lit(s)) for s in range(_NAMED)])
                  ).otherwise(F.transform(F.sequence(F.lit(0), F.size("__lats") - 1), arc))
    met = met.withColumn("__arcs", arcs).withColumn("__best", F.array_min("__arcs"))
    met = met.select(*own, "__lats", "__lons", "__best",
                     F.posexplode("__arcs").alias("__at", "__km"))
    won = met.filter(F.col("__km") == F.col("__best")).select(
        *own, F.col("__km").alias(km), F.get("__lats", "__at").alias("__lat"),
        F.get("__lons", "__at").alias("__lon"))
    side = anchors.withColumnsRenamed({"lat": "__lat", "lon": "__lon"})
    return won.join(F.broadcast(side), ["__lat", "__lon"]).select(*own, *_names(anchors), km)


def cell_index(spark: SparkSession, sites: list[tuple], named: int = _NAMED,
               budget: int = _BUDGET) -> tuple[list[int], DataFrame]:
    """Levels and cells of an index over distinct ``sites`` (lat, lon, x, y, z), known to be few.

    Cells are cubes of edge ``2 ** (1 - level)``, as ``_cell`` numbers them, that meet the unit
    sphere. Of a cell's sites those stay that no other one, the nearest to its centre, beats
    everywhere in it; a difference of squared distances is linear, so its least value lies at a
    corner. Cells with more than ``named`` sites are split, as long as their children name at
    most ``budget`` sites in all, which bounds the index; the rest keep their longer lists.
    """
    place = np.array([s[:2] for s in sites], dtype=float).reshape(-1, 2)
    xyz = np.array([s[2:] for s in sites], dtype=float).reshape(-1, 3)
    sound = np.isfinite(xyz).all(axis=1)
    place, xyz = place[sound], xyz[sound]
    offsets = np.stack(np.meshgrid(*[np.arange(2 ** _STEP)] * 3, indexing="ij"), -1).reshape(-1, 3)

    level, cells = 0, np.zeros((1, 3), dtype=np.int64)
    owner, site = np.zeros(len(xyz), dtype=np.int64), np.arange(len(xyz))
    found = []

    def close(which: np.ndarray) -> None:
        """File the cells ``which``; pairs are in the order of their cells."""
        mine = which[owner]
        sizes = np.bincount(owner[mine], minlength=len(cells))[which]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        found.append((level, cells[which], ends, place[site[mine]]))

    while len(site) and level < _DEEPEST:
        inner, parent = _children(cells, level + _STEP, offsets)
        counts = np.bincount(owner, minlength=len(cells))
        sizes = counts[parent]
        if level and sizes.sum() > _WORK:
            break
        first = np.concatenate(([0], np.cumsum(counts)))[parent]
        new_owner = np.repeat(np.arange(len(inner)), sizes)
        step = np.arange(len(new_owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        new_site = site[np.repeat(first, sizes) + step]
        stay = _unbeaten(inner, level + _STEP, new_owner, new_site, xyz)
        new_owner, new_site = new_owner[stay], new_site[stay]
        if level and len(new_site) > budget:
            break
        level, cells, owner, site = level + _STEP, inner, new_owner, new_site
        big = np.bincount(owner, minlength=len(cells)) > named
        close(~big)
        kept = big[owner]
        number = np.cumsum(big) - 1
        cells, owner, site = cells[big], number[owner[kept]], site[kept]
    if len(site):
        close(np.ones(len(cells), dtype=bool))

    found = [f for f in found if len(f[1])]
    levels = sorted({f[0] for f in found})
    columns = {"__l": [np.full(len(c), lv, dtype=np.int32) for lv, c, _, _ in found]}
    for axis, n in enumerate("ijk"):
        columns[f"__{n}"] = [c[:, axis] for _, c, _, _ in found]
    schema = pa.schema([("__l", pa.int32()), *[(f"__{n}", pa.int64()) for n in "ijk"],
                        *[(f"__{n}", pa.list_(pa.float64())) for n in ("lats", "lons")]])
    flat = [pa.array(np.concatenate(v)) if v else pa.array([], schema.field(n).type)
            for n, v in columns.items()]
    for axis in (0, 1):
        flat.append(pa.chunked_array(
            [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[:, axis]))
             for _, _, ends, at in found], pa.list_(pa.float64())).combine_chunks())
    index = spark.createDataFrame(pa.Table.from_arrays(flat, schema=schema))
    return levels or [_STEP], index


def _children(cells: np.ndarray, level: int, offsets: np.ndarray):
    """Cells of ``level`` inside ``cells`` that meet the unit sphere, and whose they are."""
    inner = (cells[:, None, :] * 2 ** _STEP + offsets[None, :, :]).reshape(-1, 3)
    parent = np.repeat(np.arange(len(cells)), len(offsets))
    edge = 2.0 ** (1 - level)
    low = inner * edge - 1.0
    high = low + edge
    least = np.maximum(0.0, np.maximum(low, -high))
    most = np.maximum(np.abs(low), np.abs(high))
    meets = ((least ** 2).sum(axis=1) <= 1 + 1e-9) & ((most ** 2).sum(axis=1) >= 1 - 1e-9)
    return inner[meets], parent[meets]


def _unbeaten(cells, level, owner, site, xyz) -> np.ndarray:
    """Pairs of cell and site that can be nearest somewhere in the cell, ties and a margin for
    rounding (that of ``_reachable``, at the cell's far edge) included."""
    half = 2.0 ** -level
    centre = (cells * 2 + 1) * half - 1.0
    away = ((xyz[site] - centre[owner]) ** 2).sum(axis=1)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    best = np.minimum.reduceat(away, starts)
    rank = np.repeat(best, np.diff(np.append(starts, len(owner))))
    champion = np.zeros(len(cells), dtype=np.int64)
    won = away == rank
    champion[owner[won]] = site[won]
    lead = xyz[champion[owner]] - xyz[site]
    # Both have length 1, so a point p is nearer to the champion by 2 p (champion - site).
    least = (lead * centre[owner]).sum(axis=1) - half * np.abs(lead).sum(axis=1)
    far = (np.sqrt(rank) + half * np.sqrt(3.0)) ** 2
    return 2 * least <= far * 1e-9 + 1e-14


_BOX = ("x0", "x1", "y0", "y1", "z0", "z1")


def _box() -> list:
    """Least and greatest coordinate of the anchors of a cell."""
    return [f(c).alias(f"{c}{i}") for c in ("x", "y", "z") for i, f in ((0, F.min), (1, F.max))]


def _cell(c, level: int):
    """Slot of a coordinate in [-1, 1]; exact halving keeps levels nested."""
    return F.least(F.floor((c + 1.0) * F.lit(float(2 ** (level - 1)))),
                   F.lit(2 ** level - 1)).cast("long")


def _cells(level: int, names) -> list:
    return [_cell(F.col(c), level).alias(n) for c, n in zip(("x", "y", "z"), names)]


def _bounds(p, box):
    """Least and greatest squared distance from ``p`` to a box of real anchors; both are
    looked up by coordinate name."""
    near = far = F.lit(0.0)
    for c in ("x", "y", "z"):
        below, above = box[f"{c}0"] - p[c], p[c] - box[f"{c}1"]
        gap = F.greatest(below, above, F.lit(0.0))
        reach = F.greatest(F.abs(below), F.abs(above))
        near, far = near + gap * gap, far + reach * reach
    return near, far


class _Columns:
    """Columns of the row, looked up like the fields of a struct."""

    def __getitem__(self, name: str):
        return F.col(name)


def nearest_descent(points: DataFrame, anchors: DataFrame, *, km: str = "km",
                    leaf: int = _LEAF) -> DataFrame:
    """Many anchors: descend a grid of cells, keeping per location only the cells that can
    still hold its nearest anchor. Exact; copies of a location are searched once.

    Squared straight-line distances rank like arcs. A cell is dropped when even its least
    distance exceeds the greatest distance to some other cell, with a margin for rounding;
    the survivors' distances are then computed in full.
    """
    points, anchors = placed(points), placed(anchors)

    def located(df, lat, lon):
        x, y, z = unit_vector("lat", "lon")
        return (df.select("lat", "lon").distinct()
                .select(F.col("lat").alias(lat), F.col("lon").alias(lon),
                        x.alias("x"), y.alias("y"), z.alias("z")))

    sites = cut_lineage(located(anchors, "alat", "alon"))
    depth = _STEP
    while depth < _DEEPEST and sites.groupBy(*_cells(depth, "ijk")).count().agg(
            F.max("count")).first()[0] > leaf:
        depth += _STEP

    # First level: at most 64 cells, listed in every task.
    top = sites.groupBy(*_cells(_STEP, "ijk")).agg(*_box())
    listed = top.agg(F.collect_list(F.struct(*top.columns))).scalar()

    def measure(c):
        near, far = _bounds(_Columns(), c)
        return F.struct(near.alias("near"), far.alias("far"), c["i"].alias("i"),
                        c["j"].alias("j"), c["k"].alias("k"))

    front = located(points, "plat", "plon").withColumn("__a", listed)
    front = front.withColumn("__c", F.transform("__a", measure))
    front = front.withColumn("__b", F.array_min(F.transform("__c", lambda c: c["far"])))
    front = front.withColumn("__c", F.explode(
        F.filter("__c", lambda c: _reachable(c["near"], F.col("__b")))))
    front = front.select("plat", "plon", "x", "y", "z", "__c.i", "__c.j", "__c.k")

    per_place = W.partitionBy("plat", "plon")
    for level in range(2 * _STEP, depth + 1, _STEP):
        tree = sites.select("x", "y", "z", *_cells(level - _STEP, "ijk"),
                            *_cells(level, ("i2", "j2", "k2")))
        tree = tree.groupBy("i", "j", "k", "i2", "j2", "k2").agg(*_box())
        met = front.join(tree, ["i", "j", "k"])
        near, far = _bounds(_Columns(), _Columns())
        met = met.withColumns({"__n": near, "__f": far})
        met = met.withColumn("__b", F.min("__f").over(per_place))
        front = met.filter(_reachable(F.col("__n"), F.col("__b"))).select(
            "plat", "plon", "x", "y", "z", F.col("i2").alias("i"), F.col("j2").alias("j"),
            F.col("k2").alias("k"))

    leaves = sites.select("alat", "alon", *_cells(depth, "ijk"))
    pairs = front.join(leaves, ["i", "j", "k"]).select(
        "plat", "plon", "alat", "alon",
        great_circle_km("plat", "plon", "alat", "alon").alias(km))
    won = pairs.withColumn("__m", F.min(km).over(per_place)).filter(
        F.col(km) == F.col("__m")).drop("__m")
    back = points.withColumnsRenamed({"lat": "plat", "lon": "plon"})
    found = back.join(won, ["plat", "plon"])
    return found.join(anchors.withColumnsRenamed({"lat": "alat", "lon": "alon"}),
                      ["alat", "alon"]).select(*_names(points), *_names(anchors), km)

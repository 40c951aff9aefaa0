"""Random forests whose trees each grow in one task, over bins of rows.

As in Spark's own forests a tree sees of a row its bins, 32 a feature at most, and its label. Rows
alike in both are one cell with a count: where each of n rows is drawn Poisson(1) times for a tree,
all together are drawn Poisson(n) times, so that a tree's sample is the one drawn from single rows.
Bins bound the cells of few features, however many rows there are. Cells up to ``HELD`` bytes are
broadcast, and nothing is kept or exchanged per row and tree, where Spark keeps a count and a node
id. More cells are left to Spark's growth over all rows, ``AT_ONCE`` trees at a time, which bounds
what it keeps.

Criteria are Spark's: Gini impurity, the root of the features tried at a node (all of them by a
single tree), a gain above zero, one row or more in a child; a node whose children are leaves of
one class becomes a leaf.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut_lineage, has_at_most, release

BINS = 32
# Bytes of cells that every task may hold, trees that Spark grows at once over more, nodes whose
# statistics a task holds at once, nodes of trees broadcast at once, cells of predictions broadcast.
HELD, AT_ONCE, NODES, SENT, FEW = 64_000_000, 10, 2048, 1_000_000, 200_000
TREES = "tree int, left array<int>, feature array<int>, bin array<int>, votes array<double>"


@dataclass(frozen=True)
class Forest:
    """What to fit; ``fit`` gives a ``Grown``."""

    features: tuple[str, ...]
    trees: int
    depth: int
    seed: int = 42
    label: str = "label"

    def fit(self, rows: DataFrame) -> Grown:
        spark, own = rows.sparkSession, _complete(rows, self.features)
        edges = _edges(own, self.features)
        binned = own.select(_key(self.features, edges).alias("key"),
                            F.col(f"`{self.label}`").cast("double").alias("y"))
        cells = cut_lineage(binned.groupBy("key", "y").agg(F.count("*").alias("n")))
        found = [r.y for r in cells.select("y").distinct().collect()]
        if not found or any(y is None or y < 0 or y != int(y) for y in found):
            raise ValueError(f"rows to fit need labels 0, 1, 2 and on, not {sorted(map(str, found))}")
        classes = int(max(found)) + 1
        if cells.count() * (len(self.features) + 9) <= HELD:
            trees = self._in_tasks(spark, cells, classes)
        else:
            trees = self._by_level(binned)
        release(cells)
        return Grown(tuple(self.features), edges, trees, classes)

    def _in_tasks(self, spark, cells: DataFrame, classes: int) -> DataFrame:
        table = cells.orderBy("key", "y").toArrow().combine_chunks()
        x = _matrix(table["key"], len(self.features))
        held = spark.sparkContext.broadcast(
            (x, table["y"].to_numpy().astype(np.int32), table["n"].to_numpy()))
        depth, seed = self.depth, self.seed
        some = _tried(len(self.features), self.trees)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree in batch.column(0).to_pylist():
                    grown = grow(*held.value, classes, depth, some, np.random.default_rng([seed, tree]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int32()), *[pa.array([v], t) for v, t in zip(
                            grown, [*[pa.list_(pa.int32())] * 3, pa.list_(pa.float64())])]],
                        names=["tree", "left", "feature", "bin", "votes"])

        tasks = min(self.trees, 8 * spark.sparkContext.defaultParallelism)
        trees = cut_lineage(spark.range(0, self.trees, 1, tasks).mapInArrow(run, TREES))
        held.destroy()
        return trees

    def _by_level(self, binned: DataFrame) -> DataFrame:
        from feedloom.ml.forest import nodes_of

        bins = F.transform(F.sequence(F.lit(1), F.length("key")), lambda i: F.conv(
            F.hex(F.substring("key", i, F.lit(1))), 16, 10).cast("double"))
        held = cut_lineage(binned.select(array_to_vector(bins).alias("features"), "y"))
        some = str(_tried(len(self.features), self.trees))
        grown = []
        for first in range(0, self.trees, AT_ONCE):
            model = RandomForestClassifier(
                featuresCol="features", labelCol="y", numTrees=min(AT_ONCE, self.trees - first),
                maxDepth=self.depth, maxBins=BINS, seed=self.seed + first, cacheNodeIds=True,
                checkpointInterval=10, featureSubsetStrategy=some).fit(held)
            # Children follow one another in Spark's order of nodes only at leaves: number them anew.
            nodes = nodes_of(model).withColumn("tree", (F.col("tree") + first).cast("int"))
            grown.append(cut_lineage(nodes.groupBy("tree").applyInPandas(_levels, TREES)))
        release(held)
        out = grown[0]
        for more in grown[1:]:
            out = out.unionAll(more)
        trees = cut_lineage(out)
        release(*grown)
        return trees


@dataclass(frozen=True)
class Grown:
    """A fitted forest: ``trees`` has a row per tree, whose nodes go by level, so that a node's right
    child follows its left one; ``left`` is -1 at a leaf, ``bin`` the last one that goes left."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    trees: DataFrame
    classes: int

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` that have all features, with their ``prediction``.

        Every distinct mix of bins walks the trees once.
        """
        name = "__bins"
        keyed = _complete(rows, self.features).drop("prediction").withColumn(
            name, _key(self.features, self.edges))
        cells = cut_lineage(keyed.select(name).distinct().repartition(
            rows.sparkSession.sparkContext.defaultParallelism))
        said = self._said(cells, name)
        # Spark would go by the files' size, in which keys are short.
        small = has_at_most(said, FEW)
        return keyed.join(F.broadcast(said) if small else said.hint("merge"), name).drop(name)

    def _said(self, cells: DataFrame, name: str) -> DataFrame:
        spark, classes, features = cells.sparkSession, self.classes, len(self.features)
        sizes = self.trees.select("tree", F.size("left").alias("n")).orderBy("tree").collect()
        block = np.cumsum([r.n for r in sizes]) // SENT
        now = cells.withColumn("votes", F.array(*[F.lit(0.0)] * classes))
        schema = f"`{name}` binary, votes array<double>"
        for k in np.unique(block):
            own = [r.tree for r, b in zip(sizes, block) if b == k]
            sent = spark.sparkContext.broadcast(self._packed(own))

            def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    x = _matrix(pa.chunked_array([batch.column(0)]), features)
                    votes = batch.column(1).flatten().to_numpy().reshape(len(x), classes).copy()
                    for left, feature, last, share in sent.value:
                        votes += share[_leaves(x, left, feature, last)]
                    ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * classes)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(votes.ravel()))],
                        names=[name, "votes"])

            last, now = now, cut_lineage(now.mapInArrow(run, schema))
            sent.destroy()
            release(cells if k == block[0] else last)
        best = F.array_position("votes", F.array_max("votes")) - 1
        return now.select(name, best.cast("double").alias("prediction"))

    def _packed(self, own: list[int]) -> list[tuple]:
        held = self.trees.filter(F.col("tree").between(own[0], own[-1])).orderBy("tree").toArrow()
        out = []
        for k in range(len(held)):
            left, feature, last, votes = (held[c][k].values.to_numpy() for c in (
                "left", "feature", "bin", "votes"))
            votes = votes.reshape(len(left), self.classes)
            out.append((left, feature, last.astype(np.uint8), votes / votes.sum(axis=1, keepdims=True)))
        return out

    def nodes(self) -> DataFrame:
        """Rows ``tree, id, left, right, feature, threshold, votes``."""
        edges = F.array(*[F.array(*[F.lit(float(t)) for t in e]).cast("array<double>") for e in self.edges])
        flat = self.trees.select("tree", "votes", F.posexplode(F.arrays_zip("left", "feature", "bin")))
        at, inner = F.col("pos"), F.col("col.left") >= 0
        return flat.select(
            "tree", at.alias("id"), F.col("col.left").alias("left"),
            F.when(inner, F.col("col.left") + 1).otherwise(-1).alias("right"),
            F.col("col.feature").alias("feature"),
            F.when(inner, F.get(F.get(edges, F.col("col.feature")), F.col("col.bin"))).alias("threshold"),
            F.slice("votes", at * self.classes + 1, self.classes).alias("votes"))


def grow(x: np.ndarray, y: np.ndarray, n: np.ndarray, classes: int, depth: int, some: int,
         rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One tree over cells ``x`` (bins), ``y`` (class), ``n`` (rows): ``left, feature, bin, votes``."""
    w = rng.poisson(n)
    rows = np.flatnonzero(w)
    if not len(rows):  # No row was drawn: as the rows are.
        w, rows = n, np.arange(len(n))
    y, w = y[rows].astype(np.int64), w[rows].astype(float)
    bins, features = int(x.max(initial=0)) + 1, x.shape[1]
    at, k = np.zeros(len(rows), np.int64), 1
    levels, before = [], 0
    for level in range(depth + 1):
        votes = np.bincount(at * classes + y, w, k * classes).reshape(k, classes)
        left, feature, last = (np.full(k, -1, np.int32) for _ in range(3))
        levels.append((left, feature, last, votes))
        open_ = (votes > 0).sum(axis=1) > 1
        if level == depth or not open_.any():
            break
        keep = open_[at]
        rows, y, w, at = rows[keep], y[keep], w[keep], at[keep]
        order = np.argsort(at, kind="stable")
        rows, y, w, at = rows[order], y[order], w[order], at[order]
        nodes = np.flatnonzero(open_)
        for first in range(0, len(nodes), NODES):
            own = nodes[first:first + NODES]
            a, b = np.searchsorted(at, (own[0], own[-1] + 1))
            feature[own], last[own] = _best(
                x, rows[a:b], y[a:b], w[a:b], np.searchsorted(own, at[a:b]), votes[own], bins,
                _drawn(len(own), features, some, rng))
        cut = feature >= 0
        if not cut.any():
            break
        before += k
        place = 2 * (np.cumsum(cut) - 1)
        left[cut] = before + place[cut]
        keep = cut[at]
        rows, y, w, at = rows[keep], y[keep], w[keep], at[keep]
        at = place[at] + (x[rows, feature[at]] > last[at])
        k = 2 * int(cut.sum())
    return _pruned(levels)


def _drawn(nodes: int, features: int, some: int, rng: np.random.Generator) -> np.ndarray:
    """Features tried at each node, ``some`` different ones."""
    if some >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return np.argpartition(rng.random((nodes, features)), some, axis=1)[:, :some]


def _best(x, rows, y, w, at, votes, bins: int, drawn) -> tuple[np.ndarray, np.ndarray]:
    """Feature and last bin on the left of each node's best cut, -1 where none gains."""
    k, classes = votes.shape
    total = votes.sum(axis=1)
    # A gain is this score's excess over the node's own.
    best = (votes * votes).sum(axis=1) / total * (1 + 1e-12)
    feature, last = np.full(k, -1, np.int32), np.full(k, -1, np.int32)
    for own in drawn.T:
        here = (at * bins + x[rows, own[at]]) * classes + y
        low = np.bincount(here, w, k * bins * classes).reshape(k, bins, classes).cumsum(axis=1)[:, :-1]
        high = votes[:, None, :] - low
        below = low.sum(axis=2)
        above = total[:, None] - below
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.einsum("ijk,ijk->ij", low, low) / below + np.einsum("ijk,ijk->ij", high, high) / above
        score[(below <= 0) | (above <= 0)] = -1
        if not score.shape[1]:
            break
        cut = score.argmax(axis=1)
        found = score[np.arange(k), cut]
        more = found > best
        best[more], feature[more], last[more] = found[more], own[more], cut[more]
    return feature, last


def _pruned(levels) -> tuple[np.ndarray, ...]:
    """The levels as one tree: leaves of one class below a node make it one, what lies below goes."""
    left, feature, last, votes = (np.concatenate(c) for c in zip(*levels))
    said, ends = votes.argmax(axis=1), np.cumsum([len(v[0]) for v in levels])
    for a, b in zip([0, *ends[:-1]][::-1], ends[::-1]):
        inner = a + np.flatnonzero(left[a:b] >= 0)
        one, two = left[inner], left[inner] + 1
        same = inner[(left[one] < 0) & (left[two] < 0) & (said[one] == said[two])]
        left[same] = feature[same] = last[same] = -1
    seen = np.zeros(len(left), bool)
    seen[0] = True
    for a, b in zip([0, *ends[:-1]], ends):
        inner = a + np.flatnonzero(seen[a:b] & (left[a:b] >= 0))
        seen[left[inner]] = seen[left[inner] + 1] = True
    new = np.cumsum(seen) - 1
    left = np.where(left >= 0, new[left], -1).astype(np.int32)
    return left[seen], feature[seen], last[seen], votes[seen].ravel()


def _levels(nodes: pd.DataFrame) -> pd.DataFrame:
    """One of Spark's trees with its nodes by level; cuts lie between bins, which were its features."""
    nodes = nodes.sort_values("id")
    left, right, feature = (nodes[c].to_numpy() for c in ("left", "right", "feature"))
    order, now = [], np.array([0])
    place = np.full(len(left), -1, np.int32)
    while len(now):
        place[now] = len(order) + np.arange(len(now))
        order += now.tolist()
        inner = now[left[now] >= 0]
        now = np.column_stack((left[inner], right[inner])).ravel()
    order = np.array(order)
    inner = left[order] >= 0
    last = np.where(inner, np.floor(nodes["threshold"].fillna(-1).to_numpy()[order]), -1)
    return pd.DataFrame({
        "tree": [nodes["tree"].iloc[0]], "left": [np.where(inner, place[left[order]], -1)],
        "feature": [np.where(inner, feature[order], -1)], "bin": [last.astype(np.int32)],
        "votes": [np.concatenate(nodes["votes"].to_numpy()[order])]})


def _leaves(x: np.ndarray, left: np.ndarray, feature: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The leaf of each row of bins."""
    at = np.zeros(len(x), np.int64)
    inner = np.arange(len(x)) if left[0] >= 0 else np.arange(0)
    while len(inner):
        here = at[inner]
        at[inner] = here = left[here] + (x[inner, feature[here]] > last[here])
        inner = inner[left[here] >= 0]
    return at


def _tried(features: int, trees: int) -> int:
    return features if trees == 1 else int(np.ceil(np.sqrt(features)))


def _complete(rows: DataFrame, features) -> DataFrame:
    """Rows without a gap in the features, as the assembler keeps them."""
    for c in features:
        value = F.col(f"`{c}`").cast("double")
        rows = rows.filter(value.isNotNull() & ~F.isnan(value))
    return rows


def _key(features, edges):
    """A row's bins, a byte a feature: how many of a feature's edges lie below its value."""
    held = [np.array(e) for e in edges]

    @F.pandas_udf("binary")
    def key(*columns: pd.Series) -> pd.Series:
        bins = np.column_stack([np.searchsorted(e, c.to_numpy(dtype=float), "left")
                                for e, c in zip(held, columns)]).astype(np.uint8)
        return pd.Series(np.ascontiguousarray(bins).view(f"V{len(held)}").ravel().tolist(), dtype=object)

    return key(*[F.col(f"`{c}`").cast("double") for c in features])


def _matrix(keys: pa.ChunkedArray, features: int) -> np.ndarray:
    held = keys.cast(pa.binary(features)).combine_chunks()
    if isinstance(held, pa.ChunkedArray):
        held = held.chunk(0) if held.num_chunks else pa.array([], pa.binary(features))
    data = np.frombuffer(held.buffers()[1] or b"", np.uint8)
    return data[held.offset * features:(held.offset + len(held)) * features].reshape(len(held), features)


def _edges(rows: DataFrame, features) -> tuple[tuple[float, ...], ...]:
    """What parts each feature's bins: the middles between its values where there are at most
    ``BINS`` of them, else quantiles of all its rows."""
    names = [f"f{i}" for i in range(len(features))]
    own = rows.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, names)])

    def few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.array([]) for _ in names]
        for batch in batches:
            for i, held in enumerate(found):
                if held is not None:
                    held = np.union1d(held, batch.column(i).to_numpy(zero_copy_only=False))
                    found[i] = held if len(held) <= BINS else None
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(names)), pa.int32()), pa.array(
                [None if v is None else v.tolist() for v in found], pa.list_(pa.float64()))],
            names=["feature", "held"])

    values: list = [set() for _ in names]
    for r in own.mapInArrow(few, "feature int, held array<double>").collect():
        if r.held is None or values[r.feature] is None:
            values[r.feature] = None
        else:
            values[r.feature] |= set(r.held)
    many = [i for i, v in enumerate(values) if v is None or len(v) > BINS]
    out = [None if i in many else sorted(v) for i, v in enumerate(values)]
    out = [None if v is None else tuple((a + b) / 2 for a, b in zip(v, v[1:])) for v in out]
    if many:
        at = [k / BINS for k in range(1, BINS)]
        row = own.agg(*[F.percentile_approx(names[i], at, 10_000).alias(names[i]) for i in many]).first()
        for i in many:
            out[i] = tuple(sorted(set(row[names[i]])))
    return tuple(out)

"""Random forests: fit, evaluate, sweep, predict."""

from __future__ import annotations

import time
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import labels
from feedloom.ml.features import assembler
from feedloom.ml.grow import Forest, Grown
from feedloom.operators.aggregates import accuracy, crosstab_wide
from feedloom.plans.reports import profile_lookup
from feedloom.session import cut_lineage, scratch_dir

# The chosen forest and the parameter ranges that were searched.
TREES, DEPTH = 280, 19
TREE_SWEEP = range(10, 500, 10)
DEPTH_SWEEP = range(10, 30)
FINE_TREE_SWEEP = range(250, 341, 10)
TIMING_TREES = range(10, 200, 10)


def forest(features, *, trees: int = TREES, depth: int = DEPTH, seed: int = 42,
           label: str = "label", binned: bool = False) -> Pipeline | Forest:
    """Assembler and classifier. Node ids are cached and cut at intervals, so deep trees
    neither ship themselves to every task nor grow an endless lineage. If ``binned``, the same
    forest grown a tree per task over bins of rows (:mod:`feedloom.ml.grow`)."""
    if binned:
        return Forest(tuple(features), trees, depth, seed, label)
    model = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees,
                                   maxDepth=depth, seed=seed, cacheNodeIds=True,
                                   checkpointInterval=10)
    return Pipeline(stages=[assembler(features), model])


def deal(rows: DataFrame) -> DataFrame:
    """``rows`` evenly over the session's cores, however few files they lie in.

    Every pass of a fit walks all trees for each row, and each task sends on its statistics of all
    open nodes: fewer tasks than cores leave cores idle, more only add statistics.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit_once_read(rows: DataFrame, features, *, label: str = "label", **settings) -> Grown:
    """Fit of ``forest``, binned; its passes read the complete rows from a cache, so that what makes the rows
    runs once. They are dealt over the cores and sorted there, so that a task that runs again
    draws the same samples for its trees."""
    used = list(dict.fromkeys([*features, label]))
    held = deal(rows.select(*[F.col(f"`{c}`") for c in used]))
    held = held.sortWithinPartitions(*[F.col(f"`{c}`") for c in used]).persist()
    try:
        return forest(features, label=label, binned=True, **settings).fit(held)
    finally:
        held.unpersist()


def evaluate(model: PipelineModel | Grown, rows: DataFrame, *, label: str = "label") -> DataFrame:
    """One row: correct rows, rows, accuracy."""
    return accuracy(model.transform(deal(rows)), label, "prediction")


def confusion(model: PipelineModel | Grown, rows: DataFrame, *, label: str = "label",
              classes=tuple(float(v) for v in labels.ORDINAL.values())) -> DataFrame:
    """Predictions down, actual labels across, with totals."""
    return crosstab_wide(model.transform(deal(rows)).select("prediction", label), "prediction",
                         label, list(classes))


def sweep(train: DataFrame, valid: DataFrame, features, grid: list[tuple[int, int]], *,
          seed: int = 42, label: str = "label", at_once: int = 4) -> DataFrame:
    """Accuracy, fit and predict time for each (trees, depth), a small table of metrics.

    The assembled input is read once for all fits; ``at_once`` of them run side by side, one
    where the times themselves are the question.
    """
    spark = train.sparkSession
    stage = assembler(features)
    fit_on = stage.transform(train).select("features", label).persist()
    score_on = stage.transform(valid).select("features", label).persist()

    def run(point: tuple[int, int]) -> tuple:
        trees, depth = point
        begun = time.perf_counter()
        model = forest(features, trees=trees, depth=depth, seed=seed, label=label) \
            .getStages()[-1].fit(fit_on)
        fitted = time.perf_counter()
        row = accuracy(model.transform(score_on), label, "prediction").first()
        return (trees, depth, row["n_correct"], row["n_rows"], row["accuracy"],
                fitted - begun, time.perf_counter() - fitted)

    try:
        fit_on.count(), score_on.count()
        with ThreadPool(at_once) as pool:
            out = pool.map(inheritable_thread_target(spark)(run), grid)
    finally:
        fit_on.unpersist()
        score_on.unpersist()
    return spark.createDataFrame(
        out, "num_trees int, max_depth int, n_correct long, n_rows long, accuracy double, "
             "seconds double, predict_seconds double")


def full_grid() -> list[tuple[int, int]]:
    """All 79 points of the three searched ranges: (trees, depth)."""
    return ([(t, DEPTH) for t in TREE_SWEEP] + [(TREES, d) for d in DEPTH_SWEEP]
            + [(t, DEPTH) for t in FINE_TREE_SWEEP])


def node_table(model: PipelineModel | Grown) -> DataFrame:
    """The forest's nodes as rows: tree, id (from 0, the root), left, right (-1 at a leaf),
    feature, threshold, votes (class counts of the training rows that met the node).

    Spark writes the nodes; only continuous features, as ``assembler`` makes them, are read.
    """
    return model.nodes() if isinstance(model, Grown) else nodes_of(model.stages[-1])


def nodes_of(stage: RandomForestClassificationModel) -> DataFrame:
    spark = SparkSession.getActiveSession()
    path = scratch_dir(spark, "forest")
    stage.write().save(path)
    node, cut = F.col("nodeData"), F.col("nodeData.split")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), cut["featureIndex"].alias("feature"),
        F.get(cut["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["impurityStats"].alias("votes"))


def shared_sweep(train: DataFrame, valid: DataFrame, features, grid=None, *, seed: int = 42,
                 label: str = "label") -> DataFrame:
    """Accuracy of each (trees, depth) of ``grid``, all 79 points if none is given, from one fit.

    The largest forest asked for is fitted once. A point with fewer trees is its first trees, one
    with less depth is the same trees cut off there, a node being its own leaf; neither is
    bit for bit the forest that a fit of its own draws, but one of the same distribution of trees.
    Each row walks each tree once; votes are read at the depths of the grid on the way and summed
    over the trees, so that all points cost one pass. Rows of a batch are walked side by side; the
    node table is broadcast, as Spark does with the model itself that holds the same nodes.
    """
    grid = list(dict.fromkeys(full_grid() if grid is None else grid))
    most, deepest = max(t for t, _ in grid), max(d for _, d in grid)
    model = fit_once_read(train, features, trees=most, depth=deepest, seed=seed, label=label)
    return score_points(model, valid, features, grid, label=label)


def score_points(model: PipelineModel | Grown, rows: DataFrame, features, grid, *,
                 label: str = "label") -> DataFrame:
    """num_trees, max_depth, n_correct, n_rows, accuracy of prefixes of a fitted forest.

    Rows that lack a feature are not scored, as the assembler skips them; a null label is never
    correct. Of classes with equally many votes the lowest wins, as in the model.
    """
    spark, names = rows.sparkSession, [f"f{i}" for i in range(len(features))]
    trees = spark.sparkContext.broadcast(_packed(node_table(model)))
    wanted = {d: {t for t, x in grid if x == d} for _, d in grid}
    most, deepest = max(t for t, _ in grid), max(wanted)
    schema = "num_trees int, max_depth int, n_correct long, n_rows long"

    def walk(batches):
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            truth = batch["y"].to_numpy(dtype=float)
            total = {d: 0.0 for d in wanted}
            right = []
            for number, tree in enumerate(trees.value[:most], start=1):
                at = np.zeros(len(x), dtype=np.int64)
                for depth in range(deepest + 1):
                    if depth in wanted:
                        total[depth] = total[depth] + tree["share"][at]
                        if number in wanted[depth]:
                            said = total[depth].argmax(axis=1)
                            right.append((number, depth, int((said == truth).sum()), len(x)))
                    inner = np.flatnonzero(tree["left"][at] >= 0)
                    if not len(inner):
                        # All stand on leaves: deeper points read the same nodes.
                        for later in (d for d in wanted if d > depth):
                            total[later] = total[later] + tree["share"][at]
                            if number in wanted[later]:
                                said = total[later].argmax(axis=1)
                                right.append((number, later, int((said == truth).sum()), len(x)))
                        break
                    here = at[inner]
                    low = x[inner, tree["feature"][here]] <= tree["threshold"][here]
                    at[inner] = np.where(low, tree["left"][here], tree["right"][here])
            yield pd.DataFrame(right, columns=["num_trees", "max_depth", "n_correct", "n_rows"])

    narrow = deal(rows).select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, names)],
                         F.col(label).cast("double").alias("y"))
    counted = narrow.dropna("any", subset=names).mapInPandas(walk, schema)
    return counted.groupBy("num_trees", "max_depth").agg(
        F.sum("n_correct").alias("n_correct"), F.sum("n_rows").alias("n_rows")).withColumn(
        "accuracy", F.col("n_correct") / F.col("n_rows"))


def _packed(nodes: DataFrame) -> list[dict]:
    """Per tree, arrays in the order of node ids; ``share`` is each node's votes over their sum."""
    held = nodes.orderBy("tree", "id").toArrow()
    tree = held["tree"].to_numpy()
    votes = held["votes"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
    share = votes / votes.sum(axis=1, keepdims=True)
    columns = {n: held[n].to_numpy() for n in ("left", "right", "feature", "threshold")}
    ends = np.flatnonzero(np.diff(tree, append=-1)) + 1
    starts = np.concatenate(([0], ends[:-1]))
    return [{"share": share[a:b], **{n: v[a:b] for n, v in columns.items()}}
            for a, b in zip(starts, ends)]


def fit_times(train: DataFrame, features, trees=TIMING_TREES, *, depth: int = DEPTH,
              seed: int = 42) -> DataFrame:
    """Run times per number of trees at the parallelism of this session."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    done = sweep(train, train, features, [(t, depth) for t in trees], seed=seed, at_once=1)
    return done.select(F.lit(cores).alias("cores"), "num_trees", "seconds", "predict_seconds")


def predict_profile(model: PipelineModel | Grown, profile: DataFrame, requests: DataFrame, *,
                    position: int = 2) -> DataFrame:
    """Prediction for each requested camera and hour, from its mean profile.

    The rows to predict are written first: the assembler's check for gaps over the expressions of
    all means would have the optimizer list every mix of an expression and its name.
    """
    from feedloom.operators.reshape import place

    rows = model.transform(cut_lineage(profile_lookup(profile, requests)))
    names = {float(v): k for k, v in labels.ORDINAL.items()}
    named = labels.lookup(F.col("prediction"), names)
    out = rows.withColumn("congestion_prediction", named).select(
        *[c for c in profile.columns if c != "time_hr"], "congestion_prediction")
    return place(out, "congestion_prediction", position)

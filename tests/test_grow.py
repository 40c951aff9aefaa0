"""Forests grown a tree per task over binned rows."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from feedloom.ml import forest as R
from feedloom.ml import grow as G


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows of a feature of many values, one of few and one of a single value; some labels are noise."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double")
    return spark.range(3000).select(
        (noise / 7).alias("x"), (F.col("id") % 5).cast("double").alias("few"), F.lit(1.0).alias("one"),
        F.when(F.col("id") % 10 == 0, F.col("id") / 10 % 3).otherwise(F.floor(noise / 334))
        .cast("int").alias("label")).persist()


FEATURES = ["x", "few", "one"]


def test_nothing_is_kept_per_row_and_tree(spark, rows, monkeypatch):
    """Spark's growth keeps a count and a node id per row and tree; binned rows do without it."""
    def fit(*args):
        raise AssertionError("grown over single rows")

    monkeypatch.setattr(RandomForestClassifier, "_fit", fit)
    model = R.fit_once_read(rows, FEATURES, trees=30, depth=12)
    votes = [sum(r.votes) for r in R.node_table(model).filter("id = 0").collect()]
    # Each row is drawn once on average, by a tree's own draw.
    assert len(votes) == 30 and len(set(votes)) > 15
    assert np.mean(votes) == pytest.approx(3000, abs=60) and 25 < np.std(votes) < 90
    assert R.evaluate(model, rows).first().accuracy > 0.9


def test_more_cells_than_a_task_may_hold_are_left_to_spark(spark, rows, monkeypatch):
    small = R.fit_once_read(rows, FEATURES, trees=5, depth=6)
    monkeypatch.setattr(G, "HELD", 0)
    monkeypatch.setattr(G, "AT_ONCE", 2)
    large = R.fit_once_read(rows, FEATURES, trees=5, depth=6)
    assert sorted(r.tree for r in large.trees.collect()) == list(range(5))
    assert small.edges == large.edges and len(small.edges[0]) == 31
    one, two = (R.evaluate(m, rows).first() for m in (small, large))
    assert one.n_rows == two.n_rows == 3000
    assert one.accuracy == pytest.approx(two.accuracy, abs=0.02) and two.accuracy > 0.9


@pytest.mark.parametrize("held", [G.HELD, 0])
def test_nodes_and_predictions_are_one_forest(spark, rows, monkeypatch, held):
    """Walks over nodes and real values find what predictions by bins do, also in blocks of a tree."""
    monkeypatch.setattr(G, "HELD", held)
    model = R.fit_once_read(rows, FEATURES, trees=4, depth=7)
    gaps = rows.unionByName(spark.createDataFrame(
        [(None, 1.0, 1.0, 0), (float("nan"), 1.0, 1.0, 0), (-5.0, 9.0, 0.0, 0), (1e9, -9.0, 2.0, 2)], rows.schema))
    want = {(r.num_trees, r.max_depth): r.n_correct for r in
            R.score_points(model, gaps, FEATURES, [(4, 7)]).collect()}
    assert want == {(4, 7): R.evaluate(model, gaps).first().n_correct}
    said = sorted(map(tuple, model.transform(gaps).collect()))
    assert len(said) == 3002
    monkeypatch.setattr(G, "SENT", 3)
    monkeypatch.setattr(G, "FEW", 10)
    assert sorted(map(tuple, model.transform(gaps).collect())) == said
    assert model.transform(gaps.limit(0)).count() == 0


def test_a_tree_parts_what_its_rows_tell(spark):
    """Depth, best cuts, rows by their count, and no node whose leaves say the same."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 32, (500, 4)).astype(np.uint8)
    y = (x[:, 0] > 9).astype(np.int32) + (x[:, 2] > 20)
    n = rng.integers(1, 4, 500)
    left, feature, last, votes = G.grow(x, y, n, 3, 19, 4, np.random.default_rng(7))
    votes = votes.reshape(len(left), 3)
    drawn = np.random.default_rng(7).poisson(n)
    assert votes[0].tolist() == [drawn[y == c].sum() for c in range(3)]
    at = G._leaves(x, left, feature, last)
    assert (votes[at].argmax(axis=1) == y)[drawn > 0].all()
    assert (feature[0], last[0]) in {(0, 9), (2, 20)} and len(left) <= 9
    inner = np.flatnonzero(left >= 0)
    assert np.array_equal(votes[inner], votes[left[inner]] + votes[left[inner] + 1])
    assert len(G.grow(x, y, n, 3, 0, 4, rng)[0]) == 1
    blocks = G.NODES
    try:
        G.NODES = 1
        again = G.grow(x, y, n, 3, 19, 4, np.random.default_rng(7))
    finally:
        G.NODES = blocks
    assert again[3].tolist() == votes.ravel().tolist()


def test_labels_that_are_no_classes_fail(spark, rows):
    for bad in (rows.withColumn("label", F.lit(0.5)), rows.withColumn("label", F.lit(-1)), rows.limit(0)):
        with pytest.raises(ValueError, match="labels"):
            R.fit_once_read(bad, FEATURES, trees=2, depth=2)


def test_confusion_of_rows_that_repeat_is_that_of_single_rows(spark, rows, monkeypatch):
    """Tables a hundred times as large of the same bins have cells that are as many."""
    seen, grow = [], G.Forest._in_tasks

    def counted(forest, session, cells, classes):
        seen.append((cells.count(), cells.agg(F.sum("n")).first()[0]))
        return grow(forest, session, cells, classes)

    monkeypatch.setattr(G.Forest, "_in_tasks", counted)
    many = rows.crossJoin(spark.range(100).select("id")).drop("id")
    for own in (rows, many):
        model = R.fit_once_read(own, FEATURES, trees=5, depth=12)
    assert [n for _, n in seen] == [3000, 300_000] and seen[1][0] <= 32 * 5 * 3
    # Cells of the same values: quantiles of the repeated rows are those of the rows.
    assert seen[0][0] == seen[1][0]
    table = {r["prediction"]: r for r in R.confusion(model, rows, classes=(0.0, 1.0, 2.0)).collect()}
    right = sum(table[str(float(c))][str(float(c))] for c in range(3))
    assert table["Total"]["Total"] == 3000 and right == R.evaluate(model, rows).first().n_correct > 2700

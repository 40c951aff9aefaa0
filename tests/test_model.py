"""Features, split and forests."""

import pytest
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog import QUERIES
from feedloom.ml import features as M
from feedloom.ml import forest as R
from feedloom.ml import grow
from feedloom.plans import reports
from feedloom.plans.wide_table import build_wide_table
from tests import fixtures as X


@pytest.fixture(scope="module")
def learnable(spark):
    """The label follows from x; y is noise."""
    rows = spark.range(4000).select(
        "id", (F.col("id") % 40).cast("double").alias("x"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("y"),
        F.floor(F.col("id") % 40 / 10).cast("double").alias("label"))
    return M.split(rows, ["id"])


def test_features_hold_no_label_and_no_gaps(spark):
    wide = build_wide_table(X.feeds(spark))
    frame = M.numeric_frame(wide, keep=S.WAREHOUSE_KEY)
    assert S.LABEL not in frame.columns and len(S.FEATURES) == 37
    # One row in each snapshot has a known label and all measures.
    assert sorted(map(tuple, frame.select("cam_id", "direction", "label").collect())) == [(1001, 1, 1.0)] * 2
    assert "cam_id" not in M.numeric_frame(wide, drop_camera=True).columns
    assert set(M.categorical_columns(wide)) == {
        "two_hr_forecast_value", *[f"four_day_{m}_{d}" for d in S.DAYS for m in ("wind_direction", "forecast")],
        "twenty_four_hr_general_forecast", "twenty_four_hr_general_wind_direction",
        *[f"twenty_four_hr_period_{p}" for p in S.PERIODS]}


def test_split_is_stable_and_has_its_shares(spark, learnable):
    n = {r.part: r["count"] for r in learnable.groupBy("part").count().collect()}
    assert n["test"] / 4000 == pytest.approx(0.25, abs=0.03)
    assert n["valid"] / 4000 == pytest.approx(0.1875, abs=0.03)
    again = M.split(learnable.drop("part").repartition(13), ["id"])
    assert again.join(learnable, ["id", "part"]).count() == 4000


def test_one_hot_has_a_slot_per_category(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    model = M.one_hot(df, ["c"])
    new = spark.createDataFrame([("a",), ("b",), ("new",)], "c string")
    got = [r[0].toArray().tolist() for r in model.transform(new).select("c_hot").collect()]
    assert got == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]


def test_categories_are_numbered_over_all_ranges(spark):
    """Thousands of values, ties, nulls, an empty text; numbers as a sort of everything gives them."""
    df = spark.range(9000).select(F.when(F.col("id") % 11 == 0, None).otherwise(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 4000).cast("string"))).alias("c"))
    df = df.unionAll(spark.createDataFrame([("",)], "c string"))
    got = {r.category: r.slot for r in M.categories(df, "c").collect()}
    counts = df.dropna().groupBy("c").count().collect()
    want = sorted(counts, key=lambda r: (-r["count"], r.c.encode()))
    assert got == {r.c: i for i, r in enumerate(want)} and got["hot"] == 0
    out = M.one_hot(df, ["c"]).transform(df).select("c", "c_index", "c_hot").collect()
    assert len(out) == df.count()
    assert all(r.c_hot.size == len(want) + 1 and list(r.c_hot.indices) == [r.c_index] and
               r.c_index == got.get(r.c, len(want)) for r in out)


def test_one_hot_of_columns_with_few_or_no_values(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (1, None, "b")], "n int, e string, t string")
    out = M.one_hot(df, ["n", "e", "t"]).transform(df)
    assert out.columns[:3] == df.columns
    got = sorted((r.n, r.t or "", r.n_hot.toArray().tolist(), r.t_hot.toArray().tolist(),
                  r.e_hot.toArray().tolist()) for r in out.collect())
    assert [g[2:] for g in got] == [
        ([1, 0, 0], [1, 0, 0], [0, 1]), ([1, 0, 0], [0, 1, 0], [0, 1]), ([0, 1, 0], [0, 0, 1], [0, 1])]
    assert M.one_hot(df.limit(0), ["t"]).transform(df.limit(0)).count() == 0


def test_forest_learns(spark, learnable):
    train, valid, test = (learnable.filter(F.col("part") == p) for p in ("train", "valid", "test"))
    model = R.forest(["x", "y"], trees=10, depth=6).fit(train)
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    score = R.evaluate(model, test).first()
    assert score.accuracy > max(0.9, majority)
    table = {r["prediction"]: r for r in R.confusion(model, test).collect()}
    assert table["Total"]["Total"] == test.count()
    right = sum(table[str(float(c))][str(float(c))] for c in range(4))
    assert right == score.n_correct
    grid = R.sweep(train, valid, ["x", "y"], [(2, 1), (5, 6)]).collect()
    assert [(r.num_trees, r.max_depth) for r in grid] == [(2, 1), (5, 6)]
    assert grid[1].accuracy > grid[0].accuracy
    times = R.fit_times(train, ["x"], trees=[2, 3], depth=2)
    assert times.columns == ["cores", "num_trees", "seconds", "predict_seconds"]
    assert times.count() == 2


def test_points_of_one_forest(spark, learnable):
    """The whole forest's point is the model's own accuracy; with every feature at every node and the
    same sample, a cut of depth is the fit of that depth; fewer trees come near their own fit."""
    train, valid = (learnable.filter(F.col("part") == p).drop("part") for p in ("train", "valid"))
    noisy = train.withColumn("label", F.when(F.col("id") % 7 == 0, F.pmod(F.col("id"), F.lit(4)))
                             .otherwise(F.col("label")).cast("double"))
    feats, grid = ["x", "y"], [(6, 5), (6, 2), (3, 2), (1, 0), (6, 9)]
    model = R.forest(feats, trees=6, depth=9).fit(noisy)
    gaps = valid.unionByName(spark.createDataFrame([(-1, None, 1.0, 0.0)], valid.schema))
    got = {(r.num_trees, r.max_depth): r for r in
           R.score_points(model, gaps, feats, grid).collect()}
    assert set(got) == set(grid) and {r.n_rows for r in got.values()} == {valid.count()}
    own = {(r.num_trees, r.max_depth): r for r in R.sweep(noisy, valid, feats, grid).collect()}
    assert got[6, 9].n_correct == own[6, 9].n_correct == R.evaluate(model, valid).first().n_correct
    for point in ((6, 5), (6, 2)):
        assert got[point].accuracy == pytest.approx(own[point].accuracy, abs=0.01)
    assert got[3, 2].accuracy == pytest.approx(own[3, 2].accuracy, abs=0.05)
    assert len(R.full_grid()) == 79 and R.score_points(model, valid.limit(0), feats, grid).count() == 0


def test_deep_forest_with_cached_node_ids(spark, learnable):
    model = R.forest(["x", "y"], trees=2, depth=12).fit(learnable.filter("part = 'train'"))
    assert R.evaluate(model, learnable.filter("part = 'test'")).first().accuracy > 0.9


def test_fit_and_scores_use_all_cores_for_rows_of_one_task(spark, learnable, monkeypatch):
    """Rows of one task are dealt evenly; a recomputed task meets its rows in the same order."""
    seen = []

    class Stub:
        def fit(self, rows):
            seen.append(rows.rdd.glom().collect())

        def transform(self, rows):
            seen.append(rows.rdd.glom().collect())
            return rows.withColumn("prediction", F.col("label"))

    monkeypatch.setattr(R, "forest", lambda *args, **settings: Stub())
    one = learnable.coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1
    R.fit_once_read(one, ["x", "y"], trees=2)
    assert R.evaluate(Stub(), one).first().n_correct == 4000
    R.confusion(Stub(), one)
    for parts in seen:
        assert [len(p) for p in parts] == [pytest.approx(4000 / cores, abs=2)] * cores
    assert all(p == sorted(p) for p in seen[0])
    assert sorted(tuple(r) for p in seen[0] for r in p) == sorted(map(tuple, one.select("x", "y", "label").collect()))


def test_prediction_per_request(spark):
    wide = build_wide_table(X.feeds(spark))
    feats = ["rainfall_realtime", "cam_id", "direction"]
    model = R.forest(feats, trees=2, depth=2).fit(
        M.numeric_frame(wide, features=feats, keep=("cam_id", "direction")))
    profile = reports.hourly_profile(wide, ["rainfall_realtime"]).withColumn("time_hr", F.lit("01"))
    got = R.predict_profile(model, profile, spark.createDataFrame(
        [(1001, "0030")], "cam_id long, time string"))
    assert got.columns == ["cam_id", "direction", "congestion_prediction", "rainfall_realtime"]
    assert {r.congestion_prediction for r in got.collect()} == {"Mild"} and got.count() == 2


def test_prediction_from_a_profile_of_many_measures(spark):
    """Planning does not list every mix of a mean and its name (2 to the power of the measures)."""
    measures = [f"m{i}" for i in range(35)]
    wide = spark.range(400).select(
        F.lit("2024-03-01T010500").alias(S.TS), (F.col("id") % 4).alias("cam_id"),
        F.lit(1).alias("direction"), (F.col("id") % 4).cast("double").alias("label"),
        *[(F.col("id") % 4 + i).cast("double").alias(m) for i, m in enumerate(measures)])
    model = R.fit_once_read(wide, [*measures, "cam_id", "direction"], trees=2, depth=2)
    asked = spark.createDataFrame([(2, "0130"), (9, "0130")], "cam_id long, time string")
    got = R.predict_profile(model, reports.hourly_profile(wide, measures), asked).collect()
    assert [(r.cam_id, r.congestion_prediction, r.m3) for r in got] == [(2, "Medium", 5.0)]


def test_profile_prediction_fits_the_whole_forest(spark, monkeypatch):
    """The query names no smaller forest than its operator's 280 trees of depth 19."""
    class Seen(Exception):
        pass

    def fit(forest, rows):
        raise Seen(forest.trees, forest.depth, len(forest.features))

    monkeypatch.setattr(grow.Forest, "fit", fit)
    with pytest.raises(Seen) as seen:
        QUERIES["profile_prediction"](spark, "/root/testdata/sf0.001")
    assert seen.value.args == (280, 19, 37)

"""What Spark would size too low is not sent through the driver."""

from pyspark.sql import functions as F

from feedloom.llm import near_copies, simhash
from feedloom.operators import boxes as B
from feedloom.session import cut_lineage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_probes_of_fingerprints_are_not_broadcast(spark):
    prints = cut_lineage(spark.range(2000).select(
        F.when(F.col("id") < 1000, F.xxhash64("id")).otherwise(
            F.xxhash64(F.col("id") - 1000).bitwiseXOR(F.lit(5 << 30))).alias("fp")))
    links = simhash.links(prints)
    assert "BroadcastExchange" not in plan(links)
    assert {frozenset(r) for r in links.collect()} == {
        frozenset((r.fp, r.other)) for r in prints.select(
            "fp", F.col("fp").bitwiseXOR(F.lit(5 << 30)).alias("other")).collect()}


def test_cells_of_many_boxes_are_not_broadcast(spark, monkeypatch):
    """Few boxes, which Spark takes their cells to be, lie in many cells."""
    points = cut_lineage(spark.range(3000).selectExpr(
        "id", "1.0D + (id % 60) / 100 AS lat", "103.0D + floor(id / 60) / 100 AS lon"))
    boxes = cut_lineage(spark.range(40).selectExpr(
        "id AS b", "1.0D + id / 100 AS south", "103.0D + id / 200 AS west").selectExpr(
        "*", "south + 0.065 AS north", "west + 0.045 AS east"))
    monkeypatch.setattr(B, "HELD", 500, raising=False)
    many = B.points_in_boxes(points, boxes)
    assert "BroadcastExchange" not in plan(many)
    monkeypatch.setattr(B, "HELD", 50_000, raising=False)
    few = B.points_in_boxes(points, boxes)
    assert "BroadcastExchange" in plan(few)
    want = points.crossJoin(boxes).filter(
        "lat between south and north and lon between west and east").select("id", "b")
    want = sorted(map(tuple, want.collect()))
    assert len(want) > 500
    for found in (many, few):
        assert sorted((r.id, r.b) for r in found.collect()) == want


def test_near_copies_are_sized_at_run_time(spark, monkeypatch):
    """What the stage joins is broadcast once its rows are known, and its settings end with it."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(n, None) for n in names]
    seen, alike = [], near_copies._Texts.alike

    def looked(texts, pairs, share):
        seen.append(plan(texts.may(pairs, share)))
        return alike(texts, pairs, share)

    monkeypatch.setattr(near_copies._Texts, "alike", looked)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda w: F.concat(
        F.floor(F.col("id") / 2).cast("string"), F.lit("w"), w.cast("string"))))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 2 == 0, text).otherwise(F.concat(text, F.lit(" more"))).alias("text"))
    assert sorted(r.doc_id for r in near_copies.keep_first(docs).collect()) == list(range(0, 40, 2))
    assert seen and not any("BroadcastExchange" in p for p in seen)
    assert [spark.conf.get(n, None) for n in names] == before

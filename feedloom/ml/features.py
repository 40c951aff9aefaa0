"""Model input from the wide table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S
from feedloom.functions import labels, timetext
from feedloom.session import cut_lineage, has_at_most

CAMERA = ("cam_id", "direction")


def parse_times(wide: DataFrame, columns=S.TIME_COLUMNS) -> DataFrame:
    """Canonical texts to timestamps."""
    return wide.withColumns({c: timetext.to_ntz(c) for c in columns})


def numeric_frame(wide: DataFrame, *, features=S.FEATURES, label: str = S.LABEL,
                  mapping: dict = labels.ORDINAL, keep=(), drop_camera: bool = False
                  ) -> DataFrame:
    """Complete rows with a known label, coded as ``label``; the label is no feature."""
    used = [f for f in features if f != label and not (drop_camera and f in CAMERA)]
    rows = wide.filter(labels.is_known(label))
    out = rows.select(*keep, *[F.col(f"`{f}`").cast("double").alias(f) for f in used
                               if f not in keep],
                      labels.ordinal(label, mapping).cast("double").alias("label"))
    return out.dropna("any")


def categorical_columns(wide: DataFrame, *, label: str = S.LABEL,
                        exclude=(*S.IDENTIFIERS, *S.TIME_COLUMNS)) -> list[str]:
    return [f.name for f in wide.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in (*exclude, label)]


def categories(df: DataFrame, column: str) -> DataFrame:
    """``category, slot`` of a column's values as texts: the most frequent gets slot 0, of equally
    frequent ones the lesser text comes first; null is no category.

    Counts are sorted by range and numbered within each range; the ranges' sizes, a row per
    partition, give what comes before. The values themselves never meet in one task.
    """
    text = F.col(f"`{column}`").cast("string").alias("category")
    counts = df.select(text).dropna().groupBy("category").agg(F.count("*").alias("n"))
    order = (F.desc("n"), F.asc("category"))
    # Written once, so that every reader sees the same ranges.
    placed = cut_lineage(counts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "category", F.monotonically_increasing_id().alias("at")))
    part, here = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    return placed.withColumn("part", part).join(
        F.broadcast(sizes.select("part", before.alias("before"))), "part").select(
        "category", (F.col("before") + here).alias("slot"))


@dataclass(frozen=True)
class OneHot:
    """Categories of each column as a table, and the encoder that knows only their numbers."""

    tables: dict[str, DataFrame]
    encoder: OneHotEncoderModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``<column>_index`` and the sparse vector ``<column>_hot``; a value without a
        category, null included, takes the slot after the last one."""
        for (column, known), size in zip(self.tables.items(), self.encoder.categorySizes):
            key, named = f"__{column}", known.select(
                F.col("category").alias(f"__{column}"), F.col("slot").alias("__slot"))
            named = F.broadcast(named) if has_at_most(known) else named
            df = df.withColumn(f"{column}_index", F.col(f"`{column}`").cast("string"))
            df = df.join(named, F.col(f"`{column}_index`") == F.col(f"`{key}`"), "left").withColumn(
                f"{column}_index", F.coalesce("__slot", F.lit(size)).cast("double")).drop(
                key, "__slot")
        return self.encoder.transform(df)


def one_hot(df: DataFrame, columns: list[str]) -> OneHot:
    """Encoder with a slot for every category and one for unseen values.

    The driver meets a number per column, not the categories. A column without any value has the
    slot for unseen values only beside an empty one.
    """
    tables = {c: cut_lineage(categories(df, c)) for c in columns}
    names = [f"{c}_index" for c in columns]
    last = [t.agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0] for t in tables.values()]
    encode = OneHotEncoder(inputCols=names, outputCols=[f"{c}_hot" for c in columns],
                           dropLast=False, handleInvalid="keep")
    return OneHot(tables, encode.fit(df.sparkSession.createDataFrame(
        [[float(x) for x in last]], ", ".join(f"`{n}` double" for n in names))))


def assembler(columns) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features",
                           handleInvalid="skip")


def bucket(keys, seed: int = 42):
    """Fraction in [0, 1) that depends on the key alone, not on the layout of the data."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return head / F.lit(float(2 ** 32))


def split(df: DataFrame, keys, *, test: float = 0.25, valid: float = 0.25,
          seed: int = 42) -> DataFrame:
    """Adds ``part``: a share ``test`` of all rows, then ``valid`` of the others."""
    b = bucket(keys, seed)
    cut = test + (1 - test) * valid
    return df.withColumn("part", F.when(b < test, "test").when(b < cut, "valid")
                         .otherwise("train"))

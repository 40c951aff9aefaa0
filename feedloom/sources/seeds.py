"""Seed files: small CSV tables kept by hand, bound by name and checked by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S
from feedloom.operators.reshape import paired_unpivot
from feedloom.sources.csvfeeds import read_csv_by_name


def checked(rows: DataFrame, keys) -> DataFrame:
    """``rows``, failing the job where a key is absent or given twice."""
    keys = list(keys)
    absent = F.count_if(F.greatest(*[F.col(f"`{k}`").isNull() for k in [*keys, *keys]]))
    twice = rows.groupBy(*[f"`{k}`" for k in keys]).agg(F.count("*").alias("n")).filter("n > 1")
    ok = F.assert_true((rows.agg(absent).scalar() == 0) & (twice.agg(F.count("*")).scalar() == 0),
                       F.lit(f"seed rows without or with equal {', '.join(keys)}"))
    return rows.filter(ok.isNull())


def read_seed(spark: SparkSession, path: str | list[str], schema: T.StructType, keys=None, *,
              glob: str | None = None) -> DataFrame:
    """A seed by the names of its header, whatever their order; its first column is the key unless
    ``keys`` names others."""
    first = schema.fieldNames()[0]
    rows = read_csv_by_name(spark, path, schema, marker=first, glob=glob)
    return checked(rows, keys or [first])


def routes(cameras: DataFrame) -> DataFrame:
    """The camera seed's pairs ``dir_start_1``, ``dir_finish_1`` and on as a row per direction."""
    numbered = [c for c in cameras.columns if S.strip_suffix(c) != c]
    stems = list(dict.fromkeys(map(S.strip_suffix, numbered)))
    out = paired_unpivot(cameras, ["camera_id", "cam_loc", "remarks"], stems,
                         range(1, len(numbered) // len(stems) + 1))
    return out.select(*S.ROUTES.fieldNames())

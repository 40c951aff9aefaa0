"""Session settings, shared scratch folders and size checks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows below which a dimension may be held by every task.
SMALL_ROWS = 20_000


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the plans rely on; all can be set on a live session."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even when the split costs one more exchange downstream.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


@contextmanager
def sized_at_run_time(spark: SparkSession) -> Iterator[None]:
    """Within, Spark broadcasts a table only once it has met its rows, or where it is told to, and
    deletes the rows that a query exchanged as soon as the query ends.

    Else it goes by the size of compressed files, which says little of short keys, lists or what an
    explode makes of them, and exchanged rows stay on disk until the driver happens to collect
    garbage.
    """
    static, adaptive, clean = (f"spark.sql.{n}" for n in (
        "autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold",
        "classic.shuffleDependency.fileCleanup.enabled"))
    before = {n: spark.conf.get(n, None) for n in (static, adaptive, clean)}
    spark.conf.set(adaptive, before[adaptive] or spark.conf.get(static))
    spark.conf.set(static, "-1")
    spark.conf.set(clean, "true")
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is missing and all tasks run in this process is one made up.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = os.path.join(tempfile.gettempdir(), "feedloom-shared")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/feedloom/{name}-{uuid.uuid4().hex}"


def count_up_to(df: DataFrame, rows: int) -> int:
    """Number of rows, counting no further than ``rows + 1``."""
    return df.select(F.lit(1)).limit(rows + 1).count()


def has_at_most(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    return count_up_to(df, rows) <= rows


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder on any file system Spark knows; False if it is not there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = scratch_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return _told(df.sparkSession.read.parquet(path), path)


def cut_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Cut that is dealt and sorted by ``keys``, so that joins and groups on them need no
    exchange of its side. The name under which Spark knows the dealing goes at once."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch_dir(spark, "keyed"), f"feedloom_{uuid.uuid4().hex}"
    (df.repartition(parts, *keys).write.bucketBy(parts, *keys).sortBy(*keys)
     .option("path", path).option("compression", "zstd").saveAsTable(name))
    out = _told(spark.table(name), path)
    spark.sql(f"DROP TABLE {name}")
    return out


def _told(df: DataFrame, path: str) -> DataFrame:
    df._cut_at = path
    return df


def release(*cuts: DataFrame) -> None:
    """Delete cuts whose readers are done; for frames as the functions above return them."""
    for df in cuts:
        remove(df.sparkSession, df._cut_at)

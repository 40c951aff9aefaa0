"""Documents to token files: STAGES run in order, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, mixing, near_copies, quality, token_records
from feedloom.session import cut_lineage, scratch_dir, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (5-word Jaccard of 0.8) the smallest id's document stays."""
    return near_copies.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is cut or repeated to its target; a row per pass over a document."""
    sized = mixing.with_sizes(docs)
    sizes = cut_lineage(sized.select("doc_id", "source", "size"))
    cells, shards = mixing.quotas(sizes)
    taken = mixing.take(mixing.mix(sized, cells, shards, tie=F.xxhash64("text")))
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' records, read back."""
    folder = scratch_dir(spark, "corpus")
    return token_records.read(token_records.write(docs, folder, TOKENIZER), folder)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Fingerprints, seeded blocks and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

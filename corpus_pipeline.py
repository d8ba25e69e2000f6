"""From raw documents to packed training windows, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as
the next one's ``docs``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from emberline.llm import jaccard, mixing, packing, secret_scan, toxicity
from emberline.llm.components import small_batches
from emberline.llm.queries import VOCABULARY
from emberline.session import scratch_path, ship_package


def stage(function):
    """A step of the pipeline in a session that is set up for whole texts."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents above the model's limit go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or by others, the one with the least doc_id stays."""
    return jaccard.keep_one(docs)


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    return secret_scan.redact(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped, kept or doubled until the sources have their target sizes."""
    return mixing.apply(docs)


@stage
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of training windows."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Learned weights and random rounding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

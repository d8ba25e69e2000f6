"""The registered queries of the training-data operators; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberline.llm import digest, jaccard, katz, mixing, negatives, packing, periodic, permutation
from emberline.llm import personal, quality, secret_scan, substrings, toxicity
from emberline.llm.components import small_batches
from emberline.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op4_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op5_permutation_index(spark, sf_dir):
    return permutation.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op8_digests(spark, sf_dir):
    return digest.fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark, sf_dir):
    return substrings.dedup(table(spark, sf_dir, "documents"))


@query
def op3_katz_scores(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"), katz.one_in_seven())


@query
def op7_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_hard_negatives(spark, sf_dir):
    return negatives.mine(negatives.shifted(table(spark, sf_dir, "embeddings")))


@query
def op12_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return personal.summary(personal.scan(docs, personal.fit(docs)))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic.summary(periodic.find(table(spark, sf_dir, "documents"), periodic.looped))

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    boosting,
    curriculum,
    dac,
    factorization,
    hostrules,
    linespread,
    rotation,
    simhash,
    subspaces,
    topk,
    transducer,
    tries,
    urlfilter,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {
    "op1_exact_top_k": topk.ORACLE,
    "op2_url_filter": urlfilter.ORACLE,
    "op3_embedding_near_dedup": subspaces.ORACLE,
    "op5_mixing_to_target_weights": curriculum.ORACLE,
    "op10_line_dedup": linespread.ORACLE,
    "op11_host_rules": hostrules.ORACLE,
    "op12_fill_in_middle": rotation.ORACLE,
    "op13_filter_audit": tries.ORACLE,
}

TOKENIZER = "byte_bpe_50k.json"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.every(table(spark, sf_dir, "embeddings"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlfilter.judged(table(spark, sf_dir, "pages"))
    # Logarithms differ in their last digits between engines. A rule's verdict stands without the score.
    score = F.round(F.col("score").cast("decimal(38,12)"), 6).cast("double")
    return found.withColumn("score", F.when(F.col("rule").isNull(), score))


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspaces.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = factorization.train(docs, table(spark, sf_dir, "labels"))
    return factorization.judged(docs, machine)


@query
def op5_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.accounts(table(spark, sf_dir, "documents"))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dac.read(dac.write(docs, public_tokenizers.path(TOKENIZER)))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = boosting.train(docs, table(spark, sf_dir, "labels"))
    return boosting.judged(docs, forest)


@query
def op9_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    return transducer.digests(docs, path, transducer.build(docs, path))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linespread.report(table(spark, sf_dir, "documents"))


@query
def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judged(table(spark, sf_dir, "documents"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation.digests(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

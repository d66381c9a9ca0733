"""The corpus pipeline: reject, clean, deduplicate, mix and encode documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``docs``.

In every stage null texts count as empty, rows without an id or a source take part,
very long texts are taken whole, further columns are carried along, and an empty table
gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import boosting, curriculum, linespread, simhash, transducer
from tidemark.llm.common import table
from tidemark.llm.registry import TOKENIZER
from tidemark.session import configure
from tidemark.sources import stored


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, accepts.

    A score equal to the threshold accepts; rows that repeat are judged alike. Without
    labels every score is even, which accepts.
    """
    configure(spark)
    return boosting.accepted(docs, boosting.train(docs, table(spark, sf_dir, "labels")))


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sites keep their first occurrence only.

    The first is that of the smallest id, no id last, then text digest and position;
    rows that repeat wholly lose the same lines. A document may end up empty, and stays.
    """
    configure(spark)
    return linespread.line_dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays.

    It is the one with the smallest id, no id last, then the least text digest; of rows
    that repeat wholly one stays. Documents without words are one group.
    """
    configure(spark)
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per copy that the mix takes, in training order.

    No source is a source of its own. Copies at one position follow a hash of id and
    text. Documents without words count as one copy where their place is within the target.
    """
    configure(spark)
    return curriculum.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per copy; an empty text has no ids."""
    configure(spark)
    path = public_tokenizers.path(TOKENIZER)
    return transducer.digests(docs, path, transducer.build(docs, path))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("line dedup", remove_boilerplate),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("bpe encoding and decoding", encode),
]

# A trained model, 64-bit text hashes and byte-pair merges are not SQL; tests compare
# the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

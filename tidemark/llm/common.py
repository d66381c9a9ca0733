"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure
from tidemark.sources import read_table

# Text that a task turns into Python or numpy objects at once. One longer text is
# still handled whole, alone in its slice.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(configure(spark), f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession, path: str) -> str:
    """Hand a file to all executors; its name there, for ``SparkFiles.get``."""
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < len(sizes):
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def unpacked(batch: pa.RecordBatch, text: str = "text") -> pa.RecordBatch:
    """A batch with the struct column ``row`` and the text inside it as a column."""
    row = batch.column("row")
    return pa.RecordBatch.from_arrays([row, pc.struct_field(row, text)], ["row", text])


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [value or "" for value in batch.column(text).to_pylist()]


def remainder(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def text_key(text: str = "text") -> Column:
    """A digest of the text, to tell rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same_key(left: DataFrame, right: DataFrame, names: Iterable[str]) -> Column:
    """Equal on all the names, null equal to null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int) -> DataFrame:
    """(doc_id, label, text) of at most ``sample`` labelled documents that are not held out.

    Ids are hashed and the smallest hashes win, so reruns agree. Rows whose id or
    label is null are left out; an id that is labelled or present twice counts
    once, with the larger label and text.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.filter(remainder("doc_id", folds) != held_out)
    ids = docs.select("doc_id").distinct().join(known, "doc_id")
    chosen = ids.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(sample)
    # At most ``sample`` short rows, so the texts need no shuffle to meet them.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))

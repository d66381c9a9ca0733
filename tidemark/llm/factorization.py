"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words and the beginnings of its longer words, hashed.
The score is ``sigmoid(bias + sum w_i + sum_{i<j} <v_i, v_j>)`` over the terms a text
holds, so a pair of terms can weigh more, or less, than both alone. Linear weights are
shrunk towards zero with each step; terms at zero take no part, in pairs neither, so
common words in long texts add up to nothing.

The fit uses a bounded sample: the ``sample`` labelled training rows whose ids have
the smallest hash. The driver gets their term hashes, and the model is bounded by the
terms that at least ``min_df`` of them share. Terms and scores are computed by tasks
over whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tidemark.llm.common import remainder, slices, texts_of, training_sample

SAMPLE = 12_000
FOLDS = 3
HELD_OUT = 1
THRESHOLD = 0.7
HASH_BITS = 24
# Lengths, in characters, of the beginnings of longer words that count as terms.
PREFIXES = (4, 6)

_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
_TO_BLANK = bytes.maketrans(_MARKS, b" " * len(_MARKS))


def _hash(words: list[bytes]) -> np.ndarray:
    """(words, 1 + prefixes) hashes: of the word, and of its beginnings, -1 if it is not longer."""
    mask, crc = (1 << HASH_BITS) - 1, zlib.crc32
    out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int64)
    out[:, 0] = np.fromiter((crc(word) & mask for word in words), np.int64, len(words))
    for at, size in enumerate(PREFIXES, 1):
        for row, word in enumerate(words):
            if len(word) > size and len(text := word.decode("utf-8", "replace")) > size:
                out[row, at] = crc(b"^" + text[:size].encode()) & mask
    return out


def terms(texts: list[str], active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) of every distinct term of every text, sorted.

    With ``active``, sorted term hashes, only those terms, as positions in it.
    """
    split = [text.lower().encode("utf-8", "replace").translate(_TO_BLANK).split() for text in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.empty(int(counts.sum()), object)
    flat[:] = [word for words in split for word in words]
    codes, words = pd.factorize(flat)
    hashes = _hash(list(words))
    if active is not None:
        at = np.searchsorted(active, hashes)
        found = (at < len(active)) & (hashes >= 0)
        found[found] = active[at[found]] == hashes[found]
        hashes = np.where(found, at, -1)
    owner = np.repeat(np.arange(len(texts)), counts)
    pairs = np.concatenate([(owner[keep] << 32) | each[keep] for each in hashes[codes].T for keep in [each >= 0]])
    pairs = np.unique(pairs)
    return pairs >> 32, pairs & 0xFFFFFFFF


@dataclass(frozen=True)
class Settings:
    """Settings of the fit."""

    factors: int = 4
    epochs: int = 8
    batch: int = 256
    rate: float = 0.3
    shrink: float = 5e-4
    penalty: float = 1e-4
    min_df: int = 4
    seed: int = 7


@dataclass
class Machine:
    """Weights of the terms that the fit kept, in the order of their hashes."""

    bias: float
    active: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """Probabilities of label 1; a text without known terms has that of the bias."""
        owner, term = terms(texts, self.active)
        return 1.0 / (1.0 + np.exp(-_margin(owner, term, len(texts), self.bias, self.weight, self.factor)))


def _margin(owner, term, count, bias, weight, factor) -> np.ndarray:
    total = np.full(count, bias)
    total += np.bincount(owner, weight[term], count)
    for k in range(factor.shape[1]):
        v = factor[term, k]
        total += 0.5 * (np.bincount(owner, v, count) ** 2 - np.bincount(owner, v * v, count))
    return np.clip(total, -30, 30)


def fit(owner: np.ndarray, term: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Machine:
    """Adaptive gradient steps on the logistic loss; ``owner`` is sorted and numbers the labels."""
    labels = np.asarray(labels, np.float64)
    n = len(labels)
    hashes, df = np.unique(term, return_counts=True)
    active = hashes[df >= settings.min_df]
    mean = float(np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    bias = float(np.log(mean / (1 - mean)))
    width = len(active)
    weight = np.zeros(width)
    rng = np.random.default_rng(settings.seed)
    factor = rng.normal(0, 0.01, (width, settings.factors))
    if not width or labels.min() == labels.max():
        return Machine(bias, active[:0], weight[:0], factor[:0])
    at = np.minimum(np.searchsorted(active, term), width - 1).astype(np.int32)
    known = active[at] == term
    owner, term = owner[known], at[known]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    w_sum, v_sum, b_sum = np.full(width, 1e-6), np.full((width, settings.factors), 1e-6), 1e-6
    for _ in range(settings.epochs):
        order = rng.permutation(n)
        for first in range(0, n, settings.batch):
            rows = order[first : first + settings.batch]
            sizes = bounds[rows + 1] - bounds[rows]
            spot = np.repeat(bounds[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            which, doc = term[spot], np.repeat(np.arange(len(rows)), sizes)
            ids, local = np.unique(which, return_inverse=True)
            # A term whose weight is zero has no pairs yet.
            w, v = weight[ids], factor[ids] * (weight[ids] != 0)[:, None]
            miss = 1.0 / (1.0 + np.exp(-_margin(doc, local, len(rows), bias, w, v))) - labels[rows]
            miss /= len(rows)
            slope = np.bincount(local, miss[doc], len(ids))
            w_sum[ids] += slope**2
            step = settings.rate / np.sqrt(w_sum[ids])
            w = w - step * slope
            weight[ids] = np.sign(w) * np.maximum(np.abs(w) - step * settings.shrink, 0)
            for k in range(settings.factors):
                each = v[local, k]
                sums = np.bincount(doc, each, len(rows))
                g = np.bincount(local, miss[doc] * (sums[doc] - each), len(ids))
                g = g * (weight[ids] != 0) + settings.penalty * v[:, k]
                v_sum[ids, k] += g**2
                factor[ids, k] -= settings.rate * 0.2 * g / np.sqrt(v_sum[ids, k])
            g = miss.sum()
            b_sum += g**2
            bias -= settings.rate * g / np.sqrt(b_sum)
    kept = np.flatnonzero(weight)
    return Machine(float(bias), active[kept], weight[kept], factor[kept])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS,
          held_out: int = HELD_OUT, sample: int = SAMPLE, settings: Settings = Settings()) -> Machine:
    """Fit on the bounded sample; no labelled rows give an even score for all."""
    chosen = training_sample(docs, labels, label, folds, held_out, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, term = terms(texts_of(batch))
            offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(term.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists], ["doc_id", "label", "terms"])

    fields = [chosen.schema["doc_id"], StructField("label", IntegerType()), StructField("terms", ArrayType(IntegerType(), False))]
    rows = chosen.mapInArrow(run, StructType(fields)).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), settings)
    lists = rows["terms"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    return fit(owner, lists.flatten().to_numpy(), rows["label"].to_numpy(), settings)


def judged(docs: DataFrame, machine: Machine, folds: int = FOLDS, held_out: int = HELD_OUT,
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; null texts count as empty.

    A row without an id is not held out, a score equal to the threshold is predicted 1.
    Repeated rows stay; an empty table gives an empty one. Columns other than doc_id
    and text aren't read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(machine.score(texts_of(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    narrow = docs.select("doc_id", "text")
    scored = narrow.mapInArrow(run, StructType([narrow.schema["doc_id"], StructField("score", DoubleType())]))
    side = F.coalesce(remainder("doc_id", folds) == held_out, F.lit(False))
    return scored.select("doc_id", side.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

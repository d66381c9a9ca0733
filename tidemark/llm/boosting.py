"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the labelled rows are cut into at most 255 bins per column. Trees grow
level by level from histograms of gradients, each node split where the gain is
largest, and end up in flat arrays (feature, threshold, children, value). Scoring
walks all rows of a batch through all trees at once with numpy.

The fit uses a bounded sample: the ``sample`` labelled training rows whose ids have
the smallest hash, so memory on the driver is bounded by ``sample`` times the number
of statistics. Statistics and scores are computed by tasks over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from tidemark.llm import docstats
from tidemark.llm.common import remainder, slices, texts_of, training_sample, unpacked

SAMPLE = 20_000
FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3


@dataclass(frozen=True)
class Boosting:
    """Settings of the fit."""

    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 255
    least_rows: int = 20
    penalty: float = 1.0


@dataclass
class Forest:
    """Trees of one depth as arrays over (tree, node); node i has children 2i+1 and 2i+2."""

    start: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for a (rows, statistics) array."""
        trees = np.arange(len(self.feature))[:, None]
        each = np.arange(len(rows))[None, :]
        node = np.zeros((len(self.feature), len(rows)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (rows[each, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.start + self.value[trees, node].sum(0)
        return 1.0 / (1.0 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges between bins: midpoints of distinct values, or quantiles where there are many."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return ((values[1:].astype(np.float64) + values[:-1]) / 2).astype(np.float32)


def fit(rows: np.ndarray, labels: np.ndarray, settings: Boosting = Boosting()) -> Forest:
    """Trees for 0/1 labels by the logistic loss. One class only gives its own constant."""
    rows, labels = np.asarray(rows, np.float32), np.asarray(labels, np.float64)
    n, width = rows.shape
    nodes = 2 ** (settings.depth + 1) - 1
    feature = np.zeros((settings.trees, nodes), np.int64)
    threshold = np.full((settings.trees, nodes), np.inf, np.float32)
    value = np.zeros((settings.trees, nodes))
    mean = float(np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    forest = Forest(start, settings.depth, feature, threshold, value)
    if n == 0 or labels.min() == labels.max():
        return forest
    edges = [_edges(rows[:, j], settings.bins) for j in range(width)]
    most = max(map(len, edges)) + 1
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], 1)
    slots = binned + most * np.arange(width)[None, :]
    total = np.full(n, start)
    for tree in range(settings.trees):
        chance = 1.0 / (1.0 + np.exp(-total))
        slope, curve = chance - labels, np.maximum(chance * (1 - chance), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(settings.depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * most) + slots).ravel()
            size = count * width * most
            shape = (count, width, most)
            g = np.bincount(cell, np.repeat(slope, width), size).reshape(shape).cumsum(2)
            h = np.bincount(cell, np.repeat(curve, width), size).reshape(shape).cumsum(2)
            c = np.bincount(cell, minlength=size).reshape(shape).cumsum(2)
            all_g, all_h, all_c = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = (
                g**2 / (h + settings.penalty)
                + (all_g - g) ** 2 / (all_h - h + settings.penalty)
                - all_g**2 / (all_h + settings.penalty)
            )
            gain[(c < settings.least_rows) | (all_c - c < settings.least_rows)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for k in range(count):
                column, cut = divmod(int(best[k]), most)
                if gain[k, column, cut] > 1e-9 and cut < len(edges[column]):
                    feature[tree, first + k] = column
                    threshold[tree, first + k] = edges[column][cut]
            # A node without a split keeps an infinite threshold: all its rows go left.
            node = 2 * node + 1 + (rows[np.arange(n), feature[tree, node]] > threshold[tree, node])
        leaves = np.bincount(node, slope, nodes), np.bincount(node, curve, nodes)
        value[tree] = -settings.rate * leaves[0] / (leaves[1] + settings.penalty)
        total += value[tree, node]
    return forest


_STATS = ArrayType(FloatType(), False)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``stats``, the statistics of the whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.concatenate([docstats.statistics(text) for text in texts_of(batch)])
            stats = pa.FixedSizeListArray.from_arrays(pa.array(found), len(docstats.NAMES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), stats], [*keep, "stats"])

    fields = [docs.schema[name] for name in keep] + [StructField("stats", _STATS)]
    return docs.select(*keep, "text").mapInArrow(run, StructType(fields))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS,
          held_out: int = HELD_OUT, sample: int = SAMPLE, settings: Boosting = Boosting()) -> Forest:
    """Fit on the bounded sample; no labelled rows give an even score for all."""
    rows = with_statistics(training_sample(docs, labels, label, folds, held_out, sample), ["label"]).toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(docstats.NAMES))), np.zeros(0), settings)
    stats = np.stack(rows["stats"].to_numpy())
    marks = rows["label"].to_numpy()
    # Rows come in any order; a fixed order keeps sums, and so the trees, the same in each run.
    order = np.lexsort([*stats.T, marks])
    return fit(stats[order], marks[order], settings)


def with_score(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per document: ``row``, all input columns as a struct, and ``score``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(map(unpacked, batches)):
            found = forest.score(np.stack([docstats.statistics(text) for text in texts_of(batch)]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found)], ["row", "score"])

    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, StructType([packed.schema["row"], StructField("score", DoubleType())]))


def judged(docs: DataFrame, forest: Forest, folds: int = FOLDS, held_out: int = HELD_OUT,
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; null texts count as empty.

    A row without an id is not held out, a score equal to the threshold is predicted 1.
    Repeated rows stay; an empty table gives an empty one. Columns other than doc_id
    and text aren't read.
    """
    scored = with_score(docs.select("doc_id", "text"), forest).select("row.doc_id", "score")
    side = F.coalesce(remainder("doc_id", folds) == held_out, F.lit(False))
    return scored.select("doc_id", side.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold.

    Null texts count as empty; repeated rows are judged alike, rows without an id like
    others; an empty table gives an empty one.
    """
    return with_score(docs, forest).filter(F.col("score") >= threshold).select("row.*")

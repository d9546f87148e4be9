"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document is ``sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``.  The pairwise
part is computed in time linear in the document's features by the sum-of-squares identity
``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.

Features: distinct words hashed into ``WORD_BINS`` bins, with damped counts of unit length; structure
statistics of the whole text (shares of upper case, digits, marks and several single marks, word
length, repeated words, line lengths), each as one of ``STAT_BINS`` one-hot levels; and the text's
length as metadata.  Language, source, id and labels are never features.

The model is fitted in the driver on at most ``TRAIN_ROWS`` labelled documents (the smallest hashes
of their ids), which bounds what is collected there; scoring is one narrow pass over all documents.

Defined results: null and empty texts have no words and the lowest statistics, and get a score like
all others; without labels, or with one class only, the smoothed share of label 1 is everyone's score;
labels of unknown documents are ignored; a document with several labels counts once for each; null
ids are never held out; repeated rows get equal scores; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marisight.llm import _words as W
from marisight.llm._batches import slices

WORD_BINS = 1 << 16
STAT_BINS = 16
FACTORS = 8
TRAIN_ROWS = 12_000
THRESHOLD = 0.3
_EPOCHS, _LEAST_STEPS, _BATCH, _RATE = 12, 200, 256, 0.08
_MARKS = b"!*#$%&|.,"
_STATS = 3 + len(_MARKS) + 6
SIZE = WORD_BINS + _STATS * STAT_BINS


def _share_level(share: np.ndarray) -> np.ndarray:
    """0 for none, then one level per factor of two below 1."""
    with np.errstate(divide="ignore"):
        return np.where(share <= 0, 0, np.clip(STAT_BINS - 1 + np.ceil(np.log2(np.maximum(share, 1e-9))), 1, STAT_BINS - 1)).astype(np.int64)


def _log_level(x: np.ndarray, step: float = 1.0) -> np.ndarray:
    return np.clip(np.log2(np.maximum(x, 0) + 1) / step, 0, STAT_BINS - 1).astype(np.int64)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of every text, ordered by row and feature."""
    m = len(column)
    w = W.words(column)
    raw, offsets = W.utf8(column)
    words, row = w.counts, w.row_of()
    size = np.diff(offsets)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    n = np.maximum(size, 1)
    stats = [count((raw >= 65) & (raw <= 90)), count((raw >= 48) & (raw <= 57)), count((raw > 32) & (raw < 127) & ~((raw >= 48) & (raw <= 57)) & ~((raw | 32) >= 97) | (raw > 122) & (raw < 127))]
    stats += [count(raw == b) for b in _MARKS]
    levels = [_share_level(s / n) for s in stats]
    h = W.word_hashes(w)
    key = (row.astype(np.uint64) << np.uint64(16)) | (h >> np.uint64(48))
    key, times = np.unique(key, return_counts=True)
    rows, bins = (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(0xFFFF)).astype(np.int64)
    distinct = np.bincount(rows, minlength=m)
    lines = count(raw == 10) + 1
    some = np.maximum(words, 1)
    levels += [
        _log_level(size / some, 0.25),
        _share_level(distinct / some),
        _log_level(words / lines, 0.75),
        _log_level(np.bincount(rows, weights=times.astype(float) ** 2, minlength=m) / some, 0.75),
        _log_level(size),
        _share_level(count(raw >= 128) / n),
    ]
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(rows, weights=value * value, minlength=m))
    value = value / norm[rows] if len(rows) else value
    stat_rows = np.repeat(np.arange(m), _STATS)
    stat_bins = (WORD_BINS + np.arange(_STATS) * STAT_BINS + np.stack(levels, 1)).ravel() if m else np.zeros(0, np.int64)
    all_rows, all_bins = np.r_[rows, stat_rows], np.r_[bins, stat_bins]
    all_values = np.r_[value, np.full(len(stat_rows), 1 / np.sqrt(_STATS))].astype(np.float32)
    by = np.argsort(all_rows, kind="stable")
    return all_rows[by], all_bins[by], all_values[by]


@dataclass
class Model:
    """Bias, linear weights and factors."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def sums(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(logit, sum_i v_if x_i) of m rows."""
        logit = self.bias + np.bincount(row, weights=self.linear[feature] * value, minlength=m)
        total = np.empty((m, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            vx = self.factors[feature, f] * value
            total[:, f] = np.bincount(row, weights=vx, minlength=m)
            logit += 0.5 * (total[:, f] ** 2 - np.bincount(row, weights=vx * vx, minlength=m))
        return logit, total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Logistic loss by AdaGrad, on (features, values) of each document."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32))
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    rng = np.random.default_rng(seed)
    model.factors = rng.normal(0, 0.05, (SIZE, FACTORS)).astype(np.float32)
    g_linear, g_factors = np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6)
    g_bias = 1e-6
    for _ in range(max(_EPOCHS, -(-_LEAST_STEPS * _BATCH // len(rows)))):  # few rows are seen more often
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), _BATCH):
            ids = order[lo : lo + _BATCH]
            row = np.repeat(np.arange(len(ids)), [len(rows[i][0]) for i in ids])
            feature = np.concatenate([rows[i][0] for i in ids])
            value = np.concatenate([rows[i][1] for i in ids]).astype(np.float64)
            logit, total = model.sums(row, feature, value, len(ids))
            error = (sigmoid(logit) - labels[ids]) / len(ids) * 16
            touched, at = np.unique(feature, return_inverse=True)
            ex = error[row] * value
            d = np.bincount(at, weights=ex, minlength=len(touched)) + 1e-4 * model.linear[touched]
            g_linear[touched] += d * d
            model.linear[touched] -= (_RATE * d / np.sqrt(g_linear[touched])).astype(np.float32)
            for f in range(FACTORS):
                v = model.factors[feature, f]
                d = np.bincount(at, weights=ex * (total[row, f] - v * value), minlength=len(touched)) + 1e-4 * model.factors[touched, f]
                g_factors[touched, f] += d * d
                model.factors[touched, f] -= (_RATE * 0.5 * d / np.sqrt(g_factors[touched, f])).astype(np.float32)
            g_bias += float(error.sum()) ** 2
            model.bias -= _RATE * float(error.sum()) / np.sqrt(g_bias)
    return model


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", most: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``most`` labelled rows of docs, none of them held out."""
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)
    rows = docs.select("doc_id", F.col(text).alias("t")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("t").alias("t")).select("t", "doc_id", "y")  # one text of an id that repeats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 1 << 20):
            row, feature, value = features(batch.column(0))
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            made = [pa.ListArray.from_arrays(offsets, pa.array(feature.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(value))]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *made], names=["doc_id", "y", "feature", "value"])

    table = rows.mapInArrow(run, "doc_id long, y int, feature array<int>, value array<float>").toArrow()
    pairs = []
    ids, y = table["doc_id"].to_numpy(), table["y"].to_numpy()
    lists = [table[c].combine_chunks() if table.num_rows else None for c in ("feature", "value")]
    if table.num_rows:
        lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
        offsets = [np.asarray(x.offsets) for x in lists]
        flat = [np.asarray(x.values) for x in lists]
        pairs = [tuple(v[o[i] : o[i + 1]] for v, o in zip(flat, offsets)) for i in range(table.num_rows)]
    order = np.lexsort((y, ids)) if len(ids) else np.zeros(0, int)
    return fit([pairs[i] for i in order], y[order].astype(float))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """docs' columns (or ``keep``) with ``score`` and ``predicted``, which stand for columns of docs of these names;
    with a ``prefix`` before them those stay."""
    made = (prefix + "score", prefix + "predicted")
    names = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.col(text).alias("__t"), *[F.col(c).alias("__" + c) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 1 << 20):
            logit, _ = model.sums(*features(batch.column(0)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sigmoid(logit))], names=[*names, made[0]])

    out = rows.mapInArrow(run, StructType([*docs.select(*names).schema.fields, StructField(made[0], DoubleType())]))
    return out.withColumn(made[1], (F.col(made[0]) >= threshold).cast("int"))


def op2_quality_fm(spark, sf_dir: str) -> DataFrame:
    """Every whole document scored for quality; see the module."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

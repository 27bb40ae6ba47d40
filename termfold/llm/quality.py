"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of each whole text (shares of kinds of bytes, repetition of words and lines, lengths, entropy) are computed
once, in Spark tasks, and kept as a narrow table. The model is fitted on at most about FIT_ROWS labelled rows, drawn
by a hash of the id; the rest of the work covers all rows. Columns are cut into at most BINS bins by quantiles; trees
grow level by level on gradient histograms and end as arrays (feature, threshold, value of each node of a complete
binary tree), so a batch of documents walks a tree in ``depth`` vectorised steps.

Defined results: null and empty texts have all statistics 0 and get a score like any other; a repeated label row
counts each time; labels that are null, or of ids that no document has, are ignored; without any label, or
with one class only, every score is the share of class 1 (0.5 without labels). A null doc_id counts as empty text for
the held-out remainder, and is never learned from. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.llm.shared import ship_package, sliced, table, tidy
from termfold.operators.staging import staged

FIT_ROWS = 40_000
BINS, TREES, DEPTH, RATE, PENALTY, LEAST = 64, 80, 4, 0.15, 1.0, 5.0
THRESHOLD = 0.3
FOLDS = 5

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b",.;:", b"!?", b"#$%&*@^~=+<>\\",
    b"|_/-", b"()[]{}", b"'\"`",
]
NAMES = [
    "log_bytes", "log_words", "log_lines", "word_bytes", "longest_word", "line_words", "lower", "upper", "digits", "blanks", "breaks",
    "stops", "calls", "symbols", "bars", "brackets", "quotes", "beyond_ascii", "control", "entropy", "top_byte", "distinct_words",
    "top_word", "once_words", "equal_neighbours", "distinct_lines", "short_words", "no_letter_end", "distinct_pairs",
]
_OF = np.full(256, len(_CLASSES), np.int64)
for _i, _c in enumerate(_CLASSES):
    _OF[list(_c)] = _i
_OF[128:] = len(_CLASSES) + 1
_LETTER = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ,.") | frozenset(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """The values named in NAMES, of one text."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_OF, weights=counts, minlength=len(_CLASSES) + 2) / n
    share = counts[counts > 0] / n
    m = len(words)
    tally = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    lines = [x for x in text.split(b"\n") if x]
    once = sum(c == 1 for c in tally.values())
    pairs = len(set(zip(words, words[1:]))) / (m - 1) if m > 1 else 1.0
    return [
        np.log1p(n), np.log1p(m), np.log1p(len(lines)), lengths.mean(), float(np.log1p(lengths.max())), m / max(1, len(lines)),
        *kinds[: len(_CLASSES)], kinds[len(_CLASSES) + 1], kinds[len(_CLASSES)],
        float(-(share * np.log2(share)).sum()), float(counts.max() / n), len(tally) / m, max(tally.values()) / m, once / m,
        sum(map(eq, words, words[1:])) / m, len(set(lines)) / max(1, len(lines)), float((lengths <= 3).mean()),
        sum(w[-1] not in _LETTER for w in words) / m, pairs,
    ]


@tidy
def _statistics(batches):
    for b in sliced(batches):
        rows = np.array([statistics(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()], np.float32).reshape(b.num_rows, len(NAMES))
        values = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(NAMES), pa.int32()), pa.array(rows.ravel(), pa.float32()))
        yield pa.RecordBatch.from_arrays([b.column(0), values], names=["doc_id", "x"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics in the order of NAMES."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_statistics, "doc_id long, x array<float>")


@dataclass
class Model:
    """Trees as arrays: one row per tree, one column per node of a complete binary tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return 1.0 / (1.0 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosted trees for logistic loss."""
    nodes = 2 ** (DEPTH + 1) - 1
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)))
    n, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(features)], 1)   # x <= edge: left
    flat = binned + np.arange(features) * BINS
    base = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(n, base)
    model = Model(base, np.zeros((TREES, nodes), np.int64), np.full((TREES, nodes), np.inf), np.zeros((TREES, nodes)))
    for t in range(TREES):
        p = 1.0 / (1.0 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * BINS) + flat).ravel()
            size = width * features * BINS
            g = np.bincount(at, np.repeat(grad, features), size).reshape(width, features, BINS).cumsum(2)
            h = np.bincount(at, np.repeat(hess, features), size).reshape(width, features, BINS).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + PENALTY) + (all_g - g) ** 2 / (all_h - h + PENALTY) - all_g**2 / (all_h + PENALTY)
            gain[(h < LEAST / 4) | (all_h - h < LEAST / 4)] = 0
            for k in range(width):
                best = int(gain[k].argmax())
                f, b = divmod(best, BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    model.feature[t, first + k], model.threshold[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.threshold[t, node])
        leaves = 2**DEPTH - 1
        g = np.bincount(node - leaves, grad, 2**DEPTH)
        h = np.bincount(node - leaves, hess, 2**DEPTH)
        model.value[t, leaves:] = -RATE * g / (h + PENALTY)
        total += model.value[t, node]
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("y"))
    labelled = staged(stats.join(usable, "doc_id").select("doc_id", "x", "y"))
    total, scale = labelled.count(), 1 << 30
    share = min(scale, int(scale * rows / max(1, total)))
    picked = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share).toPandas()
    if not len(picked):
        return train(np.zeros((0, len(NAMES))), np.zeros(0))
    x = np.array(picked["x"].tolist(), np.float32)
    y = picked["y"].to_numpy(np.float64)
    order = np.lexsort((y, *x.T, picked["doc_id"].to_numpy()))
    return train(x[order], y[order])


@tidy
def _scores(batches, model):
    for b in batches:
        x = np.array(b.column(1).to_pylist(), np.float32).reshape(b.num_rows, len(NAMES))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    stats = staged(document_statistics(docs))
    model = fit(stats, labels)
    scores = stats.select("doc_id", "x").mapInArrow(partial(_scores, model=model), "doc_id long, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@tidy
def _kept(batches, model, column: int):
    for b in sliced(batches):
        texts = b.column(column).cast(pa.binary()).to_pylist()
        x = np.array([statistics(t or b"") for t in texts], np.float32).reshape(b.num_rows, len(NAMES))
        yield b.filter(pa.array(model.score(x) >= THRESHOLD))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = fit(staged(document_statistics(docs)), labels)
    return docs.mapInArrow(partial(_kept, model=model, column=docs.columns.index("text")), docs.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text. Trees are grown level by level on features
binned by quantiles, with the gradients of the logistic loss summed per bin.
Fitted trees are flattened into arrays, and all documents of a batch walk down
one tree at a time by vectorised look-ups.

Defined cases: null texts are empty; an empty text has all statistics 0 and is
scored like any other; labels that are null or of unknown documents teach
nothing; several labels of one document count by the largest; without any label
every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import texts
from isotherm.llm.language import lowest

#: Labelled documents that the trees are fitted on, chosen by a hash of the id.
TRAIN_DOCS = 20_000
BINS, TREES, DEPTH, RATE, LEAST_WEIGHT = 64, 60, 4, 0.2, 5.0
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "upper", "lower", "digits", "spaces", "line_ends", "sentence_ends", "other_ascii", "not_ascii", "bars",
    "exclamations", "word_bytes", "distinct_words", "distinct_lines", "line_bytes", "longest_word", "distinct_bytes",
    "common_word", "other_in_words", "byte_entropy",
]


def _mask(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_UPPER, _LOWER, _DIGITS = (_mask(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_SPACES, _ENDS = _mask(" \t\r"), _mask(".,;:?")


def statistics(text: str) -> list[float]:
    """The features of one text, all from the whole text."""
    data = text.encode()
    n = len(data)
    if not n:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    distinct = set(words)
    lines = text.split("\n")
    letters = _UPPER | _LOWER
    ascii_other = by_byte[:128][~(letters | _DIGITS | _SPACES | _ENDS)[:128]].sum() - by_byte[10]
    share = by_byte[by_byte > 0] / n
    n_words = max(1, len(words))
    return [
        np.log1p(n),
        by_byte[_UPPER].sum() / n,
        by_byte[_LOWER].sum() / n,
        by_byte[_DIGITS].sum() / n,
        by_byte[_SPACES].sum() / n,
        by_byte[10] / n,
        by_byte[_ENDS].sum() / n,
        ascii_other / n,
        by_byte[128:].sum() / n,
        by_byte[ord("|")] / n_words,
        by_byte[ord("!")] / n_words,
        n / n_words,
        len(distinct) / n_words,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        np.log1p(max(map(len, distinct), default=0)),
        float(np.count_nonzero(by_byte)),
        np.log1p(n_words) - np.log1p(len(distinct)),
        ascii_other / n_words,
        float(-(share * np.log(share)).sum()),
    ]


@dataclass
class BoostedTrees:
    """Complete trees of one depth, flattened: node i of a tree has children 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total, depth, everyone = np.full(len(rows), self.base), int(np.log2(self.leaf.shape[1])), np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[everyone, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> BoostedTrees:
    """Second-order boosting of the logistic loss on binned features."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T, strict=True)], 1)
    n, width = rows.shape
    mean = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    total, inner, leaves = np.full(n, base), 2**depth - 1, 2**depth
    all_features, all_thresholds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - labels, p * (1 - p)
        node, feature, threshold = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            start, count = 2**level - 1, 2**level
            slot = (node - start)[:, None] * width * BINS + np.arange(width) * BINS + binned
            g, h = (np.bincount(slot.ravel(), np.repeat(x, width), count * width * BINS).reshape(count, width, BINS).cumsum(2) for x in (grad, hess))
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
            gain[(h < LEAST_WEIGHT / 4) | (h_all - h < LEAST_WEIGHT / 4)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for i, at in enumerate(best):
                f, b = divmod(int(at), BINS)
                if gain[i, f, b] > 1e-6 and b < len(edges[f]):
                    feature[start + i], threshold[start + i] = f, edges[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > threshold[node])
        place = node - inner
        g, h = (np.bincount(place, x, leaves) for x in (grad, hess))
        leaf = -RATE * g / (h + 1)
        total += leaf[place]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_leaves.append(leaf)
    return BoostedTrees(np.array(all_features), np.array(all_thresholds), np.array(all_leaves), base)


def _matrix(found: Iterable[str]) -> np.ndarray:
    return np.array([statistics(text) for text in found], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS) -> BoostedTrees | None:
    """Fit on at most ``most_docs`` labelled documents (``doc_id, label``), those with the smallest hash of their id.

    Rows that share an id are one document, by their smallest text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("statistics", pa.list_(pa.float64()))])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_matrix(batch.column(1).to_pylist()).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found], schema=schema)

    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = lowest(known, most_docs, "doc_id")  # bounded by the parameter
    sample = texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = sample.select("doc_id", "text", "label")
    rows = sample.mapInArrow(task, "doc_id long, label int, statistics array<double>").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    return fit_trees(np.array(rows["statistics"].to_pylist()), rows["label"].to_numpy().astype(float))


def score(docs: DataFrame, trees: BoostedTrees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; higher: label 1 likelier."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1).to_pylist())
            found = trees.scores(rows) if trees else np.full(len(rows), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], schema=schema)

    return texts(docs, id_col=id_col, text_col=text_col).mapInArrow(task, "doc_id long, score double")

"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics are computed once for each document. The trees are grown on a bounded
sample of labelled rows: features are cut into bins at their quantiles, and
each level of a tree is found from sums of gradients by node, feature and bin. The trees are flattened into
arrays, which numpy runs through for a batch of documents at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import written

#: Labelled rows that the trees are grown on, at most about so many; chosen by a hash of the id.
SAMPLE_ROWS = 100_000
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64
#: Ridge on the leaves, and the least second-order weight of a child.
RIDGE, LEAST_WEIGHT = 1.0, 2.0

FEATURES = (
    "chars", "words", "lines", "bytes_per_char", "letters", "digits", "capitals", "white", "stops", "symbols",
    "other_ascii", "high_bytes", "byte_entropy", "word_length", "word_length_spread", "longest_word",
    "distinct_words", "commonest_word", "words_once", "words_without_letters", "words_with_symbols",
    "repeated_neighbours", "distinct_lines", "line_length", "lines_with_stop", "stop_gaps", "long_words", "short_words",
)

CLASSES = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "white": b" \t\n\r\x0b\x0c",
    "stops": b".,;:!?",
    "symbols": b"#$%&*@^~|<>=+{}[]\\/_",
}
_MASKS = np.zeros((256, len(CLASSES) + 2), np.float64)
for _k, _chars in enumerate(CLASSES.values()):
    _MASKS[list(_chars), _k] = 1
_MASKS[:128, len(CLASSES)] = 1 - _MASKS[:128, [0, 1, 3, 4, 5]].sum(axis=1)
_MASKS[128:, len(CLASSES) + 1] = 1
SYMBOL = re.compile(r"[#$%&*@^~|<>=+{}\[\]\\/_]")
NO_LETTER = re.compile(r"[\W\d_]+")


def statistics(text: str) -> list[float]:
    """The FEATURES of a text; an empty text has zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return [0.0] * len(FEATURES)
    counts = np.bincount(data, minlength=256).astype(np.float64)
    share = counts[counts > 0] / len(data)
    words = text.split()
    n = max(len(words), 1)
    lengths = np.array(list(map(len, words)) or [0], np.float64)
    times = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    stops = counts[list(b".!?")].sum()
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))), float(np.log1p(len(lines))), len(data) / len(text),
        *(counts @ _MASKS / len(data)).tolist(),
        float(-(share * np.log2(share)).sum()), float(lengths.mean()), float(lengths.std()), float(np.log1p(lengths.max())),
        len(times) / n, max(times.values(), default=0) / n, sum(v == 1 for v in times.values()) / n,
        sum(v for w, v in times.items() if NO_LETTER.fullmatch(w)) / n,
        sum(v for w, v in times.items() if SYMBOL.search(w)) / n,
        repeats / n, len(set(lines)) / len(lines), float(np.log1p(len(text) / len(lines))),
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines), float(np.log1p(n / (stops + 1))),
        float((lengths > 15).mean()), float((lengths < 3).mean()),
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees as arrays: of node k, the children are 2k+1 and 2k+2. Rows of `features` beyond `thresholds` go right."""

    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray  # trees x inner nodes
    leaves: np.ndarray  # trees x leaves
    start: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels y (0 to 1); without rows, one that gives 0.5."""
    inner, n_features = 2**depth - 1, x.shape[1]
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.array([]) for f in range(n_features)]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    flat = bins + np.arange(n_features) * BINS
    total = np.full(len(x), start)
    features = np.zeros((trees, inner), np.int64)
    thresholds = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, 2**depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (n_features * BINS) + flat).ravel()
            shape = (width, n_features, BINS)
            g, h = (
                np.bincount(at, np.repeat(v, n_features), width * n_features * BINS).reshape(shape) for v in (gradient, weight)
            )
            left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = (
                left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            )
            gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    features[t, first + k], thresholds[t, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(x)), features[t][node]] > thresholds[t][node])
        g, h = (np.bincount(node - inner, v, 2**depth) for v in (gradient, weight))
        leaves[t] = -RATE * g / (h + RIDGE)
        total += leaves[t][node - inner]
    return Trees(features, thresholds, leaves, start)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, stats) of all documents, written."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(stats, pa.list_(pa.float32()))], names=["id", "stats"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(measure, f"id {kind}, stats array<float>"), "quality-stats")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)


def fit(
    stats: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id", label_col: str = "quality",
) -> Trees:
    """Trees from labelled rows for whose "id" train is true. An id with several labels has their mean; null labels are none."""
    labels = labels.groupBy(F.col(id_col).alias("id")).agg(F.avg(label_col).cast("double").alias("label"))
    rows = stats.filter(train).join(labels.filter("label is not null"), "id")
    rows = written(rows.select("id", "stats", "label"), "quality-labelled")
    share = min(1.0, sample_rows / max(rows.count(), 1))
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # In a fixed order, so that sums and hence trees don't depend on the order of tasks.
    found = sample.select("stats", "label").toArrow().sort_by([("label", "ascending")])
    x, y = matrix(found.column("stats")), found.column("label").to_numpy()
    order = np.lexsort((*x.T, y))
    return grow(x[order], y[order])


def score(stats: DataFrame, trees: Trees) -> DataFrame:
    """Rows (id, score): the probability of label 1."""
    model = stats.sparkSession.sparkContext.broadcast(trees)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(model.value.predict(matrix(batch.column("stats"))), pa.float64())],
                names=["id", "score"],
            )

    kind = stats.schema["id"].dataType.simpleString()
    return stats.select("id", "stats").mapInArrow(predict, f"id {kind}, score double")


def quality_scores(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: id, score (0 to 1, higher where label 1 is likelier).

    train is a condition on "id" for rows whose labels may be learned. Null texts count as empty. Without any label
    all scores are 0.5. Repeated rows and rows without an id are scored like all others; other columns aren't read.
    """
    stats = document_statistics(docs, id_col, text_col)
    return score(stats, fit(stats, labels, train, sample_rows, id_col, label_col))

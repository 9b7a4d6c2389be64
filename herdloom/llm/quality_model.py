"""Quality score: gradient-boosted trees on histograms of document statistics.

Trees are grown on the driver from a bounded sample of labelled documents and flattened into arrays; a
task walks all its rows down a tree at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import id_remainder, map_slices, stored, texts

#: Labelled documents that the trees are fitted on: a bounded sample by hash of the id.
SAMPLE_DOCS = 30_000
BINS, ROUNDS, DEPTH, RATE, SMOOTH, LEAST_WEIGHT = 64, 60, 4, 0.15, 1.0, 2.0
BASE_SCORE = 0.5

# Classes of bytes that are counted.
UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes(range(0x61, 0x7B))
DIGITS = b"0123456789"
STOPS = b".,;:?'\"()-"
SYMBOLS = b"#*$%&|<>@=+_~^\\/{}[]`"
SHOUTS = b"!"
SPACES = b" \t\n\x0b\x0c\r"

FEATURES = (
    "words", "chars_per_word", "longest_word", "upper", "lower", "digits", "stops", "symbols", "shouts", "spaces",
    "wide", "different_words", "different_lines", "words_per_line", "repeated_neighbours", "words_with_stop",
    "words_with_capital", "short_words",
)


def features_of(text: str) -> list[float]:
    """Statistics of a whole text; all 0 for an empty one."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(data), len(words)
    share = [(size - len(data.translate(None, kind))) / size for kind in (UPPER, LOWER, DIGITS, STOPS, SYMBOLS, SHOUTS, SPACES)]
    lines = [line for line in data.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int32, n)
    lasts, firsts = bytes([w[-1] for w in words]), bytes([w[0] for w in words])
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float(np.log1p(lengths.max())),
        *share,
        (size - len(text)) / size,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        (n - len(lasts.translate(None, STOPS))) / n,
        (n - len(firsts.translate(None, UPPER))) / n,
        float((lengths <= 2).mean()),
    ]


def document_features(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``features`` of every whole text; NULL reads as empty."""
    ddl = f"{id_column} bigint, features array<double>"
    work = lambda batch: [batch.column(id_column), [features_of(t) for t in texts(batch, text_column)]]
    return map_slices(df.select(id_column, text_column), lambda: work, ddl)


class Trees:
    """Boosted trees as flat arrays: of each node its feature, threshold, children and value."""

    def __init__(self, start: float = 0.0):
        self.start = start
        self.roots: list[int] = []
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def node(self, value: float) -> int:
        for column, item in zip(
            (self.feature, self.threshold, self.left, self.right, self.value), (-1, 0.0, -1, -1, value)
        ):
            column.append(item)
        return len(self.feature) - 1

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1. Rows at a leaf stay there, so each tree takes ``DEPTH`` steps."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, value = np.array(self.left), np.array(self.right), np.array(self.value)
        total, all_rows = np.full(len(rows), self.start), np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                low = rows[all_rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += value[at]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees | None:
    """Trees for the logistic loss, or None without labels of both kinds."""
    if len(labels) == 0 or labels.min() == labels.max():
        return None
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, rows.T)], 1)
    width = rows.shape[1]
    flat = binned + np.arange(width) * BINS
    mean = labels.mean()
    trees = Trees(float(np.log(mean / (1 - mean))))
    margin = np.full(len(labels), trees.start)
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = labels - chance, chance * (1 - chance)
        trees.roots.append(trees.node(0.0))
        todo = [(trees.roots[-1], np.arange(len(labels)), 0)]
        while todo:
            node, members, depth = todo.pop()
            g, h = slope[members].sum(), curve[members].sum()
            best = None
            if depth < DEPTH:
                places = flat[members].ravel()
                hist = [
                    np.bincount(places, np.repeat(v[members], width), width * BINS).reshape(width, BINS).cumsum(1)
                    for v in (slope, curve)
                ]
                g_low, h_low = hist
                g_high, h_high = g - g_low, h - h_low
                gain = g_low**2 / (h_low + SMOOTH) + g_high**2 / (h_high + SMOOTH) - g**2 / (h + SMOOTH)
                gain[(h_low < LEAST_WEIGHT) | (h_high < LEAST_WEIGHT)] = 0
                column, cut = np.unravel_index(gain.argmax(), gain.shape)
                if gain[column, cut] > 1e-6 and cut < len(edges[column]):
                    best = int(column), int(cut)
            if best is None:
                trees.value[node] = float(RATE * g / (h + SMOOTH))
                margin[members] += trees.value[node]
                continue
            column, cut = best
            low = binned[members, column] <= cut
            trees.feature[node], trees.threshold[node] = column, float(edges[column][cut])
            trees.left[node], trees.right[node] = trees.node(0.0), trees.node(0.0)
            todo += [(trees.left[node], members[low], depth + 1), (trees.right[node], members[~low], depth + 1)]
    return trees


def training_sample(features: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """Features and labels of about ``sample_docs`` labelled documents the model may learn from."""
    usable = labels.filter((id_remainder("doc_id", 3) != 1) & F.col("quality").isNotNull()).select("doc_id", "quality")
    share = min(1.0, sample_docs / max(1, usable.count()))
    picked = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    table = features.join(picked, "doc_id").select("doc_id", "features", "quality").toArrow()
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    rows = np.array(table.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return rows[order], table.column("quality").to_numpy().astype(float)[order]


def score_documents(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``score`` that a whole text has label 1, and ``predicted`` at one half, for every row of ``df``.

    Learns from labels whose id leaves another remainder than 1 by 3; neither labels nor ids, sources or
    languages are features. Without labels of both kinds every score is one half. NULL and empty texts
    have features of 0. Texts are read once; the features are stored, joined with the labels and scored.
    """
    features = stored(document_features(df, id_column, text_column), "quality-features")
    named = features.withColumnRenamed(id_column, "doc_id")
    sent = df.sparkSession.sparkContext.broadcast(fit(*training_sample(named, labels)))

    def make():
        trees = sent.value

        def work(batch):
            values = batch.column("features")
            rows = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            score = trees.score(rows) if trees and len(rows) else np.full(len(rows), BASE_SCORE)
            return [batch.column(id_column), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

        return work

    return map_slices(features, make, f"{id_column} bigint, score double, predicted int")

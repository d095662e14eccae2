"""Quality classifier: histogram gradient-boosted trees (operator 4).

Documents become statistics of their text (shares of character classes,
words, lines and repeats). Trees are grown on histograms of binned
statistics with logistic loss and flattened into arrays: every tree is a
complete binary tree, so numpy walks all trees of a block of documents
level by level.

Trees are fitted on a bounded sample of labelled rows (``max_rows``, by
default 20,000, those with the smallest id hashes); all documents are
scored over their whole texts.

Results in special cases: a null text counts as empty and gets a score;
null labels and rows without id teach nothing; several labels of an id
count by their mean (half: 1), several texts of a labelled id by the
smallest text; without labelled documents every score is 0.5; an empty
table gives an empty table; input columns with the name of an output
column are replaced, all others are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_or_empty

STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "upper", "digit", "space", "stop", "symbol",
    "bracket", "high", "entropy", "line_length", "line_ends", "repeated_lines", "distinct_words", "top_word",
    "repeated_neighbours", "compression", "lone_symbols", "shouted_words", "decorated_words", "worst_line_symbols",
)


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space,
    5 sentence sign, 6 bracket or quote, 7 symbol, 8 beyond ASCII."""
    kinds = np.zeros(256, dtype=np.int64)
    for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
                        (b"0123456789", 3), (b" \t\n\r\v\f", 4), (b".,;:?!'-", 5), (b"()[]{}\"<>", 6),
                        (b"#$%&*+/=@\\^_`|~", 7)):
        kinds[list(chars)] = kind
    kinds[128:] = 8
    return kinds


_CLASSES = _byte_classes()
_PRESS = zstandard.ZstdCompressor(level=1)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of STATISTICS."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(codes, minlength=256)
    classes = np.bincount(_CLASSES, weights=counts, minlength=9) / n
    share = counts[counts > 0] / n
    words = text.split()
    w = max(len(words), 1)
    tally = Counter(words)
    lines = text.split("\n")
    line_tally = Counter(lines)
    # Distinct words stand for all their copies, so a word costs little.
    lone = shouted = decorated = long_words = 0
    for word, c in tally.items():
        last = word[-1]
        if word.isupper() and len(word) > 1:
            shouted += c
        if not last.isalnum():
            if len(word) == 1:
                lone += c
            elif len(word) > 2 and not word[-2].isalnum():
                decorated += c
        if len(word) > 18:
            long_words += c
    symbol = _CLASSES[codes] == 7
    worst = 0.0
    if symbol.any():
        starts = np.concatenate([[0], np.flatnonzero(codes == 10) + 1])
        starts = starts[starts < n]
        sizes = np.diff(np.concatenate([starts, [n]]))
        worst = float((np.add.reduceat(symbol, starts, dtype=np.int64) / np.maximum(sizes, 40)).max())
    return [
        math.log1p(n), math.log1p(len(words)), len(text) / w, long_words / w, classes[2], classes[3], classes[4],
        classes[5], classes[7], classes[6], classes[8], float(-(share * np.log2(share)).sum()),
        math.log1p(n / len(lines)), sum(c for x, c in line_tally.items() if x.rstrip().endswith((".", "!", "?"))) / len(lines),
        1 - len(line_tally) / len(lines), len(tally) / w, max(tally.values(), default=0) / w,
        sum(map(str.__eq__, words, words[1:])) / w, len(_PRESS.compress(raw)) / n, lone / w, shouted / w,
        decorated / w, worst,
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float32).reshape(len(texts), len(STATISTICS))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of one depth as arrays: feature and threshold
    of node i of each tree (children 2i + 1 and 2i + 2), values of its
    leaves, and the score before the first tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: all rows walk all trees together."""
        total = np.full(len(x), self.start, dtype=np.float64)
        trees, inner = self.feature.shape
        if trees:
            at = np.zeros((len(x), trees), dtype=np.int64)
            own, row = np.arange(trees), np.arange(len(x))[:, None]
            for _ in range(int(math.log2(inner + 1))):
                right = x[row, self.feature[own, at]] > self.threshold[own, at]
                at = 2 * at + 1 + right
            total += self.leaf[own, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
         smooth: float = 2.0, least: float = 1.0) -> Forest:
    """Boosted trees on histograms of ``x`` for labels ``y`` (0 or 1)."""
    inner = (1 << depth) - 1
    none = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)), 0.0)
    if not len(y):
        return none
    share = (y.sum() + 1) / (len(y) + 2)
    start = math.log(share / (1 - share))
    if y.min() == y.max():
        return Forest(none.feature, none.threshold, none.leaf, start)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(y), start)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            gain_best, split = np.full(width, 1e-6), [None] * width
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                key = local * (len(c) + 1) + binned[:, f]
                shape = (width, len(c) + 1)
                g = np.bincount(key, grad, shape[0] * shape[1]).reshape(shape).cumsum(axis=1)
                h = np.bincount(key, hess, shape[0] * shape[1]).reshape(shape).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gr, hr = gt - gl, ht - hl
                gain = gl ** 2 / (hl + smooth) + gr ** 2 / (hr + smooth) - gt ** 2 / (ht + smooth)
                gain[(hl < least) | (hr < least)] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                for i in np.flatnonzero(value > gain_best):
                    gain_best[i], split[i] = value[i], (f, top[i])
            right = np.zeros(len(y), dtype=bool)
            for i, s in enumerate(split):
                if s is not None:
                    feature[first + i], threshold[first + i] = s[0], cuts[s[0]][s[1]]
                    mine = local == i
                    right[mine] = binned[mine, s[0]] > s[1]
            node = 2 * node + 1 + right
        at = node - inner
        g, h = (np.bincount(at, v, inner + 1) for v in (grad, hess))
        leaf = rate * g / (h + smooth)
        total += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Forest(np.stack(features), np.stack(thresholds), np.stack(leaves), start)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = 20_000) -> Forest:
    """Fit on the labelled documents; at most ``max_rows`` labels are used,
    those with the smallest hashes of their ids."""
    taught = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y"))
              .where("id is not null and y is not null")
              .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # The sample is bounded by max_rows, whatever the size of the tables.
    rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(taught), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(list(matrix(b["text"].to_pylist())),
                                                                pa.list_(pa.float32())), b["y"]], names=["id", "x", "y"])

    found = sorted(rows.mapInArrow(measure, "id long, x array<float>, y int").collect(), key=lambda r: r["id"])
    x = np.array([r["x"] for r in found], dtype=np.float32).reshape(len(found), len(STATISTICS))
    return grow(x, np.array([r["y"] for r in found], dtype=np.float64))


def score(docs: DataFrame, forest: Forest, text_col: str = "text", output: str = "score") -> DataFrame:
    """Add ``output``: probability of label 1 of every whole text."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(forest.score(matrix(batch.to_pylist())), pa.float64())

    return docs.withColumn(output, run(text_or_empty(text_col)))

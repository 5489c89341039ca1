"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counts and ratios of the whole text. Training sorts each
statistic into quantile bins once and grows every tree level by level from
histograms of gradients; the data are a bounded sample of labelled rows (the
first ``max_rows`` by a hash of the identifier), of which only the statistics
reach the driver. A finished forest is flattened: all trees are complete binary
trees of one depth in two arrays (split feature, threshold) and one of leaf
values, and a batch walks all trees at once with numpy indexing, level by level.

Scoring runs in Arrow batches over the text alone; labels, language, source and
identifier are no inputs. Defined cases: null and empty texts are scored like any
other (all counts zero); labels that are null are left out, repeated labels of an
identifier are averaged; rows whose identifier is null are never training rows
and not held out. Without labelled rows the score is 0.5 everywhere, with one
class its rate. Empty tables give empty results; repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, in_arrow, quoted, text_of

MAX_TRAINING_ROWS = 40_000
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.15
THRESHOLD = 0.3
HELD_OUT_OF = 5

STATISTICS = ("bytes", "words", "word_bytes", "line_bytes", "distinct_words", "repeated_lines", "spaces", "upper",
              "digits", "symbols", "bars", "exclaims", "stops", "quotes", "brackets", "other_ascii", "controls", "wide",
              "longest_word")


def statistics(text: bytes) -> list[float]:
    """One row in the order of ``STATISTICS``."""
    n = len(text)
    count = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) if n else np.zeros(256, dtype=np.int64)
    share = lambda chars: float(count[list(chars)].sum()) / max(n, 1)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return [
        float(n), float(len(words)), (n - count[9:14].sum() - count[32]) / max(len(words), 1), n / max(len(lines), 1),
        len(set(words)) / max(len(words), 1), 1 - len(set(lines)) / max(len(lines), 1),
        (count[9:14].sum() + count[32]) / max(n, 1), count[65:91].sum() / max(n, 1), count[48:58].sum() / max(n, 1),
        share(b"#*$%&<>^~_=+@"), share(b"|\\/"), share(b"!?"), share(b".,;:"), share(b"'\"`"), share(b"()[]{}"), share(b"-"),
        (count[:9].sum() + count[14:32].sum() + count[127]) / max(n, 1), count[128:].sum() / max(n, 1),
        float(max(map(len, words), default=0))]


@dataclass
class Forest:
    """Complete trees: node i has the children 2i+1 and 2i+2; leaves are numbered after them."""

    feature: np.ndarray    # [tree, node]
    threshold: np.ndarray  # [tree, node]; a value above it goes right
    leaf: np.ndarray       # [tree, leaf]
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        trees = np.arange(len(self.feature))[None, :]
        for at in range(0, len(x), 2048):
            part = x[at:at + 2048]
            rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(self.feature)), dtype=np.int64)
            for _ in range(self.depth):
                right = part[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[at:at + 2048] += self.leaf[trees, node - (2 ** self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Logistic loss; splits need ``least`` hessian on both sides."""
    nodes = 2 ** depth - 1
    rate_of = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(rate_of / (1 - rate_of)))
    if not len(y) or y.min() == y.max():
        return Forest(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes + 1)), base, depth)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    feature, threshold = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf)
    leaf, margin = np.zeros((trees, nodes + 1)), np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)  # node within its level
        for level in range(depth):
            k = 2 ** level
            gain, best_f, best_b = np.zeros(k), np.zeros(k, np.int64), np.full(k, bins + 1)
            for f in range(width):
                cell = at * bins + binned[:, f]
                gs = np.bincount(cell, weights=g, minlength=k * bins).reshape(k, bins).cumsum(axis=1)
                hs = np.bincount(cell, weights=h, minlength=k * bins).reshape(k, bins).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                value = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                value[(hs < least) | (ht - hs < least)] = 0
                value[:, len(edges[f]):] = 0
                b = value.argmax(axis=1)
                v = value[np.arange(k), b]
                better = v > gain + 1e-9
                gain[better], best_f[better], best_b[better] = v[better], f, b[better]
            for j in range(k):
                if gain[j] > 0:
                    feature[t, k - 1 + j], threshold[t, k - 1 + j] = best_f[j], edges[best_f[j]][best_b[j]]
            at = 2 * at + (binned[np.arange(n), best_f[at]] > best_b[at])
        leaf[t] = -rate * np.bincount(at, weights=g, minlength=nodes + 1) / (np.bincount(at, weights=h, minlength=nodes + 1) + ridge)
        margin += leaf[t, at]
    return Forest(feature, threshold, leaf, base, depth)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def _measured(df: DataFrame) -> DataFrame:
    """Columns y, key, text of a bounded frame to y, key, x."""
    def batches(it):
        for batch in it:
            x = [statistics(t.as_py() or b"") for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["y", "key", "x"])
    return in_arrow(df.select("y", "key", "text"), batches, "y double, key string, x array<double>")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    name = labels[key].cast("string")
    known = (labels.where(labels[label].isNotNull() & labels[key].isNotNull() & ~held_out(labels[key]))
             .groupBy(name.alias("key")).agg(F.avg(labels[label].cast("double")).alias("y"))
             .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    rows = docs.select(docs[key].cast("string").alias("key"), text_of(docs, text).alias("text"))
    # One row per identifier, so that repeated rows do not lift the bound.
    sample = _measured(rows.join(F.broadcast(known), "key")).groupBy("key").agg(F.first("y").alias("y"), F.min("x").alias("x"))
    got = sorted(sample.collect(), key=lambda r: r["key"])
    x = np.array([r["x"] for r in got], dtype=np.float64).reshape(len(got), len(STATISTICS))
    return fit(x, (np.array([r["y"] for r in got]) >= 0.5).astype(np.float64))


def scored(df: DataFrame, forest: Forest, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), then ``score``: the probability of label 1."""
    keep = list(df.columns) if keep is None else keep
    body, score = fresh(df, "__text"), fresh(df, "score")
    src = df.select(*[df[quoted(c)] for c in keep], text_of(df, text).alias(body))
    kind = df.select(*[df[quoted(c)] for c in keep]).schema.add(score, "double")

    def batches(it):
        for batch in it:
            x = np.array([statistics(t.as_py() or b"") for t in batch.column(len(keep)).cast(pa.binary())], dtype=np.float64)
            done = forest.score(x.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(done)], names=[f.name for f in kind])

    return in_arrow(src, batches, kind)


def accepted(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
             threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` that the classifier does not reject, with all their columns."""
    found = scored(df, train(df, labels, text, key), text)
    score = found.columns[-1]
    return found.where(F.col(score) >= threshold).select(*[found[c] for c in df.columns])

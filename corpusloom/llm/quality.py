"""Quality of whole texts: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusloom.llm.common import with_columns
from corpusloom.llm.ngram_join import in_parts

#: Labelled documents a model is fitted on at most.
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS, RATE, REGULAR, LEAST_WEIGHT = 80, 4, 64, 0.15, 1.0, 3.0
THRESHOLD = 0.3

_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n", b".", b",", b"!?", b"|", b"#$%&*@^~", b"<>{}[]()", b"\"'", b"-_=+/\\", b":;",
)
_MASKS = np.array([[byte in group for group in _GROUPS] + [byte >= 0xC0] for byte in range(256)], float)
NAMES = (
    [f"share_{i}" for i in range(_MASKS.shape[1])]
    + ["log_bytes", "log_words", "bytes_per_word", "distinct_words", "commonest_word", "log_lines", "distinct_lines", "bytes_per_line", "ended_lines", "entropy", "longest_word"]
)


def statistics(body: bytes) -> np.ndarray:
    """The statistics of one text (UTF-8), all of it; zeros for an empty one."""
    made = np.zeros(len(NAMES))
    size = len(body)
    if not size:
        return made
    counts = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    k = _MASKS.shape[1]
    made[:k] = counts @ _MASKS / size
    seen = counts[counts > 0] / size
    words, lines = body.split(), [line for line in body.split(b"\n") if line.strip()]
    n, m = len(words), len(lines)
    tally = Counter(words)
    made[k:] = (
        np.log1p(size), np.log1p(n), size / max(n, 1), len(tally) / max(n, 1), max(tally.values(), default=0) / max(n, 1), np.log1p(m), len(set(lines)) / max(m, 1),
        size / max(m, 1), sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / max(m, 1), -(seen * np.log2(seen)).sum(), max(map(len, tally), default=0),
    )
    return made


@dataclass
class Forest:
    """Trees of equal depth as arrays: node i of a tree has children 2i+1 and 2i+2; the last level are the leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1: all trees walk down together, a level at a time."""
        if not len(self.feature):
            return np.full(len(rows), 1 / (1 + np.exp(-self.base)))
        trees = np.arange(len(self.feature))
        at = np.zeros((len(rows), len(trees)), np.int64)
        for _ in range(DEPTH):
            value = np.take_along_axis(rows, self.feature[trees, at], axis=1)
            at = 2 * at + 1 + (value > self.threshold[trees, at])
        total = self.base + self.leaf[trees, at - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_forest(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Logistic gradient boosting over binned statistics. Without both labels, a forest of no trees."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return Forest(base, np.empty((0, 0), int), np.empty((0, 0)), np.empty((0, 0)))
    n, f = rows.shape
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], axis=1)
    offsets = np.arange(f) * BINS
    inner = 2**DEPTH - 1
    feature, threshold, leaf = np.zeros((TREES, inner), int), np.full((TREES, inner), np.inf), np.zeros((TREES, 2**DEPTH))
    score = np.full(n, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - labels, p * (1 - p)
        node = np.zeros(n, int)
        for depth in range(DEPTH):
            first, nodes = 2**depth - 1, 2**depth
            cell = ((node - first)[:, None] * (f * BINS) + offsets + binned).ravel()
            sums = [np.bincount(cell, np.repeat(v, f), nodes * f * BINS).reshape(nodes, f, BINS).cumsum(axis=2) for v in (gradient, weight)]
            (g, h), (g_all, h_all) = sums, (s[:, :, -1:] for s in sums)
            gain = g**2 / (h + REGULAR) + (g_all - g) ** 2 / (h_all - h + REGULAR) - g_all**2 / (h_all + REGULAR)
            gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for i, cut in enumerate(best):
                j, b = divmod(int(cut), BINS)
                if gain[i, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, first + i], threshold[t, first + i] = j, edges[j][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > threshold[t, node])
        last = node - inner
        g, h = np.bincount(last, gradient, 2**DEPTH), np.bincount(last, weight, 2**DEPTH)
        leaf[t] = -RATE * g / (h + REGULAR)
        score += leaf[t, last]
    return Forest(base, feature, threshold, leaf)


def held_out(id_col: str) -> Column:
    """Documents whose labels are never learned from: crc32 of the id as text is divisible by 5 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", limit: int = TRAINING_ROWS) -> Forest:
    """A forest fitted on at most ``limit`` labelled documents that are not held out, those with the smallest hash of the id.

    Statistics are made where the documents are; only their numbers come to the driver. A document with
    several labels counts with the smallest; null labels and ids count for nothing.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("doc is not null and label is not null")
    known = known.groupBy("doc").agg(F.min("label").alias("label")).filter(~held_out("doc"))
    sample = F.broadcast(known.orderBy(F.xxhash64("doc"), "doc").limit(limit))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), body.alias("body")).join(sample, "doc")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            made = [statistics(b) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("label"), pa.array(made, pa.list_(pa.float64()))], names=["doc", "label", "stats"])

    got = texts.mapInArrow(read, "doc long, label int, stats array<double>").groupBy("doc").agg(F.min("label").alias("label"), F.min("stats").alias("stats")).orderBy("doc").toPandas()
    if not len(got):
        return fit_forest(np.empty((0, len(NAMES))), np.empty(0))
    return fit_forest(np.array(got["stats"].tolist()), got["label"].to_numpy(float))


def score(docs: DataFrame, forest: Forest, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out`` (replaced if it is there).

    Only the text is read. A null or empty text has the statistics of an empty one; every row gets a
    score, repeated rows the same; an empty table gives an empty one; extra columns are passed on.
    """
    model = docs.sparkSession.sparkContext.broadcast(forest)
    kept = docs.drop(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, text_col):
            rows = np.stack([statistics(t.encode() if isinstance(t, str) else t or b"") for t in batch.column(text_col).to_pylist()])
            yield with_columns(batch, **{out: pa.array(model.value.predict(rows))})

    return kept.mapInArrow(add, StructType([*kept.schema.fields, StructField(out, DoubleType())]))

"""Toxicity of whole texts: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusloom.llm.common import fresh, with_columns
from corpusloom.session import materialize

#: Labelled documents a model is fitted on at most.
TRAINING_ROWS = 20_000
#: Lengths of the n-grams; they are hashed to 2 ** BITS buckets, of which the FEATURES most telling are weighted.
SIZES, BITS, FEATURES = (3, 4, 5, 6), 20, 1024
STEPS, PENALTY, THRESHOLD = 200, 1.0, 0.7
_PART = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of lower-cased UTF-8 that are not ASCII letters nor beyond ASCII become spaces.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def buckets(body: bytes) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text, part by part. Only A-Z is lower-cased; what is no letter is one space."""
    shown = (b" " + body.lower().translate(_LETTERS) + b" ").decode("utf-8", "replace")
    codes = np.frombuffer(shown.encode("utf-32-le"), np.uint32)
    codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
    for start in range(0, len(codes), _PART):
        part = codes[start : start + _PART + SIZES[-1] - 1].astype(np.uint64)
        total = part.copy()
        for n in range(2, SIZES[-1] + 1):
            if len(part) < n:
                break
            total = total[:-1] * _STEP + part[n - 1 :]
            if n in SIZES:
                yield (((total ^ (total >> np.uint64(29))) * _STEP) >> np.uint64(64 - BITS)).astype(np.int32)


def distinct_buckets(body: bytes) -> np.ndarray:
    parts = list(buckets(body))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int32)


@dataclass
class Model:
    """``slot`` of each bucket (the last one: no feature), ``weight`` of each slot (the last one is 0)."""

    slot: np.ndarray
    weight: np.ndarray
    bias: float

    def present(self, body: bytes) -> np.ndarray:
        """Which features a text has, and a last value without a meaning."""
        seen = np.zeros(len(self.weight), bool)
        for found in buckets(body):
            seen[self.slot[found]] = True
        return seen

    def score(self, body: bytes) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weight[self.present(body)].sum()))))


def log_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Naive Bayes log-count ratio of each bucket from the documents of either label that have it, one added to each."""
    return np.log((toxic + 1) / (n_toxic + 2)) - np.log((clean + 1) / (n_clean + 2))


def fit_linear(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with a squared penalty, by accelerated gradient steps."""
    rows, labels = rows.astype(np.float32), labels.astype(np.float32)
    weight = ahead = np.zeros(rows.shape[1], np.float32)
    probe = np.ones(rows.shape[1], np.float32)
    for _ in range(20):  # the largest curvature, by powers
        probe = rows.T @ (rows @ probe)
        probe /= max(float(np.linalg.norm(probe)), 1e-12)
    curve = 0.3 * float(np.linalg.norm(rows @ probe)) ** 2 + PENALTY + 1e-6
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = bias_ahead = float(np.log(share / (1 - share)))
    for step in range(STEPS):
        off = 1 / (1 + np.exp(-np.clip(rows @ ahead + bias_ahead, -30, 30))) - labels
        new = ahead - (rows.T @ off + PENALTY * ahead) / curve
        new_bias = bias_ahead - float(off.sum()) / (0.3 * len(labels))
        push = step / (step + 3)
        ahead, bias_ahead = new + push * (new - weight), new_bias + push * (new_bias - bias)
        weight, bias = new, new_bias
    return weight.astype(float), float(bias)


def held_out(id_col: str) -> Column:
    """Documents whose labels are never learned from: crc32 of the id as text leaves 1 by 3 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """``label, body`` of at most ``limit`` labelled documents that are not held out, those with the smallest hash of the id."""
    known = labels.select(F.col(f"`{id_col}`").cast("string").alias("doc"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.filter("doc is not null and label is not null").groupBy("doc").agg((F.min("label") > 0).cast("int").alias("label"))
    known = F.broadcast(known.filter(~held_out("doc")).orderBy(F.xxhash64("doc"), "doc").limit(limit))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc"), body.alias("body")).join(known, "doc")
    return materialize(texts.groupBy("doc", "label").agg(F.min("body").alias("body")), "labelled")


def _counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The documents of either label that have each bucket: the sample has a fixed bound, so have its buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for label, body in zip(batch.column("label").to_pylist(), batch.column("body")):
                total[label][distinct_buckets(body.as_py())] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[1][at]), pa.array(total[0][at])], names=["bucket", "toxic", "clean"])

    made = sample.mapInArrow(count, "bucket int, toxic int, clean int").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    got = made.toPandas()
    toxic, clean = np.zeros(1 << BITS), np.zeros(1 << BITS)
    toxic[got["bucket"]], clean[got["bucket"]] = got["toxic"], got["clean"]
    return toxic, clean


def _features(sample: DataFrame, model: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Which features each document of the sample has, as bits, and its label, in the order of the ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(model.value.present(body.as_py())[:-1]).tobytes() for body in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("label"), pa.array(bits, pa.binary())], names=["doc", "label", "bits"])

    got = sample.mapInArrow(read, "doc string, label int, bits binary").orderBy("doc").toPandas()
    width = len(model.value.weight) - 1
    held = np.frombuffer(b"".join(map(bytes, got["bits"])), np.uint8).reshape(len(got), -1)
    return np.unpackbits(held, axis=1, count=width), got["label"].to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = TRAINING_ROWS) -> Model:
    """A model fitted on at most ``limit`` labelled documents that are not held out.

    1. Documents of either label that have an n-gram are counted; the log of the ratio of the two shares is the
       n-gram's scale. The ``FEATURES`` ratios that stand out most against their error become features.
    2. A feature of a document is its ratio if the n-gram is in the whole text, else 0. Weights come from a
       penalised logistic regression over these.

    A document with several labels counts with the smallest, with several texts with the first in byte order. Null labels
    and ids count for nothing. Without rows of both labels, all texts get the share of label 1 (one half without rows).
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, limit)
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    if not n_toxic or not n_clean:
        return Model(np.zeros(1 << BITS, np.int16), np.zeros(1), float(np.log(share / (1 - share))))
    toxic, clean = _counts(sample)
    ratio = log_ratios(toxic, clean, n_toxic, n_clean)
    telling = np.where(toxic + clean > 0, np.abs(ratio) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1)), 0)
    best = np.argsort(-telling, kind="stable")[:FEATURES]
    slot = np.full(1 << BITS, FEATURES, np.int16)
    slot[best] = np.arange(FEATURES)
    empty = Model(slot, np.zeros(FEATURES + 1), 0.0)
    seen, wanted = _features(sample, docs.sparkSession.sparkContext.broadcast(empty))
    weight, bias = fit_linear(seen * ratio[best].astype(np.float32), wanted)
    return Model(slot, np.append(weight * ratio[best], 0.0), bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out`` (replaced if it is there).

    Only the text is read, all of it. A null or empty text has no n-grams and gets the bias alone; every row gets a score,
    repeated rows the same; an empty table gives an empty one; extra columns are passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(out)
    body = fresh(kept, "body")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(text.as_py() or b"") for text in batch.column(body)]
            yield with_columns(batch.drop_columns([body]), **{out: pa.array(scores, pa.float64())})

    texts = kept.withColumn(body, F.col(f"`{text_col}`").cast("string").cast("binary"))
    return texts.mapInArrow(add, StructType([*kept.schema.fields, StructField(out, DoubleType())]))

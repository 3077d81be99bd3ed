"""Passages that occur before: windows of words that repeat, found level by level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from corpusloom.llm.common import NULL_ID, doubled, hash_words, keyed_texts, mix, small, window_hashes
from corpusloom.session import materialize

WORDS = 20
_SECOND = 0x5BD1E995


def level_hashes(words: list[bytes], length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``length`` words, made by doubling from its odd part."""
    step = length & -length
    hashes, n = window_hashes(hash_words(words, seed), length // step), length // step
    while n < length:
        hashes, n = doubled(hashes, n), 2 * n
    return mix(hashes)


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest hash of every ``span`` neighbours (the first of equal ones), ascending, each once."""
    if len(hashes) < span:
        return np.empty(0, np.int64)
    return np.unique(np.arange(len(hashes) - span + 1) + sliding_window_view(hashes, span).argmin(axis=1))


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + length, size), -1)
    return np.cumsum(edges[:size]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (words joined by one space).

    A word goes if a window of ``length`` words (even) covers it whose words also begin earlier: in a document
    with a smaller id, or before in the same. Windows are found in levels:

    1. Documents equal word for word: all but the first go whole, and take no further part.
    2. Windows of half the length. Every window of full length holds ``length // 2 + 1`` of them; only the
       one with the smallest hash (an anchor) is counted, so a sixth of all windows is. Those found once end here.
    3. Windows of full length around a repeated anchor, by 128-bit hashes: the first place of each is found, and
       all other places are removed.

    Counts are combined per task, so a passage that a third of the documents holds is a row per task; the
    rows of a common window in the join back can be split by adaptive execution. Longer repeats are runs
    of such windows. A null text has no words. Rows with the same id are read as one document after another
    in the order of their texts' hashes; equal rows are one document and get the same result. A null id counts
    as smaller than all others. An empty table gives an empty one; extra columns are not read.
    """
    half, span = length // 2, length // 2 + 1
    texts = keyed_texts(docs, id_col, text_col).withColumn("row", F.xxhash64("body"))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [body.split() for body in batch.column("body").to_pylist()]
            digests = pa.array([xxh3_128_digest(b" ".join(w)) for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(map(len, words), pa.int64()), digests], names=["doc", "row", "n_words", "digest"])

    known = materialize(texts.mapInArrow(profile, "doc long, row long, n_words long, digest binary"), "profiles")
    first = known.filter(F.col("n_words") >= length).groupBy("digest").agg(F.min(F.struct("doc", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = known.join(first, "digest").filter((F.col("doc") != F.col("first.doc")) | (F.col("row") != F.col("first.row")))
    copies = small(materialize(repeated.select("doc", "row").distinct(), "copies"))
    alone = texts.join(copies, ["doc", "row"], "left_anti")

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, places, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
            for body in batch.column("body").to_pylist():
                hashes = level_hashes(body.split(), half)
                at = anchors(hashes, span)
                found.append(hashes[at])
                places.append(at)
                sizes.append(len(at))
            owner = [np.repeat(batch.column(c).to_numpy(), sizes) for c in ("doc", "row")]
            columns = [np.concatenate(found).view(np.int64), *owner, np.concatenate(places).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "doc", "row", "place"])

    marks = alone.mapInArrow(halves, "anchor long, doc long, row long, place int")
    # Written, so that the join below is of two plain shuffles, whose large partitions can be split.
    common = materialize(marks.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "common")
    hit = materialize(marks.join(common, "anchor").groupBy("doc", "row").agg(F.collect_list("place").alias("places")), "anchors")

    def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row, body, places in zip(*(batch.column(c).to_pylist() for c in ("doc", "row", "body", "places"))):
                if places is None:
                    continue
                words = body.split()
                near = np.zeros(len(words) + 1, np.int64)  # windows of full length that hold a repeated anchor
                np.add.at(near, np.maximum(np.array(places) - half, 0), 1)
                np.add.at(near, np.array(places) + 1, -1)
                starts = np.flatnonzero(np.cumsum(near)[: len(words) - length + 1])
                lanes = [level_hashes(words, length, seed)[starts].view(np.int64) for seed in (0, _SECOND)]
                owner = [np.full(len(starts), v, np.int64) for v in (doc, row)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*lanes, *owner, starts.astype(np.int32))], names=["a", "b", "doc", "row", "start"])

    # Both uses of the texts below share one shuffle of them.
    placed = texts.join(hit, ["doc", "row"], "left")
    windows = placed.mapInArrow(wholes, "a long, b long, doc long, row long, start int")
    at = F.struct("doc", "row", "start")
    earliest = windows.groupBy("a", "b").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = windows.join(earliest, ["a", "b"]).filter(at > F.col("first")).groupBy("doc", "row").agg(F.collect_list("start").alias("starts"))
    gone = copies.withColumn("whole", F.lit(True))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for body, starts, whole in zip(*(batch.column(c).to_pylist() for c in ("body", "starts", "whole"))):
                words = body.split()
                lost = np.ones(len(words), bool) if whole else covered(np.array(starts or [], np.int64), length, len(words))
                n_words.append(len(words))
                n_removed.append(int(lost.sum()))
                left = [w for w, out in zip(words, lost) if not out] if n_removed[-1] else words
                kept.append(b" ".join(left).decode())
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    whole = texts.join(later, ["doc", "row"], "left").join(gone, ["doc", "row"], "left")
    shown = F.when(F.col("doc") != F.lit(NULL_ID), F.col("doc")).alias("doc_id")
    return whole.select(shown, "body", "starts", "whole").mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: Stands for a null id inside joins: one document that comes before all others.
NULL_ID = -(2**63)
#: Rows a forced broadcast may have; beyond it, Spark joins by shuffling.
BROADCAST_ROWS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, in any case of letters."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def id_key(name: str) -> Column:
    """The id as a long that is never null, for joins."""
    return F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(NULL_ID))


def id_back(name: str) -> Column:
    """The id that ``id_key`` came from."""
    return F.when(F.col(name) != NULL_ID, F.col(name))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id as ``doc`` (never null) and the text as UTF-8 bytes in ``body`` (null: empty), nothing else."""
    return docs.select(id_key(id_col).alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hash_words(words: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    if seed:
        return np.fromiter((xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), n, 2**64))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` values, one array operation per value of a run."""
    size = len(hashes) - n + 1
    if size <= 0:
        return hashes[:0]
    total = hashes[:size].copy()
    for j in range(1, n):
        total *= _STEP
        total += hashes[j : j + size]
    return total


def doubled(hashes: np.ndarray, n: int) -> np.ndarray:
    """From the hashes of all runs of ``n`` values, those of all runs of ``2 * n``."""
    return hashes[:-n] * power(n) + hashes[n:] if len(hashes) > n else hashes[:0]


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield as_batch(held, schema)
            held = []
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with columns put in place of those of the same name, or after the others."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, array in columns.items():
        if name in names:
            arrays[names.index(name)] = array
        else:
            names.append(name)
            arrays.append(array)
    return pa.RecordBatch.from_arrays(arrays, names=names)

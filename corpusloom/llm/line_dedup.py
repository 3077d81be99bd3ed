"""Lines that many documents repeat: explode, hash, count documents, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_128_digest

from corpusloom.llm.common import as_batch, fresh, id_key, keyed_texts, with_columns
from corpusloom.llm.ngram_join import in_parts
from corpusloom.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line stripped of ASCII white space, A-Z in lower case; None if it is too short to count."""
    line = line.strip().lower()
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode()) < min_chars:
        return None
    return xxh3_128_digest(line)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated lines, and ``n_lines`` and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents stays only in the document with the largest id that holds it, there as often as it
    occurs. Only the hashes of lines are shuffled for counting; the texts move once, to meet the
    hashes they lose. A very common line is counted per task first, and its rows in the join back
    can be split among tasks by adaptive execution.

    A null or empty text is one empty line. Rows with the same id are one document: they count once
    and lose the same lines. A null id counts as one document before all others. An empty table gives
    an empty one. Columns named like the two counts are replaced; others are passed on.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("line", pa.binary()), ("doc", pa.int64())])
        for batch in in_parts(batches):
            found = []
            for doc, body in zip(batch.column("doc").to_pylist(), batch.column("body").to_pylist()):
                own = {line_key(line, min_chars) for line in body.split(b"\n")}
                found.extend((key, doc) for key in own if key is not None)
            yield as_batch(found, schema)

    lines = materialize(keyed_texts(docs, id_col, text_col).mapInArrow(keys, "line binary, doc long"), "lines")
    counted = lines.groupBy("line").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))
    # Written, so that the join below is of two plain shuffles, whose large partitions can be split.
    repeated = materialize(counted.filter(F.col("n") >= min_docs).select("line", "keeper"), "repeated")
    doc, lost = fresh(docs, "_doc"), fresh(docs, "_lost")
    losses = (
        lines.join(repeated, "line")
        .filter(F.col("doc") != F.col("keeper"))
        .groupBy(F.col("doc").alias(doc))
        .agg(F.collect_set("line").alias(lost))
    )
    kept = docs.drop("n_lines", "n_dropped")
    schema = StructType(
        [StructField(f.name, StringType()) if f.name == text_col else f for f in kept.schema.fields]
        + [StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    )

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, text_col):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column(text_col).to_pylist(), batch.column(lost).to_pylist()):
                parts = (text or "").encode().split(b"\n")
                left = [p for p in parts if line_key(p, min_chars) not in gone] if (gone := set(gone or ())) else parts
                texts.append(b"\n".join(left).decode())
                n_lines.append(len(parts))
                n_dropped.append(len(parts) - len(left))
            made = {text_col: pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
            yield with_columns(batch, **made).select(schema.fieldNames())

    return (
        kept.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
        .withColumn(doc, id_key(id_col))
        .join(losses, doc, "left")
        .mapInArrow(drop, schema)
    )

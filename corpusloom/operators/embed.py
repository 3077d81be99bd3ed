"""Text to vector: a Spark ML default, or any model the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from corpusloom import rules
from corpusloom.functions.columns import tokenize

Encoder = Callable[[Sequence[str]], np.ndarray]


def embed_tfidf(df: DataFrame, text: str = "text", out: str = "embedding", size: int = 512) -> DataFrame:
    """Hashed tf-idf vectors of unit length. Fitting makes one pass that aggregates ``size`` numbers."""
    tokens = df.withColumn("_tokens", tokenize(F.lower(text)))
    counted = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=size).transform(tokens)
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(counted).transform(counted)
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit").transform(weighted)
    return unit.withColumn(out, vector_to_array("_unit", "float64")).drop("_tokens", "_tf", "_tfidf", "_unit")


def embed_with(
    df: DataFrame,
    load: Callable[[], Encoder],
    text: str = "text",
    out: str = "embedding",
    batch_size: int = rules.EMBED_BATCH,
) -> DataFrame:
    """Vectors from a model. ``load`` runs once per task; its encoder gets ``batch_size`` texts at a time."""
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(FloatType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load()
        for batch in batches:
            for i in range(0, batch.num_rows, batch_size):
                part = batch.slice(i, batch_size)
                vectors = np.asarray(encoder(part.column(text).to_pylist()), dtype=np.float32)
                column = pa.array(list(vectors), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, out])

    return df.mapInArrow(encode, schema)

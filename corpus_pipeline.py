"""The corpus pipeline: stages over the documents table, each written before the next reads it.

Every stage takes (spark, docs, folder) and works on all rows it is given. All but the last return
the columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import id_key, small
from corpusloom.llm.decontamination import contamination
from corpusloom.llm.line_dedup import dedup_lines
from corpusloom.llm.ngram_join import ngram_components
from corpusloom.llm.packing import pack
from corpusloom.llm.quality import THRESHOLD, score, train
from corpusloom.llm.queries import tokenizer_path
from corpusloom.session import materialize, ship_package


#: Words a worker remembers while it packs: the executors' heaps have grown in the stages before, so there is little room beside them.
REMEMBERED = 60_000


def _leave(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the ids of ``gone`` (a column ``doc``)."""
    return docs.withColumn("doc", id_key("doc_id")).join(small(materialize(gone, "gone")), "doc", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship_package(spark)
    forest = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, forest, out="quality_score").filter(F.col("quality_score") >= THRESHOLD).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; ``n_chars`` counted anew."""
    ship_package(spark)
    return dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar n-gram sets join, the one with the smallest id."""
    ship_package(spark)
    found = ngram_components(docs)
    return _leave(docs, found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key("doc_id").alias("doc")))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _leave(docs, found.filter("n_hit > 0").select(id_key("doc_id").alias("doc")).distinct())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into."""
    ship_package(spark)
    return pack(docs, tokenizer_path(), remembered=REMEMBERED)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("packing", packing),
]

#: The classifier and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

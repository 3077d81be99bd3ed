"""Merge of earlier annotation rounds, whose annotators delivered different formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import lookup, nth_choice, one_hot_label, recode_or_keep
from corpusloom.operators.combine import union_all


def _labelled(df: DataFrame, annotator: str, sentiment: Column, text: Column, corpusid: Column) -> DataFrame:
    label = F.lower(recode_or_keep(F.lower(sentiment), rules.OLD_LABELS))
    part = lambda name: F.col(name) if name in df.columns else F.lit(None)
    return df.select(
        F.lit(annotator).alias("annotator"),
        text.alias("text"),
        label.alias("sentiment"),
        corpusid.cast("bigint").alias("corpusid"),
        part("section").cast("string").alias("section"),
        part("subsection").cast("int").alias("subsection"),
    )


def from_text_labels(df: DataFrame, annotator: str) -> DataFrame:
    """A ``sentiment`` column in old or new label names; unlabelled rows drop."""
    rows = df.where(F.col("sentiment").isNotNull())
    return _labelled(rows, annotator, F.col("sentiment"), F.col("text"), F.col("corpusid"))


def from_tasks(df: DataFrame, annotator: str) -> DataFrame:
    """Annotated tasks: the first choice of the first annotation."""
    rows = df.select(nth_choice(F.col("annotations")).alias("sentiment"), "data.*")
    return _labelled(rows, annotator, F.col("sentiment"), F.col("text"), F.col("corpusid"))


def from_flags(df: DataFrame, annotator: str) -> DataFrame:
    """One column each for Yes, No and Maybe."""
    label = one_hot_label(F.col("Yes"), F.col("No"), F.col("Maybe"))
    return _labelled(df, annotator, label, F.col("text"), F.col("corpusid"))


def from_codes(df: DataFrame, annotator: str, code: str = "is_data_availability") -> DataFrame:
    """Codes 1, 2 and 3; uncoded rows drop."""
    rows = df.where(F.col(code).isNotNull())
    label = code_label(F.col(code))
    return _labelled(rows, annotator, label, F.col("text"), F.col("corpusid"))


def code_label(code: Column) -> Column:
    """Label of a numeric code; a code outside the scheme stays, as text."""
    return F.coalesce(lookup(code.cast("int"), rules.CODE_LABELS), code.cast("string"))


def merge_rounds(*parts: DataFrame) -> DataFrame:
    return union_all(*parts)

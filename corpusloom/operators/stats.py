"""Statistics of a corpus. Every one is a small aggregate with map-side combining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import percent, ratio


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds, 0 (not null) on no rows."""
    return F.count(F.when(condition, F.lit(1)))


def _has_statement() -> Column:
    return F.col("has_data_statement") == "yes"


def source_stats(df: DataFrame) -> DataFrame:
    """Per source: rows, rows with a statement and their percentage, distinct categories."""
    # Counting per (source, category) first keeps one hot source from meeting in one task.
    fine = df.groupBy("source", "statement_category").agg(
        F.count(F.lit(1)).alias("n"), count_where(_has_statement()).alias("n_yes")
    )
    return (
        fine.groupBy("source")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum("n_yes").alias("has_statement_count"),
            F.count("statement_category").alias("unique_categories"),
        )
        .withColumn("has_statement_percentage", percent(F.col("has_statement_count"), F.col("row_count")))
        .orderBy("source")
    )


def total_stats(df: DataFrame) -> DataFrame:
    """The whole table in one row."""
    per_source = df.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), count_where(_has_statement()).alias("n_yes")
    )
    totals = per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("n_yes"), F.lit(0)).alias("total_has_statement_count"),
        F.count("source").alias("source_count"),
    )
    return totals.withColumn(
        "total_has_statement_percentage", percent(F.col("total_has_statement_count"), F.col("total_rows"))
    )


def branch_stats(df: DataFrame) -> DataFrame:
    """What each harmonised source reports: rows, rows with a statement, percentage."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), count_where(_has_statement()).alias("has_data_statement_count")
    ).withColumn(
        "has_data_statement_percentage", percent(F.col("has_data_statement_count"), F.col("total_rows"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), column)


def groups_above(df: DataFrame, group: str, n: int) -> DataFrame:
    """Groups with more than ``n`` rows."""
    return df.groupBy(group).count().where(F.col("count") > n)


def split_balance(df: DataFrame, label: str = "sentiment_encoded") -> DataFrame:
    """Per split: size, positives, negatives, share of positives."""
    return (
        df.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("positive"),
        )
        .withColumn("negative", F.col("samples") - F.col("positive"))
        .withColumn("balance_ratio", ratio(F.col("positive"), F.col("samples")))
    )


def venue_coverage(venues: DataFrame, selected: DataFrame) -> DataFrame:
    """Target venues, venues with at least one selected paper, selected papers."""
    per_venue = selected.groupBy("venue").agg(F.count(F.lit(1)).alias("n"))
    named = venues.where(F.col("venue").isNotNull()).select("venue").distinct()
    return named.join(per_venue, "venue", "left").agg(
        F.count(F.lit(1)).alias("total_venues"),
        count_where(F.col("n") > 0).alias("venues_with_papers"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_papers"),
    )


def extraction_counts(mapping: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Venues and papers processed, paragraphs extracted, as one row."""
    per_venue = mapping.groupBy("venue").agg(F.count(F.lit(1)).alias("n"))
    extracted = paragraphs.agg(F.count(F.lit(1)))
    return per_venue.agg(
        F.count(F.lit(1)).alias("total_venues_processed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_papers_processed"),
    ).withColumn("total_paragraphs_extracted", extracted.scalar())


def configured_counts(df: DataFrame, column: str, configured: Sequence[str]) -> DataFrame:
    """Rows for every configured value, 0 for those with none."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in configured], f"{column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n_rows"))


def label_shares(df: DataFrame, annotator: str = "annotator", label: str = "sentiment") -> DataFrame:
    """Per annotator: labels given, and the percentage of each of yes, no and maybe."""
    counts = [count_where(F.col(label) == v).alias(f"n_{v}") for v in rules.LABELS]
    tally = df.groupBy(annotator).agg(F.count(F.lit(1)).alias("n_labelled"), *counts)
    shares = {f"{v}_pct": percent(F.col(f"n_{v}"), F.col("n_labelled"), 2) for v in rules.LABELS}
    return tally.withColumns(shares)


def label_totals(df: DataFrame, label: str = "sentiment") -> DataFrame:
    counts = [count_where(F.col(label) == v).alias(f"tot_{v}") for v in rules.LABELS]
    return df.agg(F.count(F.lit(1)).alias("total_labelled"), *counts)


def consensus(
    votes: DataFrame, item: str, annotator: str, vote: str, low: float = 0.2, high: float = 0.8
) -> DataFrame:
    """Per item: mean vote over its annotators, whether it is clear (<= low or >= high), unanimity.

    An annotator who voted twice on an item counts once, with their mean vote.
    """
    per_annotator = votes.groupBy(item, annotator).agg(
        F.avg(vote).alias("v"), F.min(vote).alias("lo"), F.max(vote).alias("hi")
    )
    score = F.round(F.avg("v"), 6)
    return per_annotator.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_annotators"),
        score.alias("score"),
        F.when((score <= low) | (score >= high), 1).otherwise(0).alias("clear"),
        F.when(F.min("lo") == F.max("hi"), 1).otherwise(0).alias("unanimous"),
    )


def consensus_count(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("n_items"), count_where(F.col("unanimous") == 1).alias("n_unanimous"))


def centred(df: DataFrame, *columns: str) -> DataFrame:
    """Subtract each column's mean, as ``<column>_centered``; the means are one-value subqueries."""
    return df.withColumns({f"{c}_centered": F.col(c) - df.agg(F.avg(c)).scalar() for c in columns})

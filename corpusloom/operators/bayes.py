"""Multinomial naive Bayes over words, as counts and one join by word; SQL can repeat it.

Weights are whole millionths, so a score is an exact sum whatever the order of its terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.training import confusion
from corpusloom.session import materialize, small

WORD_PATTERN = r"([\p{L}\p{N}_]+)"
SCALE = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of letters, digits and underscores, in lower case; none of a null text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 1)


def _scaled(value: Column) -> Column:
    return F.round(value * SCALE).cast("bigint")


def fit_bayes(train: DataFrame, text: str = "text", label: str = "sentiment_encoded") -> DataFrame:
    """``(word, weight)``: millionths of the log odds of label 1 that one occurrence adds, smoothed by one.

    The row without a word holds the prior. Rows without a label are left out. Words are counted in
    each partition before the shuffle, so a word that holds a third of all text is one row per task.
    """
    known = train.where(F.col(label).isin(0, 1)).select(F.col(text).alias("text"), F.col(label).alias("label"))
    words = known.select("label", F.explode(words_of(F.col("text"))).alias("word"))
    n1, n0 = (F.count_if(F.col("label") == value) for value in (1, 0))
    counts = materialize(words.groupBy("word").agg(n1.alias("n1"), n0.alias("n0")), "word-counts")
    totals = counts.agg(
        F.coalesce(F.sum("n1"), F.lit(0)).alias("t1"), F.coalesce(F.sum("n0"), F.lit(0)).alias("t0"), F.count(F.lit(1)).alias("v")
    )
    odds = F.ln((F.col("n1") + 1) / (F.col("t1") + F.col("v"))) - F.ln((F.col("n0") + 1) / (F.col("t0") + F.col("v")))
    # The totals are one row.
    weights = counts.join(F.broadcast(totals), F.lit(True)).select("word", _scaled(odds).alias("weight"))
    prior = known.agg(n1.alias("d1"), n0.alias("d0")).select(
        F.lit(None).cast("string").alias("word"), _scaled(F.ln((F.col("d1") + 1) / (F.col("d0") + 1))).alias("weight")
    )
    return materialize(weights.unionByName(prior), "word-weights")


def score_bayes(rows: DataFrame, weights: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``rows`` with ``bayes_score`` (millionths of log odds) and ``prediction`` (1 if it is above 0).

    ``key`` must identify a row: rows that share one, or have none, each get the sum of all their
    words. Words unknown to the model count nothing; a text without words, or
    a null one, gets the prior. Weights are broadcast up to a checked number of rows; beyond it
    they are joined by shuffling words, of which adaptive execution splits the frequent.
    """
    model = small(weights.where("word is not null"))
    prior = weights.where("word is null").agg(F.max("weight")).scalar()
    words = rows.select(F.col(key).alias("_key"), F.explode(words_of(F.col(text))).alias("word"))
    sums = words.join(model, "word").groupBy("_key").agg(F.sum("weight").alias("_sum"))
    found = rows.join(sums, F.col(key).eqNullSafe(F.col("_key")), "left")
    score = F.coalesce(F.col("_sum"), F.lit(0)) + F.coalesce(prior, F.lit(0))
    scored = found.withColumn("bayes_score", score).drop("_key", "_sum")
    return scored.withColumn("prediction", (F.col("bayes_score") > 0).cast("int"))


def bayes_metrics(rows: DataFrame, key: str) -> DataFrame:
    """Fit on the train split and measure on the test split, as ``training.evaluate`` does."""
    weights = fit_bayes(rows.where("split = 'train'"))
    return confusion(score_bayes(rows.where("split = 'test'"), weights, key))

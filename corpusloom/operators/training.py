"""Training rows from de-duplicated annotations, length handling, and the baseline classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import binary, binary_label, hash_order, ratio, tokenize
from corpusloom.operators.chat import chat_text
from corpusloom.operators.sampling import split_by_hash, split_exact
from corpusloom.operators.stats import count_where
from corpusloom.session import materialize


def encoded(annotations: DataFrame) -> DataFrame:
    rows = annotations.dropna(subset=["text", "has_data_statement"])
    return rows.withColumn("sentiment_encoded", binary(F.col("sentiment")))


def training_rows(
    annotations: DataFrame,
    key: str,
    test_fraction: float = rules.TEST_FRACTION,
    seed: int | str = rules.SEED,
    exact: bool = True,
) -> DataFrame:
    """Encoded rows with their split. ``exact`` gives exact sizes, else each row's hash decides alone."""
    split = split_exact if exact else split_by_hash
    return split(encoded(annotations), key, test_fraction, seed)


def formatted(rows: DataFrame, model: str = "llama3.2") -> DataFrame:
    """``split`` and the chat ``text``; the rest is dropped."""
    answer = binary_label(F.col("sentiment_encoded"))
    return rows.select("split", chat_text(F.col("text"), answer, model).alias("text"))


def truncate_tokens(text: Column, max_tokens: int = rules.MAX_TOKENS) -> Column:
    """The first tokens of the text, as the trainer's sequence limit does."""
    return F.slice(tokenize(text), 1, max_tokens)


def length_bucket(tokens: Column, width: int = 64) -> Column:
    return F.floor(F.size(tokens) / width).cast("int")


def grouped_by_length(df: DataFrame, text: str = "text", width: int = 64, partitions: int | None = None) -> DataFrame:
    """Order rows so that those of similar length lie together.

    Ranges are cut by (bucket, hash), so one very common length is spread over several partitions.
    """
    tokens = df.withColumn("tokens", truncate_tokens(F.col(text)))
    bucketed = tokens.withColumn("length_bucket", length_bucket(F.col("tokens"), width))
    order = ["length_bucket", hash_order(F.col(text), "length")]
    if partitions is None:
        ranged = bucketed.repartitionByRange(*order)
    else:
        ranged = bucketed.repartitionByRange(partitions, *order)
    return ranged.sortWithinPartitions("length_bucket")


@dataclass(frozen=True)
class Classifier:
    model: PipelineModel
    metrics: DataFrame


def fit_classifier(train: DataFrame, size: int = 1 << 14, max_iter: int = 20) -> PipelineModel:
    """Bag-of-words logistic regression over ``text`` and ``sentiment_encoded``."""
    words = RegexTokenizer(
        inputCol="text", outputCol="words", pattern=r"[\p{L}\p{N}_]+", gaps=False, toLowercase=True
    )
    counts = HashingTF(inputCol="words", outputCol="tf", numFeatures=size)
    weights = IDF(inputCol="tf", outputCol="features")
    model = LogisticRegression(labelCol="label", maxIter=max_iter, regParam=0.01)
    labelled = train.withColumn("label", F.col("sentiment_encoded").cast("double"))
    return Pipeline(stages=[words, counts, weights, model]).fit(labelled)


def confusion(predicted: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class of ``prediction``, as one row from one pass."""
    truth, guess = F.col("sentiment_encoded"), F.col("prediction").cast("int")
    counts = predicted.agg(
        F.count(F.lit(1)).alias("test_samples"),
        count_where((truth == 1) & (guess == 1)).alias("tp"),
        count_where((truth == 0) & (guess == 1)).alias("fp"),
        count_where((truth == 1) & (guess == 0)).alias("fn"),
        count_where((truth == 0) & (guess == 0)).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "test_samples",
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp + F.col("tn"), F.col("test_samples")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    return confusion(model.transform(test))


def train_and_evaluate(rows: DataFrame, path: str | None = None) -> Classifier:
    """Fit on the train split, measure on the test split, save the model when a path is given.

    Fitting passes over the rows several times, so they are written once with the columns it needs.
    """
    rows = materialize(rows.select("text", "sentiment_encoded", "split"), "training")
    model = fit_classifier(rows.where("split = 'train'"))
    if path is not None:
        model.write().overwrite().save(path)
    return Classifier(model, evaluate(model, rows.where("split = 'test'")))

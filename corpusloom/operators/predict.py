"""Pre-annotation: a constrained label per row, from any model or from the phrase cascade."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import phrase_cascade

Labeller = Callable[[Sequence[str]], Sequence[str]]


def cascade_label(text: Column) -> Column:
    """Default label from the phrases: no where data are said to be unavailable, maybe when unclear."""
    category = phrase_cascade(text, rules.CASCADE_MEDICAL)
    return (
        F.when(category.isin("not_applicable", "not_available", "no_statement"), F.lit("no"))
        .when(category == "other", F.lit("maybe"))
        .otherwise(F.lit("yes"))
    )


def _checked(labels: Sequence, allowed: frozenset, n: int) -> list:
    labels = list(labels)
    if len(labels) != n:
        return [None] * n
    return [v if v in allowed else None for v in labels]


def predict_labels(
    df: DataFrame,
    load: Callable[[], Labeller] | None = None,
    text: str = "text",
    out: str = "prediction",
    labels: Sequence[str] = rules.LABELS,
) -> DataFrame:
    """Add a label from ``labels`` per row, null where the model fails or answers anything else.

    ``load`` runs once per task and returns a function over a batch of texts. A failing batch is
    retried row by row, so one bad row leaves the others labelled. Without ``load`` the phrase
    cascade labels the rows with built-in functions.
    """
    if load is None:
        return df.withColumn(out, cascade_label(F.col(text)))
    allowed = frozenset(labels)

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            try:
                answers = _checked(model(list(texts)), allowed, len(texts))
            except Exception:  # noqa: BLE001
                answers = []
                for t in texts:
                    try:
                        answers += _checked(model([t]), allowed, 1)
                    except Exception:  # noqa: BLE001
                        answers.append(None)
            yield pd.Series(answers, dtype=object)

    return df.withColumn(out, label(F.col(text)))

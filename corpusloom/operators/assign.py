"""Disjoint assignment of annotation tasks, task records, and the layout-quadrant variant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import hash_order, nth_choice, prefix
from corpusloom.operators.ranking import draw_with_replacement, shuffled_rank, take_shuffled, top_k_per_group
from corpusloom.operators.stats import centred, count_where


def _names(annotators: Sequence[str]) -> Column:
    return F.array(*[F.lit(a) for a in annotators])


def assign(
    pool: DataFrame,
    key: str,
    annotators: Sequence[str],
    per_annotator: int = rules.TASKS_PER_ANNOTATOR,
    seed: int | str = rules.SEED,
    strict: bool = True,
) -> DataFrame:
    """``per_annotator`` pool rows for each annotator in turn, no row for two; adds ``annotator``.

    ``key`` must identify a row. Only the ranks that are assigned are ranked. A pool that is too small is
    an error if ``strict``, else the last annotators get fewer rows.
    """
    if strict:
        pool = take_shuffled(pool, key, per_annotator * len(annotators), seed)
    ranked = shuffled_rank(pool, key, seed, rank="_rank", limit=per_annotator * len(annotators))
    turn = F.floor((F.col("_rank") - 1) / per_annotator).cast("int")
    return ranked.withColumn("annotator", F.get(_names(annotators), turn)).drop("_rank")


def remaining(pool: DataFrame, assigned: DataFrame, key: str) -> DataFrame:
    return pool.join(assigned.select(key), key, "left_anti")


def with_overlap(
    assigned: DataFrame, key: str, annotators: Sequence[str], share: int = 15, seed: int | str = "overlap"
) -> DataFrame:
    """Assigned rows plus, for every annotator, ``share`` rows of each other annotator to check agreement.

    Adds ``owner``, the annotator a row was first assigned to.
    """
    own = assigned.withColumn("owner", F.col("annotator"))
    others = F.filter(_names(annotators), lambda a: a != F.col("annotator"))
    offered = own.withColumn("_to", F.explode(others))
    order = [hash_order(F.concat_ws("|", "_to", F.col(key).cast("string")), seed), F.col(key)]
    shared = top_k_per_group(offered, ["owner", "_to"], order, share)
    return own.unionByName(shared.withColumn("annotator", F.col("_to")).drop("_to"))


def quadrant(x: Column, y: Column) -> Column:
    """0 to 3, counter-clockwise from both coordinates positive."""
    return (
        F.when((x > 0) & (y > 0), 0).when((x <= 0) & (y > 0), 1).when((x <= 0) & (y <= 0), 2).otherwise(3)
    )


def with_quadrant(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Centre both coordinates on their means and add the quadrant."""
    return centred(df, x, y).withColumn("quadrant", quadrant(F.col(f"{x}_centered"), F.col(f"{y}_centered")))


def assign_quadrants(
    df: DataFrame,
    key: str,
    annotators: Sequence[str],
    draws: int = 500,
    x: str = "x",
    y: str = "y",
    seed: int | str = rules.SEED,
) -> DataFrame:
    """One layout quadrant per annotator, ``draws`` draws with replacement, so at most that many rows each.

    There are four quadrants; an empty one gives its annotator no rows.
    """
    if not 0 < len(annotators) <= 4:
        raise ValueError(f"{len(annotators)} annotators for four quadrants")
    placed = with_quadrant(df, x, y)
    parts = [
        draw_with_replacement(placed.where(F.col("quadrant") == q), key, draws, f"{seed}|{q}").withColumn(
            "annotator", F.lit(name)
        )
        for q, name in enumerate(annotators)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- task records ---------------------------------------------------------------------------
def task_data() -> Column:
    return F.struct("corpusid", "corpusid_unique", "par_id", "wc", "text").alias("data")


def empty_annotation(annotator_id: Column, email: Column) -> Column:
    """An annotation without a choice, which is how a task is assigned to a person."""
    who = F.struct(
        annotator_id.alias("id"),
        F.lit("").alias("first_name"),
        F.lit("").alias("last_name"),
        F.lit(None).cast("string").alias("avatar"),
        email.alias("email"),
        prefix(email, 2).alias("initials"),
    )
    return annotation(who, F.array().cast("array<string>"))


def annotation(completed_by: Column, choices: Column) -> Column:
    result = F.struct(
        F.struct(choices.alias("choices")).alias("value"),
        F.lit("").alias("id"),
        F.lit("sentiment").alias("from_name"),
        F.lit("text").alias("to_name"),
        F.lit("choices").alias("type"),
        F.lit("manual").alias("origin"),
    )
    entry = F.struct(
        F.lit(False).alias("ground_truth"), completed_by.alias("completed_by"), F.array(result).alias("result")
    )
    return F.array(entry).alias("annotations")


def predictions(label: Column, model_version: str, result_id: Column) -> Column:
    result = F.struct(
        result_id.cast("string").alias("id"),
        F.lit("sentiment").alias("from_name"),
        F.lit("text").alias("to_name"),
        F.lit("labels").alias("type"),
        F.struct(F.array(label).alias("choices")).alias("value"),
    )
    entry = F.struct(F.lit(model_version).alias("model_version"), F.array(result).alias("result"))
    return F.when(label.isNotNull(), F.array(entry)).alias("predictions")


def build_tasks(
    assigned: DataFrame,
    annotator_ids: DataFrame,
    prediction: str | None = None,
    model_version: str = "phrase-cascade",
) -> DataFrame:
    """Nested task records from assigned rows; ``annotator_ids`` maps ``annotator`` to ``annotator_id``.

    A row whose prediction is null gets a task without predictions, one whose annotator has no id a null id.
    """
    rows = assigned.join(annotator_ids, "annotator", "left")
    label = F.lit(None).cast("string") if prediction is None else F.col(prediction)
    return rows.select(
        "annotator",
        task_data(),
        empty_annotation(F.col("annotator_id"), F.col("annotator")),
        predictions(label, model_version, F.col("corpusid_unique")),
    )


def task_json(data: Column, annotations: Column, prediction: Column) -> Column:
    """The task as JSON: nulls inside are written, but ``predictions`` only when there are some."""
    options = {"ignoreNullFields": "false"}
    bare = F.to_json(F.struct(data.alias("data"), annotations.alias("annotations")), options)
    full = F.to_json(
        F.struct(data.alias("data"), annotations.alias("annotations"), prediction.alias("predictions")), options
    )
    return F.when(prediction.isNull(), bare).otherwise(full)


def tasks_to_json(tasks: DataFrame) -> DataFrame:
    value = task_json(F.col("data"), F.col("annotations"), F.col("predictions"))
    return tasks.select("annotator", value.alias("value"))


def predicted(tasks: DataFrame, n: int = 1, label: str = "yes") -> DataFrame:
    """Tasks whose ``n``-th (0-based) prediction is ``label``."""
    return tasks.where(nth_choice(F.col("predictions"), n) == label)


def dispatch_report(tasks: DataFrame, annotators: DataFrame | None = None) -> DataFrame:
    """Tasks sent and predictions made, per annotator; with ``annotators`` also those without a task, as zeros."""
    counted = tasks.groupBy("annotator").agg(
        F.count(F.lit(1)).alias("annotations_sent"),
        count_where(F.col("predictions").isNotNull()).alias("predictions_generated"),
    )
    if annotators is None:
        return counted
    zeros = {"annotations_sent": 0, "predictions_generated": 0}
    return annotators.select("annotator").distinct().join(counted, "annotator", "full").na.fill(zeros)


def dispatch_totals(tasks: DataFrame, pool: DataFrame, key: str = "corpusid_unique") -> DataFrame:
    """One row: tasks sent, annotators with a task, predictions made, and rows of ``pool`` that no task was made of.

    Rows of the pool without a ``key`` remain.
    """
    sent = tasks.select(F.col(f"data.{key}").alias(key))
    left = pool.select(key).join(sent, key, "left_anti").agg(F.count(F.lit(1)))
    return tasks.agg(
        F.count(F.lit(1)).alias("total_dispatched"),
        F.countDistinct("annotator").alias("n_annotators"),
        count_where(F.col("predictions").isNotNull()).alias("predictions_generated"),
    ).withColumn("remaining", left.scalar())

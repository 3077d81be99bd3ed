"""From venue rankings and papers to paragraphs, and from paragraphs to dispatched tasks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.operators.assign import assign, build_tasks, dispatch_report, remaining
from corpusloom.operators.predict import Labeller, predict_labels
from corpusloom.operators.sampling import annotation_batch
from corpusloom.operators.spans import extract_paragraphs
from corpusloom.operators.stats import extraction_counts, venue_coverage
from corpusloom.operators.venues import ranking_names, resolve_venues, select_papers, target_venues
from corpusloom.session import materialize
from corpusloom.sinks import tables as sinks


@dataclass(frozen=True)
class Selection:
    mapping: DataFrame
    coverage: DataFrame


def choose_papers(
    ranking: DataFrame, metadata: DataFrame, overrides: DataFrame, papers: DataFrame, order: str
) -> Selection:
    """Papers of the ranked venues, and how well the venues are covered."""
    venues = target_venues(resolve_venues(ranking_names(ranking), metadata, overrides, order))
    mapping = select_papers(papers, venues)
    return Selection(mapping, venue_coverage(venues, mapping))


@dataclass(frozen=True)
class Ingested:
    paragraphs: DataFrame
    counts: DataFrame


def ingest_paragraphs(mapping: DataFrame, full_text: DataFrame, out: str) -> Ingested:
    """Cut and store the paragraphs per venue; a re-run replaces the rows of the mapping's venues, to none if none are left."""
    made = extract_paragraphs(mapping, full_text)
    sinks.write_partitions(made, out, "venue", covered=mapping.select("venue"))
    written = mapping.sparkSession.read.schema(made.schema).parquet(out)
    return Ingested(written, extraction_counts(mapping, written))


@dataclass(frozen=True)
class Dispatch:
    tasks: DataFrame
    report: DataFrame
    remaining: DataFrame


def dispatch(
    paragraphs: DataFrame,
    annotators: Mapping[str, int],
    out: str,
    done: DataFrame | None = None,
    per_annotator: int = rules.TASKS_PER_ANNOTATOR,
    keywords: Sequence[str] = rules.STATEMENT_KEYWORDS,
    per_venue: int = rules.SAMPLE_PER_VENUE,
    load_model: Callable[[], Labeller] | None = None,
    preannotate: bool = True,
    seed: int = rules.SEED,
) -> Dispatch:
    """Draw a batch, give each annotator their own tasks, write the payload, report."""
    spark = paragraphs.sparkSession
    batch = materialize(annotation_batch(paragraphs, done, keywords, per_venue=per_venue, seed=seed), "batch")
    assigned = assign(batch, "corpusid_unique", list(annotators), per_annotator, seed)
    if preannotate:
        assigned = predict_labels(assigned, load_model)
    ids = spark.createDataFrame(list(annotators.items()), "annotator string, annotator_id bigint")
    tasks = materialize(build_tasks(assigned, ids, "prediction" if preannotate else None), "tasks")
    sinks.write_task_payload(tasks, out)
    left = remaining(batch, tasks.select(F.col("data.corpusid_unique").alias("corpusid_unique")), "corpusid_unique")
    return Dispatch(tasks, dispatch_report(tasks), left)

"""From harmonised sources to a written training set."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import day_stamp
from corpusloom.operators import harmonize
from corpusloom.operators.combine import combine
from corpusloom.operators.dedup import DedupResult, deduplicate
from corpusloom.operators.stats import source_stats, split_balance, total_stats, value_counts
from corpusloom.operators.training import formatted, training_rows
from corpusloom.sinks import tables as sinks
from corpusloom.sources import tables as sources

# Position in this list is the order in which sources win when texts repeat.
SOURCES: tuple[tuple[str, Callable, Callable], ...] = (
    ("coded_statements", sources.read_coded_statements, harmonize.coded_statements),
    ("typed_statements", sources.read_typed_statements, harmonize.typed_statements),
    ("observed_flags", sources.read_observed_flags, harmonize.observed_flags),
    ("medical_preprints", sources.read_medical_preprints, harmonize.medical_preprints),
    ("coded_journals", sources.read_coded_journals, harmonize.coded_journals),
    ("annotation_tasks", sources.read_tasks, harmonize.annotation_tasks),
)


@dataclass(frozen=True)
class Combined:
    rows: DataFrame
    source_stats: DataFrame
    total_stats: DataFrame


def combine_sources(spark: SparkSession, paths: Mapping[str, str | Sequence[str]], out: str) -> Combined:
    """Read and harmonise the given sources, write their union once, and describe the written table.

    ``row_key`` orders rows within a source. Files have no row numbers, so it is a digest of the row:
    stable under any partitioning.
    """
    unknown = set(paths) - {name for name, _, _ in SOURCES}
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    branches = []
    for name, read, harmonise in SOURCES:
        if name in paths:
            rows = harmonise(read(spark, paths[name]))
            digest = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
            branches.append(rows.withColumn("row_key", digest))
    sinks.replace_table(combine(*branches), out, ["source"])
    written = spark.read.parquet(out)
    return Combined(written, source_stats(written), total_stats(written))


@dataclass(frozen=True)
class TrainingSet:
    path: str
    rows: DataFrame
    balance: DataFrame
    dedup: DedupResult


def build_training_set(
    combined: DataFrame,
    root: str,
    model: str = "llama3.2",
    day: str | None = None,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    threshold: float = rules.SIMILARITY_THRESHOLD,
    semantic: bool = True,
    seed: int = rules.SEED,
) -> TrainingSet:
    """De-duplicate, split, format, and write data, metadata and card under a dated folder."""
    spark = combined.sparkSession
    if day is None:
        day = spark.range(1).select(day_stamp()).first()[0]
    dedup = deduplicate(combined, ["source_rank", "row_key"], embed, threshold, semantic)
    # Texts are distinct by now, so the split depends on the rows and the seed alone, not on partitions.
    rows = training_rows(dedup.rows, "text", seed=seed)
    balance = split_balance(rows)
    path = sinks.write_splits(formatted(rows, model), root, model, day)
    metadata = sinks.run_metadata(balance, value_counts(rows, "source"), model, day)
    sinks.write_metadata(metadata, os.path.join(path, "metadata"))
    sinks.write_card(spark, sinks.dataset_card(rows, balance, model, day), os.path.join(path, "card"))
    written = spark.read.parquet(os.path.join(path, "data"))
    return TrainingSet(path, written, balance, dedup)

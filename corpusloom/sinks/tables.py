"""Tables, dated splits, metadata, annotation payloads, per-annotator files, the dataset card."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom import rules
from corpusloom.functions.columns import ratio, with_thousands
from corpusloom.operators.assign import tasks_to_json
from corpusloom.operators.chat import chat_text
from corpusloom.operators.stats import value_counts
from corpusloom.session import materialize, small


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_named_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def replace_unless_empty(df: DataFrame, path: str) -> bool:
    """Replace a table, but leave the old one when the new result is empty; tells which happened."""
    if df.isEmpty():
        return False
    replace_table(df, path)
    return True


def _sliced(df: DataFrame, counts: DataFrame, partition_by: str, rows_per_file: int) -> DataFrame:
    """``df`` with the rows of a value moved together, in as many slices as its counted rows need."""
    types = dict(df.dtypes)
    row = [F.col(f"here.`{c}`") for c in df.columns if "map<" not in types[c]]
    same = F.col(f"here.{partition_by}").eqNullSafe(F.col(f"sizes.{partition_by}"))
    placed = df.alias("here").join(small(counts).alias("sizes"), same)
    slices = F.ceil(F.col("sizes.n_rows") / rows_per_file)
    salted = placed.select("here.*", F.pmod(F.xxhash64(*row), slices).alias("_slice"))
    return salted.repartition(partition_by, "_slice").drop("_slice")


def _clear(spark: SparkSession, path: str, schema: StructType, partition_by: str, values: DataFrame) -> None:
    """Delete the folders of ``values``; their paths are at most one per value that has a folder."""
    stored = spark.read.schema(schema).parquet(path)
    same = F.col(f"stored.{partition_by}").eqNullSafe(F.col(f"gone.{partition_by}"))
    files = stored.select(partition_by, F.col("_metadata.file_path").alias("file")).alias("stored")
    gone = files.join(values.alias("gone"), same, "left_semi")
    folders = gone.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    jvm = spark.sparkContext._jvm
    for row in folders.collect():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.folder))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: str = "venue",
    covered: DataFrame | None = None,
    rows_per_file: int = 1_000_000,
) -> DataFrame:
    """Write per partition value: values in ``df`` are replaced, others stay, so a re-run adds nothing twice.

    ``covered`` lists all values this run answers for; those without a row now lose what they had.
    There are at most as many files as values plus rows / ``rows_per_file``: values are counted, and
    the rows of a large one are moved in slices. ``df`` is computed once, written to the shared
    folder, then counted and moved. Returns the manifest: each value with its ``n_rows`` (0 where
    it was cleared or never there). A null value is a value.
    """
    spark = df.sparkSession
    rows = materialize(df, "partitions")
    counts = materialize(rows.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n_rows")), "partition-sizes")
    writer = _sliced(rows, counts, partition_by, rows_per_file).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file).partitionBy(
        partition_by
    ).parquet(path)
    if covered is None:
        return counts
    same = F.col(f"all.{partition_by}").eqNullSafe(F.col(f"now.{partition_by}"))
    empty = covered.select(partition_by).distinct().alias("all").join(counts.alias("now"), same, "left_anti")
    empty = materialize(empty, "cleared")
    _clear(spark, path, rows.schema, partition_by, empty)
    return counts.unionByName(empty.withColumn("n_rows", F.lit(0).cast("bigint")))


def append_rows(df: DataFrame, path: str, partition_by: str = "venue") -> None:
    """Plain append; a re-run adds the rows again."""
    df.write.mode("append").partitionBy(partition_by).parquet(path)


def write_empty(spark: SparkSession, schema: str | StructType, path: str) -> None:
    replace_table(spark.createDataFrame([], schema), path)


def dated_path(root: str, model: str, day: str) -> str:
    return os.path.join(root, f"data-availability-{model}-{day}")


def write_splits(rows: DataFrame, root: str, model: str, day: str) -> str:
    """``split=train`` and ``split=test`` in a dated folder; ``day`` is ``yyyyMMdd``."""
    path = dated_path(root, model, day)
    replace_table(rows, os.path.join(path, "data"), ["split"])
    return path


def run_metadata(balance: DataFrame, sources: DataFrame, model: str, day: str) -> DataFrame:
    """One row that describes a written training set; both inputs are already small aggregates."""

    def of(split: str, column: str):
        return F.coalesce(F.max(F.when(F.col("split") == split, F.col(column))), F.lit(0))

    pairs = sources.agg(F.map_from_entries(F.collect_list(F.struct("source", "count"))))
    return balance.agg(
        F.lit(day).alias("dataset_date"),
        F.lit(model).alias("target_model"),
        F.coalesce(F.sum("samples"), F.lit(0)).alias("total_samples"),
        of("train", "samples").alias("train_samples"),
        of("test", "samples").alias("test_samples"),
        F.lit(f"sft_{model}_chat_format").alias("format"),
        F.lit(True).alias("uses_deduplicated_data"),
    ).withColumn("source_distribution", pairs.scalar())


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.coalesce(1).write.mode("overwrite").json(path)


def write_task_payload(tasks: DataFrame, path: str) -> None:
    """Tasks as JSON lines, one folder per annotator."""
    tasks_to_json(tasks).write.mode("overwrite").partitionBy("annotator").text(path)


def write_annotator_files(df: DataFrame, path: str) -> None:
    """CSV files, one folder per annotator."""
    writer = df.write.mode("overwrite").partitionBy("annotator")
    writer.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def card_lines(balance: DataFrame, sources: DataFrame) -> DataFrame:
    """The figures of the card, formatted: ``(section, position, line)``; a handful of rows."""
    totals = balance.agg(F.coalesce(F.sum("samples"), F.lit(0)).alias("n"))
    total = totals.select(
        F.lit("info").alias("section"),
        F.lit(0).cast("bigint").alias("position"),
        F.concat(F.lit("- **Total samples**: "), with_thousands(F.col("n"))).alias("line"),
    )
    name = F.initcap("split")
    place = F.when(F.col("split") == "train", 1).otherwise(2)
    sizes = balance.select(
        F.lit("info").alias("section"),
        place.cast("bigint").alias("position"),
        F.concat(F.lit("- **"), name, F.lit(" samples**: "), with_thousands(F.col("samples"))).alias("line"),
    )
    shares = balance.select(
        F.lit("info").alias("section"),
        (place + 2).cast("bigint").alias("position"),
        F.concat(
            F.lit("- **"),
            name,
            F.lit(" positive ratio**: "),
            F.format_number(ratio(F.col("positive"), F.col("samples")), 3),
        ).alias("line"),
    )
    by_source = sources.select(
        F.lit("sources").alias("section"),
        F.negative("count").alias("position"),
        F.concat(
            F.lit("- **"), F.col("source"), F.lit("**: "), with_thousands(F.col("count")), F.lit(" samples")
        ).alias("line"),
    )
    return total.unionByName(sizes).unionByName(shares).unionByName(by_source)


def dataset_card(rows: DataFrame, balance: DataFrame, model: str, created: str) -> str:
    """Markdown description of a training set. The driver sees only the formatted figures."""
    lines = card_lines(balance, value_counts(rows, "source")).orderBy("section", "position", "line").collect()
    part: Mapping[str, list[str]] = {"info": [], "sources": []}
    for row in lines:
        part[row["section"]].append(row["line"])
    sample = rows.sparkSession.range(1).select(chat_text(F.lit("[SAMPLE_TEXT]"), F.lit("[yes|no]"), model)).first()[0]
    name = model.upper()
    sections = [
        "# Data Availability Statements Dataset",
        "Deduplicated, annotated texts for training models that detect data availability statements.",
        "## Dataset Information",
        "\n".join([*part["info"], f"- **Created**: {created}", f"- **Target model**: {name}"]),
        "## Data Sources",
        "\n".join(part["sources"]),
        "## Data Quality",
        "- Identical texts removed\n- Similar texts removed by embedding\n- Only 'yes' and 'no' labels",
        "## Format",
        f'Each sample follows the {name} chat format with the instruction:\n"{rules.INSTRUCTION}"',
        f"```\n{sample}\n```",
        "## Labels",
        "- **yes**: contains a data availability statement\n- **no**: does not contain one",
        "## Formats Supported",
        "\n".join(f"- {known}" for known in rules.CHAT_FORMATS),
    ]
    return "\n\n".join(sections) + "\n"


def write_card(spark: SparkSession, card: str, path: str) -> None:
    """One text file; the writer ends it with the card's last newline."""
    text = card.removesuffix("\n")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

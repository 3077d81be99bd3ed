"""CSV, JSON and Parquet scans with declared schemas, snapshots, and fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom import schemas
from corpusloom.functions.columns import normalize_na


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: str | StructType, encoding: str = "UTF-8"
) -> DataFrame:
    """CSV files of one schema, read as one: header, quoted cells over several lines, NA tokens as null.

    A file with multi-line cells is not split, so large inputs should come as many files.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
    )
    return normalize_na(reader.csv(paths if isinstance(paths, str) else list(paths)))


def read_coded_statements(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.CODED_STATEMENTS, "ISO-8859-1")


def read_typed_statements(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.TYPED_STATEMENTS)


def read_observed_flags(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.OBSERVED_FLAGS)


def read_medical_preprints(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.MEDICAL_PREPRINTS, "ISO-8859-1")


def read_coded_journals(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.CODED_JOURNALS)


def read_documents(
    spark: SparkSession, path: str | Sequence[str], schema: str, fmt: str = "parquet", fields: Sequence[str] = ("*",)
) -> DataFrame:
    """Nested documents (Parquet, ORC or JSON lines) with only the named fields."""
    return spark.read.schema(schema).format(fmt).load(path if isinstance(path, str) else list(path)).select(*fields)


def read_tasks(
    spark: SparkSession, path: str | Sequence[str], only_annotated: bool = True, multi_line: bool = True
) -> DataFrame:
    """Annotation tasks: a JSON array per file, or JSON lines with ``multi_line=False``."""
    tasks = spark.read.schema(schemas.TASK).option("multiLine", multi_line).json(path)
    return tasks.where(F.size("annotations") > 0) if only_annotated else tasks


def read_ranking(spark: SparkSession, table: str) -> DataFrame:
    """A stored venue ranking, under the names the venue operators use."""
    return spark.table(table).select(F.col("venue").alias("publication"), "h5_index", "h5_median")


def latest_snapshot(df: DataFrame, column: str = "snapshot", prefix: str = "") -> DataFrame:
    """Rows of the greatest snapshot name with a prefix.

    On a table partitioned by ``column`` only that partition is read for the rows.
    """
    named = df.where(F.col(column).startswith(prefix)) if prefix else df
    return named.where(F.col(column) == df.where(F.col(column).startswith(prefix)).agg(F.max(column)).scalar())


@dataclass(frozen=True)
class Located:
    rows: DataFrame
    source: str
    failures: tuple[str, ...]


def read_first_available(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> Located:
    """The first readable of several locations, and which one it was."""
    failures: list[str] = []
    for path in paths:
        try:
            return Located(spark.read.format(fmt).load(path), path, tuple(failures))
        except AnalysisException as missing:
            failures.append(f"{path}: {str(missing).splitlines()[0]}")
    raise FileNotFoundError("; ".join(failures) or "no location given")


def read_through(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A stored result if there is one, else compute it, store it, and read it back.

    The caller puts the parameters of the computation in the path.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        compute().write.parquet(path)
        return spark.read.parquet(path)

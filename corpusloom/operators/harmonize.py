"""Bring label sources of different shapes into the unified six-column schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules, schemas
from corpusloom.functions import columns as C


def unify(
    df: DataFrame,
    source: str,
    has_data_statement: Column,
    statement_category: Column,
    text: Column | None = None,
    venue: Column | None = None,
    publication_year: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project to the unified schema. Parts not given are typed nulls; ``keep`` carries order keys."""
    values = {
        "source": F.lit(source),
        "text": text,
        "venue": venue,
        "publication_year": publication_year,
        "has_data_statement": has_data_statement,
        "statement_category": statement_category,
    }
    projected = [
        (F.lit(None) if values[name] is None else values[name]).cast("string").alias(name)
        for name in schemas.UNIFIED_COLUMNS
    ]
    return df.select(*projected, *keep)


def coded_statements(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Statements coded with one of nine text codes."""
    df = C.normalize_na(df)
    code = F.col("statement_category")
    return unify(
        df,
        rules.SOURCE_CODED_STATEMENTS,
        text=F.col("data_statement"),
        publication_year=C.year_of(F.col("`publication_date.x`")),
        has_data_statement=C.yes_if_member(code, list(rules.STATEMENT_CODES)),
        statement_category=C.recode(code, rules.STATEMENT_CODES),
        keep=keep,
    )


def typed_statements(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Statements with a numeric type; every row has a statement, the year is unknown."""
    df = C.normalize_na(df)
    return unify(
        df,
        rules.SOURCE_TYPED_STATEMENTS,
        text=F.col("Data availability statement text"),
        venue=F.col("Journal title"),
        has_data_statement=F.lit("yes"),
        statement_category=C.recode(F.col("`Statement type (1, 2, 3, 4)`").cast("double"), rules.STATEMENT_TYPES),
        keep=keep,
    )


def observed_flags(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Papers observed to have a statement or not; the statement text was not recorded."""
    df = C.normalize_na(df)
    flag = F.col("`Is there an ASDC?`")
    return unify(
        df,
        rules.SOURCE_OBSERVED_FLAGS,
        venue=F.col("Journal name"),
        publication_year=F.col("Year of publication"),
        has_data_statement=C.recode(flag, rules.FLAG_LABELS, "unknown"),
        statement_category=C.recode(flag, rules.FLAG_CATEGORIES),
        keep=keep,
    )


def medical_preprints(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Free-text statements of preprints: presence is the label, a phrase cascade the category."""
    df = C.normalize_na(df)
    text = F.col("data_avail")
    return unify(
        df,
        rules.SOURCE_MEDICAL_PREPRINTS,
        text=text,
        venue=F.col("journal"),
        publication_year=C.year_of_yyyymmdd(F.col("date")),
        has_data_statement=C.yes_if_present(text),
        statement_category=C.phrase_cascade(text, rules.CASCADE_MEDICAL),
        keep=keep,
    )


def coded_journals(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Free-text statements of journals, with their own phrase cascade."""
    df = C.normalize_na(df)
    text = F.col("data_availability")
    return unify(
        df,
        rules.SOURCE_CODED_JOURNALS,
        text=text,
        venue=F.col("journal"),
        publication_year=C.year_of(F.col("pub_date")),
        has_data_statement=C.yes_if_present(text),
        statement_category=C.phrase_cascade(text, rules.CASCADE_JOURNALS),
        keep=keep,
    )


def annotated_only(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.size("annotations") > 0)


def annotation_tasks(tasks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Tasks exported from the annotation tool: the first choice of the first annotation is the label."""
    choice = C.first_choice(F.col("annotations"), "other")
    return unify(
        annotated_only(tasks),
        rules.SOURCE_ANNOTATION_TOOL,
        text=F.coalesce(F.col("data.text"), F.lit("")),
        has_data_statement=C.first_choice(F.col("annotations"), "unknown"),
        statement_category=C.recode(choice, rules.CHOICE_CATEGORIES),
        keep=keep,
    )

"""Schemas of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

UNIFIED_COLUMNS = (
    "source",
    "text",
    "venue",
    "publication_year",
    "has_data_statement",
    "statement_category",
)
UNIFIED = T.StructType([T.StructField(c, T.StringType()) for c in UNIFIED_COLUMNS])

VENUE_RANKING = "source string, venue string, field string, h5_index int, h5_median int"
VENUE_METADATA = (
    "display_name string, alternate_titles array<string>, abbreviated_title string, "
    "ids struct<issn: array<string>>, issn_l string"
)
PAPERS = "corpusid bigint, works_oa struct<host_venue: struct<display_name: string>>, s2orc_parsed boolean"
FULL_TEXT = (
    "corpusid bigint, "
    "content struct<text: string, annotations: struct<paragraph: string, sectionheader: string>>"
)
SPANS = "array<struct<start: string, end: string>>"
PARAGRAPHS = "corpusid bigint, venue string, par_id int, text array<string>"

_RESULT = (
    "array<struct<value: struct<choices: array<string>>, id: string, from_name: string, "
    "to_name: string, type: string, origin: string>>"
)
TASK = (
    "data struct<corpusid: bigint, corpusid_unique: string, par_id: int, wc: int, text: string>, "
    "annotations array<struct<ground_truth: boolean, completed_by: struct<id: bigint, "
    "first_name: string, last_name: string, avatar: string, email: string, initials: string>, "
    f"result: {_RESULT}>>, "
    "predictions array<struct<model_version: string, result: array<struct<id: string, "
    "from_name: string, to_name: string, type: string, value: struct<choices: array<string>>>>>>"
)

OBSERVED_FLAG_COLUMNS = (
    "Title of paper",
    "Article DOI (or URL)",
    "Journal name",
    "Year of publication",
    "Is there an ASDC?",
    "Justification for non-open data?",
    "All data available",
    "At least some data available",
    "All code available",
    "At least some code available",
    "All data available upon request",
    "At least some data available upon request",
    "no data produced",
    "links work",
)


def strings(*names: str) -> T.StructType:
    """A schema of nullable string columns."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


OBSERVED_FLAGS = strings(*OBSERVED_FLAG_COLUMNS)
CODED_STATEMENTS = strings("data_statement", "publication_date.x", "statement_category")
TYPED_STATEMENTS = T.StructType(
    [
        T.StructField("Data availability statement text", T.StringType()),
        T.StructField("Journal title", T.StringType()),
        T.StructField("Statement type (1, 2, 3, 4)", T.DoubleType()),
    ]
)
MEDICAL_PREPRINTS = strings("data_avail", "journal", "date")
CODED_JOURNALS = strings("data_availability", "journal", "pub_date")

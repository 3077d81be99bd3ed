"""Paragraphs cut out of full text by stand-off character spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions.columns import slice_text, tokenize
from corpusloom.operators.ranking import keep_first


def parse_spans(json: Column) -> Column:
    """``array<struct<start,end>>`` from a JSON string whose offsets are numbers or numeric strings."""
    return F.transform(
        F.from_json(json, schemas.SPANS),
        lambda s: F.struct(s["start"].try_cast("int").alias("start"), s["end"].try_cast("int").alias("end")),
    )


def kept_spans(paragraph: Column, sectionheader: Column) -> Column:
    """Paragraph spans that start before some section header starts.

    Without header annotation (null or empty) every paragraph is kept; with an empty list none is.
    The last header start is bound through a one-element array, so it is found once per document
    and not once per paragraph.
    """
    unheaded = F.coalesce(sectionheader == "", F.lit(True))
    last_header = F.array_max(F.transform(parse_spans(sectionheader), lambda h: h["start"]))
    bound = F.array(
        F.struct(parse_spans(paragraph).alias("spans"), last_header.alias("last"), unheaded.alias("all"))
    )
    return F.flatten(
        F.transform(bound, lambda b: F.filter(b["spans"], lambda p: b["all"] | (p["start"] < b["last"])))
    )


def paragraph_texts(text: Column, paragraph: Column, sectionheader: Column) -> Column:
    return F.transform(kept_spans(paragraph, sectionheader), lambda p: slice_text(text, p["start"], p["end"]))


def _flat(full_text: DataFrame, *carry: str) -> DataFrame:
    """The three parts of a document as plain columns, without documents that have no paragraphs."""
    spans = "content.annotations"
    annotated = full_text.where(F.col(f"{spans}.paragraph").isNotNull())
    return annotated.select(
        *carry,
        F.col("content.text").alias("_text"),
        F.col(f"{spans}.paragraph").alias("_spans"),
        F.col(f"{spans}.sectionheader").alias("_headers"),
    )


def _cut(flat: DataFrame, *carry: str) -> DataFrame:
    texts = paragraph_texts(F.col("_text"), F.col("_spans"), F.col("_headers"))
    return flat.select(*carry, F.posexplode(texts).alias("par_id", "paragraph"))


def cut_paragraphs(full_text: DataFrame, *carry: str) -> DataFrame:
    """One row per kept paragraph: the carried columns, ``par_id`` (0-based) and ``paragraph``.

    Texts are cut inside the document's row before it is exploded, so rows do not carry the whole
    document along. Documents without paragraph annotation give no row. There is no shuffle.
    """
    return _cut(_flat(full_text, *carry), *carry)


def extract_paragraphs(mapping: DataFrame, full_text: DataFrame, unique_documents: bool = False) -> DataFrame:
    """Tokenised paragraphs of the mapped papers: ``corpusid, venue, par_id, text``.

    A paper absent from the full texts gives no row; one stored twice is read once. All three steps
    work by ``corpusid``, so full texts are shuffled once, and only those that are mapped.
    """
    wanted = _flat(full_text, "corpusid").join(mapping.select("corpusid").distinct(), "corpusid", "left_semi")
    if not unique_documents:
        wanted = keep_first(wanted, ["corpusid"], [F.xxhash64("_text"), "_text", "_spans", "_headers"])
    joined = mapping.select("corpusid", "venue").join(wanted, "corpusid")
    return _cut(joined, "corpusid", "venue").select(
        "corpusid", "venue", "par_id", tokenize(F.col("paragraph")).alias("text")
    )

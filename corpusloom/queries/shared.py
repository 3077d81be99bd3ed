"""Inputs derived from the test tables, and the SQL that derives the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.columns import tokenize
from corpusloom.operators.assign import annotation, task_data
from corpusloom.operators.harmonize import unify
from corpusloom.queries.registry import Tables

ANNOTATORS = ("ann@example.org", "bob@example.org", "cyd@example.org")

LABEL_SQL = "case when toxic = 1 then 'maybe' when quality = 1 then 'yes' else 'no' end"
CATEGORY_SQL = "case when toxic = 1 then 'uncertain' when quality = 1 then 'has_statement' else 'no_statement' end"
LABELLED_SQL = f"""
    select doc_id, source, lang, text, {LABEL_SQL} as label, {CATEGORY_SQL} as category
    from documents join labels using (doc_id)
"""
BINARY_SQL = f"""
    select doc_id, source, text, label, case label when 'yes' then 1 else 0 end as sentiment_encoded
    from ({LABELLED_SQL}) where label in ('yes', 'no')
"""
COMBINED_SQL = f"""
    select 'documents' as source, text, source as venue, cast(null as varchar) as publication_year,
           label as has_data_statement, category as statement_category, 0 as source_rank, doc_id as row_key
    from ({LABELLED_SQL})
    union all
    select 'benchmark', text, null, null, 'yes', 'has_statement', 1, item_id from benchmark
    union all
    select 'conversations', text, role, null,
           case role when 'user' then 'no' else 'unknown' end,
           case role when 'user' then 'no_statement' else 'other' end, 2, conv_id * 1000000 + turn
    from conversations
"""
UNIFIED_LIST = "source, text, venue, publication_year, has_data_statement, statement_category"


def label() -> Column:
    return F.when(F.col("toxic") == 1, "maybe").when(F.col("quality") == 1, "yes").otherwise("no")


def category() -> Column:
    return (
        F.when(F.col("toxic") == 1, "uncertain").when(F.col("quality") == 1, "has_statement").otherwise("no_statement")
    )


def labelled(t: Tables) -> DataFrame:
    """Documents with an annotator's label."""
    return (
        t.documents.join(t.labels, "doc_id")
        .withColumn("label", label())
        .withColumn("category", category())
        .select("doc_id", "source", "lang", "text", "label", "category")
    )


def branches(t: Tables) -> list[DataFrame]:
    """Three unified sources with an order key."""
    is_user = F.col("role") == "user"
    return [
        unify(
            labelled(t).withColumn("row_key", F.col("doc_id")),
            "documents",
            text=F.col("text"),
            venue=F.col("source"),
            has_data_statement=F.col("label"),
            statement_category=F.col("category"),
            keep=["row_key"],
        ),
        unify(
            t.benchmark.withColumn("row_key", F.col("item_id")),
            "benchmark",
            text=F.col("text"),
            has_data_statement=F.lit("yes"),
            statement_category=F.lit("has_statement"),
            keep=["row_key"],
        ),
        unify(
            t.conversations.withColumn("row_key", F.col("conv_id") * 1000000 + F.col("turn")),
            "conversations",
            text=F.col("text"),
            venue=F.col("role"),
            has_data_statement=F.when(is_user, "no").otherwise("unknown"),
            statement_category=F.when(is_user, "no_statement").otherwise("other"),
            keep=["row_key"],
        ),
    ]


PARAGRAPH_SQL = r"""
    select doc_id as corpusid, source as venue, par_id,
           regexp_extract_all(line, '([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])', 1) as tokens
    from (select doc_id, source, unnest(string_split(text, chr(10))) as line,
                 cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as int) as par_id
          from documents)
"""


def paragraphs(t: Tables) -> DataFrame:
    """Lines of the documents as tokenised paragraphs."""
    lines = t.wide("documents", "doc_id", "source", "text").select(
        F.col("doc_id").alias("corpusid"), F.col("source").alias("venue"), F.posexplode(F.split("text", "\n"))
    )
    return lines.select("corpusid", "venue", F.col("pos").alias("par_id"), tokenize(F.col("col")).alias("text"))


def tasks(t: Tables) -> DataFrame:
    """Labelled documents as annotation tasks. The unclear ones come without a choice."""
    rows = labelled(t).select(
        "doc_id",
        F.col("doc_id").alias("corpusid"),
        F.concat_ws("_", "doc_id", F.lit("0")).alias("corpusid_unique"),
        F.lit(0).alias("par_id"),
        F.size(F.split("text", " ")).alias("wc"),
        "text",
        "label",
    )
    who = F.struct(
        F.lit(1).cast("bigint").alias("id"),
        F.lit("").alias("first_name"),
        F.lit("").alias("last_name"),
        F.lit(None).cast("string").alias("avatar"),
        F.lit(ANNOTATORS[0]).alias("email"),
        F.lit(ANNOTATORS[0][:2]).alias("initials"),
    )
    chosen = F.when(F.col("label") == "maybe", F.array().cast("array<string>")).otherwise(F.array("label"))
    return rows.select("doc_id", "label", task_data(), annotation(who, chosen))


def phrase_sql(phrases: tuple[str | None, ...], key: str) -> str:
    listed = ", ".join("null" if p is None else f"'{p}'" for p in phrases)
    return f"[{listed}][{key} % {len(phrases)} + 1]"


def nth_phrase(phrases: tuple[str | None, ...], key: str) -> Column:
    """One of the phrases, going round with the key; the documents themselves hold none of them."""
    listed = F.array(*[F.lit(p).cast("string") for p in phrases])
    return F.get(listed, (F.col(key) % len(phrases)).cast("int"))

"""Queries on recoding, cascades, dates, task records and annotator statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import columns as C
from corpusloom.operators import harmonize, rounds, stats
from corpusloom.operators.assign import predicted, predictions, task_json
from corpusloom.operators.predict import predict_labels
from corpusloom.queries.registry import Tables, query
from corpusloom.queries.shared import (
    LABELLED_SQL,
    labelled,
    nth_phrase,
    phrase_sql,
    tasks,
)

_CODES = {
    "1-URGENT": "in paper and si",
    "2-HIGH": "repository",
    "3-MEDIUM": "access restricted",
    "4-NOT SPECIFIED": "not coded yet",
}


@query(
    "q_harmonize_codes",
    f"""
    select 'federer_data_2018' as source, o_orderpriority || ' ' || o_orderkey as text, cast(null as varchar) as venue,
           cast(year(o_orderdate) as varchar) as publication_year,
           case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'yes' else 'no' end
               as has_data_statement,
           case o_orderpriority when '1-URGENT' then 'available_paper_si' when '2-HIGH' then 'available_repository'
               when '3-MEDIUM' then 'restricted' else 'other' end as statement_category
    from orders
    """,
)
def harmonize_codes(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("data_statement"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("publication_date.x"),
        C.lookup(F.col("o_orderpriority"), _CODES).alias("statement_category"),
    )
    return harmonize.coded_statements(raw)


@query(
    "q_harmonize_types",
    """
    select 'grant_impact_2018' as source, p_name as text, p_brand as venue, cast(null as varchar) as publication_year,
           'yes' as has_data_statement,
           case p_size % 6 when 1 then 'upon_request' when 2 then 'available_paper_si'
               when 3 then 'available_repository' when 4 then 'available_paper_si' else 'other' end
               as statement_category
    from part
    """,
)
def harmonize_types(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_name").alias("Data availability statement text"),
        F.col("p_brand").alias("Journal title"),
        (F.col("p_size") % 6).cast("double").alias("Statement type (1, 2, 3, 4)"),
    )
    return harmonize.typed_statements(raw)


def _observed(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderpriority").alias("Journal name"),
        F.date_format("o_orderdate", "yyyy").alias("Year of publication"),
        C.lookup(F.col("o_orderstatus"), {"F": "yes", "O": "no", "P": "Yes"}).alias("Is there an ASDC?"),
    )
    return harmonize.observed_flags(raw)


@query(
    "q_harmonize_flags",
    """
    select 'jones_observed_2025' as source, cast(null as varchar) as text, o_orderpriority as venue,
           cast(year(o_orderdate) as varchar) as publication_year,
           case o_orderstatus when 'F' then 'yes' when 'O' then 'no' else 'unknown' end as has_data_statement,
           case o_orderstatus when 'F' then 'has_statement' when 'O' then 'no_statement' else 'other' end
               as statement_category
    from orders
    """,
)
def harmonize_flags(t: Tables) -> DataFrame:
    return _observed(t)


_MEDICAL = (
    "Data are available UPON REQUEST.",
    "On reasonable request; see the supplementary files.",
    "See the Supplementary files.",
    "All data are included within this work.",
    "Deposited in a public repository.",
    "Data are not publicly available.",
    "Not applicable.",
    "Data not available.",
    "There are no empirical data.",
    "",
    None,
    "NA",
)
_JOURNALS = (
    "All data are within the paper; the rest on request.",
    "Within the Manuscript.",
    "See Supporting Information.",
    "Data are publicly available.",
    "See our WEBPAGES.",
    "Data upon request.",
    "Ask on request.",
    "Data cannot be shared.",
    "Data are not available.",
    "",
    None,
    "NULL",
)


def _statement(phrases: tuple[str | None, ...]):
    phrase = nth_phrase(phrases, "doc_id")
    return F.when(phrase.isin("NA", "NULL"), phrase).otherwise(F.concat("text", F.lit(" "), phrase))


_STATEMENTS_SQL = """
    with raw as (select *, {phrase} as phrase, strftime(timestamp '2015-01-31' + to_days(cast(doc_id % 3000 as int)),
                        '{fmt}') as day from documents),
         s as (select *, case when phrase in ('NA', 'NULL') then null else text || ' ' || phrase end as t from raw)
    select '{source}' as source, t as text, lang as venue, day[{year}] as publication_year,
           case when t is not null then 'yes' else 'no' end as has_data_statement,
           {cascade} as statement_category
    from s
"""


@query(
    "q_cascade_a",
    _STATEMENTS_SQL.format(
        phrase=phrase_sql(_MEDICAL, "doc_id"),
        fmt="%Y%m%d",
        year="1:4",
        source="mcguinness_descriptive_2021",
        cascade="""
        case when t is null then 'no_statement'
             when contains(lower(t), 'upon request') or contains(lower(t), 'on reasonable request') then 'upon_request'
             when contains(lower(t), 'supplementary') or contains(lower(t), 'within the article')
                  or contains(lower(t), 'included within') then 'available_paper_si'
             when contains(lower(t), 'repository') or contains(lower(t), 'publicly available')
                  or contains(lower(t), 'public domain') then 'available_repository'
             when contains(lower(t), 'not applicable') then 'not_applicable'
             when contains(lower(t), 'not available') or contains(lower(t), 'no empirical data') then 'not_available'
             else 'other' end""",
    ),
)
def cascade_a(t: Tables) -> DataFrame:
    day = F.date_add(F.lit("2015-01-31").cast("date"), (F.col("doc_id") % 3000).cast("int"))
    raw = t.documents.select(
        _statement(_MEDICAL).alias("data_avail"),
        F.col("lang").alias("journal"),
        F.date_format(day, "yyyyMMdd").alias("date"),
    )
    return harmonize.medical_preprints(raw)


@query(
    "q_cascade_b",
    _STATEMENTS_SQL.format(
        phrase=phrase_sql(_JOURNALS, "doc_id"),
        fmt="%Y-%m-%d",
        year="1:4",
        source="karcher_replication_2025",
        cascade="""
        case when t is null then 'no_statement'
             when contains(lower(t), 'within the paper') or contains(lower(t), 'within the manuscript')
                  or contains(lower(t), 'supporting information') then 'available_paper_si'
             when contains(lower(t), 'publicly available') or contains(lower(t), 'repository')
                  or contains(lower(t), 'webpages') then 'available_repository'
             when contains(lower(t), 'upon request') or contains(lower(t), 'on request') then 'upon_request'
             when contains(lower(t), 'cannot be shared') or contains(lower(t), 'not available') then 'not_available'
             else 'other' end""",
    ),
)
def cascade_b(t: Tables) -> DataFrame:
    day = F.date_add(F.lit("2015-01-31").cast("date"), (F.col("doc_id") % 3000).cast("int"))
    raw = t.documents.select(
        _statement(_JOURNALS).alias("data_availability"),
        F.col("lang").alias("journal"),
        F.date_format(day, "yyyy-MM-dd").alias("pub_date"),
    )
    return harmonize.coded_journals(raw)


@query(
    "q_branch_stats",
    """
    select count(*) as total_rows, count(*) filter (where o_orderstatus = 'F') as has_data_statement_count,
           round(100 * count(*) filter (where o_orderstatus = 'F') / count(*), 1) as has_data_statement_percentage
    from orders
    """,
)
def branch_stats(t: Tables) -> DataFrame:
    return stats.branch_stats(_observed(t))


_TOKENS = ("NA", "N/A", "none", "None", "nan", "", "NULL", " NA", "kept")


@query(
    "q_na_tokens",
    f"""
    with raw as (select doc_id, {phrase_sql(_TOKENS, "doc_id")} as cell from documents)
    select doc_id, case when cell in ('NA', 'N/A', 'None', 'nan', '', 'NULL') then null else cell end as cell from raw
    """,
)
def na_tokens(t: Tables) -> DataFrame:
    return C.normalize_na(t.documents.select("doc_id", nth_phrase(_TOKENS, "doc_id").alias("cell")))


@query(
    "q_year",
    """
    select o_orderkey, cast(year(o_orderdate) as int) as year_iso, cast(year(o_orderdate) as int) as year_us,
           cast(year(o_orderdate) as int) as year_compact, cast(null as int) as year_bad
    from orders
    """,
)
def year(t: Tables) -> DataFrame:
    written = {"iso": "yyyy-MM-dd", "us": "M/d/yyyy", "compact": "yyyyMMdd"}
    dates = t.orders.select("o_orderkey", *[F.date_format("o_orderdate", f).alias(n) for n, f in written.items()])
    return dates.select(
        "o_orderkey",
        C.year_of(F.col("iso")).alias("year_iso"),
        C.year_of(F.col("us")).alias("year_us"),
        C.year_of_yyyymmdd(F.col("compact").cast("int")).alias("year_compact"),
        C.year_of(F.concat(F.lit("on "), "iso")).alias("year_bad"),
    )


@query(
    "q_recode_keep",
    """
    select c_custkey, case c_mktsegment when 'BUILDING' then 'construction' when 'MACHINERY' then 'machines'
                      else lower(c_mktsegment) end as segment,
           case c_mktsegment when 'BUILDING' then 'construction' when 'MACHINERY' then 'machines' else 'other' end
               as coarse
    from customer
    """,
)
def recode_keep(t: Tables) -> DataFrame:
    names = {"BUILDING": "Construction", "MACHINERY": "Machines"}
    return t.customer.select(
        "c_custkey",
        F.lower(C.recode_or_keep(F.col("c_mktsegment"), names)).alias("segment"),
        F.lower(C.recode(F.col("c_mktsegment"), names)).alias("coarse"),
    )


@query(
    "q_task_json_roundtrip",
    f"""
    select 'label_studio' as source, text, cast(null as varchar) as venue, cast(null as varchar) as publication_year,
           case label when 'maybe' then 'unknown' else label end as has_data_statement,
           case label when 'yes' then 'has_statement' when 'no' then 'no_statement' else 'other' end
               as statement_category
    from ({LABELLED_SQL})
    """,
)
def task_json_roundtrip(t: Tables) -> DataFrame:
    none = F.lit(None).cast("array<string>")
    written = tasks(t).select(task_json(F.col("data"), F.col("annotations"), none).alias("json"))
    read = written.select(F.from_json("json", schemas.TASK).alias("task")).select("task.*")
    return harmonize.annotation_tasks(read)


@query(
    "q_prediction_filter",
    f"""
    select doc_id, label from ({LABELLED_SQL}) where label = 'yes'
    """,
)
def prediction_filter(t: Tables) -> DataFrame:
    first = predictions(F.lit("no"), "first", F.col("doc_id"))
    second = predictions(F.col("label"), "second", F.col("doc_id"))
    both = tasks(t).select("doc_id", "label", F.concat(first, second).alias("predictions"))
    return predicted(both, 1, "yes").select("doc_id", "label")


@query(
    "q_onehot",
    """
    select doc_id, case when toxic = 1 then 'maybe' when quality = 0 then 'no' else 'yes' end as label from labels
    """,
)
def onehot(t: Tables) -> DataFrame:
    flags = t.labels.select(
        "doc_id", F.col("quality").alias("yes"), (1 - F.col("quality")).alias("no"), F.col("toxic").alias("maybe")
    )
    label = C.one_hot_label(F.col("yes"), F.col("no"), F.col("maybe"))
    return flags.select("doc_id", label.alias("label"))


_CODE_SQL = "1 + (1 - quality) + 2 * toxic"


@query(
    "q_code_labels",
    f"""
    select doc_id, case {_CODE_SQL} when 1 then 'yes' when 2 then 'no' when 3 then 'maybe' else '4.0' end as label
    from labels
    """,
)
def code_labels(t: Tables) -> DataFrame:
    code = (1 + (1 - F.col("quality")) + 2 * F.col("toxic")).cast("double")
    return t.labels.select("doc_id", rounds.code_label(code).alias("label"))


@query(
    "q_merge_rounds",
    f"""
    with l as ({LABELLED_SQL})
    select annotator, sentiment, count(*) as n from (
        select 'text' as annotator, label as sentiment from l
        union all select 'tasks', label from l where label <> 'maybe'
        union all select 'flags', label from l
        union all select 'codes', label from l
    ) group by all
    """,
)
def merge_rounds(t: Tables) -> DataFrame:
    rows = labelled(t).select(F.col("doc_id").alias("corpusid"), "text", "label")
    label = F.col("label")
    old = F.when(label == "yes", "data availability statement").when(label == "no", "Not").otherwise("Maybe")
    parts = [
        rounds.from_text_labels(rows.withColumn("sentiment", old), "text"),
        rounds.from_tasks(tasks(t), "tasks").where(F.col("sentiment").isNotNull()),
        rounds.from_flags(
            rows.select("*", *[(label == v).cast("int").alias(v.capitalize()) for v in ("yes", "no", "maybe")]),
            "flags",
        ),
        rounds.from_codes(
            rows.withColumn(
                "is_data_availability", F.when(label == "yes", 1.0).when(label == "no", 2.0).otherwise(3.0)
            ),
            "codes",
        ),
    ]
    return rounds.merge_rounds(*parts).groupBy("annotator", "sentiment").agg(F.count(F.lit(1)).alias("n"))


def _labelled_events(t: Tables) -> DataFrame:
    """Events as annotations: five annotators, three labels."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("value"),
        (F.col("user_id") % 5).alias("annotator"),
        F.when(kind.isin("view", "click"), "yes").when(kind.isin("purchase", "signup"), "no").otherwise("maybe").alias(
            "sentiment"
        ),
    )


_EVENTS_SQL = """
    select user_id % 5 as annotator, case when event_type in ('view', 'click') then 'yes'
           when event_type in ('purchase', 'signup') then 'no' else 'maybe' end as sentiment from events
"""


@query(
    "q_annotator_props",
    f"""
    select annotator, count(*) as n_labelled,
           count(*) filter (where sentiment = 'yes') as n_yes, count(*) filter (where sentiment = 'no') as n_no,
           count(*) filter (where sentiment = 'maybe') as n_maybe,
           round(100 * count(*) filter (where sentiment = 'yes') / count(*), 2) as yes_pct,
           round(100 * count(*) filter (where sentiment = 'no') / count(*), 2) as no_pct,
           round(100 * count(*) filter (where sentiment = 'maybe') / count(*), 2) as maybe_pct
    from ({_EVENTS_SQL}) group by annotator
    """,
)
def annotator_props(t: Tables) -> DataFrame:
    return stats.label_shares(_labelled_events(t))


@query(
    "q_label_totals",
    f"""
    select count(*) as total_labelled, count(*) filter (where sentiment = 'yes') as tot_yes,
           count(*) filter (where sentiment = 'no') as tot_no, count(*) filter (where sentiment = 'maybe') as tot_maybe
    from ({_EVENTS_SQL})
    """,
)
def label_totals(t: Tables) -> DataFrame:
    return stats.label_totals(_labelled_events(t))


_VOTES_SQL = """
    select user_id as item, extract(day from ts) % 5 as annotator,
           case when event_type in ('view', 'click') then 1 else 0 end as vote from events
"""
_SCORED_SQL = f"""
    select item, count(*) as n_annotators, round(avg(v), 6) as score,
           case when round(avg(v), 6) <= 0.3 or round(avg(v), 6) >= 0.7 then 1 else 0 end as clear,
           case when min(lo) = max(hi) then 1 else 0 end as unanimous
    from (select item, annotator, avg(vote) as v, min(vote) as lo, max(vote) as hi
          from ({_VOTES_SQL}) group by item, annotator) group by item
"""


def _scored(t: Tables) -> DataFrame:
    votes = t.events.select(
        F.col("user_id").alias("item"),
        (F.dayofmonth("ts") % 5).alias("annotator"),
        F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0).alias("vote"),
    )
    return stats.consensus(votes, "item", "annotator", "vote", 0.3, 0.7)


@query("q_votes", _SCORED_SQL)
def votes(t: Tables) -> DataFrame:
    return _scored(t)


@query(
    "q_consensus_count",
    f"select count(*) as n_items, count(*) filter (where unanimous = 1) as n_unanimous from ({_SCORED_SQL})",
)
def consensus_count(t: Tables) -> DataFrame:
    return stats.consensus_count(_scored(t))


@query(
    "q_predict",
    f"""
    with raw as (select doc_id, {phrase_sql(_MEDICAL, "doc_id")} as phrase, text from documents),
         s as (select doc_id, lower(case when phrase in ('NA', 'NULL') then phrase else text || ' ' || phrase end) as t
               from raw)
    select doc_id, case
        when contains(t, 'upon request') or contains(t, 'on reasonable request') or contains(t, 'supplementary')
             or contains(t, 'within the article') or contains(t, 'included within') or contains(t, 'repository')
             or contains(t, 'publicly available') or contains(t, 'public domain') then 'yes'
        when t is null or contains(t, 'not applicable') or contains(t, 'not available')
             or contains(t, 'no empirical data') then 'no'
        else 'maybe' end as prediction
    from s
    """,
)
def predict(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", _statement(_MEDICAL).alias("text"))
    return predict_labels(rows).select("doc_id", "prediction")


def _load_length_model():
    def label(texts):
        return ["yes" if len(x) < 1500 else "no" if len(x) < 6000 else "unsure" for x in texts]

    return label


@query(
    "q_predict_model",
    """
    select doc_id, case when length(text) < 1500 then 'yes' when length(text) < 6000 then 'no' end as prediction
    from documents
    """,
)
def predict_model(t: Tables) -> DataFrame:
    """A model function over batches; answers outside the label set become null."""
    return predict_labels(t.wide("documents", "doc_id", "text"), _load_length_model).select("doc_id", "prediction")


@query(
    "q_build_tasks",
    f"""
    select doc_id, label, doc_id || '_0' as corpusid_unique, len(string_split(text, ' ')) as wc, 'an' as initials,
           case label when 'maybe' then 0 else 1 end as n_choices from ({LABELLED_SQL})
    """,
)
def build_tasks(t: Tables) -> DataFrame:
    made = tasks(t)
    entry = F.get("annotations", F.lit(0))
    choices = F.get(entry["result"], F.lit(0))["value"]["choices"]
    return made.select(
        "doc_id",
        "label",
        "data.corpusid_unique",
        F.col("data.wc").cast("bigint").alias("wc"),
        entry["completed_by"]["initials"].alias("initials"),
        F.size(choices).alias("n_choices"),
    )

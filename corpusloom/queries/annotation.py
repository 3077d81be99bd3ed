"""Queries on sampling and assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import assign, ranking, sampling
from corpusloom.operators.predict import predict_labels
from corpusloom.queries.registry import Tables, query
from corpusloom.queries.shared import ANNOTATORS, PARAGRAPH_SQL, paragraphs

KEYWORDS = ("the", "and")
PER_VENUE = 20
QUOTA = 40


@query(
    "q_eligible_venues",
    f"""
    select venue, count(*) as n from ({PARAGRAPH_SQL}) where list_has_any(tokens, ['the', 'and'])
    group by venue having count(*) > 30
    """,
)
def eligible(t: Tables) -> DataFrame:
    return sampling.eligible_venues(paragraphs(t), KEYWORDS, 30)


@query(
    "q_stratified_head",
    """
    select doc_id, source from (
        select *, row_number() over (partition by source order by md5('42|' || doc_id), doc_id) as rn from documents)
    where rn <= 10
    """,
)
def stratified_head(t: Tables) -> DataFrame:
    return ranking.shuffled_head(t.documents.select("doc_id", "source"), ["source"], "doc_id", 10)


@query(
    "q_stratified_head_large",
    """
    select l_orderkey, l_linenumber, l_returnflag from (
        select *, row_number() over (partition by l_returnflag
                  order by md5('42|' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey),
                  l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey) as rn from lineitem)
    where rn <= 1500
    """,
)
def stratified_head_large(t: Tables) -> DataFrame:
    """Few groups and many rows per group, beyond what Spark prunes by itself."""
    key = F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", key.alias("key"))
    return ranking.shuffled_head(rows, ["l_returnflag"], "key", 1500).drop("key")


_BATCH_SQL = """
    with hits as (select *, corpusid || '_' || par_id as k from ({paragraphs})
                  where list_has_any(tokens, ['the', 'and'])),
         big as (select venue from hits group by venue having count(*) > {overshoot}),
         pool as (select * from hits where venue in (select venue from big) {before}),
         s as (select *, row_number() over (partition by venue order by md5('42|sample|' || k), k) as rn from pool),
         f as (select * from s where rn <= {overshoot} {after}),
         h as (select *, row_number() over (partition by venue order by md5('42|' || k), k) as rn2,
                      array_to_string(tokens, ' ') as joined from f)
    select corpusid, k as corpusid_unique, venue, par_id, cast(len(string_split(joined, ' ')) as int) as wc,
           joined as text
    from h where rn2 <= {head} and len(string_split(joined, ' ')) > 5 and len(string_split(joined, ' ')) < 1000
"""
_DONE = "and corpusid not in (select doc_id from labels)"


def _batch_sql(before: str, after: str) -> str:
    return _BATCH_SQL.format(
        paragraphs=PARAGRAPH_SQL, before=before, after=after, overshoot=2 * PER_VENUE, head=PER_VENUE
    )


def _batch(t: Tables, exclude_first: bool) -> DataFrame:
    done = t.labels.select(F.col("doc_id").alias("corpusid"))
    return sampling.annotation_batch(
        paragraphs(t), done, KEYWORDS, per_venue=PER_VENUE, exclude_first=exclude_first
    )


@query("q_batch_builder", _batch_sql(_DONE, ""))
def batch_builder(t: Tables) -> DataFrame:
    return _batch(t, True)


@query("q_batch_builder_late", _batch_sql("", _DONE))
def batch_builder_late(t: Tables) -> DataFrame:
    """Sampling first and dropping the done rows afterwards."""
    return _batch(t, False)


@query(
    "q_batch_overlap",
    f"""
    select count(*) as n_shared from (select distinct corpusid from ({_batch_sql(_DONE, "")})
    where corpusid in (select doc_id from labels))
    """,
)
def batch_overlap(t: Tables) -> DataFrame:
    return sampling.overlap_count(_batch(t, True), t.labels.select(F.col("doc_id").alias("corpusid")))


_FOUR = (*ANNOTATORS, "fourth")
_FOUR_SQL = "['" + "', '".join(_FOUR) + "']"
_NAMES_SQL = "['" + "', '".join(ANNOTATORS) + "']"
_ASSIGN_SQL = f"""
    select doc_id, source, {_NAMES_SQL}[cast(floor((r - 1) / {QUOTA}.0) as int) + 1] as annotator
    from (select *, row_number() over (order by md5('42|' || doc_id)) as r from documents)
    where r <= {QUOTA * len(ANNOTATORS)}
"""


def assigned(t: Tables) -> DataFrame:
    return assign.assign(t.documents.select("doc_id", "source"), "doc_id", ANNOTATORS, QUOTA)


@query("q_assign", _ASSIGN_SQL)
def assignment(t: Tables) -> DataFrame:
    return assigned(t)


@query(
    "q_remaining",
    f"select source, count(*) as n from documents where doc_id not in (select doc_id from ({_ASSIGN_SQL})) group by all",
)
def remaining(t: Tables) -> DataFrame:
    left = assign.remaining(t.documents.select("doc_id", "source"), assigned(t), "doc_id")
    return left.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_overlap",
    f"""
    with a as ({_ASSIGN_SQL}),
         o as (select a.doc_id, a.source, a.annotator as owner, r.name as receiver,
                      row_number() over (partition by a.annotator, r.name
                          order by md5('overlap|' || r.name || '|' || a.doc_id), a.doc_id) as rn
               from a join (select unnest({_NAMES_SQL}) as name) r on r.name <> a.annotator)
    select doc_id, source, annotator, annotator as owner from a
    union all select doc_id, source, receiver, owner from o where rn <= 15
    """,
)
def overlap(t: Tables) -> DataFrame:
    return assign.with_overlap(assigned(t), "doc_id", ANNOTATORS)


@query(
    "q_draws",
    """
    with r as (select doc_id, source, row_number() over (order by md5('42|' || doc_id)) as rank from documents),
         d as (select distinct ('0x' || substr(md5('42|draw|' || i), 1, 15))::bigint
                      % (select count(*) from documents) + 1 as rank from range(300) as x(i))
    select doc_id, source from r where rank in (select rank from d)
    """,
)
def draws(t: Tables) -> DataFrame:
    return ranking.draw_with_replacement(t.documents.select("doc_id", "source"), "doc_id", 300)


@query(
    "q_take_exact",
    """
    select doc_id from (select doc_id, row_number() over (order by md5('42|' || doc_id)) as r from documents)
    where r <= 150
    """,
)
def take_exact(t: Tables) -> DataFrame:
    return ranking.take_shuffled(t.documents.select("doc_id"), "doc_id", 150)


@query(
    "q_shuffled_rank",
    "select o_orderkey, row_number() over (order by md5('42|' || o_orderkey)) as rank from orders",
)
def shuffled_rank(t: Tables) -> DataFrame:
    return ranking.shuffled_rank(t.orders.select("o_orderkey"), "o_orderkey")


def _tasks(t: Tables) -> DataFrame:
    rows = assigned(t).join(t.documents.select("doc_id", "text"), "doc_id")
    keyed = predict_labels(rows).select(
        "annotator",
        F.col("doc_id").alias("corpusid"),
        F.concat_ws("_", "doc_id", F.lit("0")).alias("corpusid_unique"),
        F.lit(0).alias("par_id"),
        F.size(F.split("text", " ")).alias("wc"),
        "text",
        "prediction",
    )
    ids = t.spark.createDataFrame(list(zip(ANNOTATORS, range(1, 4))), "annotator string, annotator_id bigint")
    return assign.build_tasks(keyed, ids, "prediction")


@query(
    "q_dispatch_report",
    f"""
    select annotator, count(*) as annotations_sent, count(*) as predictions_generated
    from ({_ASSIGN_SQL}) group by annotator
    """,
)
def dispatch_report(t: Tables) -> DataFrame:
    return assign.dispatch_report(_tasks(t))


@query(
    "q_dispatch_all_annotators",
    f"""
    select a.annotator, count(s.annotator) as annotations_sent, count(s.annotator) as predictions_generated
    from (select unnest([{", ".join(f"'{name}'" for name in (*ANNOTATORS, "spare"))}]) as annotator) a
    left join ({_ASSIGN_SQL}) s on a.annotator = s.annotator group by a.annotator
    """,
)
def dispatch_all_annotators(t: Tables) -> DataFrame:
    known = t.spark.createDataFrame([(name,) for name in (*ANNOTATORS, "spare")], "annotator string")
    return assign.dispatch_report(_tasks(t), known)


@query(
    "q_dispatch_totals",
    f"""
    select count(*) as total_dispatched, count(distinct annotator) as n_annotators, count(*) as predictions_generated,
           (select count(*) from documents where doc_id not in (select doc_id from ({_ASSIGN_SQL}))) as remaining
    from ({_ASSIGN_SQL})
    """,
)
def dispatch_totals(t: Tables) -> DataFrame:
    pool = t.documents.select(F.concat_ws("_", "doc_id", F.lit("0")).alias("corpusid_unique"))
    return assign.dispatch_totals(_tasks(t), pool)


_QUADRANT_SQL = """
    select *, case when x > 0 and y > 0 then 0 when x <= 0 and y > 0 then 1 when x <= 0 and y <= 0 then 2 else 3 end
              as quadrant
    from (select p_partkey, p_size - avg(p_size) over () as x, p_retailprice - avg(p_retailprice) over () as y
          from part)
"""


def _layout(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"))


@query(
    "q_quadrant",
    f"select p_partkey, round(x, 4) as x_centered, round(y, 4) as y_centered, quadrant from ({_QUADRANT_SQL})",
)
def quadrant(t: Tables) -> DataFrame:
    placed = assign.with_quadrant(_layout(t))
    rounded = [F.round(c, 4).alias(c) for c in ("x_centered", "y_centered")]
    return placed.select("p_partkey", *rounded, "quadrant")


@query(
    "q_quadrant_assign",
    f"""
    with p as (select *, row_number() over (partition by quadrant order by md5('42|' || quadrant || '|' || p_partkey))
                         as rank, count(*) over (partition by quadrant) as n from ({_QUADRANT_SQL})),
         d as (select distinct q.quadrant, ('0x' || substr(md5('42|' || q.quadrant || '|draw|' || i), 1, 15))::bigint
                      % q.n + 1 as rank
               from (select distinct quadrant, n from p) q, range(50) as x(i))
    select p_partkey, quadrant, {_FOUR_SQL}[quadrant + 1] as annotator from p join d using (quadrant, rank)
    """,
)
def quadrant_assign(t: Tables) -> DataFrame:
    return assign.assign_quadrants(_layout(t), "p_partkey", _FOUR, 50).select(
        "p_partkey", "quadrant", "annotator"
    )

"""Queries on the combined corpus: union, statistics, cleaning, splits, card, filters, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import columns as C
from corpusloom.operators import bayes, combine, dedup, sampling, stats, training
from corpusloom.operators.ranking import keep_first
from corpusloom.queries.registry import Tables, query
from corpusloom.queries.shared import BINARY_SQL, COMBINED_SQL, UNIFIED_LIST, branches, labelled
from corpusloom.sinks.tables import card_lines
from corpusloom.sources.tables import latest_snapshot


def combined(t: Tables) -> DataFrame:
    return combine.combine(*branches(t))


@query("q_combine", f"select {UNIFIED_LIST}, source_rank, row_key from ({COMBINED_SQL})")
def union(t: Tables) -> DataFrame:
    return combined(t)


_STATS_SQL = """
    select source, count(*) as row_count, count(*) filter (where has_data_statement = 'yes') as has_statement_count,
           count(distinct statement_category) as unique_categories,
           round(100 * count(*) filter (where has_data_statement = 'yes') / count(*), 1) as has_statement_percentage
    from ({rows}) group by source order by source
"""


@query("q_stats", _STATS_SQL.format(rows=COMBINED_SQL))
def source_stats(t: Tables) -> DataFrame:
    return stats.source_stats(combined(t))


@query(
    "q_stats_global",
    f"""
    select count(*) as total_rows, count(*) filter (where has_data_statement = 'yes') as total_has_statement_count,
           count(distinct source) as source_count,
           round(100 * count(*) filter (where has_data_statement = 'yes') / count(*), 1)
               as total_has_statement_percentage
    from ({COMBINED_SQL})
    """,
)
def total_stats(t: Tables) -> DataFrame:
    return stats.total_stats(combined(t))


@query(
    "q_value_counts",
    f"select statement_category, count(*) as count from ({COMBINED_SQL}) group by all order by count desc, 1",
)
def value_counts(t: Tables) -> DataFrame:
    return stats.value_counts(combined(t), "statement_category")


_CLEAN_SQL = f"""
    select * from (
        select *, row_number() over (partition by text order by source_rank, row_key) as rn
        from ({COMBINED_SQL}) where text is not null and has_data_statement in ('yes', 'no')) where rn = 1
"""


def _clean(t: Tables) -> DataFrame:
    rows = dedup.binary_only(dedup.labelled_texts(combined(t)))
    return dedup.exact_dedup(rows, ["source_rank", "row_key"])


@query("q_clean_corpus", f"select {UNIFIED_LIST}, has_data_statement as sentiment from ({_CLEAN_SQL})")
def clean_corpus(t: Tables) -> DataFrame:
    return _clean(t).drop("source_rank", "row_key")


@query("clean_corpus_stats", _STATS_SQL.format(rows=_CLEAN_SQL))
def clean_corpus_stats(t: Tables) -> DataFrame:
    return stats.source_stats(_clean(t))


@query(
    "q_dedup_funnel",
    f"""
    with c as (select * from ({COMBINED_SQL}) where text is not null and has_data_statement is not null),
         n as (select count(*) as original_count,
                      count(*) filter (where has_data_statement in ('yes', 'no')) as cleaned_count,
                      count(distinct case when has_data_statement in ('yes', 'no') then text end)
                          as exact_dedup_count from c)
    select *, exact_dedup_count as final_count, cleaned_count - exact_dedup_count as exact_duplicates_removed,
           0::bigint as semantic_duplicates_removed, original_count - exact_dedup_count as total_removed,
           round(100 * (original_count - exact_dedup_count) / original_count, 2) as removal_percentage
    from n
    """,
)
def dedup_funnel(t: Tables) -> DataFrame:
    """The funnel with semantic de-duplication switched off."""
    return dedup.deduplicate(combined(t), ["source_rank", "row_key"], enabled=False).stats


_SPLIT_SQL = f"""
    select *, case when row_number() over (order by md5('42|' || doc_id)) <= ceil(0.2::double * count(*) over ())
              then 'test' else 'train' end as split from ({BINARY_SQL})
"""


def binary_rows(t: Tables) -> DataFrame:
    rows = labelled(t).withColumnRenamed("label", "has_data_statement")
    return dedup.binary_only(rows).select("doc_id", "source", "text", "has_data_statement", "sentiment")


def split_rows(t: Tables) -> DataFrame:
    return training.training_rows(binary_rows(t), "doc_id")


@query("q_split", f"select doc_id, split, sentiment_encoded from ({_SPLIT_SQL})")
def split(t: Tables) -> DataFrame:
    return split_rows(t).select("doc_id", "split", "sentiment_encoded")


@query(
    "q_split_by_hash",
    """
    select doc_id, case when ('0x' || substr(md5('42|' || doc_id), 1, 8))::bigint / 4294967296.0::double < 0.2
                   then 'test' else 'train' end as split from documents
    """,
)
def split_by_hash(t: Tables) -> DataFrame:
    return sampling.split_by_hash(t.documents.select("doc_id"), "doc_id")


_BALANCE_SQL = f"""
    select split, count(*) as samples, cast(sum(sentiment_encoded) as bigint) as positive,
           count(*) - cast(sum(sentiment_encoded) as bigint) as negative,
           round(sum(sentiment_encoded) / count(*), 3) as balance_ratio
    from ({_SPLIT_SQL}) group by split
"""


@query("q_balance", _BALANCE_SQL)
def balance(t: Tables) -> DataFrame:
    return stats.split_balance(split_rows(t))


@query(
    "q_training_rows",
    f"""
    select split, '<|im_start|>system
{rules.SYSTEM_MESSAGE}<|im_end|>
<|im_start|>user
{rules.INSTRUCTION.replace("'", "''")}

Text: ' || text || '<|im_end|>
<|im_start|>assistant
' || label || '<|im_end|>' as text from ({_SPLIT_SQL})
    """,
)
def training_text(t: Tables) -> DataFrame:
    return training.formatted(split_rows(t), "qwen")


@query(
    "q_dataset_card",
    f"""
    with b as ({_BALANCE_SQL}),
         s as (select source, count(*) as n from ({BINARY_SQL}) group by source)
    select 'info' as section, 0::bigint as position,
           format('- **Total samples**: {{:,}}', cast(sum(samples) as bigint)) as line from b
    union all
    select 'info', case split when 'train' then 1 else 2 end,
           format('- **{{}} samples**: {{:,}}', upper(split[1]) || split[2:], samples) from b
    union all
    select 'info', case split when 'train' then 3 else 4 end,
           format('- **{{}} positive ratio**: {{:.3f}}', upper(split[1]) || split[2:], balance_ratio) from b
    union all
    select 'sources', -n, format('- **{{}}**: {{:,}} samples', source, n) from s
    """,
)
def dataset_card(t: Tables) -> DataFrame:
    rows = split_rows(t)
    return card_lines(stats.split_balance(rows), stats.value_counts(rows, "source"))


@query(
    "q_latest_snapshot",
    """
    with s as (select *, strftime(ts, '%Y%m%d') as snapshot from events)
    select event_id, snapshot from s where snapshot = (select max(snapshot) from s)
    """,
)
def snapshot(t: Tables) -> DataFrame:
    return latest_snapshot(t.events.select("event_id", C.day_stamp(F.col("ts")).alias("snapshot")))


@query(
    "q_keep_first",
    """
    select o_custkey, o_orderkey, o_orderdate from (
        select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders)
    where rn = 1
    """,
)
def first_order(t: Tables) -> DataFrame:
    return keep_first(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )


@query("q_filters", "select doc_id, lang from documents where contains(text, ' the ') and lang <> 'de'")
def filters(t: Tables) -> DataFrame:
    return t.documents.where(F.col("text").contains(" the ") & (F.col("lang") != "de")).select("doc_id", "lang")


@query(
    "q_not_null",
    f"select doc_id, label from ({BINARY_SQL}) where text is not null and label is not null",
)
def not_null(t: Tables) -> DataFrame:
    return dedup.labelled_texts(binary_rows(t)).select("doc_id", F.col("sentiment").alias("label"))


@query("q_sorted_sources", "select distinct source from documents order by source")
def sorted_sources(t: Tables) -> DataFrame:
    return combine.distinct_values(t.documents, "source").orderBy("source")


@query("q_top_orders", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "q_set_diff",
    "select distinct o_custkey as key from orders where o_orderstatus = 'F' "
    "except select o_custkey from orders where o_orderstatus = 'P'",
)
def set_diff(t: Tables) -> DataFrame:
    keys = t.orders.select(F.col("o_custkey").alias("key"), "o_orderstatus")
    return combine.value_difference(keys.where("o_orderstatus = 'F'"), keys.where("o_orderstatus = 'P'"), "key")


@query(
    "q_set_intersection",
    "select doc_id as key from documents intersect select doc_id from labels",
)
def set_intersection(t: Tables) -> DataFrame:
    documents = t.documents.select(F.col("doc_id").alias("key"))
    return combine.value_intersection(documents, t.labels.select(F.col("doc_id").alias("key")), "key")


@query(
    "q_union_missing",
    """
    select c_custkey as key, c_name as name, c_mktsegment as segment from customer
    union all select s_suppkey, s_name, null from supplier
    """,
)
def union_missing(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return combine.union_all(customers, suppliers, allow_missing=True)


@query(
    "q_feature_join",
    "select doc_id, source, label from documents left join embeddings on doc_id = vec_id",
)
def feature_join(t: Tables) -> DataFrame:
    features = t.embeddings.select(F.col("vec_id").alias("doc_id"), "label")
    return combine.with_features(t.documents.select("doc_id", "source"), features, "doc_id")


@query("q_classifier")
def classifier(t: Tables) -> DataFrame:
    """Logistic regression on the train split, measured on the test split."""
    return training.train_and_evaluate(split_rows(t)).metrics


_BAYES_SQL = f"""
    with s as ({_SPLIT_SQL}),
         w as (select doc_id, split, sentiment_encoded as y,
                      unnest(regexp_extract_all(lower(text), '([\\p{{L}}\\p{{N}}_]+)', 1)) as word from s),
         c as (select word, count(*) filter (where y = 1) as n1, count(*) filter (where y = 0) as n0
               from w where split = 'train' group by word),
         n as (select sum(n1) as t1, sum(n0) as t0, count(*) as v from c),
         m as (select word, round(1e6::double * (ln((n1 + 1) / (t1 + v)) - ln((n0 + 1) / (t0 + v))))::bigint as weight from c, n),
         p as (select round(1e6::double * ln((count(*) filter (where sentiment_encoded = 1) + 1)
                      / (count(*) filter (where sentiment_encoded = 0) + 1)))::bigint as prior from s where split = 'train'),
         t as (select doc_id, sum(weight)::bigint as total from w join m using (word) where split = 'test' group by doc_id)
    select doc_id, sentiment_encoded, coalesce(total, 0) + prior as bayes_score,
           cast(coalesce(total, 0) + prior > 0 as int) as prediction
    from s left join t using (doc_id), p where split = 'test'
"""


@query("q_bayes", _BAYES_SQL)
def bayes_scores(t: Tables) -> DataFrame:
    """Naive Bayes fitted on the train split; scores of the test split."""
    rows = split_rows(t).select("doc_id", "split", "sentiment_encoded", "text")
    scored = bayes.score_bayes(rows.where("split = 'test'"), bayes.fit_bayes(rows.where("split = 'train'")), "doc_id")
    return scored.select("doc_id", "sentiment_encoded", "bayes_score", "prediction")


@query(
    "q_bayes_metrics",
    f"""
    with c as (select count(*) as test_samples,
                      count(*) filter (where sentiment_encoded = 1 and prediction = 1) as tp,
                      count(*) filter (where sentiment_encoded = 0 and prediction = 1) as fp,
                      count(*) filter (where sentiment_encoded = 1 and prediction = 0) as fn,
                      count(*) filter (where sentiment_encoded = 0 and prediction = 0) as tn from ({_BAYES_SQL}))
    select *, round((tp + tn) / test_samples, 3) as accuracy, round(tp / nullif(tp + fp, 0), 3) as "precision",
           round(tp / nullif(tp + fn, 0), 3) as recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 3) as f1 from c
    """,
)
def bayes_metrics(t: Tables) -> DataFrame:
    return bayes.bayes_metrics(split_rows(t).select("doc_id", "split", "sentiment_encoded", "text"), "doc_id")

"""Queries on paragraphs, tokens, chat text, exact and semantic de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import columns as C
from corpusloom.operators import dedup, similarity, spans, sparse, training
from corpusloom.operators.chat import chat_text, classification_prompt
from corpusloom.queries.registry import Tables, query
from corpusloom.queries.shared import BINARY_SQL, labelled
from corpusloom.session import materialize, small

# The test vectors hold no pair at the default threshold; this one splits them well.
THRESHOLD = 0.35


def full_texts(t: Tables) -> DataFrame:
    """Documents with their lines as paragraph spans.

    By language: no header annotation, an empty list, the last line as header, the same with
    offsets written as strings.
    """
    lines = F.split("text", "\n")
    starts = F.aggregate(
        lines,
        F.array(F.lit(0)),
        lambda acc, line: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(line) + 1)),
    )
    # Zipped, the starts are computed once per document; inside a lambda, once per line.
    ends = F.zip_with(
        F.slice(starts, 1, F.size(lines)),
        lines,
        lambda start, line: F.struct(start.alias("start"), (start + F.length(line)).alias("end")),
    )
    located = t.wide("documents", "doc_id", "source", "lang", "text")
    last = F.array(F.element_at(ends, -1))
    quoted = F.transform(
        last, lambda s: F.struct(s["start"].cast("string").alias("start"), s["end"].cast("string").alias("end"))
    )
    header = (
        F.when(F.col("lang") == "fr", F.lit("[]"))
        .when(F.col("lang") == "de", F.to_json(last))
        .when(F.col("lang") == "es", F.to_json(quoted))
    )
    annotations = F.struct(F.to_json(ends).alias("paragraph"), header.alias("sectionheader"))
    return located.select(
        F.col("doc_id").alias("corpusid"),
        F.col("source").alias("venue"),
        F.struct("text", annotations.alias("annotations")).alias("content"),
    )


SPANS_SQL = """
    with a as (select doc_id as corpusid, source as venue, lang, string_split(text, chr(10)) as lines from documents),
         p as (select corpusid, venue, lang, len(lines) as n, unnest(lines) as paragraph,
                      cast(generate_subscripts(lines, 1) - 1 as int) as par_id from a)
    select corpusid, venue, par_id, paragraph from p
    where lang = 'en' or (lang in ('de', 'es') and par_id < n - 1)
"""


@query("q_spans", SPANS_SQL)
def cut(t: Tables) -> DataFrame:
    return spans.cut_paragraphs(full_texts(t), "corpusid", "venue")


@query(
    "q_extract_paragraphs",
    rf"""
    select corpusid, venue, par_id,
           array_to_string(regexp_extract_all(paragraph, '([\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s])', 1), ' ') as tokens
    from ({SPANS_SQL}) where corpusid in (select doc_id from labels)
    """,
)
def extract(t: Tables) -> DataFrame:
    texts = full_texts(t)
    mapping = texts.select("corpusid", "venue").join(
        t.labels.select(F.col("doc_id").alias("corpusid")), "corpusid", "left_semi"
    )
    cut_texts = spans.extract_paragraphs(mapping, texts.select("corpusid", "content"))
    return cut_texts.select("corpusid", "venue", "par_id", C.join_tokens(F.col("text")).alias("tokens"))


@query(
    "q_tokens",
    r"""
    with t as (select doc_id, regexp_extract_all(text, '([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])', 1) as tokens
               from documents)
    select doc_id, len(tokens) as n_tokens, array_to_string(tokens, ' ') as joined from t
    """,
)
def tokens(t: Tables) -> DataFrame:
    found = t.wide("documents", "doc_id", "text").select("doc_id", C.tokenize(F.col("text")).alias("tokens"))
    return found.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        C.join_tokens(F.col("tokens")).alias("joined"),
    )


@query(
    "q_wordcount_filter",
    """
    select doc_id, len(string_split(text, ' ')) as wc from documents
    where len(string_split(text, ' ')) > 5 and len(string_split(text, ' ')) < 400
    """,
)
def wordcount_filter(t: Tables) -> DataFrame:
    counted = t.documents.select("doc_id", C.word_count(F.col("text")).cast("bigint").alias("wc"))
    return counted.where((F.col("wc") > 5) & (F.col("wc") < 400))


@query(
    "q_length_bucket",
    r"""
    with t as (select doc_id, list_slice(regexp_extract_all(text, '([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])', 1), 1, 512)
               as tokens from documents)
    select doc_id, len(tokens) as n_tokens, cast(floor(len(tokens) / 64.0) as int) as length_bucket,
           array_to_string(tokens, ' ') as kept from t
    """,
)
def length_bucket(t: Tables) -> DataFrame:
    grouped = training.grouped_by_length(t.wide("documents", "doc_id", "text"))
    return grouped.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        "length_bucket",
        C.join_tokens(F.col("tokens")).alias("kept"),
    )


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chat_sql(model: str) -> str:
    parts = rules.CHAT_FORMATS.get(model, rules.CHAT_FORMATS["generic"])
    message = {
        "system": _literal(rules.SYSTEM_MESSAGE),
        "user": _literal(rules.INSTRUCTION + "\n\nText: ") + " || text",
        "assistant": "label",
    }
    turns = [
        f"{_literal(parts[role][0])} || {message[role]} || {_literal(parts[role][1])}" for role in message if role in parts
    ]
    return f"select doc_id, {' || '.join(turns)} as chat from ({BINARY_SQL})"


def _chat_query(model: str, name: str) -> None:
    @query(name, _chat_sql(model))
    def chat(t: Tables) -> DataFrame:
        rows = labelled(t).where(F.col("label").isin("yes", "no"))
        answer = C.binary_label(C.binary(F.col("label")))
        return rows.select("doc_id", chat_text(F.col("text"), answer, model).alias("chat"))


for _model, _name in {
    "llama3.2": "q_chat_llama3_2",
    "qwen": "q_chat_qwen",
    "gemma": "q_chat_gemma",
    "gpt-oss": "q_chat_gpt_oss",
    "some-other-model": "q_chat_generic",
}.items():
    _chat_query(_model, _name)


@query(
    "q_prompt",
    f"select item_id, {_literal(rules.PROMPT_BEFORE)} || text || {_literal(rules.PROMPT_AFTER)} as prompt from benchmark",
)
def prompt(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", classification_prompt(F.col("text")).alias("prompt"))


@query(
    "q_exact_dedup",
    """
    select doc_id, text, source from (
        select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn = 1
    """,
)
def exact_dedup(t: Tables) -> DataFrame:
    return dedup.exact_dedup(t.documents, ["doc_id"]).select("doc_id", "text", "source")


@query(
    "q_cosine",
    """
    select vec_id, round(list_cosine_similarity(embedding::double[], list_reverse(embedding)::double[]), 6) as cosine
    from embeddings
    """,
)
def cosine(t: Tables) -> DataFrame:
    similarity_to_reverse = C.cosine(F.col("embedding"), F.reverse("embedding"))
    return t.embeddings.select("vec_id", F.round(similarity_to_reverse, 6).alias("cosine"))


@query(
    "q_first_similar",
    f"""
    select b.vec_id as vec_id, min(a.vec_id) as first_match from embeddings a join embeddings b on a.vec_id < b.vec_id
    where list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= {THRESHOLD}
    group by b.vec_id
    """,
)
def first_similar(t: Tables) -> DataFrame:
    return similarity.first_similar(t.embeddings, "vec_id", "embedding", THRESHOLD)


@query(
    "q_semantic_dedup",
    f"""
    with recursive
        v as (select vec_id, embedding::double[] as e, row_number() over (order by vec_id) as rn from embeddings),
        pairs as (select a.rn as i, b.rn as j from v a join v b on a.rn < b.rn
                  where list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
        near as (select v.rn, coalesce(list(i) filter (where i is not null), []) as earlier
                 from v left join pairs on v.rn = pairs.j group by v.rn),
        walk as (
            select 0::bigint as rn, []::bigint[] as kept
            union all
            select near.rn, case when list_has_any(near.earlier, walk.kept) then walk.kept
                                 else list_append(walk.kept, near.rn) end
            from walk join near on near.rn = walk.rn + 1)
    select vec_id, label from embeddings
    where vec_id in (select vec_id from v where rn in
                     (select unnest(kept) from walk where rn = (select max(rn) from v)))
    """,
)
def semantic_dedup(t: Tables) -> DataFrame:
    return similarity.semantic_dedup(t.embeddings, "vec_id", "embedding", THRESHOLD).select("vec_id", "label")


@query(
    "q_text_dedup",
    f"""
    with recursive
        doc as materialized (select doc_id, source, text from (select *, row_number() over (partition by text order by doc_id) as k from documents) where k = 1),
        word as (select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{C.TOKEN_PATTERN}')) as w from doc),
        term as (select doc_id, w, count(*) as tf from word group by all),
        often as (select w, count(*) as n, ln(((select count(*) from doc) + 1) / (count(*) + 1)) as idf from term group by w),
        weighed as (select doc_id, w, n, tf * idf as x from term join often using (w) where idf > 0),
        unit as materialized (select doc_id, w, n, x / sqrt(sum(x * x) over (partition by doc_id)) as x from weighed),
        -- Similar texts share a term from which on either has at least the threshold left, rarest terms first.
        early as materialized (select doc_id, w from (select doc_id, w, n, sqrt(sum(x * x) over (partition by doc_id order by n desc, w)) as rest from unit)
                  where n > 1 and rest >= {rules.SIMILARITY_THRESHOLD} - 1e-9),
        met as (select distinct a.doc_id as i, b.doc_id as j from early a join early b on a.w = b.w and a.doc_id < b.doc_id),
        pairs as materialized (select i, j from met join unit a on a.doc_id = i join unit b on b.doc_id = j and b.w = a.w
                  group by all having sum(a.x * b.x) >= {rules.SIMILARITY_THRESHOLD} - 1e-12),
        v as materialized (select doc_id, row_number() over (order by doc_id) as rn from doc),
        near as materialized (select v.rn, coalesce(list(i) filter (where i is not null), []) as earlier
                 from v left join pairs on v.doc_id = pairs.j group by v.rn),
        kept as (
            select 0::bigint as rn, []::bigint[] as ids
            union all
            select near.rn, case when list_has_any(near.earlier, kept.ids) then kept.ids else list_append(kept.ids, v.doc_id) end
            from kept join near on near.rn = kept.rn + 1 join v on v.rn = near.rn)
    select doc_id, source, text from doc where doc_id in (select unnest(ids) from kept where rn = (select max(rn) from v))
    """,
)
def text_dedup(t: Tables) -> DataFrame:
    """Texts compared by their tf-idf vectors over the whole vocabulary, at the default threshold."""
    docs = t.documents.select("doc_id", "source", "text")
    copies = materialize(dedup.exact_copies(docs, "doc_id"), "copies")
    return sparse.dedup_texts(docs.join(small(copies), "doc_id", "left_anti"), "doc_id")

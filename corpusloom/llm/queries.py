"""The numbered queries over the test tables: one per operator, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ship_package


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.quality import THRESHOLD, held_out, score, train

    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, _table(spark, folder, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.line_dedup import dedup_lines

    made = dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.warc import derive, page_responses

    made = derive(page_responses(_table(spark, folder, "pages")), "page_id")
    return made.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type",
        F.col("headers")["WARC-Block-Digest"].alias("block_digest"), F.col("headers")["WARC-Source-Payload-Digest"].alias("source_payload_digest"),
        F.octet_length("block").cast("long").alias("content_length"), F.decode("block", "UTF-8").alias("block"),
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.decontamination import contamination

    made = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return made.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.pivot_search import top_k

    return top_k(_table(spark, folder, "embeddings"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.packing import pack

    return pack(_table(spark, folder, "documents"), tokenizer_path())


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.ngram_join import ngram_components

    return ngram_components(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.substring_dedup import remove_repeats

    made = remove_repeats(_table(spark, folder, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.chat_snapshots import maximal_chats

    return maximal_chats(_table(spark, folder, "conversations"))


def op10_html_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.wrappers import extract

    made = extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return made.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.spelling import spelling_variants

    return spelling_variants(_table(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.divergence import source_divergence

    return source_divergence(_table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from corpusloom.llm.toxicity import THRESHOLD, held_out, score, train

    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, _table(spark, folder, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_line_dedup, op3_warc_derivatives, op4_decontamination, op5_pivot_search, op6_packing, op7_ngram_join, op8_substring_dedup, op9_chat_snapshots, op10_html_wrappers, op11_spelling_variants, op12_source_divergence, op13_toxicity)}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op2_line_dedup": f"""
        with line as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents
        ), key as (
            select *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from line
        ), often as (
            select key, max(doc_id) as keeper from key where length(key) >= 20 group by key having count(distinct doc_id) >= 3
        ), marked as (
            select k.doc_id, k.pos, k.line, o.key is not null and k.doc_id <> o.keeper as gone from key k left join often o using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
        from marked group by doc_id""",
    "op4_decontamination": r"""
        with doc as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
        ), item as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
        ), win as (
            select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as w
            from (select *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as i from item where len(ws) > 0)
        ), place as (
            select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as w
            from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from doc, (select distinct n from win))
        ), hit as (
            select doc_id, item_id, p.n, i from place p join win using (w, n)
        ), word as (
            select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from (select distinct doc_id, n, i from hit)) group by 1
        ), named as (
            select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items from (select distinct doc_id, item_id from hit) group by 1
        )
        select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from doc left join word using (doc_id) left join named using (doc_id)""",
    "op5_pivot_search": """
        with part as (
            select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings
        ), num as (
            select vec_id, i, floor(1024 * x)::bigint as x from part
            where vec_id not in (select vec_id from part where x is null or isnan(x) or isinf(x))
        ), pair as (
            select q.vec_id as query_id, v.vec_id, sum(q.x * v.x)::bigint as score
            from num q join num v on q.i = v.i and q.vec_id <> v.vec_id where q.vec_id % 100 = 0 group by all
        ), ranked as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score from pair
        )
        select * from ranked where rank <= 10""",
    "op8_substring_dedup": r"""
        with doc as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
        ), place as (
            select doc_id, i, array_to_string(ws[i:i + 19], ' ') as w
            from (select *, unnest(range(1, len(ws) - 18)) as i from doc)
        ), again as (
            select doc_id, i from (select *, row_number() over (partition by w order by doc_id, i) as k from place) where k > 1
        ), gone as (
            select distinct doc_id, unnest(range(i, i + 20)) as k from again
        ), word as (
            select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as k from doc
        ), kept as (
            select doc_id, count(g.k) as n_removed, string_agg(w, ' ' order by k) filter (g.k is null) as t
            from word left join gone g using (doc_id, k) group by 1
        )
        select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
        from doc left join kept using (doc_id)""",
    "op9_chat_snapshots": """
        with said as (
            select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        ), numbered as (
            select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
                   sha256(role || chr(31) || text) as mark
            from said window w as (partition by conv_id order by turn nulls first, role, text)
        ), prefix as (
            select conv_id, k, n, string_agg(mark, '') over (partition by conv_id order by k) as path from numbered
        ), whole as (
            select min(conv_id) as conv_id from prefix where k = n and path not in (select path from prefix where k < n) group by path
        )
        select conv_id, count(*) as n_turns, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by k) as text
        from numbered join whole using (conv_id) group by conv_id""",
    "op11_spelling_variants": r"""
        with recursive doc as (
            select coalesce(doc_id::varchar, '') || ':' as mark, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        ), run as (
            select mark, r, count(*) as n from (select mark, unnest(regexp_extract_all(t, '[A-Za-zÀ-ÿ]+')) as r from doc) group by all
        ), polynomial as (
            select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
            from (select unnest(range(256))::bigint as i)
        ), bytes as (
            select mark, r, n, list_prepend(4294967295::bigint, flatten(list_transform(string_split(mark || r, ''),
                   lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end))) as b from run
        ), hashed as (
            select r, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as h from bytes, polynomial
        ), spoiled as (
            select case when h % 97 = 0 then substr(r, 1, h % length(r)) || substr(r, (h % length(r) + 2)::bigint) else r end as word, n from hashed
        ), word as (
            select word, sum(n)::bigint as n, length(word) as len from spoiled where length(word) >= 5 group by word having sum(n) >= 3
        ), hole as (
            select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail from (select *, unnest(range(1, len + 1)) as i from word)
        ), near as (
            select a.word, b.word as other, b.n as other_n from hole a join hole b using (i, head, tail) where a.word <> b.word
            union select h.word, w.word, w.n from hole h join word w on w.word = h.head || h.tail
            union select w.word, h.word, h.n from hole h join word w on w.word = h.head || h.tail
        ), best as (
            select word, count(*) as n_near, min(struct_pack(less := -other_n, other := encode(other))) as b from near group by word
        ), formed as (
            select w.word, w.n, coalesce(n_near, 0) as n_near, case when -b.less >= 2 * w.n then decode(b.other) end as form,
                   case when -b.less >= 2 * w.n then -b.less end as form_n from word w left join best using (word)
        ), way as (
            select word, word as root, 0 as step from word
            union all select way.word, f.form, step + 1 from way join formed f on f.word = way.root where f.form is not null
        )
        select f.word, form, root, n, n_near, form_n from formed f join (select word, max_by(root, step) as root from way group by word) using (word)""",
    "op12_source_divergence": r"""
        with doc as (
            select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        ), said as (
            select d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from doc
        ), kept as (
            select lang, term, count(*) as q_n from said group by all having count(distinct d) >= 3
        ), cell as (
            select lang, source, term, count(*) as n from said join kept using (lang, term) group by all
        ), grp as (
            select lang, source, coalesce(any_value(v), 0) as v, coalesce(sum(n), 0) as total
            from (select distinct lang, source from doc) left join cell using (lang, source) left join (select lang, count(*) as v from kept group by lang) using (lang)
            group by all
        ), whole as (
            select lang, sum(q_n) as total from kept group by lang
        ), every as (
            select g.lang, g.source, k.term, coalesce(n, 0) as n, q_n, 1 + (1000000000::hugeint * (coalesce(n, 0) + 1)) // (g.total::hugeint + v) as p,
                   1 + (1000000000::hugeint * (q_n + 1)) // (w.total::hugeint + v) as q
            from grp g join kept k using (lang) join whole w using (lang) left join cell c on c.lang = g.lang and c.source = g.source and c.term = k.term
        ), term as (
            select lang, source, term as item, ((p - q) * (p - q)) // q as value from every where n > 0 and p > q
        ), summed as (
            select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
            from every a join every b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ), pair as (
            select a.lang, a.source, b.source as item, coalesce(value, 0) as value
            from grp a join grp b on a.lang = b.lang and a.source <> b.source left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
        ), ranked as (
            select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pair
            union all
            select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, encode(item)) from term
        )
        select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked where part = 'pair' or rank <= 200""",
}

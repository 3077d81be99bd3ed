"""Queries on venue rankings, venue resolution, paper selection and stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import columns as C
from corpusloom.operators import spans, stats, venues
from corpusloom.queries.registry import Tables, query
from corpusloom.queries.texts import SPANS_SQL, full_texts
from corpusloom.sources.html import first_table, html_table_rows

_ALIASES = {"Nation Five": "Nation_5"}
_EXCLUDED = "nation_24"


def ranking(t: Tables) -> DataFrame:
    """Nations as ranked venues."""
    return venues.ranking_names(
        t.nation.select(
            F.col("n_name").alias("venue"), F.col("n_nationkey").alias("h5_index"), F.col("n_regionkey").alias("h5_median")
        )
    )


def metadata(t: Tables) -> DataFrame:
    """Customers as venue records: many per venue, one name in the alias table, some under other names."""
    key = F.col("c_nationkey")
    name = (
        F.when(key == 5, "Nation Five")
        .when(key >= 20, F.concat(F.lit("Journal of "), key))
        .otherwise(F.concat(F.lit("Nation_"), key))
    )
    return t.customer.select(
        "c_custkey",
        name.alias("display_name"),
        F.array().cast("array<string>").alias("alternate_titles"),
        F.lit(None).cast("string").alias("abbreviated_title"),
        F.struct(F.array(F.concat(F.lit("I"), "c_custkey"), F.lit("J")).alias("issn")).alias("ids"),
        F.concat(F.lit("L"), key).alias("issn_l"),
    )


def overrides(t: Tables) -> DataFrame:
    return t.nation.where("n_nationkey >= 20").select(
        F.lower("n_name").alias("publication"), F.concat(F.lit("L"), "n_nationkey").alias("issn_l")
    )


_META_SQL = """
    select * from (
        select 'I' || c_custkey as issn, 'L' || c_nationkey as issn_l,
               case when c_nationkey = 5 then 'Nation Five' when c_nationkey >= 20 then 'Journal of ' || c_nationkey
                    else 'Nation_' || c_nationkey end as display_name,
               row_number() over (partition by c_nationkey order by c_custkey) as rn
        from customer) where rn = 1
"""
_RESOLVED_SQL = f"""
    with m as ({_META_SQL}),
         r as (select lower(n_name) as publication, n_nationkey as h5_index, n_regionkey as h5_median from nation),
         a as (select r.*, m.display_name, m.issn_l, m.issn from r left join m on r.publication =
               lower(case when m.display_name = 'Nation Five' then 'Nation_5' else m.display_name end)),
         o as (select lower(n_name) as publication, 'L' || n_nationkey as issn_l from nation where n_nationkey >= 20),
         b as (select a.publication, a.h5_index, a.h5_median, m.display_name, o.issn_l, m.issn
               from a left join o using (publication) left join m on m.issn_l = o.issn_l
               where a.display_name is null and a.publication <> 'nation_24'),
         u as (select *, 1 as pass from a where display_name is not null union all select *, 2 from b)
    select publication, h5_index, h5_median, display_name, issn_l, issn from (
        select *, row_number() over (partition by display_name order by pass, publication) as rn from u) where rn = 1
"""


def resolved(t: Tables) -> DataFrame:
    return venues.resolve_venues(ranking(t), metadata(t), overrides(t), "c_custkey", _ALIASES, _EXCLUDED)


@query("q_venue_resolve", _RESOLVED_SQL)
def venue_resolve(t: Tables) -> DataFrame:
    return resolved(t)


def papers(t: Tables) -> DataFrame:
    """Orders as papers; the venue is the customer's nation, under its display name."""
    key = F.col("c_nationkey")
    name = F.when(key == 5, "Nation Five").otherwise(F.concat(F.lit("Nation_"), key))
    located = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return located.select(
        F.col("o_orderkey").alias("corpusid"),
        F.struct(F.struct(name.alias("display_name")).alias("host_venue")).alias("works_oa"),
        (F.col("o_orderstatus") == "F").alias("s2orc_parsed"),
    )


_SELECTED_SQL = f"""
    select v.display_name as venue, o_orderkey as corpusid
    from orders join customer on o_custkey = c_custkey
    join (select distinct display_name from ({_RESOLVED_SQL}) where display_name is not null) v
         on v.display_name = case when c_nationkey = 5 then 'Nation Five' else 'Nation_' || c_nationkey end
    where o_orderstatus = 'F'
"""


@query("q_paper_select", _SELECTED_SQL)
def paper_select(t: Tables) -> DataFrame:
    return venues.select_papers(papers(t), venues.target_venues(resolved(t)))


@query(
    "q_coverage",
    f"""
    select (select count(distinct display_name) from ({_RESOLVED_SQL})) as total_venues,
           count(distinct venue) as venues_with_papers, count(*) as total_papers from ({_SELECTED_SQL})
    """,
)
def coverage(t: Tables) -> DataFrame:
    targets = venues.target_venues(resolved(t))
    return stats.venue_coverage(targets, venues.select_papers(papers(t), targets))


@query(
    "q_extraction_counts",
    f"""
    select (select count(distinct source) from documents) as total_venues_processed,
           (select count(*) from documents) as total_papers_processed,
           count(*) as total_paragraphs_extracted from ({SPANS_SQL})
    """,
)
def extraction_counts(t: Tables) -> DataFrame:
    texts = full_texts(t)
    mapping = t.documents.select(F.col("doc_id").alias("corpusid"), F.col("source").alias("venue"))
    return stats.extraction_counts(mapping, spans.cut_paragraphs(texts, "corpusid"))


def _ranking_pages(t: Tables) -> DataFrame:
    """A page per customer: a header row, a full row, a short row, then a second table."""
    html = F.concat(
        F.lit("<html><body><table class='v'><tr><th>Publication</th><th>h5</th><th>median</th></tr><tr><td><a href='/x'>"),
        F.col("c_name"),
        F.lit("</a> &amp;\n <b>"),
        F.col("c_mktsegment"),
        F.lit("</b></td><td>"),
        F.col("c_nationkey"),
        F.lit("<td>"),
        F.col("c_custkey"),
        F.lit("</tr><tr><td>"),
        F.col("c_mktsegment"),
        F.lit("</td></tr></table><table><tr><td>other</td></tr></table>"),
    )
    customers = t.wide("customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return customers.select(F.col("c_custkey").alias("page_id"), F.col("c_mktsegment").alias("field"), html.alias("html"))


@query(
    "q_html_roundtrip",
    """
    select 'gscholar_venues' as source, c_name || ' & ' || c_mktsegment as venue, c_mktsegment as field,
           c_nationkey as h5_index, cast(c_custkey as int) as h5_median from customer
    union all
    select 'gscholar_venues', c_mktsegment, c_mktsegment, null, null from customer
    """,
)
def html_roundtrip(t: Tables) -> DataFrame:
    pages = _ranking_pages(t)
    rows = first_table(pages).join(pages.select("page_id", "field"), "page_id")
    return venues.ranking_from_cells(rows)


@query(
    "q_html_lists",
    """
    with n as (select page_id, html[strpos(html, '<nav>'):] as h from pages where contains(html, '<nav>')),
         l as (select page_id, regexp_extract_all(h[:strpos(h, '</nav>')], '<li><a [^>]*>([^<]*)</a>', 1) as c from n)
    select page_id, len(c) as n_rows from l where len(c) > 0
    """,
)
def html_lists(t: Tables) -> DataFrame:
    """The navigation list of each stored page, written as the page's only table and read back."""
    nav = F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1)
    table = F.regexp_replace(F.regexp_replace(nav, "(?i)<li>", "<tr><td>"), "(?i)</?ul>", "")
    pages = t.pages.select("page_id", F.concat(F.lit("<table>"), table, F.lit("</table>")).alias("html"))
    rows = html_table_rows(pages).where("table_idx = 0")
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "q_html_sources",
    r"""
    select c.lang, count(p.page_id) as n_rows
    from (select unnest(['en', 'fr', 'de', 'es', 'it']) as lang) c
    left join pages p on regexp_extract(p.url, '\.com/([a-z]+)/', 1) = c.lang group by c.lang
    """,
)
def html_sources(t: Tables) -> DataFrame:
    found = t.pages.select(F.regexp_extract("url", r"\.com/([a-z]+)/", 1).alias("lang"))
    return stats.configured_counts(found, "lang", ["en", "fr", "de", "es", "it"])


@query(
    "q_ratio",
    """
    select l_orderkey, l_linenumber, l_partkey, round(l_linenumber / 7.0::double, 3) as position,
           cast(null as double) as bad from lineitem
    """,
)
def position_ratio(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        C.position_ratio(F.concat(F.col("l_linenumber"), F.lit("/7"))).alias("position"),
        C.position_ratio(F.concat(F.col("l_linenumber"), F.lit("/0"))).alias("bad"),
    )


@query(
    "q_prefix_rename",
    """
    select c_custkey || '_' || c_nationkey as corpusid_unique, left(c_mktsegment, 2) as initials,
           c_name as venue, 'customer' as source from customer
    """,
)
def prefix_rename(t: Tables) -> DataFrame:
    return t.customer.withColumnRenamed("c_name", "venue").select(
        C.composite_key(F.col("c_custkey"), F.col("c_nationkey")).alias("corpusid_unique"),
        C.prefix(F.col("c_mktsegment"), 2).alias("initials"),
        "venue",
        F.lit("customer").alias("source"),
    )

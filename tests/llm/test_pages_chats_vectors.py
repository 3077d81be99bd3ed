"""Operators on pages, conversations and vectors against brute force."""

import json
import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm.chat_snapshots import _marked, maximal_chats, numbered_prefixes
from corpusloom.llm.html_tokens import lex, plain_text
from corpusloom.llm.pivot_search import top_k
from corpusloom.llm.warc import derive, digest, from_bytes, page_responses, to_bytes
from corpusloom.llm.wrappers import Site, compiled, expression, extract, main_text, read_page, slots_of

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href="/a">A</a></ul></nav>'
    '<div class="cookie-notice">We use cookies</div><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp; tail</h1><p><b>First\n  part<br>goes on.<p>Second &#233;'
    '<aside>Aside</aside><form>Name <input></form><section class="comments"><p>Nice</p></section></article><footer>&copy; me</footer>'
)


def test_main_text():
    assert main_text(PAGE) == "Head & tail\n\nFirst part goes on.\n\nSecond é"
    assert main_text("") == "" and main_text("<p>a<p>b") == "a\n\nb" and main_text("plain  text") == "plain text"
    assert main_text("<div><p>kept <a href=x>link</a> on</p><div hidden>no</div></div>") == "kept link on"
    assert main_text("<main><p>x</p></main><p>outside</p>") == "x"
    assert main_text("<p>a < b &lt; c</p>") == "a < b < c"


def test_text_of_formulas_and_listings_is_read():
    page = (
        "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><xmp><b> &amp;</xmp><noscript><p>plain</p></noscript><svg><text>label</text><path/></svg><svg/>"
        "<script>var a</script><style>p{}</style><template><p>never</p></template><p>end</p><iframe src=x><p>after</p></article>"
    )
    assert main_text(page).split() == plain_text(page).split() == "Let x=1 be <b> &amp; plain label end after".split()
    assert plain_text("<xmp>a<p>b") == "a\nb" and plain_text("<textarea>a<p>b") == "a\nb" and plain_text("a<script>b<p>c") == "a"


def test_names_do_not_hide_articles():
    assert main_text("<div class='layout sidebar-page'><article><p>story</p><p class=related>x</p></article><div>side</div></div>") == "story"
    assert main_text("<div id=page class='no-sidebar hasComments'><p>story</p><div class=sidebar>x</div></div>") == "story"
    assert main_text("<article><p>story</p></article><div class=related><article>other</article></div><aside><article>x</article></aside>") == "story"
    assert main_text("<h1 class=main-title>Title</h1><img class=main-image><p>the story is longer</p>") == "Title\n\nthe story is longer"
    assert main_text("<div class=main><header><h1>Head</h1></header><p>story of the page</p></div><p>outside</p>") == "Head\n\nstory of the page"
    assert main_text("<div class=ad><div itemprop=articleBody><p>story</p></div></div><p>outside</p>") == "story"
    assert main_text("<p>story <span class=share>Share</span> goes on</p><div class=ad><p>x</p></div>") == "story goes on"


def test_wrapper_has_repeated_and_optional_groups():
    site = Site()
    for page in ("<body><h1>a</h1><p>x</p><p>y</p></body>", "<body><h1>b</h1><div class=note>n</div><p>z</p></body>"):
        site.add(*read_page(page))
    assert expression(site.wrapper) == "<body><h1>#</>(<div.note>#</>)?(<p>#</>)+</>"


def test_template_text_of_a_host_goes(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><div>Read more news</div><p>Text {i}</p><ul><li><a href=/>L{i}</a></li></ul></article>") for i in range(6)]
    rows += [(7, "http://other.example/", "<article><div>Read more news</div><p>Alone</p></article>"), (8, None, None), (9, "http://[", ""), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, html string, _host string, dropped string").repartition(4)
    made = extract(pages)
    assert made.columns == [*pages.columns, "text"] and made.count() == 10
    got = {r["page_id"]: r["text"] for r in made.collect()}
    assert got == {**{i: f"Text {i}" for i in range(6)}, 7: "Read more news\n\nAlone", 8: "", 9: ""}
    assert extract(pages.limit(0)).count() == 0


def test_slots_are_nodes_of_the_wrapper(spark):
    """Slots of one path at two positions, and in a repeated group, are told apart."""
    page = "<article><div>Share this story</div><p>Story {0}</p><div>By writer {0}</div></article>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {i: f"Story {i}\n\nBy writer {i}" for i in range(6)}


def test_article_text_that_pages_share_stays(spark):
    """Articles with a long common beginning, with headings all pages have, and a slot that few pages of a host have."""
    same = "word " * 200
    rows = [(i, f"http://mirror.example/{i}", f"<article><h1>T{i}</h1><p>{same}</p><p>End {i}</p></article>") for i in range(6)]
    rows += [(10 + i, f"http://cook.example/{i}", f"<article><h1>T{i}</h1><h2>Ingredients</h2><p>Dish {i}</p></article>") for i in range(6)]
    rows += [(20 + i, f"http://copy.example/{i}", f"<article><h1>T{i}</h1><div>The one story</div></article>") for i in range(6)]
    rows += [(30 + i, f"http://rare.example/{i}", f"<p>Post {i}</p>" + "<blockquote>Rare words</blockquote>" * (i < 5)) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    want = {i: f"T{i}\n\n{same.strip()}\n\nEnd {i}" for i in range(6)}
    want |= {10 + i: f"T{i}\n\nIngredients\n\nDish {i}" for i in range(6)} | {20 + i: f"T{i}\n\nThe one story" for i in range(6)}
    assert got == want | {30 + i: f"Post {i}" + "\n\nRare words" * (i < 5) for i in range(20)}


def test_pages_fit_the_wrapper_of_their_host():
    draw = random.Random(4)

    def element(depth):
        name = draw.choice(["div", "section", "p"] if depth else ["p"])
        return f"<{name}>{''.join(element(depth - 1) for _ in range(draw.randint(0, 4))) if name != 'p' else 'x'}</{name}>"

    for _ in range(100):
        site, pages = Site(), [read_page("".join(element(2) for _ in range(draw.randint(1, 4)))) for _ in range(6)]
        for page in pages:
            site.add(*page)
        pattern = compiled(json.dumps(site.wrapper))
        for tree, blocks in pages:
            assert len(slots_of(tree, pattern)) == len(blocks)
    first = "<div><h1>a</h1></div><section>s</section><div><p>b</p></div>"
    site = Site()
    for page in (first, "<section>s</section><div><p>b</p></div>", "<div><h1>a</h1></div>"):
        site.add(*read_page(page))
    pattern = compiled(json.dumps(site.wrapper))
    whole = slots_of(read_page(first)[0], pattern)
    assert slots_of(read_page("<div><p>b</p></div>")[0], pattern) == whole[2:] and slots_of(read_page("<div><h1>a</h1></div>")[0], pattern) == whole[:1]


def test_archive_records(spark):
    rows = [(1, "http://x.example/", PAGE), (2, None, None), (3, "http://y.example/", "<p>a</p>"), (3, "http://y.example/", "<p>a</p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, block string")
    source = page_responses(pages)
    made = [r.asDict() for r in derive(source, "page_id").collect()]
    responses = {r["record_id"]: r for r in source.collect()}
    assert len(made) == 8
    for r in made:
        assert r["refers_to"] in responses and r["headers"]["WARC-Block-Digest"] == digest(bytes(r["block"]))
        assert r["headers"]["WARC-Source-Payload-Digest"] == responses[r["refers_to"]]["headers"]["WARC-Payload-Digest"]
    first = {r["warc_type"]: bytes(r["block"]).decode() for r in made if r["page_id"] == 1}
    assert first["conversion"] == plain_text(PAGE) and "http-header-content-type: text/html; charset=utf-8\r\n" in first["metadata"] and "outlink: /a L a/@href" in first["metadata"]
    data = b"".join(to_bytes(r) for r in made)
    back = list(from_bytes(data))
    assert [(b["record_id"], b["refers_to"], b["block"]) for b in back] == [(r["record_id"], r["refers_to"], bytes(r["block"])) for r in made]
    assert derive(source.limit(0)).count() == 0


def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (3, 0, "user", "hi"), (3, 1, "assistant", "no"), (4, 5, "user", "hi"), (4, 9, "assistant", "no")]
    rows += [(5, 0, None, None), (6, 0, "user", ""), (None, 0, "user", "null id"), (7, 0, "userh", "i"), (3, 1, "assistant", "no"), (8, None, "user", "first"), (8, 0, "user", "second")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in maximal_chats(turns).collect()}
    assert set(got) == {2, 3, 5, 6, 7, 8, None}
    assert got[3] == (2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nno<|im_end|>\n")
    assert maximal_chats(turns.limit(0)).count() == 0


def test_long_conversations_are_many_parts(spark):
    """A conversation of a third of all turns, the null id and shared numbers; prefixes go on from part to part."""
    draw = random.Random(9)
    said = [(draw.choice("ab"), draw.choice(["x", "y", "", None])) for _ in range(3000)]
    rows = [(1, i, *s) for i, s in enumerate(said)] + [(2, 2 * i, *s) for i, s in enumerate(said[:2999])] + [(3, i, *s) for i, s in enumerate(said)]
    rows += [(4, i, *s) for i, s in enumerate(said[:1500])] + [(4, 1500, "c", "other")] + [(None, None, "a", str(i)) for i in range(2000)]
    rows += [(5, 0, "a", str(i)) for i in range(1000)] + rows[:500]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    talks: dict = {}
    for c, t, r, x in set((c, t, r, x or "") for c, t, r, x in rows):
        talks.setdefault(c, []).append((-1 if t is None else t, r, x))
    talks = {c: [(r, x) for _, r, x in sorted(talk)] for c, talk in talks.items()}
    want = {
        c: (len(talk), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in talk))
        for c, talk in talks.items()
        if not any(other[: len(talk)] == talk and (len(other) > len(talk) or (o or 9) < (c or 9)) for o, other in talks.items() if o != c)
    }
    assert set(want) == {1, 4, 5, None}
    assert {r["conv_id"]: (r["n_turns"], r["text"]) for r in maximal_chats(turns).collect()} == want
    marked = _marked(turns, "conv_id", "turn", "role", "text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["key"], r["position"]): r for r in numbered_prefixes(marked).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == sum(map(len, talks.values()))
    sums = lambda key, n: [got[key, n][f"s{i}"] for i in range(4)]
    assert all(sums("1", n) == sums("2", n) == sums("3", n) for n in range(1, 3000)) and sums("4", 1500) == sums("1", 1500) and sums("4", 1501) != sums("1", 1501)
    assert [got["", n]["n_turns"] for n in (1, 2000)] == [2000, 2000]


def test_top_k_is_exact(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1 + (i % 7 == 0)) for _ in range(6)]) for i in range(400)]
    rows += [(i, list(rows[5][1])) for i in range(400, 480)]  # equal vectors: ties
    rows += [(500, None), (600, [1.0, None]), (700, [1.0, math.nan]), (800, [math.inf]), (900, []), (901, [2.0]), (None, [1.0] * 6), rows[3]]
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, pivot int, distance double").repartition(3)
    got = [tuple(r) for r in top_k(table).orderBy("query_id", "rank").collect()]
    fine = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in fine if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert got == want
    assert top_k(table.filter(F.lit(False))).count() == 0


def test_top_k_meets_all_vectors_over_many_partitions(spark):
    """Pivots and annuli of the two sides of a group go to the same partition; small partitions that are put together hide it."""
    draw = random.Random(3)
    rows = {i: [draw.gauss(0, 1) for _ in range(8)] for i in range(1000)}
    merging, partitions = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"
    before = {name: spark.conf.get(name) for name in (merging, partitions)}
    spark.conf.set(merging, "false")
    spark.conf.set(partitions, "7")
    try:
        got = [tuple(r) for r in top_k(spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    fine = {i: [math.floor(1024 * x) for x in v] for i, v in rows.items()}
    want = []
    for q in range(0, 1000, 100):
        scored = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert got == want


def test_a_page_is_read_into_tokens_once(spark, monkeypatch):
    read = []

    class Rows:
        def mapInArrow(self, build, schema):
            fields = {"page_id": 1, "warc_type": "response", "record_id": "r", "target_uri": "u", "date": "d", "headers": None, "block": PAGE.encode()}
            return [r for batch in build(iter([pa.RecordBatch.from_pylist([fields])])) for r in batch.to_pylist()]

        def select(self, *columns):
            return self

    for module in ("warc", "html_tokens"):
        monkeypatch.setattr(f"corpusloom.llm.{module}.lex", lambda page: read.append(page) or lex(page))
    made = {r["warc_type"]: r["block"].decode() for r in derive(Rows())}
    assert len(read) == 1 and made["conversion"] == plain_text(PAGE) and "outlink: /a L a/@href" in made["metadata"]

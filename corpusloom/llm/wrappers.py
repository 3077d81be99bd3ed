"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page is read as a tree of block elements and text slots. Trees of a host are aligned level by level:
neighbours of one label become a repeated group, elements only some pages have become optional, differing
texts become slots. Each page is then matched with its host's wrapper: what the slots, nodes of the wrapper, hold over all pages
of the host (links, constant text) and what their elements are called tells the article from what surrounds it.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom.llm.common import as_batch, fresh, small, with_columns
from corpusloom.llm.html_tokens import BLOCKS, attributes, balanced
from corpusloom.session import materialize

#: Elements that are never part of an article.
_SIDE_TAGS = frozenset("nav footer aside form button select datalist dialog menu title head input label fieldset output progress meter".split())
#: Elements whose name alone says something.
_TELLING = _SIDE_TAGS | {"article", "main", "header", "a"}
#: Words of class, id and role that name what is not article.
_SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner banners nav navigation navbar menu menus "
    "breadcrumb breadcrumbs masthead topbar footer foot contentinfo sidebar sidebars aside complementary widget widgets cookie cookies consent notice notices gdpr privacy "
    "alert alerts newsletter subscribe subscription signup login signin register search searchbox share sharing social related recommended recommendations comment comments "
    "commentlist disqus reply replies respond popup modal overlay dialog pagination pager paywall toolbar skip outbrain taboola".split()
)
#: After these, the words of a name tell what is not there, or beside the element.
_MODIFIERS = frozenset("with without has have no non not hide hides".split())
_FLUSH_HOSTS = 2000
_FLUSH_SHAPES = 20_000
_SALTS = 32
#: Elements that hold an article's own text.
_PROSE = frozenset("address blockquote body caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary td th xmp".split())
#: From so many pages on, a slot that has one text on all of them, and is on most pages of its host, is template text.
_LITERAL_PAGES = 5
_LINK_SHARE = 0.9


def _heading(name: str) -> bool:
    return re.fullmatch("h[1-6]", name) is not None


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _words(*values: str) -> set[str]:
    return {w.lower() for v in values for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", v)}


def _side_named(names: str) -> bool:
    """Whether class, id or role name what is not article; words after a modifier (with-sidebar, no-ads) do not count."""
    for name in names.split():
        for word in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name):
            if word.lower() in _MODIFIERS:
                break
            if word.lower() in _SIDE_WORDS:
                return True
    return False


class Flags(NamedTuple):
    """What an open element and those around it say.

    ``side``: not article, whatever else is said. ``named``: not article by the words of a name outside any article
    element. ``main``: in an article element. ``may``: elements around it that are named main, by number. ``headed``: in
    a header that only such an element could make part of the article.
    """

    side: bool = False
    named: bool = False
    main: bool = False
    may: tuple[int, ...] = ()
    headed: bool = False
    link: bool = False


class Block:
    """A run of text: the path of its block elements, its text, how much of it is links, and what its elements say."""

    __slots__ = ("path", "text", "linked", "side", "main", "flags")

    @property
    def prose(self) -> str:
        """The name of the innermost block element."""
        return self.path[-1].split(".")[0] if self.path else ""

    def __init__(self, path: tuple[str, ...], text: str, linked: int, side: bool, flags: Flags) -> None:
        self.path, self.text, self.linked, self.side, self.main, self.flags = path, text, linked, side, flags.main, flags


def _settle(blocks: list[Block]) -> None:
    """Decide what needs the whole page: which elements called main, and which articles within what is named as something else, count.

    An article element inside a named element counts if the page has no text in an article elsewhere. Without an article
    element, the element called main that holds most text is one, if that is more than half of the page's.
    """
    held = [b for b in blocks if not b.side and b.text]
    free = any(b.main and not b.flags.named for b in held)
    for b in held:
        b.side = b.flags.named and (free or not b.main)
    chosen = None
    if not any(b.main and not b.side for b in held):
        sizes: dict[int, int] = {}
        for b in held:
            for element in () if b.side else b.flags.may:
                sizes[element] = sizes.get(element, 0) + len(b.text)
        whole = sum(len(b.text) for b in held if not b.side)
        _, chosen = max(((n, element) for element, n in sizes.items() if 2 * n > whole), default=(0, None))
        for b in held:
            b.main = chosen in b.flags.may
    for b in held:
        b.side = b.side or b.flags.headed and not b.main


def read_page(page: str) -> tuple[list, list[Block]]:
    """The tree of a page's block elements ([label, children]; a text slot is ["#", []]) and its runs of text."""
    root: list = ["", []]
    nodes, path = [root], [()]
    flags = [Flags()]
    mains = itertools.count(1)
    blocks: list[Block] = []
    run: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if len(run) == 1:  # most runs
            part, inner = run[0]
            kept = text = " ".join(part.split())
        elif text := " ".join("".join([part for part, _ in run]).split()):
            inner = all(side for part, side in run if part.strip())
            mixed = not inner and any(side for _, side in run)
            kept = " ".join("".join([part for part, side in run if not side]).split()) if mixed else text
        if text:
            nodes[-1][1].append(["#", []])
            blocks.append(Block(path[-1], kept, min(linked, len(text)), inner, flags[-1]))
        run.clear()
        linked = 0

    for kind, value, source in balanced(page):
        if kind == "text":
            run.append((value, flags[-1].side))
            if flags[-1].link:
                linked += len(value.strip())
            continue
        block = value in BLOCKS
        if block and run:
            flush()
        if kind == "open":
            given = attributes(source) if source else {}
            names = " ".join([given.get(a, "") for a in ("class", "id", "role", "itemprop")]) if given else ""
            words = _words(names) if names.strip() else set()
            if not given and value not in _TELLING:
                flags.append(flags[-1])
            else:
                side, named, main, may, headed, link = flags[-1]
                opens = value in ("article", "main") or "articlebody" in given.get("itemprop", "").lower().split()
                hides = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
                side = side or hides or value in _SIDE_TAGS or value == "header" and not (main or may)
                if words & _SIDE_WORDS and not opens and value not in ("html", "body") and _side_named(names):
                    # Text between blocks is left out of a block by its inline elements, so those say it at once.
                    side, named = side or main or not block, True
                if "main" in words and not main and value not in ("html", "body"):
                    may = (*may, next(mains))
                headed = headed or value == "header" and not main
                flags.append(Flags(side, named, main or opens, may, headed, link or value == "a"))
            if value in ("br", "img", "hr"):
                run.append((" ", flags[-1].side))
            if block:
                label = value + "".join([f".{w}" for w in sorted(words)]) if words else value
                node = [label, []]
                nodes[-1][1].append(node)
                nodes.append(node)
                path.append((*path[-1], label))
        else:
            flags.pop()
            if block:
                nodes.pop()
                path.pop()
    if run:
        flush()
    _settle(blocks)
    return root, blocks


def fold(node: list) -> list:
    """A wrapper of one tree: [label, mark, children]; neighbours of one label are a repeated group (mark "+")."""
    made: list = []
    for child in map(fold, node[1]):
        if made and made[-1][0] == child[0]:
            merged = align(made[-1], child)
            made[-1] = [merged[0], "*" if merged[1] in ("?", "*") else "+", merged[2]]
        else:
            made.append(child)
    return [node[0], "", made]


def _joined(a: str, b: str) -> str:
    optional, repeated = a in ("?", "*") or b in ("?", "*"), a in ("+", "*") or b in ("+", "*")
    return {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[optional, repeated]


def _optional(node: list) -> list:
    return [node[0], _joined(node[1], "?"), node[2]]


def align(a: list, b: list) -> list:
    """The wrapper that fits what either of two wrappers of one label fits; mismatches become optional or repeated groups."""
    if a[2] == b[2]:
        return [a[0], _joined(a[1], b[1]), a[2]]
    made: list = []
    left, right = [c[0] for c in a[2]], [c[0] for c in b[2]]
    for kind, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        pairs = [align(x, y) for x, y in zip(a[2][i:j], b[2][k:m])] if kind == "equal" else [_optional(c) for c in a[2][i:j] + b[2][k:m]]
        for node in pairs:
            if made and made[-1][0] == node[0]:
                merged = align(made[-1], node)
                optional = made[-1][1] in ("?", "*") and node[1] in ("?", "*")
                made[-1] = [merged[0], "*" if optional else "+", merged[2]]
            else:
                made.append(node)
    return [a[0], _joined(a[1], b[1]), made]


def expression(node: list) -> str:
    """The wrapper written as a regular expression over tags and text slots (``#``)."""
    inner = "".join(map(expression, node[2]))
    whole = node[0] if node[0] == "#" else f"<{node[0]}>{inner}</>" if node[0] else inner
    return f"({whole}){node[1]}" if node[1] else whole


class Pattern:
    """A node of a host's wrapper, numbered in the order of the page, with what finding a page's elements in it needs."""

    __slots__ = ("at", "label", "required", "children", "labels", "places", "needed")

    def __init__(self, node: list, numbers: Iterator[int]) -> None:
        self.at, self.label, self.required = next(numbers), node[0], node[1] in ("", "+")
        self.children = [Pattern(c, numbers) for c in node[2]]
        self.labels = [c.label for c in self.children]
        self.places: dict[str, list[int]] = {}
        self.needed = [0]  # required children before each place
        for i, c in enumerate(self.children):
            self.places.setdefault(c.label, []).append(i)
            self.needed.append(self.needed[-1] + c.required)


def compiled(wrapper: str) -> Pattern:
    """A wrapper from its JSON."""
    return Pattern(json.loads(wrapper), itertools.count())


def _misfit(run: list[list], child: Pattern) -> int:
    """How many labels inside a run of elements a node of the wrapper does not have, and the other way round."""
    had = {c[0] for element in run for c in element[1]}
    return len(had.difference(child.labels)) + sum(c.required and c.label not in had for c in child.children)


def _fit(runs: list[tuple[str, list[list]]], pattern: Pattern) -> list[Pattern | None]:
    """The child of a wrapper's node that each run of neighbours of one label is, in order: as few required ones passed over as can be."""
    children, needed = pattern.children, pattern.needed
    if [label for label, _ in runs] == pattern.labels:
        return children
    found: list[Pattern | None] = [None] * len(runs)
    low: list[tuple[int, int]] = []  # run, leftmost place
    after = 0
    for i, (label, _) in enumerate(runs):
        places = pattern.places.get(label, [])
        k = bisect_left(places, after)
        if k < len(places):
            low.append((i, places[k]))
            after = places[k] + 1
    before, wide = len(children), []
    for i, first in reversed(low):
        places = pattern.places[runs[i][0]]
        k = bisect_left(places, before)
        before = places[k - 1]
        wide.append((i, places[bisect_left(places, first) : k]))
    steps: list[list[tuple[int, int, int]]] = []  # place, cost, index of the step before
    for i, places in reversed(wide):
        step, had, least, back = [], 0, None, -1
        for j in places:
            if steps:
                while had < len(steps[-1]) and steps[-1][had][0] < j:
                    cost = steps[-1][had][1] - needed[steps[-1][had][0] + 1]
                    if least is None or cost < least:
                        least, back = cost, had
                    had += 1
            cost = (least or 0) + needed[j] + (_misfit(runs[i][1], children[j]) if len(places) > 1 else 0)
            step.append((j, cost, back))
        steps.append(step)
    if steps:
        at = min(range(len(steps[-1])), key=lambda n: steps[-1][n][1] - needed[steps[-1][n][0] + 1])
        for (i, _), step in zip(wide, reversed(steps)):
            found[i] = children[step[at][0]]
            at = step[at][2]
    return found


def slots_of(tree: list, pattern: Pattern) -> list[str]:
    """For each run of text of a page, in order, the node of the host's wrapper that it fills.

    Neighbours of one label are one run, as in ``fold``, and go to one node. An element that has no node (where labels alone
    leave open which of several nodes a page's element is) is named by its path below the last node.
    """
    made: list[str] = []

    def unknown(node: list, name: str) -> None:
        if node[0] == "#":
            made.append(name)
        for child in node[1]:
            unknown(child, f"{name}/{child[0]}")

    def walk(node: list, at: Pattern) -> None:
        runs: list[tuple[str, list[list]]] = []
        for child in node[1]:
            if runs and runs[-1][0] == child[0]:
                runs[-1][1].append(child)
            else:
                runs.append((child[0], [child]))
        for (label, run), to in zip(runs, _fit(runs, at)):
            for child in run:
                if to is None:
                    unknown(child, f"{at.at}/{label}")
                elif label == "#":
                    made.append(str(to.at))
                else:
                    walk(child, to)

    walk(tree, pattern)
    return made


class Site:
    """The wrapper of the pages of a host so far; pages of one folded tree are joined once."""

    def __init__(self) -> None:
        self.wrapper: list | None = None
        self._seen: set[str] = set()

    def add(self, tree: list, blocks: list[Block] | None = None) -> None:
        self.join(json.dumps(fold(tree)))

    def join(self, wrapper: str) -> None:
        if wrapper not in self._seen:
            self._seen.add(wrapper)
            made = json.loads(wrapper)
            self.wrapper = made if self.wrapper is None else align(self.wrapper, made)


class Slots:
    """What the pages of a host hold in each slot of its wrapper: pages, characters, linked characters and the digest of the one text, if it is one."""

    def __init__(self) -> None:
        self.pages = 0
        self.slots: dict[str, list] = {}

    def add(self, tree: list, blocks: list[Block], pattern: Pattern) -> None:
        own: dict[str, list] = {}
        for b, at in zip(blocks, slots_of(tree, pattern), strict=True):
            slot = own.setdefault(at, [1, 0, 0, [], b.main, b.side, b.prose])
            slot[1] += len(b.text)
            slot[2] += b.linked
            slot[3].append(b.text)
            slot[5] = slot[5] and b.side
        for slot in own.values():
            slot[3] = hashlib.sha256("\n".join(slot[3]).encode("utf-8", "surrogatepass")).hexdigest()
        self.pages += bool(own)
        self.count(own)

    def count(self, slots: dict[str, list]) -> None:
        for at, (pages, chars, linked, text, main, side, prose) in slots.items():
            had = self.slots.get(at)
            if had is None:
                self.slots[at] = [pages, chars, linked, text, main, side, prose]
            else:
                self.slots[at] = [had[0] + pages, had[1] + chars, had[2] + linked, text if text == had[3] else None, had[4] or main, had[5] and side, had[6]]

    def merge(self, other: str) -> None:
        pages, slots = json.loads(other)
        self.pages += pages
        self.count(slots)

    def dump(self) -> str:
        return json.dumps([self.pages, self.slots])

    def dropped(self) -> list[str]:
        """Slots of the wrapper that are not article by what all pages of the host have in them.

        Links go. One text that most pages of the host have goes outside article elements. Inside them it goes only
        from bare containers, and only if paragraphs or containers of the article differ: headings, paragraphs, items and
        cells of an article are its own, whatever other pages say.
        """
        marked = any(s[4] and not s[5] for s in self.slots.values())
        inside = {at: s for at, s in self.slots.items() if not s[5] and (s[4] or not marked)}
        varied = any(s[3] is None and not _heading(s[6]) for s in inside.values())

        def template(pages: int, text: str | None, main: bool, prose: str) -> bool:
            return varied and text is not None and pages >= _LITERAL_PAGES and 2 * pages > self.pages and not (main and prose in _PROSE)

        return sorted(
            at
            for at, (pages, chars, linked, text, main, _, prose) in inside.items()
            if chars and linked >= _LINK_SHARE * chars or template(pages, text, main, prose)
        )


def main_text(page: str, pattern: Pattern | None = None, dropped: frozenset[str] = frozenset()) -> str:
    """The article of a page: blocks joined by an empty line. Without an article element, all that is not set aside."""
    tree, blocks = read_page(page)
    gone = [at in dropped for at in slots_of(tree, pattern)] if pattern and dropped else [False] * len(blocks)
    held = [(b, out) for b, out in zip(blocks, gone, strict=True) if not b.side and b.text]
    if any(b.main for b, _ in held):
        held = [(b, out) for b, out in held if b.main]
    return "\n\n".join([b.text for b, out in held if not out])


@F.pandas_udf(StringType())
def _host(urls: pd.Series) -> pd.Series:
    return pd.Series([host_of(u) for u in urls], dtype=object)


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """One row per host: ``host`` and its ``wrapper``, as JSON.

    Every page of a host counts. A task gives each folded tree of a host once; those are joined in an order that does
    not depend on partitions, in two levels, so a host with a third of all pages is many small groups.
    """

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("shape", pa.string())])
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            made = []
            for address, source in zip(batch.column("url").to_pylist(), batch.column("page").to_pylist()):
                row = (host_of(address), json.dumps(fold(read_page(source)[0])))
                if row not in seen:
                    seen.add(row)
                    made.append(row)
            yield as_batch(made, schema)
            if len(seen) > _FLUSH_SHAPES:
                seen.clear()

    def joined(wrappers: Iterable[str]) -> str:
        site = Site()
        for wrapper in wrappers:
            site.join(wrapper)
        return json.dumps(site.wrapper)

    def halfway(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "salt": [parts["salt"].iloc[0]], "shape": [joined(sorted(set(parts["shape"])))]})

    def final(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "wrapper": [joined(parts.sort_values("salt")["shape"])]})

    given = pages.select(F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{page}`").cast("string"), F.lit("")).alias("page"))
    parts = given.mapInArrow(shapes, "host string, shape string").withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(_SALTS)))
    half = parts.groupBy("host", "salt").applyInPandas(halfway, "host string, salt long, shape string")
    return half.groupBy("host").applyInPandas(final, "host string, wrapper string")


def _patterns() -> Callable[[str], Pattern]:
    """Compiles wrappers, remembering those of the last hosts."""
    return lru_cache(_FLUSH_HOSTS)(compiled)


def dropped_slots(located: DataFrame, host: str, wrapper: str, page: str) -> DataFrame:
    """One row per host: ``host`` and ``dropped`` (slots of its wrapper, as JSON), from pages that have their host's wrapper beside them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("site", pa.string())])
        sites: dict[str, Slots] = {}
        pattern = _patterns()
        for batch in batches:
            for name, made, source in zip(*(batch.column(c).to_pylist() for c in ("host", "wrapper", "page"))):
                sites.setdefault(name, Slots()).add(*read_page(source), pattern(made))
            if len(sites) > _FLUSH_HOSTS:
                yield as_batch([(name, site.dump()) for name, site in sites.items()], schema)
                sites = {}
        yield as_batch([(name, site.dump()) for name, site in sites.items()], schema)

    def joined(parts: pd.DataFrame) -> Slots:
        site = Slots()
        for part in parts["site"]:
            site.merge(part)
        return site

    def halfway(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "site": [joined(parts).dump()]})

    def final(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "dropped": [json.dumps(joined(parts).dropped())]})

    given = located.select(F.col(host).alias("host"), F.col(wrapper).alias("wrapper"), F.coalesce(F.col(f"`{page}`").cast("string"), F.lit("")).alias("page"))
    parts = given.mapInArrow(partial, "host string, site string").withColumn("salt", F.pmod(F.xxhash64("site"), F.lit(_SALTS)))
    half = parts.groupBy("host", "salt").applyInPandas(halfway, "host string, site string")
    return half.groupBy("host").applyInPandas(final, "host string, dropped string")


def extract(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``out`` (replaced if it is there).

    The pages are read three times: for the wrapper of each host, for what its slots hold, and for the text.

    A null or empty page has an empty text; a null or broken address counts as the host with the empty
    name. Rows are kept one to one, repeated ones too; an empty table gives an empty one; extra columns
    are passed on.
    """
    pages = pages.drop(out) if out != page else pages
    host, made_of, gone = fresh(pages, "_host"), fresh(pages, "_wrapper"), fresh(pages, "_dropped")
    wrappers = small(materialize(infer(pages, url, page), "wrappers").select(F.col("host").alias(host), F.col("wrapper").alias(made_of)), 20_000)
    hosted = pages.withColumn(host, _host(F.col(f"`{url}`").cast("string")))
    found = dropped_slots(hosted.join(wrappers, host), host, made_of, page).select(F.col("host").alias(host), F.col("dropped").alias(gone))
    sites = small(materialize(wrappers.join(found, host), "slots"), 20_000)
    schema = StructType([f for f in pages.schema.fields if f.name != out] + [StructField(out, StringType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, slots = _patterns(), lru_cache(_FLUSH_HOSTS)(lambda listed: frozenset(json.loads(listed)))
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in (page, made_of, gone)))
            made = [main_text(source or "", pattern(wrapper), slots(listed)) for source, wrapper, listed in rows]
            yield with_columns(batch, **{out: pa.array(made, pa.string())}).select(schema.fieldNames())

    return hosted.join(sites, host, "left").mapInArrow(texts, schema)

"""How the sources of a language differ in their words: exact divergences of smoothed term shares.

Terms with the same counts have the same value, so values are found per cell of counts, cells are ranked by how many
terms they hold, and only the terms of the cells that reach the report are looked up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import small
from corpusloom.session import materialize

SCALE, TOP, DOCUMENTS = 10**9, 200, 3
#: Counted terms that a task holds before it hands them on.
HELD = 300_000
#: Counts (terms times sources) that one task compares at a time, and the fewest terms of a block.
CELLS, BLOCK_TERMS = 1 << 19, 2048
_LONG_TEXT = 1 << 22
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(body: bytes) -> Iterator[bytes] | list[bytes]:
    """The terms of a text (UTF-8) with A-Z lower-cased; bytes beyond ASCII belong to terms."""
    lower = body.lower()
    return _TERM.findall(lower) if len(lower) < _LONG_TEXT else (found[0] for found in _TERM.finditer(lower))


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, from rows of ``lang, source, body``."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), (total, docs_with) in held.items():
                made = [[lang] * len(total), [source] * len(total), list(total), list(total.values()), [docs_with[t] for t in total]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)
            held.clear()

        for batch in batches:
            for lang, source, body in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("body")):
                own = Counter(terms(body.as_py()))
                total, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                total.update(own)
                docs_with.update(own.keys())
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from emit()
        yield from emit()

    made = docs.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return made.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, all_counts: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 1) / all_counts)`` by long division, exact for sums below 9e15."""
    whole, rest = np.divmod(counts + 1, all_counts)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, all_counts)
        whole = whole * 1000 + digit
    return whole + 1


def _share(n: str, all_counts: str) -> Column:
    """The same of columns."""
    return F.expr(f"1 + (cast({n} + 1 as decimal(19, 0)) * {SCALE}BD) div cast({all_counts} as decimal(19, 0))")


def _value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def kept_terms(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: the terms in ``documents`` documents of their language.

    ``first`` marks one row of a term of a language.
    """
    of_term = Window.partitionBy("lang", "term")
    all_rows = count_terms(docs).select(
        "*", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"), (F.row_number().over(of_term.orderBy("source")) == 1).alias("first")
    )
    return all_rows.filter(F.col("lang_docs") >= documents).drop("docs", "lang_docs")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, number`` (from 0 in a language), ``sources`` of the language, and ``total``, ``lang_total``: N + V of either."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("firsts"))
    of_lang = Window.partitionBy("lang")
    made = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["n", "firsts"])
    made = made.withColumns({"terms": F.sum("firsts").over(of_lang), "lang_n": F.sum("n").over(of_lang), "sources": F.count("*").over(of_lang)})
    number = F.row_number().over(of_lang.orderBy("source")) - 1
    return made.select("lang", "source", number.alias("number"), "sources", "terms", (F.col("n") + F.col("terms")).alias("total"), (F.col("lang_n") + F.col("terms")).alias("lang_total"))


def _term_part(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that are more usual in a group than in its language, by value, ranks up to ``top``."""
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "lang_n").agg(F.count("*").alias("terms"))
    cells = cells.join(groups.select(*group, "total", "lang_total"), group).withColumns({"p": _share("n", "total"), "q": _share("lang_n", "lang_total")})
    cells = materialize(cells.filter("p > q").withColumn("value", _value("p", "q")).select(*group, "n", "lang_n", "terms", "value"), "cells")
    # Equal values of different cells are one rank range; as each holds a term, only the first ``top`` can be reached.
    merged = cells.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
    first = merged.withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= top)
    before = F.sum("terms").over(by_value) - F.col("terms")
    reached = first.withColumn("before", before).filter(F.col("before") < top).select(*group, "value", "before")
    reached = materialize(cells.join(reached, [*group, "value"]).select(*group, "n", "lang_n", "value", "before"), "reached")
    found = kept.join(small(reached), [*group, "n", "lang_n"])
    place = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    ranked = found.withColumn("place", place).filter(F.col("place") <= top).withColumn("rank", (F.col("before") + F.col("place")).cast("int"))
    return ranked.filter(F.col("rank") <= top).select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pair_sums(kept: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """``lang, a, b, value``: the sum over all kept terms for each two sources (by number) of a language.

    The terms of a language are dealt to blocks; a block is a table of counts, terms by sources. Terms with the same
    counts everywhere are one cell that counts as often.
    """
    in_block = F.greatest(F.lit(BLOCK_TERMS), F.floor(F.lit(cells) / F.col("sources")))
    known = groups.filter("terms > 0").withColumn("blocks", F.ceil(F.col("terms") / in_block).cast("int"))
    counts = kept.join(known.select("lang", "source", "number", "blocks"), ["lang", "source"])
    counts = counts.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "term", "number", "n")
    sources = known.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("number").alias("place"), "total")

    def compare(counts: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        columns = ["lang", "block", "a", "b", "value"]
        if not len(counts):
            return pd.DataFrame([], columns=columns)
        sources = sources.sort_values("place")
        codes, names = pd.factorize(counts["term"])
        table = np.zeros((len(names), len(sources)), np.int64)
        table[codes, counts["number"]] = counts["n"]
        table, terms = np.unique(table, axis=0, return_counts=True)
        p = shares(table, sources["total"].to_numpy()[None, :])
        rows = []
        for a in range(p.shape[1]):
            apart = p[:, [a]] - p
            rows.append((apart * apart // p * terms[:, None]).sum(axis=0))
        a, b = np.indices((len(rows), len(rows)))
        made = pd.DataFrame({"lang": counts["lang"].iloc[0], "block": counts["block"].iloc[0], "a": a.ravel(), "b": b.ravel(), "value": np.concatenate(rows)})
        return made[made["a"] != made["b"]]

    pairs = counts.groupBy("lang", "block").cogroup(sources.groupBy("lang", "block")).applyInPandas(compare, "lang string, block int, a int, b int, value long")
    return pairs.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _pair_part(kept: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """All other sources of each group's language, by value."""
    sums = _pair_sums(kept, groups, cells)
    own = groups.select("lang", "source", F.col("number").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    pairs = own.join(other, "lang").filter("a <> b").join(sums, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", top: int = TOP, documents: int = DOCUMENTS, cells: int = CELLS
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs.

    With N occurrences of the V kept terms of a language in a group, a term of count c has the share ``p = 1 + floor(SCALE
    * (c + 1) / (N + V))``, and ``f = floor((p - q) ** 2 / q)``. Part ``pair`` sums f over all kept terms against each
    other source of the language (0 without terms); part ``term`` gives f against the language as a whole for the terms the
    group has and has more of, ranks up to ``top``. Values are descending, equal ones in byte order of the item.

    Sums stay below 2 ** 63 as long as V is below 8e9, and N + V is below 9e15. A null text, lang or source is an empty one; every
    row is a document, so repeated rows count each; an empty table gives an empty one; extra columns are not read. The
    result has a row for each two sources of a language, and so has each block of its terms.
    """
    plain = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (lang_col, source_col, text_col)]
    rows = docs.select(plain[0].alias("lang"), plain[1].alias("source"), plain[2].cast("binary").alias("body"))
    kept = materialize(kept_terms(rows, documents), "terms")
    groups = small(materialize(_groups(rows, kept), "groups"))
    return _pair_part(kept, groups, cells).unionByName(_term_part(kept, groups, top))

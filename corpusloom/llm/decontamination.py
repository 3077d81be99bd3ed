"""Benchmark passages in documents, found by winnowed fingerprints. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import NULL_ID, id_key, small
from corpusloom.session import materialize

WINDOW = 10
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII that is not a digit or a small letter parts words.
_PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z in lower case, runs of digits, letters and all that is not ASCII. Null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _PARTS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once; its arrays are then cut without copying them whole."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(values: Column, n: int, made: Callable[[Column, Column], Column], kind: str) -> Column:
    """``made(run, place)`` of every run of ``n`` neighbouring values; places count from 0."""
    runs = F.transform(F.sequence(F.lit(1), F.size(values) - (n - 1)), lambda i: made(F.slice(values, i, n), i - 1))
    return F.when(F.size(values) >= n, runs).otherwise(F.array().cast(f"array<{kind}>"))


def _beside(values: Column, others: Column, shift: int, made: Callable[[Column, Column], Column]) -> Column:
    """``made`` of each value and the one ``shift`` places on among ``others``, null past the end."""
    return F.zip_with(values, F.slice(others, F.lit(shift + 1), F.size(others)), made)


def _grams(words: Column, n: int) -> Column:
    """Hash of every run of ``n`` words."""

    def run(hashes: Column) -> Column:
        made = hashes
        for shift in range(1, n):
            made = _beside(made, hashes, shift, lambda a, b: F.xxhash64(a, b))
        return F.slice(made, F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), run)


def _minima(hashes: Column, span: int) -> Column:
    """The smallest of every ``span`` neighbouring hashes, by minima of 1, 2, 4 ... of them."""

    def wider(values: Column, width: int) -> Column:
        if width == span:
            return values
        step = min(width, span - width)
        return _let(values, lambda v: wider(_beside(v, v, step, lambda a, b: F.least(a, b)), width + step))

    return _let(hashes, lambda h: F.slice(wider(h, 1), F.lit(1), F.greatest(F.size(h) - (span - 1), F.lit(0))))


def _fingerprints(words: Column, length: int, window: int) -> Column:
    """Hashes that two texts share if they share ``length`` words: winnowed for a full window, all for a shorter item."""
    return F.array_distinct(_minima(_grams(words, GRAM), window - GRAM + 1) if length == window else _grams(words, length))


def _windows(words: Column, n: int) -> Column:
    """Every run of ``n`` words as text, with its place."""
    return _let(words, lambda w: _runs(w, n, lambda run, i: F.struct(i.alias("place"), F.array_join(run, " ").alias("window")), "struct<place:int,window:string>"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted strings) and ``spans`` (first word, one past the last).

    Winnowing: of the hashes of ``GRAM`` words that a window of ``window`` words holds, the smallest is kept,
    in items and documents alike, so every window that both have gives a common fingerprint. Documents with a
    fingerprint of the benchmark are then extended: their windows are compared with those of the items as text.
    An item of fewer words is one window of its own length, compared at every place.

    The benchmark's tables are broadcast only when counted small, else joined by shuffling; texts move only if the
    documents with fingerprints are too many to broadcast their ids. A null text has no words, nor has an
    empty one; items without words and null items' texts have no window; a null item id is the string "null".
    Equal rows get equal results, rows with the same id and other texts their own. Empty tables give empty
    results or no hits; extra columns are not read.
    """
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(id_key(id_col).alias("doc"), F.xxhash64(text).alias("row"), text.alias("body"))
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"), words_of(F.col(f"`{item_text}`").cast("string")).alias("words"))
    items = items.withColumn("n", F.least(F.size("words"), F.lit(window))).filter("n > 0")
    lengths = sorted(row["n"] for row in items.select("n").distinct().collect())  # at most ``window`` numbers

    marks = None
    for length in lengths:
        made = _let(F.col("words"), lambda w: _fingerprints(w, length, window))
        own = items.filter(F.col("n") == length).select(F.lit(length).alias("length"), F.explode_outer(made).alias("mark")).filter("mark is not null")
        marks = own if marks is None else marks.unionByName(own)
    if marks is None:
        none = F.array().cast("array<string>"), F.array().cast("array<struct<first:int,past:int>>")
        words = F.size(words_of(F.col("body"))).cast("long")
        return texts.select(_shown(), words.alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none[0].alias("items"), none[1].alias("spans"))

    marks = small(materialize(marks.distinct(), "marks"))

    def profile(words: Column) -> Column:
        each = [F.struct(F.lit(n).alias("length"), _fingerprints(words, n, window).alias("marks")) for n in lengths]
        return F.struct(F.size(words).cast("long").alias("n_words"), F.array(*each).alias("each"))

    profiles = texts.select("doc", "row", _let(words_of(F.col("body")), profile).alias("p")).select("doc", "row", "p.n_words", "p.each")
    profiles = materialize(profiles, "profiles")
    met = profiles.select("doc", "row", F.explode("each").alias("e")).select("doc", "row", "e.length", F.explode("e.marks").alias("mark"))
    met = met.join(marks, ["length", "mark"]).select("doc", "row").distinct()

    suspects = small(materialize(met, "suspects"))
    suspect = texts.join(suspects, ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"]).select("doc", "row", words_of(F.col("body")).alias("words"))
    hits, known = None, None
    for length in lengths:
        own = suspect.select("doc", "row", F.lit(length).alias("length"), F.inline_outer(_windows(F.col("words"), length))).filter("window is not null")
        item = items.filter(F.col("n") == length).select("item", F.inline_outer(_windows(F.col("words"), length))).select("item", "window").filter("window is not null")
        hits = own if hits is None else hits.unionByName(own)
        known = item if known is None else known.unionByName(item)
    known = materialize(known.distinct(), "windows")
    distinct_windows = small(materialize(known.select("window").distinct(), "distinct"))
    hits = materialize(hits.join(distinct_windows, "window"), "hits")

    interval = F.struct(F.col("place").alias("first"), (F.col("place") + F.col("length")).alias("past"))
    ends = F.aggregate(
        F.sort_array(F.collect_set(interval)),
        F.array().cast("array<struct<first:int,past:int>>"),
        lambda made, i: F.when(
            (F.size(made) > 0) & (F.element_at(F.when(F.size(made) > 0, made), -1)["past"] >= i["first"]),
            F.concat(
                F.slice(made, F.lit(1), F.greatest(F.size(made) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(made, -1)["first"].alias("first"), F.greatest(F.element_at(made, -1)["past"], i["past"]).alias("past"))),
            ),
        ).otherwise(F.concat(made, F.array(i))),
    )
    spans = hits.groupBy("doc", "row").agg(ends.alias("spans"))
    named = hits.select("doc", "row", "window").distinct().join(known, "window").groupBy("doc", "row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["past"] - s["first"])
    found = spans.join(named, ["doc", "row"])
    rows = profiles.select("doc", "row", "n_words").join(found, ["doc", "row"], "left")
    return rows.select(
        _shown(),
        "n_words",
        F.coalesce(hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,past:int>>")).alias("spans"),
    )


def _shown() -> Column:
    return F.when(F.col("doc") != F.lit(NULL_ID), F.col("doc")).alias("doc_id")

"""Spelling variants of a corpus: words one edit apart, found by dense prefix-suffix tiles.

Two words are one edit apart if their common prefix and common suffix together reach the length of the
longer one less one. Words meet in tiles: all words that agree outside an interval of positions. A tile with
many words is cut into the two halves of its interval, so every tile that is compared is small, whatever the
vocabulary; at an interval of one position it holds one word per letter of the alphabet at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import small
from corpusloom.session import materialize

LETTERS, OCCURRENCES, TYPO, DOMINANCE = 5, 3, 97, 2
#: Words of a tile, beyond which it is halved; comparisons of code points done at a time.
TILE, CELLS = 256, 1 << 21
#: Counted words that a task holds before it hands them on.
HELD = 300_000
_LONG_TEXT = 1 << 22
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_KEY = ["len", "lo", "hi", "head", "tail"]


def runs(text: str) -> Iterator[str] | list[str]:
    return _RUN.findall(text) if len(text) < _LONG_TEXT else (found[0] for found in _RUN.finditer(text))


def spoiled(run: str, doc_mark: int, typo: int = TYPO) -> str:
    """``run`` of a document, without one code point if ``typo`` divides its hash; ``doc_mark`` is crc32 of ``<doc_id>:``."""
    mark = zlib.crc32(run.encode(), doc_mark)
    if mark % typo:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, least: int = OCCURRENCES) -> DataFrame:
    """``word, n``: the words of at least ``letters`` code points with ``least`` occurrences over all texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, body in zip(batch.column("doc"), batch.column("body")):
                mark = zlib.crc32(f"{doc.as_py()}:".encode())
                for run, n in Counter(runs(body.as_py().lower().decode("utf-8", "replace"))).items():
                    if len(run) >= letters:
                        total[spoiled(run, mark)] += n
                if len(total) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
                    total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)

    texts = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body")
    )
    counted = texts.mapInArrow(count, "word string, n long").filter(F.char_length("word") >= letters)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _halves(rows: DataFrame) -> DataFrame:
    """Rows (word, n, len, lo, hi) in either half of their interval of edit positions, with what the words of a tile share.

    ``len`` is the length of the longer word of a pair; a word has that length or one less.
    """
    middle = F.expr("cast(ceil((lo + hi) / 2) as int)")
    halves = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    made = rows.select("word", "n", "len", F.explode(halves).alias("at")).select("word", "n", "len", "at.*").filter("lo < hi")
    tail = F.expr("substring(word, char_length(word) - (len - hi) + 1, len - hi)")
    return made.withColumn("head", F.expr("substring(word, 1, lo)")).withColumn("tail", tail)


def near_in_tiles(width: int, full: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which words of each tile are near, tiles first: (tile, word, word), true only from a longest word to another row.

    ``codes`` (tile, word, position) are the code points from the first position of the interval on, ``width`` of
    them, 0 where a word has no more; ``full`` (tile, word) marks words of the longer length, one less else. A pair
    is near if prefix and suffix reach ``width - 1``, and belongs to this interval if the prefix ends in it.
    """
    ends = np.where(full[:, :, None], codes[:, :, ::-1], np.concatenate([codes[:, :, -2::-1], np.zeros_like(codes[:, :, :1])], axis=2))
    prefix = np.zeros((*full.shape, full.shape[1]), np.int16)
    suffix, same, same_end = prefix.copy(), np.ones(prefix.shape, bool), np.ones(prefix.shape, bool)
    for k in range(width):
        same &= codes[:, :, None, k] == codes[:, None, :, k]
        same_end &= (ends[:, :, None, k] == ends[:, None, :, k]) & (ends[:, None, :, k] > 0)
        prefix += same
        suffix += same_end
    return full[:, :, None] & (codes[:, None, :, 0] >= 0) & (prefix < width) & (prefix + suffix >= width - 1)


def _best(near: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of each tile: near words and the first of them in ``order``."""
    return near.sum(axis=2), np.where(near, order[:, None, :], np.iinfo(order.dtype).max).min(axis=2)


def _compare(rows: pa.Table, starts: np.ndarray, out: list) -> None:
    """Near words of the tiles that begin at ``starts`` (and end at the last of them), all of one width."""
    width = int(rows["hi"][0].as_py() - rows["lo"][0].as_py())
    part, words, n = rows["part"].to_pylist(), rows["word"].to_pylist(), rows["n"].to_numpy()
    codes = np.array(part, f"U{width}").view(np.int32).reshape(len(part), width)
    full = pc.equal(pc.utf8_length(rows["word"]), rows["len"]).to_numpy(zero_copy_only=False)
    # The order in which a word's near words are wanted: most occurrences first, then the smaller word.
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    by_order = np.argsort(order)
    sizes = np.diff(starts)
    padded = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    for size in np.unique(padded):
        of_size = np.flatnonzero((padded == size) & (sizes > 1))
        step = max(1, CELLS // int(size * max(size, width)))
        for i in range(0, len(of_size), step):
            tiles = of_size[i : i + step]
            at = starts[tiles][:, None] + np.arange(size)
            there = np.arange(size) < sizes[tiles][:, None]
            at = np.where(there, at, 0)
            shown = np.where(there[:, :, None], codes[at], -1)
            near = near_in_tiles(width, full[at] & there, shown)
            both = near | near.transpose(0, 2, 1)
            k, best = _best(both, order[at])
            for t, j in zip(*np.nonzero(k)):
                row, other = at[t, j], by_order[best[t, j]]
                out.append((words[row], int(k[t, j]), int(n[other]), words[other]))


def _near(tiles: DataFrame) -> DataFrame:
    """``word, k, near_n, near``: near words of each word within each tile, and the one that is wanted most."""
    schema = pa.schema([("word", pa.string()), ("k", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def changes(rows: pa.Table, names: list[str]) -> np.ndarray:
        differs = np.zeros(max(rows.num_rows - 1, 0), bool)
        for name in names:
            column = rows[name].combine_chunks()
            differs |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return np.flatnonzero(differs) + 1

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish(rows: pa.Table) -> pa.RecordBatch:
            found: list[tuple] = []
            starts = np.concatenate([[0], changes(rows, _KEY), [rows.num_rows]])
            kinds = [0, *changes(rows, _KEY[:3]), rows.num_rows]
            for a, b in zip(kinds, kinds[1:]):
                own = starts[(starts >= a) & (starts <= b)] - a
                _compare(rows.slice(a, b - a), own, found)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*found) if found else [[]] * 4, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            last = changes(rows, _KEY)
            if len(last):  # the last tile may go on in the next batch
                cut = int(last[-1])
                yield finish(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield finish(pa.Table.from_batches(held))

    # A tile is compared where all its words are: shuffled by what they share, and read in that order.
    dealt = tiles.repartition(*_KEY).sortWithinPartitions(*_KEY).withColumn("part", F.expr("substring(word, lo + 1, hi - lo)"))
    return dealt.mapInArrow(compare, "word string, k long, near_n long, near string")


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n_near, near, near_n``: for each word of ``words`` (word, n; written, distinct) with near words, their number
    and the one with most occurrences, the smaller word in code-point order among equals.

    Every pair lies in exactly one interval of every cut of the positions, so it is found once.
    """
    length = F.char_length("word")
    both = words.withColumn("len", F.explode(F.array(length, length + 1)))
    rows = _halves(both.select("word", "n", "len", F.lit(0).alias("lo"), F.col("len").alias("hi")))
    ready = []
    while True:
        size = rows.groupBy(*_KEY).agg(F.count("*").alias("size"))
        # Those whose interval can be halved: a tile of one position is as small as the alphabet.
        large = small(materialize(size.filter((F.col("size") > tile) & (F.col("hi") - F.col("lo") > 1)).drop("size"), "large"))
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, _KEY, "left_anti"))
        rows = materialize(_halves(rows.join(large, _KEY, "left_semi")), "halves")
    found = None
    for tiles in ready:
        made = _near(tiles.select("word", "n", *_KEY))
        found = made if found is None else found.unionByName(made)
    wanted = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    best = found.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(wanted).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for links (word, form) that lead upwards without a circle: every round the way is twice as long."""
    way = materialize(links.select("word", F.col("form").alias("root")), "way")
    while True:
        ends = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        made = materialize(way.join(ends, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "way")
        if made.filter("moved").isEmpty():
            return made.drop("moved")
        way = made.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, least: int = OCCURRENCES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus.

    Words are maximal runs of Latin letters with only A-Z lower-cased, one code point deleted from those whose hash with the
    document's id says so. A word's form is its near word with most occurrences (the smaller one in code-point order among
    equals) if these are at least ``DOMINANCE`` times its own; else it has none, and is its own root.

    Counts cover all texts. A null text has no words; a null id counts as an empty one; repeated rows count as
    often as they are there; an empty table gives an empty one; extra columns are not read. Words are never cut: a run
    of letters of any length is a word.
    """
    words = materialize(count_words(docs, id_col, text_col, letters, least), "words")
    near = materialize(near_words(words), "near")
    joined = words.join(near, "word", "left")
    led = F.col("near_n") >= DOMINANCE * F.col("n")
    formed = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(led, F.col("near")).alias("form"), F.when(led, F.col("near_n")).alias("form_n")), "formed")
    ends = roots(formed.filter("form is not null").select("word", "form"))
    out = formed.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Documents that share most of their word n-grams: an exact similarity join with prefix trees.

Every document is the set of its n-grams in one global order, rarest first. Two sets that are similar
enough share one of the first few of either, so only documents that share a rare n-gram are compared.
They are compared by storing sets in a prefix tree, common n-grams first, and walking it with another set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from corpusloom.llm.common import hash_words, id_back, keyed_texts, mix, small, window_hashes
from corpusloom.llm.components import components
from corpusloom.session import materialize

WORDS = 5
PERCENT = 75
#: N-grams are ordered by how often their hash's leading bits occur; the table of counts has this many bits.
ORDER_BITS = 20
#: Sets in one prefix tree.
TREE_SETS = 256
#: A document is compared with its leader first if they share one in so many of its rare n-grams.
_LED = 3
#: Members of a component that the documents outside it meet in a round, and the rounds before all others are met.
_MEMBERS, _TURNS = 8, 2
_BLOCK = 16384
#: Tables of counts that are added in one group.
_ADDED = 64
#: Bits of the table of n-grams that documents share, and of one row of it (the size Spark's bitmap functions use).
_MET_BITS, _WORD_BITS = 26, 32768
#: Text, or sets, that a task works on at a time.
PART_BYTES = 2 << 20


def shingles(body: bytes, n: int) -> np.ndarray:
    """Distinct hashes of the word n-grams, ascending; of all words together if they are fewer; none without words."""
    words = body.lower().split()
    hashes = hash_words(words)
    if 0 < len(words) < n:
        return mix(window_hashes(hashes, len(words)) + np.uint64(len(words)))
    return np.unique(mix(window_hashes(hashes, n)))


def common_last(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The hashes renamed so that their order is the global one, rare first: the leading bits give way to their rank."""
    low = np.uint64(64 - ORDER_BITS)
    return np.sort(ranks[(hashes >> low).astype(np.int64)].astype(np.uint64) << low | hashes & np.uint64((1 << int(low)) - 1))


def needed(a: int, b: int, percent: int) -> int:
    """Common elements that sets of sizes ``a`` and ``b`` need for the similarity."""
    return -(-percent * (a + b) // (100 + percent))


class PrefixTree:
    """Sets of globally ordered hashes, most common first, in lexicographic order: sets with a common beginning share its nodes.

    ``shared[i]`` is the length of the path that set i shares with the one before.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        keys = [s[::-1].astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [np.frombuffer(keys[i], ">u8").astype(np.uint64) for i in self.order]
        self.shared = [0] + [self._common(a, b) for a, b in zip(self.sets, self.sets[1:])]

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        size = min(len(a), len(b))
        differ = np.flatnonzero(a[:size] != b[:size])
        return int(differ[0]) if len(differ) else size

    def similar(self, probe: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """(number of the set, common elements) for the sets similar to ``probe`` (ascending).

        Overlaps are counted along the path once and reused by all sets below it. A node's subtree is left
        when what remains of the probe, or of the set, cannot reach the overlap that is needed.
        """
        counts = np.zeros(1, np.int64)  # common elements on the first k nodes of the path
        depth = 0  # nodes of the path that are counted
        for i, (number, found) in enumerate(zip(self.order, self.sets)):
            depth = min(depth, self.shared[i])
            least = needed(len(found), len(probe), percent)
            if min(len(found), len(probe)) < least:
                continue
            while depth < len(found):
                if counts[depth] + len(found) - depth < least or counts[depth] + np.searchsorted(probe, found[depth], "right") < least:
                    break
                step = found[depth : depth + 64]
                at = np.minimum(np.searchsorted(probe, step), len(probe) - 1)
                counts = np.concatenate([counts[: depth + 1], counts[depth] + np.cumsum(probe[at] == step)])
                depth += len(step)
            if depth == len(found) and counts[depth] >= least:
                yield number, int(counts[depth])


def in_parts(batches: Iterator[pa.RecordBatch], column: str = "body", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of batches, of one row or of at most ``most`` bytes (``PART_BYTES``) in ``column``: sets take more room than texts."""
    most = PART_BYTES if most is None else most
    for batch in batches:
        start, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch  # before the next one is read


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """``doc, size, digest`` of every document, and blocks of the counts of n-grams by leading bits, with the number of the task as ``part``."""
    fields = [("doc", pa.int64()), ("size", pa.int64()), ("digest", pa.binary()), ("part", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())]
    schema = pa.schema(fields)

    def rows(n_rows: int, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[name], kind) if name in columns else pa.nulls(n_rows, kind) for name, kind in fields], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low = np.zeros(1 << ORDER_BITS, np.int64), np.uint64(64 - ORDER_BITS)
        for batch in in_parts(batches):
            sets = [shingles(body.as_py(), n) for body in batch.column("body")]
            np.add.at(total, np.concatenate([own >> low for own in sets]).astype(np.int64), 1)
            yield rows(len(sets), doc=batch.column("doc").to_pylist(), size=[len(own) for own in sets], digest=[xxh3_128_digest(own.tobytes()) for own in sets])
        parts = [total[i : i + _BLOCK].tobytes() for i in range(0, len(total), _BLOCK)]
        yield rows(len(parts), part=[TaskContext.get().partitionId()] * len(parts), block=range(len(parts)), counts=parts)

    return docs.mapInArrow(read, "doc long, size long, digest binary, part long, block int, counts binary")


def _ranks(profiles: DataFrame) -> np.ndarray:
    """The rank of each leading-bits value by its count over all documents: a table of fixed size.

    Tasks' counts are added ``_ADDED`` at a time, level by level, so that a group is of a fixed size, too.
    """

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, np.int64) for c in parts["counts"]], axis=0, dtype=np.int64)
        return pd.DataFrame({"block": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})

    summed = profiles.filter("block is not null").select("block", "part", "counts")
    tasks = (summed.agg(F.max("part")).first()[0] or 0) + 1
    while tasks > 1:
        summed = summed.groupBy("block", F.floor(F.col("part") / _ADDED).alias("part")).applyInPandas(add, "block int, part long, counts binary")
        tasks = -(-tasks // _ADDED)
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    for row in summed.collect():  # a table of 2 ** ORDER_BITS numbers whatever the input
        counts[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(bytes(row["counts"]), np.int64)
    ranks = np.empty(len(counts), np.uint32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
    return ranks


def _rare(docs: DataFrame, n: int, percent: int, ranks: Broadcast) -> DataFrame:
    """``token, doc``: the rarest n-grams of each document, so many that similar sets share one of them."""
    schema = pa.schema([("token", pa.int64()), ("doc", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            tokens = []
            for body in batch.column("body"):
                own = common_last(shingles(body.as_py(), n), ranks.value)
                # A similar set has at least this many of ours; one more than the rest must hold one.
                tokens.append(own[: len(own) - -(-percent * len(own) // 100) + 1 if len(own) else 0])
            docs_of = np.repeat(batch.column("doc").to_numpy(), [len(own) for own in tokens])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(docs_of)], schema=schema)

    return docs.mapInArrow(read, "token long, doc long")


def _maybe_met(rare: DataFrame, met: DataFrame) -> DataFrame:
    """The rows of ``rare`` whose n-gram may be in ``met``: a bit table of fixed size rules most others out before they are shuffled."""
    bit = F.col("token").bitwiseAND((1 << _MET_BITS) - 1)
    words = met.select(F.floor(bit / _WORD_BITS).cast("int").alias("word"), (bit % _WORD_BITS).alias("bit")).groupBy("word").agg(F.bitmap_construct_agg("bit").alias("bits"))
    table = np.zeros((1 << _MET_BITS) // 8, np.uint8)
    for row in words.collect():  # at most the table's 8 MB whatever the input
        table[row["word"] * _WORD_BITS // 8 : (row["word"] + 1) * _WORD_BITS // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    shared = rare.sparkSession.sparkContext.broadcast(table)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("token").to_numpy() & ((1 << _MET_BITS) - 1)
            yield batch.filter(pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool)))

    return rare.mapInArrow(keep, rare.schema)


def _sets(docs: DataFrame, n: int, ranks: Broadcast) -> DataFrame:
    """``doc`` and its whole set in the global order, as bytes."""
    schema = pa.schema([("doc", pa.int64()), ("held", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            held = [common_last(shingles(body.as_py(), n), ranks.value).tobytes() for body in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(held, pa.binary())], schema=schema)

    return docs.mapInArrow(read, "doc long, held binary")


def _least(size: Column, percent: int) -> Column:
    """The fewest elements that a set of this size has in common with a similar one."""
    return F.ceil(size * percent / 100)


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` with the component of each document, its own id if no link holds it."""
    return rows.join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of n-grams that several components hold, with the largest component as ``main`` and the rows of the n-gram as ``n``."""
    per_component = rows.groupBy("token", "component").agg(F.count("*").alias("rows"))
    mixed = per_component.groupBy("token").agg(F.max_by("component", "rows").alias("main"), F.sum("rows").alias("n"), F.count("*").alias("parts"))
    return rows.join(mixed.filter("parts > 1").drop("parts"), "token")


def _may(percent: int) -> Column:
    """Whether two documents of different components can be similar, by their sizes and the rare n-grams left from this one on."""
    largest = F.greatest("size", "size_x")
    # All but this many of the common n-grams can lie beyond the rare ones of one of the two.
    common = F.ceil(percent * (F.col("size") + F.col("size_x")) / (100 + percent)) - (_least(largest, percent) - 1)
    return (F.col("component") != F.col("component_x")) & (100 * F.least("size", "size_x") >= percent * largest) & (F.least("left", "left_x") >= common)


def _outside(rows: DataFrame) -> DataFrame:
    """The documents that are not in the largest component of an n-gram, with names ending in ``_x``."""
    return rows.filter("component <> main").select("token", *[F.col(c).alias(f"{c}_x") for c in ("doc", "size", "left", "component")])


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("doc_x", "doc").alias("x"), F.greatest("doc_x", "doc").alias("y")).distinct()


def _own_sets(texts: DataFrame, repeated: DataFrame | None, n: int, ranks: Broadcast) -> DataFrame:
    """``doc`` and its set. Rows with one id are one document; the largest set stands for it, as in its size.

    Only the sets of ids that several rows have (``repeated``, none if there are none) are shuffled for that.
    """
    if repeated is None:
        return _sets(texts, n, ranks)
    largest = _sets(texts.join(repeated, "doc", "left_semi"), n, ranks).groupBy("doc").agg(F.max_by("held", F.length("held")).alias("held"))
    return _sets(texts.join(repeated, "doc", "left_anti"), n, ranks).unionByName(largest)


def _at_trees(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, doc, tree, held``: the y's of an x dealt to prefix trees of bounded size, and x itself to each of them.

    While the places are few they are broadcast, so that the sets are shuffled once, to the trees.
    """
    n_trees = F.ceil(F.col("n") / TREE_SETS).cast("int")
    counted = pairs.groupBy("x").agg(F.count("*").alias("n")).select("x", n_trees.alias("trees"))
    stored = pairs.join(counted, "x").select("x", F.col("y").alias("doc"), F.pmod(F.xxhash64("y"), F.col("trees")).cast("int").alias("tree"))
    probes = counted.select("x", F.col("x").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"))
    return sets.join(small(materialize(stored.unionByName(probes), "places")), "doc").select("x", "doc", "tree", "held")


def _verified(texts: DataFrame, repeated: DataFrame | None, pairs: DataFrame, made: list[DataFrame], n: int, percent: int, ranks: Broadcast) -> DataFrame:
    """The pairs (x, y) that are similar. The y's of an x go to prefix trees of bounded size, x walks each of them.

    ``made`` holds the tables of sets of the rounds before; this round adds one for documents that have none yet.
    """
    pairs = materialize(pairs, "pairs")
    involved = materialize(pairs.select(F.col("x").alias("doc")).union(pairs.select("y")).distinct(), "involved")
    new = involved
    for table in made:
        new = new.join(table.select("doc"), "doc", "left_anti")
    made.append(materialize(_own_sets(texts.join(small(materialize(new, "new")), "doc", "left_semi"), repeated, n, ranks), "sets"))
    sets = reduce(DataFrame.unionByName, made).join(small(involved), "doc", "left_semi")

    def walk(rows: pa.Table) -> pa.Table:
        x, docs, held = rows["x"][0].as_py(), rows["doc"].to_pylist(), rows["held"].to_pylist()
        at = docs.index(x)
        others = [i for i in range(len(docs)) if docs[i] != x]
        tree = PrefixTree([np.frombuffer(held[i], np.uint64) for i in others])
        found = [docs[others[i]] for i, _ in tree.similar(np.frombuffer(held[at], np.uint64), percent)]
        return pa.table({"x": pa.array([x] * len(found), pa.int64()), "y": pa.array(found, pa.int64())})

    return _at_trees(pairs, sets).groupBy("x", "tree").applyInArrow(walk, "x long, y long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links of similar sets lead to.

    Two documents link when ``100 * intersection >= percent * union``. Exact, in these steps:

    1. One pass reads each document's size and digest, and counts n-grams by ``ORDER_BITS`` bits of their hash, which fixes
       the global order (any order is right; this one has common n-grams last). Equal sets become one.
    2. The rarest n-grams of each document are written and counted; only those that two documents share are kept.
    3. Each document is compared with the smallest document of the n-grams it shares, its leader, if they share
       many. So a large group of near copies costs a comparison or two per document, not one per pair. What is
       still outside then meets a few members of the largest component of each n-gram, in a few rounds.
    4. Pairs that share a rare n-gram and are still in different components are compared, unless the sizes, or too
       few rare n-grams from that one on in a common order, rule the similarity out.

    Sets are compared by 64-bit hashes of n-grams. Without words a document is alone. Rows with the same id
    are one document: they link with each other, and the largest set counts for ``n_shingles``. A null id is one
    document before all others. An empty table gives an empty one; extra columns are not read.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_col, text_col)
    profiles = materialize(_profiles(texts, n), "profiles")
    ranks = spark.sparkContext.broadcast(_ranks(profiles))
    known = profiles.filter("block is null").select("doc", "size", "digest")
    first = known.filter("size > 0").groupBy("digest").agg(F.min("doc").alias("first"))
    repeated = materialize(known.groupBy("doc").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc"), "repeated")
    repeated = None if repeated.isEmpty() else small(repeated)

    rare = materialize(_rare(texts, n, percent, ranks), "rare")
    # Written, so that the join below is of two plain shuffles, whose large partitions can be split.
    # Rows of one id count as several here: that costs rows, never results.
    met = rare.groupBy("token").agg(F.min("doc").alias("leader"), F.count("*").alias("rows"))
    met = materialize(met.filter("rows > 1").select("token", "leader"), "met")
    originals = first.join(known.groupBy("digest").agg(F.max("size").alias("size")), "digest").select(F.col("first").alias("doc"), "size")
    shared = materialize(_maybe_met(rare, met).join(met, "token").join(originals, "doc"), "shared")

    # A first round that may miss links: it only saves the second one from comparing large groups of near copies.
    led = shared.filter("doc <> leader").groupBy(F.col("leader").alias("x"), F.col("doc").alias("y")).agg(F.count("*").alias("n"), F.max("size").alias("size"))
    led = led.filter(_LED * F.col("n") >= F.col("size") - _least(F.col("size"), percent)).select("x", "y")
    made: list[DataFrame] = []
    links = materialize(_verified(texts, repeated, led, made, n, percent, ranks), "links")
    label = components(links)

    placed = _labelled(shared.drop("leader"), label)
    open_rows = _mixed(materialize(placed, "placed"))
    # Of the n-grams that x and y share, the first in this order has all others after it in both documents.
    after = Window.partitionBy("doc").orderBy(F.desc("n"), F.desc("token"))
    open_rows = materialize(open_rows.withColumn("left", F.row_number().over(after)).drop("n"), "open")

    # Rounds that may miss links, too: documents meet a few members of the largest component, others each time.
    member = F.struct("doc", "size", "left", "component")
    for turn in range(_TURNS):
        members = [F.min_by(member, F.xxhash64("doc", F.lit(turn * _MEMBERS + i))) for i in range(_MEMBERS)]
        chosen = open_rows.filter("component = main").groupBy("token").agg(F.array_distinct(F.array(*members)).alias("members"))
        some = _outside(open_rows).join(chosen, "token").withColumn("member", F.explode("members")).select("*", "member.*").filter(_may(percent))
        more = _verified(texts, repeated, _pairs(some).join(links, ["x", "y"], "left_anti"), made, n, percent, ranks)
        links = materialize(links.unionByName(more), "links")
        label = components(links)
        open_rows = materialize(_mixed(_labelled(open_rows.drop("component", "main"), label)).drop("n"), "open")

    minor = _outside(open_rows)
    each = minor.join(open_rows, "token").filter(_may(percent) & ((F.col("component") == F.col("main")) | (F.col("doc_x") < F.col("doc"))))
    rest = _verified(texts, repeated, _pairs(each).join(links, ["x", "y"], "left_anti"), made, n, percent, ranks)
    copies = known.join(first, "digest").filter("doc <> first").select(F.col("first").alias("x"), F.col("doc").alias("y"))
    final = components(links.unionByName(rest).unionByName(copies))

    whole = known.groupBy("doc").agg(F.max("size").alias("n_shingles"))
    out = whole.join(final.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component_id", F.coalesce("component", "doc"))
    return out.select(id_back("doc").alias("doc_id"), "n_shingles", id_back("component_id").alias("component_id"))

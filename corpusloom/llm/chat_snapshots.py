"""Chat text of logged conversations, without those that are the beginning of a longer one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

OPENING, CLOSING = "<|im_start|>", "<|im_end|>"
#: Hash of a prefix: sums of 32-bit parts of the hashes of its turns and their positions (a long holds 2^31 of them).
_SUMS = [f"s{i}" for i in range(4)]


def _never_null(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _marked(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with ``key`` (their conversation's id, never null), ``number`` (theirs, likewise) and ``mark`` (hash of role, its length told first, and text)."""
    said = turns.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    mark = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return said.select(_never_null("conv_id").alias("key"), _never_null("turn").alias("number"), "*", mark.alias("mark"))


def _before(rows: DataFrame, *columns: str) -> DataFrame:
    """Per conversation and part, the sums of columns over the parts before it (``before_...``) and over all (``all_...``)."""
    summed = rows.groupBy("key", "part").agg(*(F.sum(c).alias(c) for c in columns))
    all_parts = Window.partitionBy("key")
    earlier = all_parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    made = [e for c in columns for e in (F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}"), F.sum(c).over(all_parts).alias(f"all_{c}"))]
    return summed.select("key", "part", *made)


def numbered_prefixes(marked: DataFrame) -> DataFrame:
    """``key, conv_id, number, mark, position, n_turns`` and the hash of the prefix that ends there, a row per turn.

    Only hashes are sorted; texts only where turns of a conversation share a number. All turns are dealt out by ranges of
    their order, so a conversation of any length is many parts, whose counts and sums are added up.
    """
    turns = marked.groupBy("key", "conv_id", "number", "turn", "mark").agg(F.count(F.lit(1)).alias("n")).drop("n")
    tied = turns.groupBy("key", "number").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = marked.join(tied, ["key", "number"], "left_semi").select("key", "number", "mark", "role", "text").distinct()
    sortable = turns.join(ties, ["key", "number", "mark"], "left")
    order = ["turn", "role", "text"]
    placed = materialize(sortable.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("key", "part").orderBy(*order)
    counts = _before(placed.select("key", "part", F.lit(1).cast("long").alias("turns")), "turns")
    local = placed.withColumn("position", F.row_number().over(inside).cast("long")).join(counts, ["key", "part"])
    at = local.withColumn("position", F.col("position") + F.col("before_turns")).withColumn(
        "hash", F.sha2(F.concat(F.col("position").cast("string"), F.lit(":"), F.hex("mark")), 256)
    )
    parts = [F.conv(F.substring("hash", 1 + 8 * i, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(_SUMS)]
    hashed = materialize(at.select("key", "conv_id", "number", "mark", "part", "position", F.col("all_turns").alias("n_turns"), *parts), "positions")
    so_far = Window.partitionBy("key", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = hashed.select("key", "conv_id", "number", "mark", "part", "position", "n_turns", *(F.sum(s).over(so_far).alias(s) for s in _SUMS))
    whole = summed.join(_before(hashed, *_SUMS), ["key", "part"])
    return whole.select("key", "conv_id", "number", "mark", "position", "n_turns", *((F.col(s) + F.col(f"before_{s}")).alias(s) for s in _SUMS))


def maximal_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, conv_id, n_turns, position, role, text``: the turns of every conversation that no longer one begins with.

    A turn that was logged several times may be several rows. No step puts a conversation into one row or one task.
    """
    marked = _marked(turns, conv, turn, role, text)
    prefixes = materialize(numbered_prefixes(marked), "prefixes")
    path = ["position", *_SUMS]
    ends = prefixes.where("position = n_turns")
    # Equal hashes have equal turns: of those conversations the smallest id stays, a null one after all others.
    alone = ends.groupBy(*path).agg(F.min("conv_id").alias("conv_id"))
    longer = prefixes.where("position < n_turns").select(*path).distinct()
    kept = alone.join(longer, path, "left_anti").select(_never_null("conv_id").alias("key"))
    places = prefixes.join(kept, "key", "left_semi").select("key", "number", "mark", "position", "n_turns")
    return marked.join(places, ["key", "number", "mark"]).select("key", "conv_id", "n_turns", "position", "role", "text")


def maximal_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``n_turns`` and rendered ``text`` of every conversation that no longer one begins with.

    Logs that write a conversation anew after each turn leave snapshots: every one whose hash is that of a proper prefix
    of another conversation goes, by an anti-join on hashes. Of equal conversations the smallest id stays (a null id
    comes after all others). Turns are ordered by number, role and text, a null number first. Rows repeated whole count
    once (a log that was sent twice). A null role or text is an empty one.

    Only the conversations that stay are put together; each is one row of the result, so its text must fit a row (2 GB).
    ``maximal_turns`` gives them as turns, without that limit. A null id is one conversation. Empty tables give empty
    ones; extra columns are not read.
    """
    line = F.concat(F.lit(OPENING), "role", F.lit("\n"), "text", F.lit(CLOSING + "\n"))
    lines = maximal_turns(turns, conv, turn, role, text).select("conv_id", "n_turns", F.struct("position", line.alias("line")).alias("said"))
    made = lines.groupBy("conv_id", "n_turns").agg(F.sort_array(F.collect_set("said")).alias("said"))
    return made.select("conv_id", "n_turns", F.array_join(F.transform("said", lambda s: s["line"]), "").alias("text"))

"""Venue rankings, venue resolution against metadata, and paper selection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import first_element, recode_or_keep
from corpusloom.operators.combine import union_all
from corpusloom.operators.ranking import keep_first
from corpusloom.session import materialize

# Bytes of venue names up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
# Bits of one row of a venue bit table (the size Spark's bitmap functions use), and rows of the table.
BITMAP_BITS = 32_768
BITMAP_WORDS = 2_048


def ranking_from_cells(rows: DataFrame) -> DataFrame:
    """Venue ranking from table rows: venue, h5 index and h5 median by position, null where short."""
    cells = F.col("cells")
    return rows.select(
        F.lit(rules.SOURCE_VENUE_RANKING).alias("source"),
        F.get(cells, F.lit(0)).alias("venue"),
        F.col("field"),
        F.get(cells, F.lit(1)).try_cast("int").alias("h5_index"),
        F.get(cells, F.lit(2)).try_cast("int").alias("h5_median"),
    )


def ranking_names(ranking: DataFrame) -> DataFrame:
    return ranking.select(F.lower("venue").alias("publication"), "h5_index", "h5_median")


def prepared_metadata(metadata: DataFrame, order: str, aliases: Mapping = rules.VENUE_ALIASES) -> DataFrame:
    """One row per display name (the first in ``order``) with its matching name and first ISSN."""
    first = keep_first(metadata, ["display_name"], [order])
    name = F.col("display_name")
    return first.withColumn("display_name_lower", F.lower(recode_or_keep(name, aliases))).withColumn(
        "issn", first_element(F.col("ids.issn"))
    )


def match_by_name(ranking: DataFrame, metadata: DataFrame) -> DataFrame:
    """Ranked publications with the metadata whose name equals theirs; unmatched ones stay, with nulls."""
    found = metadata.select("display_name_lower", "display_name", "issn_l", "issn")
    matched = ranking.join(found, ranking.publication == found.display_name_lower, "left")
    return matched.drop("display_name_lower")


def match_by_identifier(
    missing: DataFrame, metadata: DataFrame, overrides: DataFrame, excluded: str | None = rules.EXCLUDED_VENUE
) -> DataFrame:
    """Second pass for unmatched publications: a table of ``(publication, issn_l)`` given by hand."""
    if excluded is not None:
        missing = missing.where(F.col("publication") != excluded)
    keyed = missing.drop("display_name", "issn_l", "issn").join(overrides, "publication", "left")
    found = metadata.select("issn_l", "display_name", "issn")
    return keyed.join(found, "issn_l", "left")


def resolve_venues(
    ranking: DataFrame,
    metadata: DataFrame,
    overrides: DataFrame,
    order: str,
    aliases: Mapping = rules.VENUE_ALIASES,
    excluded: str | None = rules.EXCLUDED_VENUE,
) -> DataFrame:
    """Ranked publications with their metadata: by name first, else by identifier, one per display name."""
    prepared = prepared_metadata(metadata, order, aliases)
    matched = match_by_name(ranking, prepared)
    missing = matched.where(F.col("display_name").isNull())
    # A name ranked in several fields is looked up once per ranking row, as in the first pass.
    second = match_by_identifier(missing, prepared, overrides, excluded)
    both = union_all(
        matched.where(F.col("display_name").isNotNull()).withColumn("_pass", F.lit(1)),
        second.withColumn("_pass", F.lit(2)),
    )
    first = keep_first(both, ["display_name"], ["_pass", "publication", "h5_index", "h5_median", "issn_l"])
    return first.drop("_pass")


def target_venues(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("display_name").isNotNull()).select(F.col("display_name").alias("venue")).distinct()


def _venue_bits(names: DataFrame) -> DataFrame:
    """A bit table of the venues' hashes: at most 2,048 rows of 4 KB, however many venues there are."""
    bit = _venue_bit(F.col("venue"))
    words = names.select((bit / BITMAP_BITS).cast("int").alias("_word"), F.pmod(bit, F.lit(BITMAP_BITS)).alias("_bit"))
    return words.groupBy("_word").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def _venue_bit(venue: Column) -> Column:
    return F.pmod(F.xxhash64(venue), F.lit(BITMAP_WORDS * BITMAP_BITS))


def _maybe_in(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """``rows`` whose venue's bit is set: all rows of the venues, and few others."""
    bit = _venue_bit(F.col("venue"))
    placed = rows.withColumn("_word", (bit / BITMAP_BITS).cast("int")).join(F.broadcast(bits), "_word")
    at = F.pmod(bit, F.lit(BITMAP_BITS))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return placed.where(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(rows.columns)


def in_venues(rows: DataFrame, venues: DataFrame, key: str, limit: int = BROADCAST_BYTES, salts: int = 64) -> DataFrame:
    """The rows whose ``venue`` is one of ``venues``; a null venue is none.

    The venues are written and measured. Up to ``limit`` bytes of names they are broadcast, and no
    row moves. Beyond it a bit table of their hashes, of fixed size, is broadcast first, so that
    few rows of other venues are left; these meet the names in slices of ``key``, as one venue may
    hold a third of all rows.
    """
    names = materialize(venues.select("venue").where("venue is not null").distinct(), "venues")
    size = names.agg(F.sum(F.octet_length("venue") + 16)).first()[0] or 0
    if size <= limit:
        return rows.join(F.broadcast(names), "venue", "left_semi").select(rows.columns)
    slices = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = _maybe_in(rows, _venue_bits(names)).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    return salted.join(names.withColumn("_salt", slices), ["venue", "_salt"], "left_semi").select(rows.columns)


def select_papers(papers: DataFrame, venues: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(venue, corpusid)`` of parsed papers in the target venues."""
    parsed = papers.where(F.col("s2orc_parsed")).select(
        F.col("works_oa.host_venue.display_name").alias("venue"), "corpusid"
    )
    return in_venues(parsed, venues, "corpusid", limit)

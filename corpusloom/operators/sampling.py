"""Keyword-eligible venues, per-venue sampling, the annotation batch, and the exact split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import composite_key, hash_order, join_tokens, mentions_any, word_count
from corpusloom.operators.ranking import shuffle_cut, shuffled_head, top_k_per_group
from corpusloom.operators.venues import in_venues
from corpusloom.session import materialize, small


def eligible_venues(
    paragraphs: DataFrame,
    keywords: Sequence[str] = rules.STATEMENT_KEYWORDS,
    more_than: int = 2 * rules.SAMPLE_PER_VENUE,
) -> DataFrame:
    """Venues with more than ``more_than`` paragraphs that contain a keyword, with the count."""
    return (
        paragraphs.where(mentions_any(F.col("text"), keywords))
        .groupBy("venue")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > more_than)
    )


def sample_per_venue(
    paragraphs: DataFrame,
    size: int,
    key: str,
    done: DataFrame | None = None,
    done_key: str = "corpusid",
    exclude_first: bool = True,
    seed: int | str = "sample",
) -> DataFrame:
    """``size`` seeded-random rows per venue, without the rows already done.

    Excluding first fills every quota. ``exclude_first=False`` samples first and then drops what is
    done, so quotas may end short.
    """
    if done is None:
        return shuffled_head(paragraphs, ["venue"], key, size, seed)
    done = done.select(done_key).distinct()
    if exclude_first:
        return shuffled_head(paragraphs.join(done, done_key, "left_anti"), ["venue"], key, size, seed)
    return shuffled_head(paragraphs, ["venue"], key, size, seed).join(done, done_key, "left_anti")


def annotation_batch(
    paragraphs: DataFrame,
    done: DataFrame | None = None,
    keywords: Sequence[str] = rules.STATEMENT_KEYWORDS,
    min_words: int = rules.MIN_WORDS,
    max_words: int = rules.MAX_WORDS,
    per_venue: int = rules.SAMPLE_PER_VENUE,
    exclude_first: bool = True,
    seed: int = rules.SEED,
) -> DataFrame:
    """The next paragraphs to annotate: keyword rows of large venues, at most ``per_venue`` each.

    The head per venue is taken before the length filter, so venues may end below ``per_venue``.
    """
    keyed = paragraphs.withColumn("corpusid_unique", composite_key(F.col("corpusid"), F.col("par_id")))
    matching = keyed.where(mentions_any(F.col("text"), keywords))
    # Everything up to the head is decided on keys; texts are fetched last, for the chosen rows only.
    hits = materialize(matching.select("corpusid", "corpusid_unique", "venue"), "hits")
    counted = hits.groupBy("venue").agg(F.count(F.lit(1)).alias("n"))
    pool = in_venues(hits, counted.where(F.col("n") > 2 * per_venue), "corpusid_unique")
    sampled = sample_per_venue(
        pool, 2 * per_venue, "corpusid_unique", done, exclude_first=exclude_first, seed=f"{seed}|sample"
    )
    order = [hash_order(F.col("corpusid_unique"), seed), "corpusid_unique"]
    head = top_k_per_group(sampled, ["venue"], order, per_venue)
    chosen = small(materialize(head.select("venue", "corpusid_unique"), "chosen"))
    rows = matching.join(chosen, ["venue", "corpusid_unique"], "left_semi")
    joined = rows.withColumn("text", join_tokens(F.col("text"))).withColumn("wc", word_count(F.col("text")))
    return joined.where((F.col("wc") > min_words) & (F.col("wc") < max_words)).select(
        "corpusid", "corpusid_unique", "venue", "par_id", "wc", "text"
    )


def overlap_count(batch: DataFrame, done: DataFrame, key: str = "corpusid") -> DataFrame:
    """How many keys two tables share, as one row; 0 is the guard for a fresh batch."""
    shared = batch.select(key).distinct().join(done.select(key), key, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("n_shared"))


def split_exact(
    df: DataFrame, key: str, test_fraction: float = rules.TEST_FRACTION, seed: int | str = rules.SEED
) -> DataFrame:
    """Add ``split``: exactly ceil(fraction * n) seeded-random rows are ``test``, the rest ``train``.

    Labelling is a comparison with one hash value; no row is moved.
    """
    cut = shuffle_cut(df, key, F.ceil(F.lit(test_fraction) * F.col("_total")), seed)
    is_test = hash_order(F.col(key), seed) <= cut
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def split_by_hash(
    df: DataFrame, key: str, test_fraction: float = rules.TEST_FRACTION, seed: int | str = rules.SEED
) -> DataFrame:
    """Add ``split`` from the row's own hash: sizes are near, and rows keep their side as data grow."""
    share = F.conv(F.substring(hash_order(F.col(key), seed), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return df.withColumn("split", F.when(share < test_fraction, F.lit("test")).otherwise(F.lit("train")))

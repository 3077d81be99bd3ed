"""Scalar column expressions: recoding, cascades, text, dates, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules

TOKEN_PATTERN = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy")


# ---- recoding -------------------------------------------------------------------------------
def lookup(col: Column, mapping: Mapping) -> Column:
    """Value of a literal map, null when the key is absent."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, col)


def recode(col: Column, mapping: Mapping, default: str = "other") -> Column:
    """Dictionary recode; anything unmapped, null included, becomes ``default``."""
    return F.coalesce(lookup(col, mapping), F.lit(default))


def recode_or_keep(col: Column, mapping: Mapping) -> Column:
    """Dictionary recode where unmapped values pass through unchanged."""
    return F.coalesce(lookup(col, mapping), col)


def yes_if(condition: Column) -> Column:
    """``yes`` where the condition holds, else ``no`` (unknown counts as not holding)."""
    return F.when(condition, F.lit("yes")).otherwise(F.lit("no"))


def yes_if_member(col: Column, values: Sequence) -> Column:
    return yes_if(col.isin(*values))


def yes_if_present(col: Column) -> Column:
    return yes_if(col.isNotNull())


def binary(label: Column) -> Column:
    """1 for yes, 0 for no, null for every other label."""
    return F.when(label == "yes", 1).when(label == "no", 0)


def binary_label(code: Column) -> Column:
    return F.when(code == 1, F.lit("yes")).otherwise(F.lit("no"))


def phrase_cascade(
    text: Column,
    cascade: Sequence[tuple[str, Sequence[str]]],
    otherwise: str = "other",
    when_null: str = "no_statement",
) -> Column:
    """First category one of whose phrases occurs in the lower-cased text.

    The null test comes last so that the lower-cased text sits in the branch that is always
    evaluated, where it is computed once for the row and shared by all later branches.
    """
    lowered = F.lower(text)
    result = None
    for category, phrases in cascade:
        hit = reduce(Column.__or__, [lowered.contains(p) for p in phrases])
        result = F.when(hit, F.lit(category)) if result is None else result.when(hit, F.lit(category))
    return result.when(text.isNull(), F.lit(when_null)).otherwise(F.lit(otherwise))


def one_hot_label(yes: Column, no: Column, maybe: Column) -> Column:
    """Label from three flags; a later flag wins over an earlier one, no flag keeps ``yes`` as text."""
    return (
        F.when(maybe == 1, F.lit("maybe"))
        .when(no == 1, F.lit("no"))
        .when(yes == 1, F.lit("yes"))
        .otherwise(yes.cast("string"))
    )


# ---- missing values -------------------------------------------------------------------------
def na_to_null(col: Column, tokens: Sequence[str] = rules.NA_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def normalize_na(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the NA tokens of every (or the named) string column into nulls."""
    names = [n for n, t in df.dtypes if t == "string" and (columns is None or n in columns)]
    return df.withColumns({n: na_to_null(F.col(f"`{n}`")) for n in names})


# ---- text -----------------------------------------------------------------------------------
def tokenize(text: Column) -> Column:
    """Words and single punctuation marks, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 1)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def word_count(text: Column) -> Column:
    """Pieces between single spaces; empty pieces count."""
    return F.size(F.split(text, " "))


def word_count_between(text: Column, low: int, high: int) -> Column:
    """Both bounds are exclusive."""
    words = word_count(text)
    return (words > low) & (words < high)


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` (0-based) up to, not including, ``end``."""
    return F.substring(text, start + 1, end - start)


def prefix(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def composite_key(*cols: Column) -> Column:
    return F.concat_ws("_", *cols)


def mentions_any(tokens: Column, keywords: Sequence[str]) -> Column:
    """Whether any keyword is one of the tokens, exactly and case-sensitively."""
    return F.arrays_overlap(tokens, F.array(*[F.lit(k) for k in keywords]))


def position_ratio(col: Column) -> Column:
    """``"3/12"`` becomes 0.25, to three decimals; null when it is not a ratio."""
    parts = F.split(col, "/")
    top, bottom = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.round(F.try_divide(top.try_cast("double"), bottom.try_cast("double")), 3)


# ---- dates ----------------------------------------------------------------------------------
def year_of(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Year of a date written in any of the formats; null when none fits."""
    return F.year(F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats]))


def year_of_yyyymmdd(col: Column) -> Column:
    return F.year(F.try_to_timestamp(col.cast("string"), F.lit("yyyyMMdd")))


def day_stamp(timestamp: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if timestamp is None else timestamp, "yyyyMMdd")


# ---- numbers --------------------------------------------------------------------------------
def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(100 * part / whole, digits)).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column, digits: int = 3) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def with_thousands(n: Column) -> Column:
    return F.format_number(n, 0)


# ---- nested annotation records --------------------------------------------------------------
def first_element(array: Column) -> Column:
    return F.get(array, F.lit(0))


def nth_choice(results: Column, n: int = 0) -> Column:
    """First choice of the first result of the n-th annotation or prediction; null if any level is absent."""
    result = first_element(F.get(results, F.lit(n))["result"])
    return first_element(result["value"]["choices"])


def first_choice(annotations: Column, default: str) -> Column:
    return F.coalesce(nth_choice(annotations), F.lit(default))


# ---- vectors --------------------------------------------------------------------------------
def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; 0 when either vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.try_divide(dot(a, b), norms), F.lit(0.0))


# ---- seeded order ---------------------------------------------------------------------------
def hash_order(key: Column, seed: int | str = rules.SEED) -> Column:
    """A reproducible pseudo-random sort key: the md5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))

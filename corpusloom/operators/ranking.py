"""Keep-first, top-k per group, and exact global ranks without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.columns import hash_order
from corpusloom.session import materialize

# Leading hex digits of the md5 that name a rank bucket: 65,536 buckets, whatever the data size.
BUCKET_DIGITS = 4
# Fewer digits where each group has its own buckets: 4,096, so that counting them shrinks small tables too.
GROUP_DIGITS = 3
# Groups up to which the cuts of a seeded draw are broadcast; beyond, they are joined by shuffling.
BROADCAST_GROUPS = 500_000


def _ascending(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order``; null is a key like any other.

    Each input partition keeps only its own first row per key before the shuffle, so a key holding
    a third of the rows sends one row per partition. String keys are preceded by their 64-bit hash:
    the sort then compares numbers and reads the long texts only on equal hashes.
    """
    types = dict(df.dtypes)
    hashed = [F.xxhash64(F.col(k)) for k in keys if types[k] == "string"]
    window = Window.partitionBy(*hashed, *keys).orderBy(*_ascending(order))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows per group in ``order``.

    For small ``k``, up to ``spark.sql.optimizer.windowGroupLimitThreshold``: Spark prunes every
    partition to ``k`` rows per group before the shuffle. Whole rows are shuffled, so hot groups with
    more to keep belong to ``sliced_top_k``, and seeded draws to ``shuffled_head``.
    """
    window = Window.partitionBy(*group).orderBy(*_ascending(order))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k).drop("_rn")


def sliced_top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], key: str, k: int, slices: int = 256
) -> DataFrame:
    """First ``k`` rows per group in ``order``; slices of a group, by hash of ``key``, are ranked first.

    No task sorts a whole hot group, for any ``k``.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(slices)))
    return top_k_per_group(top_k_per_group(salted, [*group, "_salt"], order, k).drop("_salt"), group, order, k)


def shuffled_head(
    df: DataFrame, group: Sequence[str], key: str, k: int, seed: int | str = rules.SEED
) -> DataFrame:
    """The first ``k`` rows per group after a seeded shuffle, for any ``k``.

    Groups are cut by comparing each row with the hash and key of its group's ``k``-th row, so rows
    stay where they are: only counts per group and hash bucket, and the keys of one bucket per
    group, are shuffled. ``df`` is read three times; write it first if it is costly to make.
    ``key`` must identify a row: rows that repeat the ``k``-th row's key stay together with it. Rows
    with a null key come in the order of their hash, before equal hashes. A null group is a group.
    """
    if k < 1:
        return df.limit(0)
    same = [F.col(f"here.{g}").eqNullSafe(F.col(f"cut.{g}")) for g in group]
    hashed = _hashed(df.select(*dict.fromkeys([*group, key])), key, seed, GROUP_DIGITS)
    sizes = hashed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 4,096 rows per group, however many rows it has.
    through = Window.partitionBy(*group).orderBy("_bucket")
    before = F.sum("_n").over(through) - F.col("_n")
    need = F.lit(k) - before
    buckets = sizes.select(*group, "_bucket", "_n", need.alias("_need")).where("_need > 0 and _need <= _n")
    cut = materialize(buckets.select(*group, "_bucket", "_need"), "cut-buckets")
    few = cut.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    cut = F.broadcast(cut) if few else cut
    inside = hashed.alias("here").join(cut.alias("cut"), [*same, F.expr("here._bucket = cut._bucket")])
    keys = inside.select("here.*", "cut._need")
    within = Window.partitionBy(*group, "_bucket").orderBy("_h", key)
    last = keys.withColumn("_rn", F.row_number().over(within)).where("_rn = _need")
    # One row per row of ``cut``: small if that is.
    last = last.select(*group, F.col("_h").alias("_last"), F.col(key).alias("_last_key"))
    last = F.broadcast(last) if few else last
    rows = df.withColumn("_h", hash_order(F.col(key), seed)).alias("here").join(last.alias("cut"), [*same, F.lit(True)], "left")
    value = F.col(f"here.{key}")
    ahead = (F.col("_h") < F.col("_last")) | (value.isNull() | (value <= F.col("_last_key"))) & (F.col("_h") == F.col("_last"))
    return rows.where(F.col("_last").isNull() | ahead).select([F.col(f"here.`{c}`") for c in df.columns])


def _bucket_starts(hashed: DataFrame) -> DataFrame:
    """Rows per hash bucket with the running count before it: at most 65,536 rows."""
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sizes.select(
        "_bucket",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("_total"),
    )


def _hashed(df: DataFrame, key: str, seed: int | str, digits: int = BUCKET_DIGITS) -> DataFrame:
    return df.withColumn("_h", hash_order(F.col(key), seed)).withColumn("_bucket", F.substring("_h", 1, digits))


def shuffled_rank(
    df: DataFrame,
    key: str,
    seed: int | str = rules.SEED,
    rank: str = "rank",
    limit: int | None = None,
) -> DataFrame:
    """Rank of every row (1-based) in a seeded shuffle of the whole table.

    Rows are counted per hash bucket, each bucket is ranked on its own, and the count of the
    buckets before it is added. Buckets are even because ``key`` identifies a row. With ``limit``
    only the buckets that can hold ranks up to it are read beyond the count.
    """
    hashed = _hashed(df, key, seed)
    starts = _bucket_starts(_hashed(df.select(key), key, seed)).select("_bucket", "_start")
    if limit is not None:
        starts = starts.where(F.col("_start") < limit)
    within = Window.partitionBy("_bucket").orderBy("_h", key)
    ranked = hashed.join(F.broadcast(starts), "_bucket").withColumn(
        rank, F.col("_start") + F.row_number().over(within)
    )
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    return ranked.drop("_h", "_bucket", "_start")


def shuffle_cut(df: DataFrame, key: str, k: Column, seed: int | str = rules.SEED) -> Column:
    """The hash of the ``k``-th row of a seeded shuffle, as a one-value subquery.

    ``k`` may use ``_total``, the number of rows. Comparing ``hash_order`` with the cut selects
    exactly ``k`` rows in a pass that moves no row. Only the bucket the cut falls in is ranked.
    """
    hashed = _hashed(df.select(key), key, seed)
    here = (
        _bucket_starts(hashed)
        .withColumn("_need", k - F.col("_start"))
        .where((F.col("_need") > 0) & (F.col("_need") <= F.col("_n")))
        .select("_bucket", "_need")
    )
    within = Window.partitionBy("_bucket").orderBy("_h")
    return (
        hashed.join(F.broadcast(here), "_bucket")
        .withColumn("_rn", F.row_number().over(within))
        .where(F.col("_rn") == F.col("_need"))
        .agg(F.max("_h"))
        .scalar()
    )


def take_shuffled(df: DataFrame, key: str, k: int, seed: int | str = rules.SEED, strict: bool = True) -> DataFrame:
    """Exactly ``k`` rows drawn without replacement; an error when there are fewer and ``strict``."""
    cut = shuffle_cut(df, key, F.lit(k), seed)
    if strict:
        none = F.raise_error(F.lit(f"cannot draw {k} rows without replacement: the pool is smaller"))
        limit = F.coalesce(cut, none) if k > 0 else F.lit("")
    else:
        limit = F.coalesce(cut, F.lit("g"))
    return df.where(hash_order(F.col(key), seed) <= limit)


def draw_with_replacement(df: DataFrame, key: str, n: int, seed: int | str = rules.SEED) -> DataFrame:
    """The distinct rows hit by ``n`` seeded draws with replacement, so at most ``n`` rows.

    Only keys are ranked; whole rows are then picked by key.
    """
    spark = df.sparkSession
    total = df.select(key).agg(F.count(F.lit(1))).scalar()
    # 15 hexadecimal digits: far more than there are rows, and still a bigint. An empty table has no row to draw.
    number = F.conv(F.substring(hash_order(F.col("id"), f"{seed}|draw"), 1, 15), 16, 10).cast("bigint")
    draws = spark.range(n).select((F.try_mod(number, total) + 1).alias("_rank")).distinct()
    ranked = shuffled_rank(df.select(key), key, seed, rank="_rank")
    drawn = ranked.join(draws, "_rank", "left_semi").select(key)
    return df.join(drawn, key, "left_semi")

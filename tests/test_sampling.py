import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import assign, ranking, sampling, stats

NAMES = ("a@example.org", "b@example.org", "c@example.org", "d@example.org")


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 4, 5, 35, 501])
def test_split_sizes_are_exact(spark, n):
    got = {r["split"]: r["count"] for r in sampling.split_exact(spark.range(n), "id").groupBy("split").count().collect()}
    test = -(-n * 2 // 10)
    assert got.get("test", 0) == test and got.get("train", 0) == n - test


def test_split_does_not_depend_on_partitioning(spark):
    one = sampling.split_exact(spark.range(0, 300, 1, 1), "id").where("split = 'test'")
    many = sampling.split_exact(spark.range(0, 300, 1, 7), "id").where("split = 'test'")
    expected = sorted(range(300), key=digest)[:60]
    assert sorted(r.id for r in one.collect()) == sorted(r.id for r in many.collect()) == sorted(expected)


def test_split_moves_no_rows(spark):
    plan = sampling.split_exact(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    outside_subquery = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]
    assert not any("Exchange" in line or "Join" in line for line in outside_subquery)


def test_split_by_hash_is_stable_under_growth(spark):
    small = {r.id: r.split for r in sampling.split_by_hash(spark.range(200), "id").collect()}
    large = {r.id: r.split for r in sampling.split_by_hash(spark.range(2000), "id").collect()}
    assert all(large[k] == v for k, v in small.items())
    assert 300 < sum(v == "test" for v in large.values()) < 500


def test_take_is_exact_and_checks_the_pool(spark):
    pool = spark.range(100)
    assert sorted(r.id for r in ranking.take_shuffled(pool, "id", 7).collect()) == sorted(sorted(range(100), key=digest)[:7])
    assert ranking.take_shuffled(pool, "id", 100).count() == 100
    assert ranking.take_shuffled(pool, "id", 0).count() == 0
    assert ranking.take_shuffled(pool, "id", 101, strict=False).count() == 100
    with pytest.raises(Exception, match="smaller"):
        ranking.take_shuffled(pool, "id", 101).count()


def test_shuffled_rank_covers_every_rank(spark):
    got = [r.id for r in ranking.shuffled_rank(spark.range(500), "id").orderBy("rank").collect()]
    assert got == sorted(range(500), key=digest)
    limited = ranking.shuffled_rank(spark.range(500), "id", limit=9).orderBy("rank").collect()
    assert [(r.id, r["rank"]) for r in limited] == [(k, i + 1) for i, k in enumerate(got[:9])]


def test_draws_with_replacement_are_at_most_n(spark):
    assert 40 < ranking.draw_with_replacement(spark.range(60), "id", 120).count() <= 60
    assert ranking.draw_with_replacement(spark.range(10_000), "id", 20).count() <= 20


def test_keep_first_is_ordered_and_treats_null_as_a_key(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), (None, 5), (None, 2), ("y", 9)], "k string, seq int").repartition(5)
    got = sorted(((r.k, r.seq) for r in ranking.keep_first(df, ["k"], ["seq"]).collect()), key=str)
    assert got == sorted([("x", 1), (None, 2), ("y", 9)], key=str)


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).cast("string").alias("k"), "id")
    plan = ranking.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


@pytest.mark.parametrize("k", [3, 1200])
def test_top_k_with_a_hot_group(spark, k):
    # Two thirds of the rows belong to one group.
    df = spark.range(4500).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"))
    got = ranking.shuffled_head(df, ["g"], "id", k)
    hot = sorted((i for i in range(4500) if i % 3 > 0), key=digest)[:k]
    assert sorted(r.id for r in got.where("g = 'hot'").collect()) == sorted(hot)
    sizes = {r["g"]: r["count"] for r in got.groupBy("g").count().collect()}
    assert sizes == {"hot": min(k, 3000), **{f"g{i}": min(k, 300) for i in range(5)}}


def executed(df):
    """Lines of the plan that ran, once it has."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [10, 2000])
def test_head_shuffles_keys_but_no_texts(spark, k, tmp_path):
    spark.range(6000).select("id", (F.col("id") % 2).alias("g"), F.repeat(F.lit("word "), 50).alias("text")).write.parquet(str(tmp_path / "t"))
    head = ranking.shuffled_head(spark.read.parquet(str(tmp_path / "t")), ["g"], "id", k)
    assert head.count() == 2 * k
    executed(head)
    plan = head._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = [block for block in plan.split("\n\n") if "Input [" in block]
    moved = [block for block in blocks if "Exchange" in block.strip().splitlines()[0]]
    assert any("id#" in block for block in moved) and not any("text#" in block for block in moved), moved
    # The rows themselves meet their cuts by broadcast only.
    joins = [block for block in blocks if "Join" in block.strip().splitlines()[0]]
    assert not any("SortMergeJoin" in block.strip().splitlines()[0] for block in joins)


def test_head_with_null_groups_few_rows_and_clashing_names(spark):
    rows = [(i, None if i % 3 == 0 else "a", i * 2, "x") for i in range(30)] + [(100, "b", 1, None), (101, "", 2, "y")]
    df = spark.createDataFrame(rows, "id bigint, g string, cut int, here string")
    got = ranking.shuffled_head(df, ["g"], "id", 4)
    assert got.columns == df.columns
    kept = {}
    for row in got.collect():
        kept.setdefault(row.g, []).append(row.id)
    expected = {None: [i for i in range(30) if i % 3 == 0], "a": [i for i in range(30) if i % 3], "b": [100], "": [101]}
    assert {g: sorted(ids) for g, ids in kept.items()} == {g: sorted(sorted(ids, key=digest)[:4]) for g, ids in expected.items()}
    assert ranking.shuffled_head(df, ["g"], "id", 0).count() == 0
    assert ranking.shuffled_head(df.limit(0), ["g"], "id", 4).count() == 0
    assert ranking.shuffled_head(df, [], "id", 5).count() == 5


def test_head_keeps_rows_that_repeat_the_last_key_together(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(40)], "id int, n int")
    got = ranking.shuffled_head(df, [], "id", 15)
    first = sorted(range(4), key=digest)[:2]
    assert sorted(r.n for r in got.collect()) == [i for i in range(40) if i % 4 in first]


def test_head_over_two_group_columns_does_not_depend_on_partitions(spark):
    df = spark.range(900).select("id", (F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"))
    heads = [ranking.shuffled_head(df.repartition(n), ["a", "b"], "id", 20) for n in (1, 7)]
    got = [sorted(r.id for r in head.collect()) for head in heads]
    assert got[0] == got[1] and len(got[0]) == 120


def test_slices_rank_as_one_group(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).alias("few"))
    got = ranking.sliced_top_k(df, ["few"], [F.col("id").desc()], "id", 1200, slices=7)
    expected = [i for i in range(4999, -1, -1) if i % 10][:1200] + list(range(0, 5000, 10))
    assert sorted(r.id for r in got.collect()) == sorted(expected)


def paragraphs(spark):
    """Venue big: 9 keyword rows; venue edge: exactly 4; venue odd: other tokens only."""
    rows = [(i, "big", 0, ["the", "data"] + ["w"] * (i + 1)) for i in range(9)]
    rows += [(100 + i, "edge", 0, ["data"]) for i in range(4)]
    rows += [(200 + i, "odd", 0, ["Data", "dataset"]) for i in range(9)]
    return spark.createDataFrame(rows, "corpusid bigint, venue string, par_id int, text array<string>")


def test_eligible_venues_need_more_than_n(spark):
    assert {r.venue: r.n for r in sampling.eligible_venues(paragraphs(spark), more_than=4).collect()} == {"big": 9}
    assert {r.venue for r in sampling.eligible_venues(paragraphs(spark), more_than=3).collect()} == {"big", "edge"}


def test_batch_takes_the_head_before_the_length_filter(spark):
    batch = sampling.annotation_batch(paragraphs(spark), min_words=5, max_words=9, per_venue=4)
    sampled = sorted((f"{i}_0" for i in range(9)), key=lambda k: digest(k, "42|sample"))[:8]
    head = sorted(sampled, key=digest)[:4]
    expected = [k for k in head if 5 < int(k.split("_")[0]) + 3 < 9]
    assert sorted(r.corpusid_unique for r in batch.collect()) == sorted(expected)


def test_batch_excludes_done_papers(spark):
    done = spark.createDataFrame([(i,) for i in range(5)], "corpusid bigint")
    for first in (True, False):
        batch = sampling.annotation_batch(paragraphs(spark), done, min_words=0, per_venue=4, exclude_first=first)
        assert sampling.overlap_count(batch, done).first()[0] == 0
        assert batch.count() <= 4
    assert sampling.annotation_batch(paragraphs(spark), done, min_words=0, per_venue=4).count() == 4


def test_assignment_is_disjoint_and_exact(spark):
    given = assign.assign(spark.range(100), "id", NAMES, 20)
    assert given.count() == given.select("id").distinct().count() == 80
    assert {r["annotator"]: r["count"] for r in given.groupBy("annotator").count().collect()} == dict.fromkeys(NAMES, 20)
    assert assign.remaining(spark.range(100), given, "id").count() == 20
    by_rank = sorted(range(100), key=digest)
    assert sorted(r.id for r in given.where(F.col("annotator") == NAMES[1]).collect()) == sorted(by_rank[20:40])


def test_overlap_gives_each_annotator_rows_of_every_other(spark):
    given = assign.assign(spark.range(100), "id", NAMES, 20)
    both = assign.with_overlap(given, "id", NAMES, 15)
    counts = {(r.annotator, r.owner): r["count"] for r in both.groupBy("annotator", "owner").count().collect()}
    assert counts == {(a, o): 20 if a == o else 15 for a in NAMES for o in NAMES}


def test_quadrants(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, -1.0, 1.0), (3, -1.0, -1.0), (4, 1.0, -1.0)], "id bigint, x double, y double")
    placed = {r.id: r.quadrant for r in assign.with_quadrant(df).collect()}
    assert placed == {1: 0, 2: 1, 3: 2, 4: 3}
    given = assign.assign_quadrants(df, "id", NAMES, 5)
    assert {r.id: r.annotator for r in given.collect()} == dict(zip([1, 2, 3, 4], NAMES))


def test_consensus_counts_an_annotator_once(spark):
    votes = spark.createDataFrame(
        [("i", "a", 1), ("i", "a", 1), ("i", "b", 0), ("j", "a", 1), ("j", "b", 1)], "item string, who string, vote int"
    )
    got = {r["item"]: (r.n_annotators, r.score, r.clear, r.unanimous) for r in stats.consensus(votes, "item", "who", "vote").collect()}
    assert got == {"i": (2, 0.5, 0, 0), "j": (2, 1.0, 1, 1)}


def test_batch_fetches_texts_last(spark, tmp_path):
    paragraphs(spark).write.parquet(str(tmp_path / "p"))
    batch = sampling.annotation_batch(spark.read.parquet(str(tmp_path / "p")), min_words=0, per_venue=2)
    assert batch.count() == 2
    exchanges = [line for line in executed(batch).splitlines() if "Exchange " in line]
    assert exchanges and all("BroadcastExchange" in line for line in exchanges)

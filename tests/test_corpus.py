import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom import rules, schemas
from corpusloom.operators import combine, dedup, embed, predict, rounds, similarity, spans, stats, training, venues
from corpusloom.operators.similarity import Layout
from corpusloom.plans import annotation, corpus

SMALL = Layout(block_rows=16, sample_rows=64, max_pivots=8, leaders=8, hot_cell_rows=24, tail_rows=4, matches=2)


# ---- spans ----------------------------------------------------------------------------------
TEXT = "Tête\U0001f600 un. Zwei zwei. Drei"
DOCS = [
    # id, text, paragraphs, headers
    (1, TEXT, '[{"start":0,"end":9},{"start":10,"end":20}]', None),
    (2, TEXT, '[{"start":0,"end":9},{"start":10,"end":20}]', ""),
    (3, TEXT, '[{"start":0,"end":9},{"start":10,"end":20}]', "[]"),
    (4, TEXT, '[{"start":"0","end":"9"},{"start":"10","end":"20"},{"start":21,"end":999}]', '[{"start":"21","end":"25"},{"start":5,"end":6}]'),
    (5, TEXT, None, None),
    (6, TEXT, "not json", None),
    (7, TEXT, '[{"start":21,"end":999}]', None),
]


def full_text(spark):
    rows = [(i, (text, (par, head))) for i, text, par, head in DOCS]
    return spark.createDataFrame(rows, schemas.FULL_TEXT)


def test_paragraph_rules(spark):
    got = {}
    for r in spans.cut_paragraphs(full_text(spark), "corpusid").orderBy("corpusid", "par_id").collect():
        got.setdefault(r.corpusid, []).append((r.par_id, r.paragraph))
    both = [(0, TEXT[0:9]), (1, TEXT[10:20])]
    assert got == {1: both, 2: both, 4: both, 7: [(0, TEXT[21:999])]}


def test_paragraph_extraction_joins_the_mapping(spark):
    texts = full_text(spark).unionByName(full_text(spark).where("corpusid = 1"))
    mapping = spark.createDataFrame([("A", 1), ("B", 1), ("A", 7), ("A", 99)], "venue string, corpusid bigint")
    got = sorted((r.corpusid, r.venue, r.par_id) for r in spans.extract_paragraphs(mapping, texts).collect())
    assert got == [(1, "A", 0), (1, "A", 1), (1, "B", 0), (1, "B", 1), (7, "A", 0)]
    counts = stats.extraction_counts(mapping, spans.extract_paragraphs(mapping, texts)).first()
    assert tuple(counts) == (2, 4, 5)


# ---- venues ---------------------------------------------------------------------------------
def test_venue_resolution(spark):
    ranking = spark.createDataFrame(
        [("s", "Nature", "a", 9, 9), ("s", "Nature", "b", 9, 9), ("s", "The Lancet Oncology", "a", 5, 6),
         ("s", "CVPR", "c", 3, 4), ("s", "Unknown", "c", 1, 1), ("s", "IEEE/CVF International Conference on Computer Vision", "c", 2, 2)],
        schemas.VENUE_RANKING,
    )
    metadata = spark.createDataFrame(
        [("NATURE", None, None, (["1", "2"],), "n1"), ("Nature", None, None, ([],), "n2"), ("Nature", None, None, None, "n3"),
         ("Lancet Oncology", None, None, (None,), "l"), ("Computer Vision Conf", None, None, (["7"],), "1063-6919")],
        schemas.VENUE_METADATA,
    ).withColumn("row", F.monotonically_increasing_id())
    overrides = spark.createDataFrame([("cvpr", "1063-6919")], "publication string, issn_l string")
    got = venues.resolve_venues(venues.ranking_names(ranking), metadata, overrides, "row")
    found = {r.display_name: (r.publication, r.issn_l, r.issn) for r in got.collect()}
    assert found == {
        "NATURE": ("nature", "n1", "1"),
        "Nature": ("nature", "n2", None),
        "Lancet Oncology": ("the lancet oncology", "l", None),
        "Computer Vision Conf": ("cvpr", "1063-6919", "7"),
        None: ("unknown", None, None),
    }
    assert venues.target_venues(got).count() == 4


def papers(spark):
    def host(name):
        return ((name,),)

    rows = [(1, host("A"), True), (2, host("A"), False), (3, host("A"), None), (4, None, True), (5, host("X"), True), (6, host("B"), True), (6, host("A"), True)]
    return spark.createDataFrame(rows, schemas.PAPERS)


def test_paper_selection_and_coverage(spark):
    targets = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "venue string")
    got = venues.select_papers(papers(spark), targets)
    assert sorted((r.venue, r.corpusid) for r in got.collect()) == [("A", 1), ("A", 6), ("B", 6)]
    assert tuple(stats.venue_coverage(targets, got).first()) == (3, 2, 3)


def test_paper_selection_is_the_same_on_both_sides_of_the_limit(spark, tmp_path):
    name = F.concat(F.lit("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500))
    rows = spark.range(6000).select(name.alias("venue"), F.col("id").alias("key"), F.lit("x").alias("_extra"))
    rows.unionByName(spark.createDataFrame([(None, -1, "x"), ("", -2, "x")], rows.schema)).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    targets = spark.createDataFrame([("v0",), ("v7",), ("v7",), ("",), (None,), ("none such",)], "venue string")
    expected = sorted([i for i in range(6000) if i % 3 == 0 or i % 500 in (0, 7)] + [-2])
    for limit in (1 << 20, 0):
        got = venues.in_venues(rows, targets, "key", limit)
        assert got.columns == rows.columns
        assert sorted(r.key for r in got.collect()) == expected
    assert venues.in_venues(rows, targets.limit(0), "key", 0).count() == 0
    assert venues.in_venues(rows.limit(0), targets, "key", 0).count() == 0


def test_bit_table_keeps_all_rows_of_the_venues_and_few_others(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("venue"))
    names = rows.where("venue % 10 = 0")
    left = {r.venue for r in venues._maybe_in(rows, venues._venue_bits(names)).collect()}
    assert {str(i) for i in range(0, 20_000, 10)} <= left and len(left) < 2_010


def test_papers_of_few_venues_are_not_shuffled(spark, tmp_path):
    papers(spark).write.parquet(str(tmp_path / "p"))
    got = venues.select_papers(spark.read.parquet(str(tmp_path / "p")), spark.createDataFrame([("A",)], "venue string"))
    got.write.format("noop").mode("overwrite").save()
    moved = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]
    assert moved and all("BroadcastExchange" in line for line in moved)


# ---- annotation rounds ----------------------------------------------------------------------
def test_rounds_merge_to_common_labels(spark):
    text = spark.createDataFrame([("t", 1, "data availability statement"), ("t", 2, "not"), ("t", 3, "Yes"), ("t", 4, None)], "text string, corpusid bigint, sentiment string")
    flags = spark.createDataFrame([("t", 5, 1, 0, 0, "3/4", 1), ("t", 6, 0, 0, 1, "1/4", 2)], "text string, corpusid bigint, Yes int, No int, Maybe int, section string, subsection int")
    codes = spark.createDataFrame([("t", 7, 2.0), ("t", 8, None)], "text string, corpusid bigint, is_data_availability double")
    merged = rounds.merge_rounds(rounds.from_text_labels(text, "a"), rounds.from_flags(flags, "b"), rounds.from_codes(codes, "c"))
    assert {r.corpusid: r.sentiment for r in merged.collect()} == {1: "yes", 2: "no", 3: "yes", 5: "yes", 6: "maybe", 7: "no"}
    assert {r.sentiment: r["count"] for r in stats.value_counts(merged, "sentiment").collect()} == {"yes": 3, "no": 2, "maybe": 1}


# ---- statistics on nothing ------------------------------------------------------------------
def test_statistics_of_empty_tables(spark):
    empty = spark.createDataFrame([], schemas.UNIFIED)
    assert tuple(stats.total_stats(empty).first()) == (0, 0, 0, 0.0)
    assert tuple(stats.branch_stats(empty).first()) == (0, 0, 0.0)
    assert stats.source_stats(empty).count() == 0
    assert {r.lang: r.n_rows for r in stats.configured_counts(spark.createDataFrame([("a",)], "lang string"), "lang", ["a", "b"]).collect()} == {"a": 1, "b": 0}


# ---- semantic de-duplication ----------------------------------------------------------------
def greedy(ids, vectors, threshold):
    norms = np.linalg.norm(vectors, axis=1)
    kept = []
    for i in np.argsort(ids):
        units = [vectors[j] / norms[j] for j in kept if norms[j]]
        if norms[i] and any(u @ (vectors[i] / norms[i]) >= threshold - 1e-12 for u in units):
            continue
        kept.append(i)
    return sorted(int(ids[i]) for i in kept)


def vector_table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "seq bigint, v array<float>")


def kept(df, threshold, layout=Layout()):
    return sorted(r.seq for r in similarity.greedy_kept(df, "seq", "v", threshold, layout).collect())


def test_chain_keeps_both_ends(spark):
    angles = [0.0, 0.5, 1.0]
    df = vector_table(spark, [1, 2, 3], [[np.cos(a), np.sin(a)] for a in angles])
    assert kept(df, 0.85) == [1, 3]
    assert {r.seq: r.first_match for r in similarity.first_similar(df, "seq", "v", 0.85).collect()} == {2: 1, 3: 2}


def test_edge_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [2.0, 0.0]), (5, None), (6, [1.0, 0.0]), (7, [1.0, 1.7320508])]
    df = spark.createDataFrame(rows, "seq bigint, v array<float>")
    assert kept(df, 0.85) == [1, 2, 3, 5, 7]
    matches = {r.seq: r.first_match for r in similarity.first_similar(df, "seq", "v", 0.85).collect()}
    assert matches == {4: 3, 6: 3}
    assert kept(df.where("seq in (1, 5)"), 0.85) == [1, 5]


def test_vectors_are_compared_in_double_precision(spark):
    """Numbers that single precision cannot hold, and cosines nearer to the threshold than it can tell."""
    far = [(1, [1e300, 0.0]), (2, [0.0, 1e-300]), (3, [1e300, 1e290])]
    near = [(4 + i, [1.0, 0.0] if i == 0 else [c, (1 - c * c) ** 0.5]) for i, c in enumerate([1.0, 0.85 - 1e-9])]
    for rows, want in ((far, [1, 2]), (near, [4, 5])):
        df = spark.createDataFrame(rows, "seq long, v array<double>")
        assert sorted(r.seq for r in similarity.greedy_kept(df, "seq", "v", 0.85).collect()) == want
    df = spark.createDataFrame(far, "seq long, v array<double>")
    assert [tuple(r) for r in similarity.first_similar(df, "seq", "v", 0.85).collect()] == [(3, 1)]


def test_similarity_at_the_threshold_removes(spark):
    df = vector_table(spark, [1, 2], [[1.0, 1.0, 0.0, 0.0], [1.0, 0.0, 1.0, 0.0]])
    assert kept(df, 0.5) == [1] and kept(df, 0.51) == [1, 2]


@pytest.mark.parametrize("threshold", [0.85, 0.4])
@pytest.mark.parametrize("layout", [Layout(), SMALL, Layout(block_rows=20, max_pivots=4, hot_cell_rows=10**9, tail_rows=0, matches=1)])
def test_equals_the_sequential_walk_with_a_hot_group(spark, threshold, layout):
    random_state = np.random.default_rng(7)
    centres = random_state.normal(size=(12, 6))
    spread = centres[random_state.integers(0, 12, 150)] + random_state.normal(size=(150, 6)) * 0.4
    hot = centres[:1] + random_state.normal(size=(80, 6)) * 0.03  # near copies
    copies = np.repeat(centres[1:2], 40, axis=0)
    vectors = np.concatenate([spread, hot, copies]).astype(np.float32)
    ids = random_state.permutation(len(vectors)) * 3
    df = vector_table(spark, ids, vectors).repartition(5)
    assert kept(df, threshold, layout) == greedy(ids, vectors.astype(float), threshold)
    matches = {r.seq: r.first_match for r in similarity.first_similar(df, "seq", "v", threshold, layout).collect()}
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    near = units @ units.T >= threshold - 1e-12
    expected = {int(ids[b]): int(min(ids[near[b] & (ids < ids[b])])) for b in range(len(ids)) if (near[b] & (ids < ids[b])).any()}
    assert matches == expected


def test_pivot_cells_miss_no_pair():
    random_state = np.random.default_rng(3)
    for threshold in (0.3, 0.85, 0.95):
        centres = random_state.normal(size=(20, 5))
        rows = centres[random_state.integers(0, 20, 400)] + random_state.normal(size=(400, 5)) * 0.3
        units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        home, copy = similarity._cells(units, units[:16], similarity._eps(threshold))
        where = copy.copy()
        where[np.arange(400), home] = True
        a, b = np.nonzero(units @ units.T >= threshold)
        meets = where[a] & where[b] & ((home[a][:, None] == np.arange(16)) | (home[b][:, None] == np.arange(16)))
        # Together in exactly one cell where at least one of the two is at home.
        assert (meets.sum(axis=1) == 1).all()


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000), st.integers(2, 40))
def test_block_kernel_finds_the_earliest(seed, n):
    random_state = np.random.default_rng(seed)
    rows = random_state.normal(size=(n, 3))
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    seq = random_state.permutation(n)
    found = similarity._earliest(units, seq, units, seq, 0.7)
    for i in range(n):
        earlier = [s for s, u in zip(seq, units) if s < seq[i] and u @ units[i] >= 0.7]
        assert found[i] == (min(earlier) if earlier else np.iinfo(np.int64).max)
        for most in (1, 3):
            rows, near = similarity._matches(units, seq, units, seq, 0.7, most)
            assert sorted(near[rows == i]) == sorted(earlier)[:most]


# ---- the de-duplication pipeline ------------------------------------------------------------
def annotations(spark):
    rows = [
        ("s", "same text here", "v", None, "yes", "c", 0, 1),
        ("s", "same text here", "v", None, "no", "c", 0, 2),
        ("s", "another text, quite different", "v", None, "no", "c", 1, 1),
        ("s", "unclear text", "v", None, "maybe", "c", 1, 2),
        ("s", None, "v", None, "yes", "c", 1, 3),
        ("s", "unlabelled", "v", None, None, "c", 1, 4),
        ("s", "same text here!", "v", None, "yes", "c", 2, 1),
    ]
    schema = ", ".join(f"{c} string" for c in schemas.UNIFIED_COLUMNS) + ", source_rank int, row_key bigint"
    return spark.createDataFrame(rows, schema)


def letters(df):
    return embed.embed_with(df, lambda: lambda texts: np.array([[t.count(c) for c in "aehnrst"] for t in texts], dtype=float))


def test_pipeline_counts_every_stage(spark):
    result = dedup.deduplicate(annotations(spark), ["source_rank", "row_key"], letters, 0.99)
    assert result.error is None
    assert [(r.text, r.sentiment) for r in result.rows.orderBy("seq").collect()] == [
        ("same text here", "yes"),
        ("another text, quite different", "no"),
    ]
    assert result.stats.first().asDict() == {
        "original_count": 5, "cleaned_count": 4, "exact_dedup_count": 3, "final_count": 2,
        "exact_duplicates_removed": 1, "semantic_duplicates_removed": 1, "total_removed": 3, "removal_percentage": 60.0,
    }
    assert result.semantic_success


def test_pipeline_when_disabled_and_when_the_model_fails(spark):
    def broken(df):
        raise RuntimeError("no model")

    off = dedup.deduplicate(annotations(spark), ["source_rank", "row_key"], broken, enabled=False)
    assert off.rows.count() == 3 and not off.semantic_success and off.error is None
    failed = dedup.deduplicate(annotations(spark), ["source_rank", "row_key"], broken)
    assert failed.rows.count() == 3 and not failed.semantic_success and failed.error == "no model"
    single = dedup.deduplicate(annotations(spark).where("source_rank = 2"), ["source_rank", "row_key"], broken)
    assert single.rows.count() == 1 and single.error is None


def test_seq_follows_the_order_under_any_partitioning(spark):
    keys = list(range(200))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k // 50, k) for k in keys], "rank int, k int").repartition(7)
    seq = combine.with_seq(df, ["rank", "k"])
    assert [r.k for r in seq.orderBy("seq").collect()] == sorted(keys)


def test_tfidf_vectors_are_unit_length(spark):
    df = spark.createDataFrame([("a b c",), ("a d",), ("e",)], "text string")
    for row in embed.embed_tfidf(df, size=64).collect():
        assert np.linalg.norm(row.embedding) == pytest.approx(1.0, abs=1e-5)


def test_embedding_batches(spark):
    seen = embed.embed_with(spark.range(70).select(F.col("id").cast("string").alias("text")).coalesce(1), lambda: lambda texts: [[len(texts)]] * len(texts))
    sizes = [int(r.embedding[0]) for r in seen.collect()]
    assert max(sizes) == rules.EMBED_BATCH and len(sizes) == 70


# ---- prediction and training ----------------------------------------------------------------
def test_predictions_are_checked_and_failures_are_null(spark):
    def load():
        def label(texts):
            if any("boom" in t for t in texts):
                raise ValueError("boom")
            return ["yes" if "data" in t else "perhaps" for t in texts]

        return label

    df = spark.createDataFrame([("data",), ("boom",), ("else",)], "text string").coalesce(1)
    assert {r.text: r.prediction for r in predict.predict_labels(df, load).collect()} == {"data": "yes", "boom": None, "else": None}


def test_classifier_learns_and_is_saved(spark, tmp_path):
    rows = spark.range(200).select(
        "id", F.when(F.col("id") % 2 == 0, "data are available").otherwise("nothing of note").alias("text"),
        F.when(F.col("id") % 2 == 0, "yes").otherwise("no").alias("sentiment"), F.lit("yes").alias("has_data_statement"),
    )
    trained = training.train_and_evaluate(training.training_rows(rows, "id"), str(tmp_path / "model"))
    metrics = trained.metrics.first()
    assert metrics.test_samples == 40 and metrics.accuracy == 1.0 and metrics.f1 == 1.0
    assert (tmp_path / "model" / "metadata").exists()


def test_length_grouping(spark):
    rows = spark.createDataFrame([("w " * n,) for n in (1, 63, 64, 130, 900)], "text string")
    got = sorted((len(r.tokens), r.length_bucket) for r in training.grouped_by_length(rows, partitions=2).collect())
    assert got == [(1, 0), (63, 0), (64, 1), (130, 2), (512, 8)]


# ---- flows ----------------------------------------------------------------------------------
def test_sources_to_training_set(spark, tmp_path):
    lines = ["data_statement,publication_date.x,statement_category"]
    lines += [f"statement number {i} {'alpha beta gamma delta'.split()[i % 4]} {i * 7919},2015-01-01,repository" for i in range(20)]
    (tmp_path / "coded.csv").write_text("\n".join(lines), "latin-1")
    (tmp_path / "m.csv").write_text("data_avail,journal,date\nupon request,J,20200101\nupon request,J,20200101\nNA,J,20200101\n", "latin-1")
    paths = {"coded_statements": str(tmp_path / "coded.csv"), "medical_preprints": str(tmp_path / "m.csv")}
    made = corpus.combine_sources(spark, paths, str(tmp_path / "combined"))
    assert {r.source: r.row_count for r in made.source_stats.collect()} == {"federer_data_2018": 20, "mcguinness_descriptive_2021": 3}
    assert made.total_stats.first().total_rows == 23
    result = corpus.build_training_set(made.rows, str(tmp_path), "gemma", "20240101", threshold=0.999)
    assert result.dedup.semantic_success
    assert result.rows.count() == 21
    assert {r.split: r.samples for r in result.balance.collect()} == {"train": 16, "test": 5}
    assert result.rows.where("text not like '<start_of_turn>user%'").count() == 0
    with pytest.raises(ValueError):
        corpus.combine_sources(spark, {"no such source": "x"}, str(tmp_path / "c"))


def test_papers_to_dispatched_tasks(spark, tmp_path):
    ranking = spark.createDataFrame([("s", "A", "f", 1, 1)], schemas.VENUE_RANKING)
    metadata = spark.createDataFrame([("A", None, None, (["1"],), "l")], schemas.VENUE_METADATA).withColumn("row", F.lit(1))
    overrides = spark.createDataFrame([], "publication string, issn_l string")
    many = spark.range(30).select(
        F.col("id").alias("corpusid"),
        F.struct(F.struct(F.lit("A").alias("display_name")).alias("host_venue")).alias("works_oa"),
        F.lit(True).alias("s2orc_parsed"),
    )
    chosen = annotation.choose_papers(ranking, metadata, overrides, many, "row")
    assert tuple(chosen.coverage.first()) == (1, 1, 30)
    body = "Our data are in a repository now . The end"
    spans_json = f'[{{"start":0,"end":{len(body)}}}]'
    texts = many.select("corpusid", F.struct(F.lit(body).alias("text"), F.struct(F.lit(spans_json).alias("paragraph"), F.lit(None).cast("string").alias("sectionheader")).alias("annotations")).alias("content"))
    for _ in range(2):  # a second run replaces, it does not add
        stored = annotation.ingest_paragraphs(chosen.mapping, texts, str(tmp_path / "paragraphs"))
        assert stored.paragraphs.count() == 30
    assert stored.counts.first().total_paragraphs_extracted == 30
    done = spark.createDataFrame([(0,), (1,)], "corpusid bigint")
    sent = annotation.dispatch(stored.paragraphs, {"x@example.org": 1, "y@example.org": 2}, str(tmp_path / "payload"), done, 4, per_venue=10)
    assert {r.annotator: (r.annotations_sent, r.predictions_generated) for r in sent.report.collect()} == {"x@example.org": (4, 4), "y@example.org": (4, 4)}
    assert sent.remaining.count() == 2
    assert spark.read.text(str(tmp_path / "payload")).count() == 8

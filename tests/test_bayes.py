import math

from corpusloom.operators import bayes

SCHEMA = "id int, text string, sentiment_encoded int, split string"
TRAIN = [
    (1, "Data are shared, data!", 1, "train"), (2, "no data", 0, "train"), (3, "shared_files here", 1, "train"),
    (4, None, 0, "train"), (5, "", 1, "train"), (6, "left out", None, "train"), (7, "Ünder no", 0, "train"),
]


def by_hand(rows):
    """The weights by plain counting."""
    import re

    counts, docs = {}, [0, 0]
    for _, text, label, _ in rows:
        if label is None:
            continue
        docs[label] += 1
        for word in re.findall(r"\w+", (text or "").lower()):
            counts.setdefault(word, [0, 0])[label] += 1
    totals = [sum(c[y] for c in counts.values()) for y in (0, 1)]
    v = len(counts)
    weights = {w: round(1e6 * (math.log((c[1] + 1) / (totals[1] + v)) - math.log((c[0] + 1) / (totals[0] + v)))) for w, c in counts.items()}
    return weights | {None: round(1e6 * math.log((docs[1] + 1) / (docs[0] + 1)))}


def test_weights_equal_plain_counts(spark):
    got = bayes.fit_bayes(spark.createDataFrame(TRAIN, SCHEMA))
    assert {r.word: r.weight for r in got.collect()} == by_hand(TRAIN)


def test_scores_add_weights_and_keep_every_row(spark):
    weights, model = by_hand(TRAIN), bayes.fit_bayes(spark.createDataFrame(TRAIN, SCHEMA))
    rows = [(1, "DATA data unknown", 1, "word"), (2, None, 0, "weight"), (3, "", 0, "x"), (4, "no no", 0, "x"), (None, "shared", 1, "x")]
    got = bayes.score_bayes(spark.createDataFrame(rows, "id int, text string, word int, weight string"), model, "id")
    assert got.columns == ["id", "text", "word", "weight", "bayes_score", "prediction"]
    prior = weights[None]
    expected = {1: prior + 2 * weights["data"], 2: prior, 3: prior, 4: prior + 2 * weights["no"], None: prior + weights["shared"]}
    found = got.collect()
    assert {r.id: r.bayes_score for r in found} == expected
    assert all(r.prediction == int(r.bayes_score > 0) for r in found)


def test_no_rows_to_fit_or_score(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = bayes.fit_bayes(none)
    assert [(r.word, r.weight) for r in model.collect()] == [(None, 0)]
    assert bayes.score_bayes(none, model, "id").count() == 0
    assert [r.bayes_score for r in bayes.score_bayes(spark.createDataFrame(TRAIN[:1], SCHEMA), model, "id").collect()] == [0]


def test_metrics_of_separable_texts(spark):
    rows = [(i, "good word" if i % 2 else "bad word", i % 2, "train" if i < 40 else "test") for i in range(60)]
    got = bayes.bayes_metrics(spark.createDataFrame(rows, SCHEMA), "id").first()
    assert (got.test_samples, got.tp, got.fp, got.fn, got.tn, got.f1) == (20, 10, 0, 0, 10, 1.0)

"""Operators on the words and letters of documents against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries
from corpusloom.llm.divergence import shares, source_divergence, terms
from corpusloom.llm.spelling import count_words, near_words, roots, runs, spelling_variants
from corpusloom.llm.toxicity import SIZES, distinct_buckets, fit_linear, held_out, log_ratios, score, train
from corpusloom.session import materialize

CLASH = ", word string, term string, n int, lo int, head string, body string, doc string, value int, rank string, number int, label int, bits int, p int"
REST = ("x", "t", 1, 2, "h", "y", "z", 3, "r", 4, 5, 6, 7)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- spelling variants ---


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, letters=5, least=3):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered(text)):
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if mark % 97 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= letters and n >= least}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        end = w
        while form[end] is not None:
            end = form[end]
        out[w] = (form[w], end, n, len(near[w]), words.get(form[w]))
    return out


def spelled():
    draw = random.Random(3)
    base = ["receive", "separate", "définir", "straße", "aaaaaa", "aaaaab", "abcabc", "Éclair", "naïveté", "x" * 40]
    rows = [(None, None), (1, None), (2, ""), (3, "1234 - 5"), (4, "Receive RECEIVE receive-receive'receive"), (None, "receive aaaaaa"), (2, "separate")]
    for i in range(60):
        words = []
        for _ in range(draw.randint(1, 80)):
            word = draw.choice(base)
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice("abé") + word[at:], word[:at] + draw.choice("abé") + word[at + 1 :]])
            words.append(draw.choice([str, str.title])(word))
        rows.append((i, draw.choice([" ", ", ", "\n", "7"]).join(words)))
    return rows + [rows[20], rows[20], (100, "a" * 70_000 + " " + "zq" * 3000)] + [(101 + i, "b" * (6000 + i % 2)) for i in range(8)]


def test_spelling_variants_are_those_of_brute_force(spark):
    rows = spelled()
    docs = spark.createDataFrame([(*r, *REST) for r in rows], "doc_id long, text string" + CLASH).repartition(5)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants(docs).collect()}
    wanted = plain_variants(rows)
    assert got == wanted
    assert any(v[0] and v[1] != v[0] for v in wanted.values())  # some chains are longer than one link


@pytest.mark.parametrize("tile", [1, 4, 1000])
def test_every_pair_of_near_words_is_met_once(spark, tile):
    draw = random.Random(tile)
    words = {"".join(draw.choice("ab") for _ in range(draw.randint(1, 7))) for _ in range(120)} | {"".join(draw.choice("abcdé") for _ in range(9)) for _ in range(40)}
    n = {w: draw.randint(1, 4) for w in words}
    table = materialize(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    got = {r["word"]: (r["n_near"], r["near"], r["near_n"]) for r in near_words(table, tile).collect()}
    for w in words:
        near = sorted((o for o in words if one_edit(w, o)), key=lambda o: (-n[o], o))
        assert got.get(w) == ((len(near), near[0], n[near[0]]) if near else None)


def test_roots_end_the_chains(spark):
    links = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("a", "w03"), ("b", "c")]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "c" if w == "b" else "w20" for w, _ in links}


def test_runs_of_long_texts_are_the_same(monkeypatch):
    text = "Ab, çé÷ x9y ßtraße"
    whole = list(runs(text))
    monkeypatch.setattr("corpusloom.llm.spelling._LONG_TEXT", 1)
    assert list(runs(text)) == whole == ["Ab", "çé÷", "x", "y", "ßtraße"]


def test_no_documents_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string" + CLASH)
    assert spelling_variants(empty).count() == 0
    assert count_words(empty).count() == 0


# --- source divergence ---


def plain_divergence(rows, top=200, documents=3):
    rows = [tuple(v or "" for v in r) for r in rows]
    said, with_term, groups = defaultdict(Counter), defaultdict(Counter), sorted({r[:2] for r in rows})
    for lang, source, text in rows:
        own = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))
        said[lang, source].update(own)
        with_term[lang].update(set(own))
    out = set()

    def part(counts, kept):
        n = sum(counts[t] for t in kept)
        return {t: 1 + 10**9 * (counts[t] + 1) // (n + len(kept)) for t in kept}

    def f(p, q):
        return (p - q) ** 2 // q

    for lang, source in groups:
        kept = [t for t, n in with_term[lang].items() if n >= documents]
        p = part(said[lang, source], kept)
        others = [s for g, s in groups if g == lang and s != source]
        q_of = {s: part(said[lang, s], kept) for s in others}
        pairs = sorted(((sum(f(p[t], q_of[s][t]) for t in kept), s) for s in others), key=lambda v: (-v[0], v[1].encode()))
        out |= {(lang, source, "pair", s, v, i) for i, (v, s) in enumerate(pairs, 1)}
        whole = sum((said[g] for g in groups if g[0] == lang), Counter())
        q = part(whole, kept)
        named = sorted(((f(p[t], q[t]), t) for t in kept if said[lang, source][t] and p[t] > q[t]), key=lambda v: (-v[0], v[1].encode()))
        out |= {(lang, source, "term", t, v, i) for i, (v, t) in enumerate(named[:top], 1)}
    return out


def sourced():
    draw = random.Random(5)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)] + ["É", "é", "日本", "Zz", "x_y"]
    rows = [(None, None, None), (None, None, "a b"), ("xx", "only", ""), ("xx", "two", None), ("", "", "a, b; A"), ("", None, "a1a B"), ("yy", "s", "rare words here")]
    for _ in range(150):
        some = draw.sample(words, draw.randint(1, 20))
        rows.append((draw.choice(["en", "en", "fr"]), draw.choice(["s0", "s0", "s0", "s1", "S2", "ü"]), " ".join(draw.choice(some) for _ in range(draw.randint(0, 60)))))
    return rows + [rows[30], rows[30], ("en", "s1", "Waka " * 30_000)]


@pytest.mark.parametrize(("top", "cells"), [(200, 1 << 19), (7, 1)])
def test_divergences_are_those_of_brute_force(spark, monkeypatch, top, cells):
    monkeypatch.setattr("corpusloom.llm.divergence.BLOCK_TERMS", 10)
    rows = sourced()
    docs = spark.createDataFrame([(*r, *REST) for r in rows], "lang string, source string, text string" + CLASH).repartition(4)
    got = [tuple(r) for r in source_divergence(docs, top=top, cells=cells).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_divergence(rows, top)


def test_ties_beyond_the_report_are_taken_in_byte_order(spark):
    texts = [" ".join("abcdefghij"[i] * 3 + "é" for i in range(10)) for _ in range(3)]
    rows = [("en", "one", t) for t in texts] + [("en", "two", "other words only")] * 3
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    got = {tuple(r) for r in source_divergence(docs, top=4).collect()}
    assert got == plain_divergence(rows, 4)
    assert sum(r[1] == "one" and r[2] == "term" for r in got) == 4


def test_no_documents_no_divergence(spark):
    assert source_divergence(spark.createDataFrame([], "lang string, source string, text string" + CLASH)).count() == 0


def test_shares_are_exact_for_large_counts():
    counts, total = [0, 5, 10**12, 3 * 10**12 + 7, 8 * 10**14], 8 * 10**14 + 3
    got = shares(np.array(counts), np.full(5, total))
    assert got.tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


def test_terms_of_long_texts_are_the_same(monkeypatch):
    body = "Ab, Çé_x9y 日本[z]".encode()
    whole = list(terms(body))
    monkeypatch.setattr("corpusloom.llm.divergence._LONG_TEXT", 1)
    assert list(terms(body)) == whole == [t.encode() for t in ("ab", "Çé", "x", "y", "日本", "z")]


# --- toxicity ---


def plain_grams(text):
    shown = re.sub(" +", " ", " " + re.sub("[\x00-\x60\x7b-\x7f]", " ", lowered(text)) + " ")
    return {shown[i : i + n] for n in SIZES for i in range(len(shown) - n + 1)}


def test_buckets_are_those_of_the_whole_texts_n_grams(monkeypatch):
    text = "Naïve, idiot!! 日本 " * 40
    whole = distinct_buckets(text.encode())
    assert len(whole) == len(plain_grams(text))
    monkeypatch.setattr("corpusloom.llm.toxicity._PART", 7)
    assert distinct_buckets(text.encode()).tolist() == whole.tolist()
    assert distinct_buckets(b"").tolist() == distinct_buckets(b" ").tolist() == []


def judged(n=400, seed=1):
    draw = random.Random(seed)
    syllables = ["ba", "ko", "ri", "te", "mu", "las", "pen", "dor", "ïl"]
    rude = ["idiot", "Moron", "worthless"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(draw.choice(syllables) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(3, 200))]
        toxic = int(i % 4 == 0)
        for _ in range(toxic * draw.randint(1, 3)):
            words.insert(draw.randrange(len(words)), draw.choice(rude))
        docs.append((i, " ".join(words), *REST))
        labels.append((i, toxic))
    return docs, labels


def test_toxic_documents_are_told_apart_by_what_was_learned(spark):
    docs, labels = judged()
    docs += [(None, None, *REST), (1000, "", *REST), (1001, None, *REST), docs[5], (1002, "ba ko idiot " + "teri mula " * 50_000, *REST)]
    labels += [(None, 1), (1, None), (7, 1), (2000, 1)]
    # Labels of held-out documents are wrong on purpose: they must not be learned from.
    given = [(i, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    table = spark.createDataFrame(docs, "doc_id long, text string" + CLASH).repartition(4)
    model = train(table, spark.createDataFrame(given, "doc_id long, toxic int"))
    got = score(table, model).withColumn("held_out", held_out("doc_id")).collect()
    assert len(got) == len(docs)
    assert all(0 <= r["score"] <= 1 for r in got)
    truth = {i: t for i, t in labels[:400]}
    for r in got:
        if r["doc_id"] in truth:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
            assert (r["score"] >= 0.7) == bool(truth[r["doc_id"]])
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[None] == by_id[1000] == by_id[1001] < 0.7 <= by_id[1002]


def test_scores_add_the_scaled_weights_of_the_n_grams_a_text_has(spark):
    docs, labels = judged(120, 2)
    table = spark.createDataFrame(docs, "doc_id long, text string" + CLASH)
    model = train(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    learned = [(text, t) for (i, text, *_), (_, t) in zip(docs, labels) if zlib.crc32(str(i).encode()) % 3 != 1]
    n = Counter(t for _, t in learned)
    with_gram = Counter((g, t) for text, t in learned for g in plain_grams(text))
    ratio = math.log((with_gram["idiot", 1] + 1) / (n[1] + 2)) - math.log((with_gram["idiot", 0] + 1) / (n[0] + 2))
    assert math.isclose(float(log_ratios(np.array([with_gram["idiot", 1]]), np.array([with_gram["idiot", 0]]), n[1], n[0])[0]), ratio)
    for r in score(table.limit(20), model).collect():
        found = {int(b) for b in distinct_buckets(r["text"].encode())}
        total = model.bias + sum(model.weight[model.slot[b]] for b in found)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_the_fit_is_a_minimum():
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(300, 5)).astype(np.float32)
    labels = (rows @ np.array([2, -1, 0, 0.5, 0]) + draw.normal(size=300) > 0.3).astype(float)
    weight, bias = fit_linear(rows, labels)
    off = 1 / (1 + np.exp(-(rows @ weight + bias))) - labels
    assert np.abs(rows.T @ off + weight).max() < 0.05 and abs(off.sum()) < 0.05


@pytest.mark.parametrize("toxic", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_without_both_labels_all_texts_get_the_share(spark, toxic):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    learned = [t for i, t in toxic if zlib.crc32(str(i).encode()) % 3 != 1]
    got = score(docs, train(docs, spark.createDataFrame(toxic, "doc_id long, toxic int")))
    assert {round(r["score"], 9) for r in got.collect()} == {round((sum(learned) + 0.5) / (len(learned) + 1), 9)}
    assert score(docs.limit(0), train(docs.limit(0), spark.createDataFrame(toxic, "doc_id long, toxic int"))).count() == 0


def test_the_query_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null").collect()}
    rows = queries.op13_toxicity(spark, folder).filter(F.col("held_out")).collect()
    rows = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]
    assert sum(p == t for p, t in rows) >= 0.93 * len(rows)
    assert not any(p and not t for p, t in rows)

"""Operators on documents against brute force, on fixtures with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries
from corpusloom.llm.components import components
from corpusloom.llm.decontamination import contamination
from corpusloom.llm.line_dedup import dedup_lines
from corpusloom.llm.ngram_join import _maybe_met, in_parts, ngram_components
from corpusloom.llm.packing import WordIds, pack
from corpusloom.llm.quality import fit_forest, score, statistics, train
from corpusloom.llm.substring_dedup import remove_repeats
from corpusloom.session import materialize

CLASH = ", doc long, body string, _doc string, line string, size int, token string, row string, n_words int, mark int"
SCHEMA = "doc_id long, text string" + CLASH
REST = (7, "x", "y", "z", 3, "t", "r", 1, 2)


def some_docs(seed=0):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "Äb", "x;y", "A"]
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [None, "", "   ", "one", "a b c d", "a b c d", "A b C d"]
    for _ in range(30):
        lines = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 30))) for _ in range(draw.randint(1, 4))]
        texts.append("\n".join(lines))
    texts += [texts[10], texts[10], texts[11] + " tail", texts[12].upper(), passage + "\n" + texts[13], texts[14] + "\t" + passage, passage, passage + " " + passage]
    common = "This Line is in many of the documents"
    texts += [f"{common}\nown {i}\n  {common.lower()}\t" for i in range(4)]
    texts.append("\n".join(f"long {i % 700} {i % 13}" for i in range(3000)))
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *REST) for i, t in enumerate(some_docs())]
    return spark.createDataFrame(rows + [rows[10], (None, "null id text of some words here", *REST)], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("limit", [1, 50, 10**6])
def test_parts_of_batches_are_bounded_and_whole(monkeypatch, limit):
    monkeypatch.setattr("corpusloom.llm.ngram_join.PART_BYTES", limit)
    bodies = [(t or "").encode() for t in some_docs()]
    batches = [pa.RecordBatch.from_pydict({"body": pa.array(b, pa.binary())}) for b in (bodies[:20], [], bodies[20:])]
    parts = [p.column("body").to_pylist() for p in in_parts(iter(batches))]
    assert [b for p in parts for b in p] == bodies
    assert all(p and (sum(map(len, p)) <= limit or sum(len(b) > 0 for b in p) == 1) for p in parts)


def texts_by_id():
    return dict(enumerate(some_docs()))


WHITE = " \t\n\v\f\r"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_parts_of_batches_hold_rows_without_text():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([None, "é" * (3 << 20), None, "a", None])})
    parts = [p.column("text").to_pylist() for p in in_parts(iter([batch, batch.slice(0, 1)]), "text")]
    assert [len(p) for p in parts] == [2, 3, 1] and [t for p in parts for t in p] == [*batch.column("text").to_pylist(), None]


def test_line_dedup(docs, no_docs):
    made = dedup_lines(docs)
    assert [c for c in made.columns if c not in ("n_lines", "n_dropped")] == docs.columns
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in made.collect()}
    lines = {i: (t or "").split("\n") for i, t in texts_by_id().items()}
    held = {}
    for i, own in lines.items():
        for line in own:
            held.setdefault(ascii_lower(line.strip(WHITE)), set()).add(i)
    for i, own in lines.items():
        gone = [len(k := ascii_lower(x.strip(WHITE))) >= 20 and len(held[k]) >= 3 and i != max(held[k]) for x in own]
        assert got[i] == (len(own), sum(gone), "\n".join(x for x, g in zip(own, gone) if not g))
    assert sum(n for _, n, _ in got.values()) > 3
    assert made.count() == docs.count() and dedup_lines(no_docs).count() == 0


def sets_of(text, n=5):
    words = ascii_lower(text or "").split() if text else []
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))}


def test_ngram_components(docs, no_docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(docs).collect()}
    sets = {i: sets_of(t) for i, t in texts_by_id().items()}
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert {i: v for i, v in got.items() if i is not None} == {i: (len(s), label[i]) for i, s in sets.items()}
    assert got[None] == (3, None)
    assert ngram_components(no_docs).count() == 0


def test_ngram_components_of_many_near_copies(spark):
    draw = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(60)] = f"e{i}{draw.randrange(9)}"
        rows.append((i, " ".join(words)))
    got = {r[0]: r[2] for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: sets_of(t) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == label and len(set(label.values())) > 1


def test_components_follow_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(50, 52), (52, 51), (60, 60), (None, 3)], "x long, y long")
    got = {r[0]: r[1] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 51: 50, 52: 50}


def test_remove_repeats(docs, no_docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(docs.dropDuplicates(["doc_id"])).collect()}
    seen = {tuple(("null id text of some words here").split())}
    for i, text in texts_by_id().items():
        words = (text or "").split()
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            if (key := tuple(words[s : s + 20])) in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        assert got[i] == (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    assert sum(n for _, n, _ in got.values()) > 100
    assert remove_repeats(docs).count() == docs.count() and remove_repeats(no_docs).count() == 0


def bench_words(text):
    out, word = [], ""
    for c in ascii_lower(text or "") + " ":
        if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def test_contamination(spark, docs, no_docs):
    texts = texts_by_id()
    items = [(1, " ".join(texts[20].split()[:12])), (10, texts[21]), (2, "p5 P6 p7"), (3, None), (4, ""), (5, "É"), (6, "nowhere at all"), (7, "p5 p6 p7"), (None, "p0 p1")]
    bench = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, words string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in contamination(docs, bench).collect()}
    for i, text in texts.items():
        words, hit, found = bench_words(text), set(), set()
        for item, source in items:
            own = bench_words(source)
            n = min(len(own), 10)
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found.add("null" if item is None else str(item))
        assert got[i] == (len(words), len(hit), sorted(found)), i
    assert contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination(no_docs, bench).count() == 0


def test_contamination_stays_out_of_python(spark, docs):
    made = contamination(docs, spark.createDataFrame([(1, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11")], "item_id long, text string"))
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    words, whole = WordIds(path), Tokenizer.from_file(path)
    draw = random.Random(1)
    pieces = ["Ab'll", "É", "é", "́", " ", "\n", "\t", " ", " ", "12", "ﬁ", "ΑΣ", "<|endoftext|>", "<|start", "日本", "🙂", "don't", "--", "\x0b", "\x1c", "İ", "ABC", "ment###", "ß", "×", "ÿ", "<", "|>", "`", "_", "~", "&&", "²"]
    for _ in range(1500):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert words.ids(text.encode()) == b"".join(i.to_bytes(4, "little") for i in ids), repr(text)


def test_packing(docs, no_docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path())
    rows = pack(docs.dropDuplicates(["doc_id"]), queries.tokenizer_path(), length=64, n_open=3).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts_by_id().items():
        ids, at = whole.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = b"".join(t.to_bytes(4, "little") for t in ids[at : at + r["length"]])
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 64 or at < 64 and at & (at - 1) == 0
    assert pack(no_docs, queries.tokenizer_path()).count() == 0


def test_words_beyond_a_number_are_forgotten_and_packed_the_same(docs):
    few, all_of_them, draw = WordIds(queries.tokenizer_path(), 50), WordIds(queries.tokenizer_path()), random.Random(2)
    for _ in range(60):
        text = " ".join("".join(draw.choices("abcdéß.,'7", k=draw.randint(1, 8))) for _ in range(40)).encode()
        assert few.ids(text) == all_of_them.ids(text)
        assert len(few._words) <= 50 + 40 and len(few._pieces) <= 50 + 40 * 8
    assert len(all_of_them._words) > 1000
    packed = [sorted(map(str, pack(docs, queries.tokenizer_path(), **kw).collect())) for kw in ({}, {"remembered": 3})]
    assert packed[0] == packed[1]


def test_workers_forget_words_when_other_work_comes(spark, docs):
    def held(batches):
        import gc

        for _ in batches:
            gc.collect()
            yield pa.RecordBatch.from_pydict({"n": [sum(type(o).__name__ == "WordIds" for o in gc.get_objects())]})

    assert pack(docs, queries.tokenizer_path()).count() > 0
    rows = spark.range(0, 16, 1, 16).mapInArrow(held, "n long").collect()
    assert [r["n"] for r in rows] == [0] * 16


def test_quality_learns_and_scores_every_row(spark, docs, no_docs):
    draw = random.Random(5)
    good = [(i, " ".join(draw.choice(["the", "tree", "grows", "slowly."]) for _ in range(50))) for i in range(150)]
    bad = [(i, " ".join(draw.choice(["$$$", "BUY!!", "|", "###"]) for _ in range(50))) for i in range(150, 300)]
    given = spark.createDataFrame([(*r, 0.5) for r in good + bad], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(None, 1), (3, None)], "doc_id long, quality int")
    forest = train(given, labels)
    made = {r["doc_id"]: r["score"] for r in score(given, forest).collect()}
    assert all((made[i] >= 0.3) == (i < 150) for i in made) and len(made) == 300
    assert score(docs, forest).count() == docs.count() and score(no_docs, forest).count() == 0
    assert 0 <= score(docs, forest).filter("text is null").first()["score"] <= 1
    assert train(given, labels.limit(0)).predict(statistics(b"")[None]) == [0.5]


def test_forest_of_one_label():
    import numpy as np

    assert fit_forest(np.ones((4, 3)), np.ones(4)).predict(np.ones((2, 3))).min() > 0.8


def test_digests_of_the_queries(spark):
    row = queries.op2_line_dedup(spark, "/root/testdata/sf0.001").filter("n_dropped = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.col("doc_id") == row["doc_id"]).first()["text"]
    assert row["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_ngrams_of_one_document_are_not_shuffled_again(spark):
    rare = spark.createDataFrame([(t * 7_919_017 - 2**62, d) for t in range(3000) for d in range(1 + (t % 10 == 0))], "token long, doc long")
    met = rare.groupBy("token").count().filter("count > 1").select("token")
    kept = _maybe_met(rare, met)
    assert kept.join(met, "token", "left_semi").count() == 600 and kept.count() < 800
    assert _maybe_met(rare, met.limit(0)).count() == 0


def test_sets_are_shuffled_only_to_their_trees(spark, monkeypatch):
    plans = []

    def written(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, name)

    monkeypatch.setattr("corpusloom.llm.ngram_join.materialize", written)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = " ".join(f"t{i}" for i in range(40))
        ngram_components(spark.createDataFrame([(i, f"{text} u{i}") for i in range(6)], "doc_id long, text string"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sets, links = ([plan for name, plan in plans if name == wanted] for wanted in ("sets", "links"))
    assert sets and not any("Exchange hashpartitioning(doc" in plan for plan in sets)
    assert links and not any("SortMergeJoin" in plan and "held" in plan for plan in links)


def test_the_largest_set_of_an_id_counts(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(1, f"{text} a"), (1, "few"), (2, f"{text} b"), (2, text), (2, "x y z"), (3, f"{text} c"), (4, "x y z q")]
    got = {r[0]: (r[1], r[2]) for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (37, 1), 2: (37, 1), 3: (37, 1), 4: (1, 4)}

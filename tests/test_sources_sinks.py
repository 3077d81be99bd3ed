import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import harmonize, stats, venues
from corpusloom.operators.assign import assign, build_tasks
from corpusloom.sinks import tables as sinks
from corpusloom.sources import tables as sources
from corpusloom.sources.html import first_table, html_table_rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_coded_statements_file(spark, tmp_path):
    path = write(
        tmp_path / "coded.csv",
        "id,data_statement,publication_date.x,statement_category\n".replace("id,", "")
        + 'Données ici,2015-01-02,in si\n"two\nlines, ""quoted""",3/4/2016,unknown code\nNA,soon,\n',
        "ISO-8859-1",
    )
    got = harmonize.coded_statements(sources.read_coded_statements(spark, path))
    assert got.schema.fieldNames() == list(schemas.UNIFIED_COLUMNS)
    assert {f.dataType.typeName() for f in got.schema} == {"string"}
    assert rows(got) == sorted(
        [
            ("federer_data_2018", "Données ici", None, "2015", "yes", "available_si"),
            ("federer_data_2018", 'two\nlines, "quoted"', None, "2016", "no", "other"),
            ("federer_data_2018", None, None, None, "no", "other"),
        ],
        key=str,
    )


def test_all_nine_codes_have_a_category(spark):
    codes = ["in paper and si", "in paper", "repository", "access restricted", "combination", "upon request"]
    codes += ["in si", "location not stated", "other"]
    df = spark.createDataFrame([("t", None, c) for c in codes], schemas.CODED_STATEMENTS)
    got = harmonize.coded_statements(df)
    assert {r["has_data_statement"] for r in got.collect()} == {"yes"}
    assert got.select("statement_category").distinct().count() == 9


def test_typed_statements_file(spark, tmp_path):
    path = write(
        tmp_path / "typed.csv",
        "Data availability statement text,Journal title,\"Statement type (1, 2, 3, 4)\"\n"
        "a,J,1.0\nb,J ,2\nc,J,3.0\nd,J,4\ne,J,5\nf,J,\n",
    )
    got = harmonize.typed_statements(sources.read_typed_statements(spark, path))
    found = {r["text"]: (r["statement_category"], r["has_data_statement"], r["publication_year"]) for r in got.collect()}
    assert found["a"][0] == "upon_request" and found["b"][0] == found["d"][0] == "available_paper_si"
    assert found["c"][0] == "available_repository" and found["e"][0] == found["f"][0] == "other"
    assert {v[1:] for v in found.values()} == {("yes", None)}


def test_observed_flags_files_read_as_one(spark, tmp_path):
    header = ",".join(schemas.OBSERVED_FLAG_COLUMNS) + "\r\n"
    tail = "," * 8 + "\r\n"
    one = write(tmp_path / "a.csv", header + '"Title\r\nhere",d,Venue,2023,yes,N/A' + tail)
    two = write(tmp_path / "b.csv", header + "T,d,Venue,2024,no,None" + tail + "T,d,Venue,,Yes," + tail + "T,d,NA,2020,," + tail)
    raw = sources.read_observed_flags(spark, [one, two])
    assert raw.count() == 4
    assert raw.where("`Justification for non-open data?` is not null").count() == 0
    assert rows(harmonize.observed_flags(raw).drop("source")) == sorted(
        [
            (None, "Venue", "2023", "yes", "has_statement"),
            (None, "Venue", "2024", "no", "no_statement"),
            (None, "Venue", None, "unknown", "other"),
            (None, None, "2020", "unknown", "other"),
        ],
        key=str,
    )


def test_medical_and_journal_files(spark, tmp_path):
    medical = write(tmp_path / "m.csv", "data_avail,journal,date\nUPON REQUEST,J,20200102\nNA,J,20210304\n", "ISO-8859-1")
    got = harmonize.medical_preprints(sources.read_medical_preprints(spark, medical))
    assert rows(got.select("text", "publication_year", "has_data_statement", "statement_category")) == sorted(
        [("UPON REQUEST", "2020", "yes", "upon_request"), (None, "2021", "no", "no_statement")], key=str
    )
    journals = write(tmp_path / "j.csv", "data_availability,journal,pub_date\nwithin the paper; on request,J,2014-05-06\n,K,2015-01-01\n")
    got = harmonize.coded_journals(sources.read_coded_journals(spark, journals))
    assert rows(got.select("venue", "publication_year", "statement_category")) == [
        ("J", "2014", "available_paper_si"),
        ("K", "2015", "no_statement"),
    ]


def test_task_export(spark, tmp_path):
    def task(text, *choices, result=True):
        entry = {"result": [{"value": {"choices": list(choices)}}] if result else []}
        return {"data": {"text": text, "corpusid": 1}, "annotations": [entry]}

    export = [
        task("a", "yes"),
        task("b", "no"),
        task("c", "maybe"),
        task("d", "sure"),
        task("e"),
        task("f", result=False),
        {"annotations": [{"result": [{"value": {"choices": ["yes"]}}]}]},
        {"data": {}, "annotations": [{"result": [{"value": {"choices": ["no"]}}]}]},
        {"data": {"text": "unseen"}, "annotations": []},
    ]
    path = write(tmp_path / "export.json", json.dumps(export, indent=1))
    got = harmonize.annotation_tasks(sources.read_tasks(spark, path))
    assert rows(got.select("text", "has_data_statement", "statement_category")) == sorted(
        [
            ("a", "yes", "has_statement"),
            ("b", "no", "no_statement"),
            ("c", "maybe", "uncertain"),
            ("d", "sure", "other"),
            ("e", "unknown", "other"),
            ("f", "unknown", "other"),
            ("", "yes", "has_statement"),
            ("", "no", "no_statement"),
        ],
        key=str,
    )
    assert sources.read_tasks(spark, path, only_annotated=False).count() == 9


PAGES = [
    (1, "<table><tr><th>V</th><th>h</th></tr><tr><td>A &amp; B</td><td>10<td>12</table><table><tr><td>x</td></tr></table>"),
    (2, "<p>none here</p>"),
    (3, "<table><tr><td>only<table><tr><td>inner</td></tr></table></td></tr></table>"),
    (4, "<table><tr><td>unclosed <b>cell"),
    (5, "<TABLE><TR><TD>caf&eacute;&nbsp; x</TD><TD>n/a</TD></TR></TABLE>"),
    (6, None),
]


def test_html_tables(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, html string")
    got = {(r.page_id, r.row_idx): r.cells for r in first_table(pages).collect()}
    assert got == {
        (1, 1): ["A & B", "10", "12"],
        (3, 0): ["onlyinner"],
        (4, 0): ["unclosed cell"],
        (5, 0): ["café x", "n/a"],
    }
    assert html_table_rows(pages).where("table_idx = 1").count() == 1


def test_ranking_columns_by_position(spark):
    cells = spark.createDataFrame([(["V", "9", "11"], "f"), (["W"], "f"), (["X", "many"], "g")], "cells array<string>, field string")
    assert rows(venues.ranking_from_cells(cells).drop("source")) == sorted(
        [("V", "f", 9, 11), ("W", "f", None, None), ("X", "g", None, None)], key=str
    )


def test_latest_snapshot_reads_one_partition(spark, tmp_path):
    df = spark.createDataFrame([("set-20240101", 1), ("set-20240301", 2), ("zzz", 3)], "snapshot string, n int")
    sinks.replace_table(df, str(tmp_path / "s"), ["snapshot"])
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert [r.n for r in sources.latest_snapshot(stored, prefix="set-").collect()] == [2]
    assert [r.n for r in sources.latest_snapshot(stored).collect()] == [3]


def test_first_available_location(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there"))
    found = sources.read_first_available(spark, [str(tmp_path / "missing"), str(tmp_path / "there")])
    assert found.rows.count() == 3 and found.source.endswith("there") and len(found.failures) == 1
    with pytest.raises(FileNotFoundError):
        sources.read_first_available(spark, [str(tmp_path / "missing")])


def test_read_through_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(4)

    for _ in range(2):
        assert sources.read_through(spark, str(tmp_path / "venues_data_500"), compute).count() == 4
    assert calls == [1]


def test_documents_and_ranking_table(spark, tmp_path):
    spark.createDataFrame([(1, ({"text": "t"},))], "corpusid bigint, content struct<text: map<string,string>>")
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([(1, ("t", ("[]", None)))], schemas.FULL_TEXT)
    df.write.json(path)
    got = sources.read_documents(spark, path, schemas.FULL_TEXT, "json", ["corpusid", "content.text"])
    assert rows(got) == [(1, "t")]
    ranking = spark.createDataFrame([("s", "V", "f", 1, 2)], schemas.VENUE_RANKING)
    sinks.replace_named_table(ranking, "ranking_for_test")
    assert rows(sources.read_ranking(spark, "ranking_for_test")) == [("V", 1, 2)]


def test_replace_unless_empty_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.replace_unless_empty(spark.range(2), path)
    assert not sinks.replace_unless_empty(spark.range(0), path)
    assert spark.read.parquet(path).count() == 2


def test_partition_writes_are_idempotent_and_append_is_not(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "venue string, n int")
    path = str(tmp_path / "p")
    sinks.write_partitions(df, path)
    sinks.write_partitions(df.where("venue = 'a'"), path)
    assert spark.read.parquet(path).count() == 2
    sinks.append_rows(df, path)
    assert spark.read.parquet(path).count() == 4


def test_partition_files_are_bounded_and_sliced(spark, tmp_path):
    df = spark.range(0, 6000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 7)).alias("venue"), "id"
    )
    path = tmp_path / "p"
    manifest = sinks.write_partitions(df, str(path), rows_per_file=500)
    assert {r.venue: r.n_rows for r in manifest.collect()} == {r["venue"]: r["count"] for r in df.groupBy("venue").count().collect()}
    files = list(path.glob("venue=*/*.parquet"))
    assert len(files) <= 8 + 6000 / 500 and len(list(path.glob("venue=hot/*.parquet"))) > 1
    assert max(spark.read.parquet(str(f)).count() for f in files) <= 1000
    assert spark.read.parquet(str(path)).select("id").distinct().count() == 6000


def test_covered_values_without_rows_are_cleared(spark, tmp_path):
    schema = "venue string, n int, _slice string, sizes map<string,int>"
    rows = [("001", 1, "s", {"a": 1}), ("a b/c=%", 2, None, None), (None, 3, "s", {}), ("stay", 4, "s", None)]
    path = str(tmp_path / "p")
    assert sinks.write_partitions(spark.createDataFrame(rows, schema).drop("_slice"), path).count() == 4
    covered = spark.createDataFrame([("001",), ("001",), ("a b/c=%",), (None,), ("never",)], "venue string")
    again = spark.createDataFrame([("001", 9, "s", None)], schema).drop("_slice")
    manifest = sinks.write_partitions(again, path, covered=covered)
    assert {r.venue: r.n_rows for r in manifest.collect()} == {"001": 1, "a b/c=%": 0, None: 0, "never": 0}
    stored = spark.read.schema(again.schema).parquet(path)
    assert sorted((r.venue, r.n) for r in stored.collect()) == [("001", 9), ("stay", 4)]
    nothing = sinks.write_partitions(again.limit(0), path, covered=covered)
    assert {r.n_rows for r in nothing.collect()} == {0}
    assert [r.venue for r in spark.read.schema(again.schema).parquet(path).collect()] == ["stay"]


def test_empty_table_keeps_its_schema(spark, tmp_path):
    sinks.write_empty(spark, schemas.VENUE_RANKING, str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    assert stored.count() == 0 and stored.columns == ["source", "venue", "field", "h5_index", "h5_median"]


def test_splits_metadata_and_card(spark, tmp_path):
    made = spark.range(1200).select(
        F.when(F.col("id") < 960, "train").otherwise("test").alias("split"),
        (F.col("id") % 4 == 0).cast("int").alias("sentiment_encoded"),
        F.when(F.col("id") < 1100, "big").otherwise("small").alias("source"),
        F.lit("t").alias("text"),
    )
    balance, sources_counted = stats.split_balance(made), stats.value_counts(made, "source")
    path = sinks.write_splits(made, str(tmp_path), "qwen", "20240229")
    assert path.endswith("data-availability-qwen-20240229")
    assert spark.read.parquet(os.path.join(path, "data")).where("split = 'test'").count() == 240
    sinks.write_metadata(sinks.run_metadata(balance, sources_counted, "qwen", "20240229"), os.path.join(path, "meta"))
    meta = spark.read.json(os.path.join(path, "meta")).first()
    assert (meta.total_samples, meta.train_samples, meta.test_samples) == (1200, 960, 240)
    assert meta.format == "sft_qwen_chat_format" and meta.source_distribution.asDict() == {"big": 1100, "small": 100}
    card = sinks.dataset_card(made, balance, "qwen", "20240229")
    assert "- **Total samples**: 1,200" in card and "- **Test positive ratio**: 0.250" in card
    assert card.index("- **big**: 1,100 samples") < card.index("- **small**: 100 samples")
    sinks.write_card(spark, card, os.path.join(path, "card"))
    assert spark.read.text(os.path.join(path, "card"), wholetext=True).first()[0] == card


def test_task_payload_and_annotator_files(spark, tmp_path):
    pool = spark.range(10).select(
        F.col("id").alias("corpusid"),
        F.concat_ws("_", "id", F.lit("0")).alias("corpusid_unique"),
        F.lit(0).alias("par_id"),
        F.lit(7).alias("wc"),
        F.lit('a "quoted"\ntext').alias("text"),
    )
    given = assign(pool, "corpusid_unique", ["x@example.org", "y@example.org"], 3)
    ids = spark.createDataFrame([("x@example.org", 1), ("y@example.org", 2)], "annotator string, annotator_id bigint")
    label = F.when(F.col("corpusid") % 2 == 0, "yes")
    tasks = build_tasks(given.withColumn("prediction", label), ids, "prediction")
    sinks.write_task_payload(tasks, str(tmp_path / "payload"))
    written = spark.read.text(str(tmp_path / "payload"))
    records = [(r.annotator, json.loads(r.value)) for r in written.collect()]
    assert len(records) == 6
    for annotator, record in records:
        who = record["annotations"][0]["completed_by"]
        assert who["email"] == annotator and who["initials"] == annotator[:2] and who["avatar"] is None
        assert record["annotations"][0]["result"][0]["value"] == {"choices": []}
        assert ("predictions" in record) == (record["data"]["corpusid"] % 2 == 0)
    sinks.write_annotator_files(given, str(tmp_path / "files"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "files"))
    assert back.groupBy("annotator").count().select("count").distinct().first()[0] == 3
    assert back.select("text").distinct().first()[0] == 'a "quoted"\ntext'


def test_per_row_plans_work_on_a_stream(spark, tmp_path):
    lines = [{"data": {"text": t}, "annotations": [{"result": [{"value": {"choices": [c]}}]}]} for t, c in [("a", "yes"), ("b", "no")]]
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "tasks.json", "\n".join(json.dumps(line) for line in lines))
    stream = spark.readStream.schema(schemas.TASK).json(str(folder))
    query = (
        harmonize.annotation_tasks(stream)
        .writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"), format="parquet")
    )
    query.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("text", "has_data_statement")) == [("a", "yes"), ("b", "no")]


def test_lineage_is_cut_in_the_named_folder(spark, tmp_path):
    from corpusloom.session import CHECKPOINT_CONF, materialize, shared_dir

    stored = materialize(spark.range(3), "n")
    assert stored.count() == 3 and "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
    named = spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    assert named is None or shared_dir(spark) == named


def test_first_table_with_text_spans_hidden_rows_and_heads(spark):
    page = (
        "<table></table><table><thead><tr><td>h1</td><td>h2</td></tr></thead>"
        "<tr><td colspan=2>wide</td><td rowspan=2>tall<script>var x=1</script></td></tr>"
        "<tr><td>a</td><td>b</td></tr><tr style='display: none'><td>no</td></tr><tr><th>x</th><th>y</th></tr></table>"
    )
    from corpusloom.sources.html import first_table, html_table_rows

    pages = spark.createDataFrame([(1, page)], "page_id bigint, html string")
    rows = [(r["is_header"], r["cells"]) for r in html_table_rows(pages).orderBy("table_idx", "row_idx").collect()]
    assert rows == [(True, ["h1", "h2"]), (False, ["wide", "wide", "tall"]), (False, ["a", "b", "tall"]), (False, ["x", "y"])]
    assert first_table(pages).count() == 3


def test_empty_pool_and_too_many_annotators(spark):
    import pytest

    from corpusloom.operators.assign import assign, assign_quadrants
    from corpusloom.operators.ranking import draw_with_replacement

    assert draw_with_replacement(spark.range(0), "id", 5).count() == 0
    with pytest.raises(ValueError):
        assign_quadrants(spark.range(4).selectExpr("id", "1.0 as x", "1.0 as y"), "id", list("abcde"))
    with pytest.raises(Exception, match="the pool is smaller"):
        assign(spark.range(5), "id", ["a", "b"], 3).count()
    assert assign(spark.range(5), "id", ["a", "b"], 3, strict=False).count() == 5

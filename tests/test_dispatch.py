"""Reports on tasks that were handed out."""

from corpusloom.operators.assign import dispatch_report, dispatch_totals

TASK = "annotator string, data struct<corpusid_unique:string>, predictions array<string>"


def test_report_keeps_annotators_without_tasks(spark):
    tasks = spark.createDataFrame([("a", ("1_0",), ["yes"]), ("a", ("2_0",), None), ("x", ("3_0",), None)], TASK)
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "annotator string")
    assert {tuple(r) for r in dispatch_report(tasks, known).collect()} == {("a", 2, 1), ("b", 0, 0), ("x", 1, 0)}
    assert {tuple(r) for r in dispatch_report(tasks).collect()} == {("a", 2, 1), ("x", 1, 0)}


def test_totals_count_what_remains(spark):
    pool = spark.createDataFrame([("1_0",), ("2_0",), ("9_0",), (None,)], "corpusid_unique string")
    tasks = spark.createDataFrame([("a", ("1_0",), ["yes"]), ("a", ("1_0",), None), ("b", ("2_0",), None)], TASK)
    assert [tuple(r) for r in dispatch_totals(tasks, pool).collect()] == [(3, 2, 1, 2)]
    assert [tuple(r) for r in dispatch_totals(tasks.limit(0), pool).collect()] == [(0, 0, 0, 4)]

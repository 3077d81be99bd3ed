import pytest
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import columns as C
from corpusloom.operators.chat import chat_text, classification_prompt
from corpusloom.operators.predict import cascade_label


@pytest.mark.parametrize(
    "text, category",
    [
        ("Data are available UPON REQUEST", "upon_request"),
        ("not available upon request", "upon_request"),
        ("in the Supplementary files", "available_paper_si"),
        ("Data are not publicly available", "available_repository"),
        ("not applicable", "not_applicable"),
        ("no empirical data", "not_available"),
        ("ask us", "other"),
        ("", "other"),
        (None, "no_statement"),
    ],
)
def test_medical_cascade(value_of, text, category):
    assert value_of(C.phrase_cascade(F.col("x"), rules.CASCADE_MEDICAL), row=(text,)) == category


@pytest.mark.parametrize(
    "text, category",
    [
        ("within the paper, the rest on request", "available_paper_si"),
        ("see our WEBPAGES", "available_repository"),
        ("on request", "upon_request"),
        ("cannot be shared", "not_available"),
        ("elsewhere", "other"),
        (None, "no_statement"),
    ],
)
def test_journal_cascade(value_of, text, category):
    assert value_of(C.phrase_cascade(F.col("x"), rules.CASCADE_JOURNALS), row=(text,)) == category


@pytest.mark.parametrize("text, label", [("upon request", "yes"), ("not available", "no"), ("hm", "maybe"), (None, "no")])
def test_cascade_label(value_of, text, label):
    assert value_of(cascade_label(F.col("x")), row=(text,)) == label


@pytest.mark.parametrize("code, category", [("in si", "available_si"), ("unheard of", "other"), (None, "other")])
def test_recode(value_of, code, category):
    assert value_of(C.recode(F.col("x"), rules.STATEMENT_CODES), row=(code,)) == category


def test_recode_or_keep_passes_unknown_values(value_of):
    for old, new in [("not", "no"), ("maybe", "maybe"), (None, None)]:
        assert value_of(C.recode_or_keep(F.col("x"), rules.OLD_LABELS), row=(old,)) == new


@pytest.mark.parametrize("cell", [*rules.NA_TOKENS, None])
def test_na_tokens_become_null(value_of, cell):
    assert value_of(C.na_to_null(F.col("x")), row=(cell,)) is None


@pytest.mark.parametrize("cell", ["none", " NA", "0", "na"])
def test_other_cells_stay(value_of, cell):
    assert value_of(C.na_to_null(F.col("x")), row=(cell,)) == cell


@pytest.mark.parametrize(
    "date, year",
    [("2015-03-01", 2015), ("3/1/2016", 2016), ("1 Mar 2017", 2017), ("2014-01-02 03:04:05", 2014), ("soon", None), (None, None)],
)
def test_year_of(value_of, date, year):
    assert value_of(C.year_of(F.col("x")), row=(date,)) == year


def test_year_of_compact_dates(value_of):
    assert value_of(C.year_of_yyyymmdd(F.col("x")), "x int", (20210315,)) == 2021
    assert value_of(C.year_of_yyyymmdd(F.col("x")), row=("20211",)) is None


def test_day_stamp(value_of):
    assert value_of(C.day_stamp(F.to_timestamp(F.col("x"))), row=("2024-02-29 23:00:00",)) == "20240229"


def test_word_count_counts_empty_pieces(value_of):
    for text, n in [("a b", 2), ("a  b", 3), ("a ", 2), ("", 1)]:
        assert value_of(C.word_count(F.col("x")), row=(text,)) == n


def test_word_count_bounds_are_exclusive(value_of):
    for words, inside in [(5, False), (6, True), (999, True), (1000, False)]:
        assert value_of(C.word_count_between(F.col("x"), 5, 1000), row=(" ".join(["w"] * words),)) is inside


def test_slice_text_counts_characters(value_of):
    text = "né\U0001f600à la carte"
    for start, end in [(0, 2), (2, 4), (3, 100), (4, 4), (50, 60)]:
        assert value_of(C.slice_text(F.col("x"), F.lit(start), F.lit(end)), row=(text,)) == text[start:end]


def test_tokenize(value_of):
    assert value_of(C.tokenize(F.col("x")), row=("Les données, été_2!",)) == ["Les", "données", ",", "été_2", "!"]


def test_keywords_match_whole_tokens_with_case(value_of):
    for tokens, hit in [(["data"], True), (["Data"], False), (["dataset"], False), ([], False)]:
        assert value_of(C.mentions_any(F.col("x"), ["data", "code"]), "x array<string>", (tokens,)) is hit


@pytest.mark.parametrize("text, ratio", [("3/12", 0.25), ("1/3", 0.333), ("1/0", None), ("1", None), ("a/b", None)])
def test_position_ratio(value_of, text, ratio):
    assert value_of(C.position_ratio(F.col("x")), row=(text,)) == ratio


def test_percent_and_ratio_guard_zero(value_of):
    for part, whole, expected in [(1, 3, 33.3), (0, 0, 0.0), (3, 3, 100.0)]:
        assert value_of(C.percent(F.col("a"), F.col("b")), "a int, b int", (part, whole)) == expected
    assert value_of(C.ratio(F.col("a"), F.col("b")), "a int, b int", (2, 3)) == 0.667


def test_rounding(value_of):
    assert value_of(F.round(F.col("a"), 1), "a double", (81.94,)) == 81.9


def test_cosine(value_of):
    schema = "a array<float>, b array<float>"
    expected = [([1.0, 0.0], [1.0, 0.0], 1.0), ([1.0, 0.0], [0.0, 2.0], 0.0), ([0.0, 0.0], [1.0, 1.0], 0.0)]
    for a, b, c in expected:
        assert value_of(C.cosine(F.col("a"), F.col("b")), schema, (a, b)) == pytest.approx(c)


def test_one_hot_later_flag_wins(value_of):
    label = C.one_hot_label(F.col("y"), F.col("n"), F.col("m"))
    for row, expected in [((1, 0, 0), "yes"), ((1, 1, 0), "no"), ((1, 1, 1), "maybe"), ((0, 0, 0), "0")]:
        assert value_of(label, "y int, n int, m int", row) == expected


ANNOTATIONS = "x array<struct<result: array<struct<value: struct<choices: array<string>>>>>>"


@pytest.mark.parametrize(
    "annotations, label",
    [
        ([([((["no"],),)],)], "no"),
        ([([(([],),)],)], "unknown"),
        ([([],)], "unknown"),
        ([], "unknown"),
        (None, "unknown"),
    ],
)
def test_first_choice(value_of, annotations, label):
    assert value_of(C.first_choice(F.col("x"), "unknown"), ANNOTATIONS, (annotations,)) == label


def test_chat_formats(value_of):
    user = f"{rules.INSTRUCTION}\n\nText: T {{x}} 100%"

    def chat(model):
        return value_of(chat_text(F.col("x"), F.lit("yes"), model), row=("T {x} 100%",))

    assert chat("gemma") == f"<start_of_turn>user\n{user}<end_of_turn>\n<start_of_turn>model\nyes<end_of_turn>"
    assert chat("qwen") == (
        f"<|im_start|>system\n{rules.SYSTEM_MESSAGE}<|im_end|>\n<|im_start|>user\n{user}<|im_end|>\n"
        "<|im_start|>assistant\nyes<|im_end|>"
    )
    assert chat("llama3.2").startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n")
    assert chat("gpt-oss").endswith("<|start|>assistant<|channel|>final<|message|>yes<|end|>")
    assert chat("never heard of") == chat("generic")


def test_prompt_ends_with_the_text(value_of):
    made = value_of(classification_prompt(F.col("x")), row=("Data {{ text }}",))
    assert made.endswith("\n\nTEXT: Data {{ text }}\nRESULT: ") and made.count("RESULT:") == 4

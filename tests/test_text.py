"""Edge strings and number grammar."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from abacist.functions import display, text

# text, extracted answer, text repaired for the answer 85 (None: unchanged)
EDGES = [
    ("答案：85 x 答案:9", "85", "答案：85"),
    ("结果 5-3", "-3", "结果 5-3\n答案：85"),
    ("85.", "85.", "85.\n答案：85"),
    ("１２个", "１２", "１２个\n答案：85"),
    ("1,000元", "000", "1,000元\n答案：85"),
    ("1/2", "2", "1/2\n答案：85"),
    ("答案：　85", "85", None),
    ("答案：\n85", "85", None),
    ("答案：1/2", "1", "答案：85"),
    ("答案：-3.5米", "-3.5", "答案：85"),
    ("no", "", "no\n答案：85"),
    ("  ", "", "\n答案：85"),
    ("a 答案：84\n再算\n答案：85", "84", "a 答案：85\n再算\n答案：85"),
    ("步骤 答案：3:2", "3", "步骤 答案：85"),
    ("答案：4.5 米\n\n因此", "4.5", "答案：85\n因此"),
    ("答案：84\r\n好", "84", "答案：85\n好"),
    ("x答案：", "", "x答案：85"),
    ("n=4．5", "5", "n=4．5\n答案：85"),
]


def apply(spark, function, values):
    """Results of a column function on a list of texts, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), "n int, t string")
    done = rows.select("n", function(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(done)]


def test_edge_strings(spark):
    texts = [t for t, _, _ in EDGES]
    assert apply(spark, text.extract_answer, texts) == [e for _, e, _ in EDGES]
    repaired = apply(spark, lambda t: text.repaired_answer_lines(t, F.lit("85")), texts)
    assert repaired == [t if r is None else r for t, _, r in EDGES]


def test_null_text(spark):
    assert apply(spark, text.extract_answer, [None]) == [""]
    assert apply(spark, text.is_blank, [None, "", " 　\n", "a"]) == [True, True, True, False]


def test_last_marker(spark):
    found = apply(spark, lambda t: text.extract_answer(t, which="last"), ["答案：1\n答案：2", "3 4"])
    assert found == ["2", "4"]
    with pytest.raises(ValueError):
        text.extract_answer(F.col("t"), which="middle")


def test_replacement_text_is_literal(spark):
    repaired = apply(
        spark, lambda t: text.repaired_answer_lines(t, F.lit(r"$1\2")), ["x\n答案：3"]
    )
    assert repaired == ["x\n答案：$1\\2"]


def test_parse_number(spark):
    cases = {
        "85": 85.0, "85.": 85.0, "-3.5": -3.5, ".5": 0.5, "1e3": 1000.0, "１２": 12.0,
        " 7 ": 7.0, "1/2": 0.5, "1/0": None, "1/2/3": None, "": None, "abc": None,
        "1d": None, "1f": None, "0x10": None, "/2": None, "3/": None, "-1/4": -0.25,
    }
    assert apply(spark, text.parse_number, list(cases)) == list(cases.values())


def test_stated_result(spark):
    cases = {
        "6×31=186，186-90=96": "96",
        "9-4=5，3×4=12": "5",
        "6*7 = 42": "42",
        "10/2=5 然后 5+5=10": "5",
        "答案：007": "7",
        "答案：-7": None,
        "没有": None,
        "99999999999999999999×1=99999999999999999999": "99999999999999999999",
    }
    assert apply(spark, text.stated_result, list(cases)) == list(cases.values())


def test_equation_holds(spark):
    cases = {"4×5=20": True, "4×5=21": False, "9-4=5": True, "9+4=5": False, "8/2=4": True,
             "8/3=2": False, "8/0=0": False, "x": None}
    assert apply(spark, text.equation_holds, list(cases)) == list(cases.values())


def test_answer_line(spark):
    rows = [("a\n答案：1", "2"), ("共 5", "5"), ("共 3-5", " 5 "), ("共 5.0", "5"), ("", "5")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, c string, a string")
    found = [r.s for r in frame.select("n", text.with_answer_line("c", "a").alias("s")).sort("n").collect()]
    assert found == ["a\n答案：1", "共 5", "共 3-5", "共 5.0\n答案：5", "\n答案：5"]


def test_strip_like_python(spark):
    texts = ["　a b ", "\x1c x \x1f", "\n\t", " z ", "plain"]
    assert apply(spark, text.strip, texts) == [t.strip() for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.decimals(-999, 999, places=1), st.integers(1000, 9999)), min_size=5, max_size=20))
def test_extract_known_answers(spark, values):
    """The marked number wins, else the last one; texts are made from the answer."""
    marked = [f"共{other}，答案：{value} 元，{other}" for value, other in values]
    last = [f"共{other}个，得到 {value}" for value, other in values]
    wanted = [str(value) for value, _ in values]
    assert apply(spark, text.extract_answer, marked) == wanted
    assert apply(spark, text.extract_answer, last) == wanted


def test_appended_marker_reads_back(spark):
    for function in (text.with_answer_line, text.repaired_answer_lines):
        made = apply(spark, lambda t: text.extract_answer(function(t, F.lit("-12.5"))), ["甲", "", "共"])
        assert made == ["-12.5"] * 3


def test_replace_numbers(spark):
    frame = spark.sql(
        "select '5个55和5' as t, array(named_struct('old', 5, 'new', 12), "
        "named_struct('old', 2, 'new', 9)) as p"
    )
    assert frame.select(text.replace_numbers("t", "p")).first()[0] == "19个55和5"
    frame = spark.sql("select '55个5' as t, array(named_struct('old', 5, 'new', 7)) as p")
    assert frame.select(text.replace_numbers("t", "p", whole_number=True)).first()[0] == "55个7"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 100000, allow_nan=False), min_size=30, max_size=30))
def test_decimals_like_python(spark, values):
    values = values + [0.25, 0.15, 0.125, 2.5, 0.35, 59.95, 3599.95, 0.05, 1.005]
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v double")
    found = rows.select(
        "n", display.fixed_decimals("v", 1).alias("one"), display.fixed_decimals("v", 2).alias("two"),
        display.fixed_decimals(-F.col("v"), 2).alias("minus"),
    ).sort("n").collect()
    for row, v in zip(found, values):
        assert row.one == f"{v:.1f}"
        assert row.two == f"{v:.2f}"
        assert row.minus.lstrip("-") == f"{v:.2f}"


def test_percent_and_duration(spark):
    frame = spark.sql("select 0.00125D as s, -0.5D as g, 90D as d")
    row = frame.select(
        display.percent_text("s"), display.percent_text("g", signed=True), display.duration_text("d")
    ).first()
    assert tuple(row) == ("0.12%", "-50.00%", "1.5m")


def test_totals_beyond_bigint_are_null(spark, tmp_path):
    """They ended the whole query before."""
    from abacist.queries import QUERIES

    most = 2**63 - 1
    rows = [(1, f"{most} 和 1"), (2, f"{most} {most} {most}"), (3, f"{most - 7}, ７"), (4, "9" * 30 + " 5"), (5, "无")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["whole_numbers"](spark, str(tmp_path)).sort("doc_id").collect()
    assert [r.total for r in found] == [None, None, most, 5, 0]
    assert [r.numbers for r in found][:3] == [f"{most},1", f"{most},{most},{most}", f"{most - 7},７"]

"""Scalar text rules on edge rows, against plain per-row statements of the rule."""

import re
import string

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textmill.functions.text import pad_punct, render_expr, strip_html, token_count, tokens
from textmill.operators.clean import (
    add_constants,
    drop_na,
    drop_tables,
    inputs_and_targets,
    keep_columns,
    label_to_word,
    render,
)

TAG_TEXTS = [
    "x<a\rb>y", "x<a\nb>y", "x<a\x85b>y", "x<a b>y", "<<b>", "a < b", "a<b>c</b>d<", "<>", "<ta<x>ble>",
    "<<x>table>", "p<\n>q", "", "plain", "<a><b>\n<c", "< < < <" * 50, "<TABLE>x</TABLE>",
]


def column(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def results(df, expression):
    return [row[1] for row in df.select("i", expression.alias("out")).orderBy("i").collect()]


def test_strip_html_is_the_lazy_pattern(spark):
    assert results(column(spark, TAG_TEXTS), strip_html(F.col("t"))) == [re.sub("<.*?>", "", t) for t in TAG_TEXTS]


def test_pad_punct_over_every_character(spark):
    marks = "".join(c for c in string.punctuation if c != "\\")
    texts = [f"a{chr(code)}b {chr(code)}" for code in range(1, 0x3100)]
    wanted = [re.sub(r"\s+", " ", re.sub(f"([{re.escape(marks)}])", r" \1 ", t)) for t in texts]
    assert results(column(spark, texts), pad_punct(F.col("t"))) == wanted


def test_no_table_survives_stripping_or_padding(spark):
    pieces = ["<", ">", "table", "<table>", "\n", "a", "<x>"]
    texts = [a + b + c + d + e for a in pieces for b in pieces for c in pieces for d in pieces for e in pieces]
    df = column(spark, texts)
    for change in (strip_html, pad_punct):
        left = df.select(F.lower(change(F.col("t"))).alias("t")).filter(F.contains("t", F.lit("<table>")))
        assert left.count() == 0


def test_tokens(spark):
    texts = ["Ab1 2.5, x_y!", "", "  ", "é½٣ a b", "\\"]
    assert results(column(spark, texts), tokens(F.col("t"))) == [
        ["Ab", "1", "2", ".", "5", ",", "x", "_", "y", "!"], [], [], ["é", "½٣", "a", " ", "b"], ["\\"],
    ]
    assert results(column(spark, texts), token_count(F.col("t"))) == [10, 0, 0, 5, 1]


def test_drop_na_drops_null_and_empty_only(spark):
    rows = [
        (0, "a", 1.0, [1]), (1, None, 1.0, [1]), (2, "", 1.0, [1]), (3, " ", 1.0, [1]),
        (4, "a", float("nan"), [1]), (5, "a", 1.0, []), (6, "a", None, [1]), (7, "a", 1.0, None),
    ]
    df = spark.createDataFrame(rows, "i int, s string, d double, l array<int>")
    assert {r.i for r in drop_na(df).collect()} == {0, 3, 4, 5}
    assert {r.i for r in drop_na(df, ["d"]).collect()} == {0, 1, 2, 3, 4, 5, 7}


def test_constants_come_after_the_null_check(spark):
    df = spark.createDataFrame([(1, "x")], "_row_id long, text string")
    out = inputs_and_targets(
        df, column_dict={"inputs": ["text", "none"]}, input_template="{}-{}", constants={"none": ""}
    )
    assert [r.input for r in out.collect()] == ["x-"]
    assert add_constants(df, {}).columns == df.columns


def test_drop_tables(spark):
    texts = ["<TABLE>", '<table class="x">', "a<table>b", "none"]
    assert [r.i for r in drop_tables(column(spark, texts), "t").orderBy("i").collect()] == [1, 3]


@pytest.mark.parametrize(
    "template, columns",
    [("{}: {}", ["a", "n"]), ("{1}{0}{1}", ["a", "n"]), ("{{{}}}", ["a"]), ("plain", ["a"]), ("", ["a"]), ("{}", ["b", "a"])],
)
def test_render_is_str_format(spark, template, columns):
    rows = [("x{}", 7, True), ("<y>", -1, False)]
    df = spark.createDataFrame(rows, "a string, n bigint, b boolean")
    got = [r.o for r in df.select(render_expr(df.schema, template, columns).alias("o")).collect()]
    assert got == [template.format(*(dict(zip("anb", row))[c] for c in columns)) for row in rows]


def test_render_prints_null_as_none(spark):
    df = spark.createDataFrame([(None, 1)], "a string, n int")
    assert render(df, "o", "{}{}", ["a", "n"]).first().o == "None1"


@pytest.mark.parametrize("template", ["{} {}", "{2}", "{a}", "{:>5}", "{!r}", "{0}{}"])
def test_render_refuses_at_build_time(spark, template):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        render(df, "o", template, ["a"])


def test_render_refuses_other_types_and_missing_columns(spark):
    df = spark.createDataFrame([(1.5,)], "d double")
    with pytest.raises(TypeError):
        render(df, "o", "{}", ["d"])
    with pytest.raises(ValueError):
        render(df, "o", "{}", ["nope"])


def test_unknown_label_is_an_error(spark):
    df = spark.createDataFrame([(0,), (2,)], "label int")
    assert {r.word_label for r in label_to_word(df, ["no", "maybe", "yes"]).collect()} == {"no", "yes"}
    many = {i: f"w{i}" for i in range(1000)}
    assert {r.word_label for r in label_to_word(df, many).collect()} == {"w0", "w2"}
    for names in ({0: "no"}, spark.createDataFrame([(0, "no")], "id int, word string")):
        with pytest.raises(PySparkException, match="unknown label"):
            label_to_word(df, names).collect()


def test_keep_columns_ignores_unknown_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert keep_columns(df, ["c", "a", "zzz"]).columns == ["a", "c"]
    assert keep_columns(df).columns == ["a", "b", "c"]

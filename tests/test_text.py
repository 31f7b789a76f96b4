import pytest

import tabloom as t


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_replace_is_a_regular_expression(spark):
    df = text(spark, "a.b.c", "$x", "[x]", "", None)
    assert column(t.replace_text(df, "s", ".", "-"), "s") == ["-----", "--", "---", "", None]
    assert column(t.replace_text(df, "s", ".", "-", literal=True), "s") == \
        ["a-b-c", "$x", "[x]", "", None]
    assert column(t.replace_text(df, "s", r"(\w)\.(\w)", "$2.$1"), "s")[0] == "b.a.c"
    assert column(t.replace_text(df, "s", "[x]", r"\$1", literal=True), "s")[2] == r"\$1"
    assert column(t.replace_text(text(spark, r"a\Eb"), "s", r"\E", "-", literal=True), "s") == ["a-b"]


def test_format(spark):
    df = text(spark, "hELLO wORLD-foo", "  a ", None)
    assert column(t.format_text(df, "s", "capitalize"), "s") == ["Hello World-foo", "  A ", None]
    assert column(t.format_text(df, "s", "upper"), "s")[0] == "HELLO WORLD-FOO"
    assert column(t.format_text(df, "s", "lower"), "s")[0] == "hello world-foo"
    with pytest.raises(ValueError):
        t.format_text(df, "s", "title")


def test_concatenate_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "s string, i int")
    assert column(t.concat_columns(df, "s", "i", "v"), "v") == ["a 1", None, None]
    with pytest.raises(ValueError):
        t.concat_columns(df, "s", "i", "v", "join")


def test_split(spark, ansi):
    df = text(spark, "a", "a-b", "a-b-c", "a-b-c-d-e", "", None)
    out = t.split_column(df, "s", "-", "x, y", keep="true")
    assert [tuple(r)[1:] for r in out.collect()] == [
        ("a", None), ("a", "b"), ("a", "b-c"), ("a", "b-c-d-e"), ("", None), (None, None)]
    out = t.split_column(df, "s", "-", ["x", "y", "z"], keep=False)
    assert [tuple(r)[1:] for r in out.collect()] == [
        ("a", None, None), ("a", "b", None), ("a", "b", "c"), ("a", "b", "c"),
        ("", None, None), (None, None, None)]
    dots = text(spark, "a.b")
    assert column(t.split_column(dots, "s", ".", "x,y", literal=True), "y") == ["b"]
    over = t.split_column(df, "s", "-", "s,y").collect()[1]
    assert (over.s, over.y) == ("a", "b")


CASES = [("hi", -1), ("hello", 0), ("hello", 3), ("  a ", 99), (None, 2)]


def operate(df, **item):
    return column(t.text_operations(df, [{"new_column": "v", **item}]), "v")


def test_substring(spark, ansi):
    df = spark.createDataFrame(CASES, "s string, n int")
    base = {"o_type": "substring", "input": "s", "i_type": "column"}
    assert operate(df, **base, f_type="value", l_type="value", length="2", **{"from": "0"}) == \
        ["hi", "he", "he", "  ", None]
    assert operate(df, **base, f_type="value", l_type="column", length="n", **{"from": 2}) == \
        ["", "", "ell", " a ", None]
    assert operate(df, **base, f_type="column", l_type="value", length=2, **{"from": "n"}) == \
        ["i", "he", "ll", "", None]
    assert operate(df, **base, f_type="column", l_type="column", length="n", **{"from": "n"}) == \
        ["", "", "llo", "", None]
    value = {"o_type": "substring", "input": "it's", "i_type": "value"}
    assert operate(df, **value, f_type="value", l_type="value", length=2, **{"from": -2}) == ["'s"] * 5


def test_left_right(spark, ansi):
    df = spark.createDataFrame(CASES, "s string, n int")
    base = {"o_type": "left_right", "input": "s", "i_type": "column"}
    assert operate(df, **base, l_type="column", length="n", **{"from": "left"}) == \
        ["", "", "hel", "  a ", None]
    assert operate(df, **base, l_type="column", length="n", **{"from": "right"}) == \
        ["", "", "llo", "  a ", None]
    assert operate(df, **base, l_type="value", length="2", **{"from": "right"}) == \
        ["hi", "lo", "lo", "a ", None]


def test_trim_only_spaces(spark):
    df = text(spark, "  a ", "\ta\t", None)
    assert operate(df, o_type="trim_spaces", input="s", i_type="column", side="both") == \
        ["a", "\ta\t", None]
    assert operate(df, o_type="trim_spaces", input="s", i_type="column", side="left")[0] == "a "
    assert operate(df, o_type="trim_spaces", input=" b ", i_type="value", side="right")[0] == " b"


def test_pad_truncates(spark, ansi):
    df = spark.createDataFrame(CASES, "s string, n int")
    base = {"o_type": "pad_spaces", "input": "s", "i_type": "column"}
    assert operate(df, **base, side="left", l_type="value", length=4) == \
        ["  hi", "hell", "hell", "  a ", None]
    assert operate(df, **base, side="right", l_type="column", length="n")[:3] == ["", "", "hel"]


def test_unknown_operation(spark):
    df = text(spark, "a")
    with pytest.raises(ValueError):
        t.text_operations(df, [{"o_type": "reverse", "input": "s", "i_type": "column",
                                "new_column": "v"}])
    with pytest.raises(ValueError):
        t.text_operations(df, [{"o_type": "trim_spaces", "input": "s", "i_type": "column",
                                "side": "middle", "new_column": "v"}])
    with pytest.raises(ValueError):
        t.text_operations(df, [{"o_type": "left_right", "input": "s", "i_type": "column",
                                "from": "left", "length": "n", "l_type": "value",
                                "new_column": "v"}])

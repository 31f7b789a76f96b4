import datetime as dt
import decimal

import pytest

import tabloom as t


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def nulls(spark):
    return spark.createDataFrame(
        [(None, None, None, None), (1, 1.5, "x", dt.date(2024, 1, 1)), (None, 2.5, None, None)],
        "i int, f double, s string, d date")


def test_select_keeps_order_and_trims(nulls):
    assert t.select_columns(nulls, " s ,i").columns == ["s", "i"]
    assert t.select_columns(nulls, "*").columns == ["i", "f", "s", "d"]
    with pytest.raises(ValueError):
        t.select_columns(nulls, "s,,i")


def test_names_with_dots_and_blanks(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c d"])
    assert rows(t.select_columns(df, ["c d", "a.b"])) == [(2, 1)]
    assert t.set_column_value(df, "a.b", "e").columns == ["a.b", "c d", "e"]


def test_drop_ignores_unknown(nulls):
    assert t.drop_columns(nulls, "i, nope").columns == ["f", "s", "d"]


def test_rename_is_sequential_and_ignores_case(nulls):
    out = t.rename_columns(nulls, [
        {"column": "I", "renameColumn": "b"}, {"column": "b", "renameColumn": "c"},
        {"column": "nope", "renameColumn": "x"}])
    assert out.columns == ["c", "f", "s", "d"]


def test_cast_text(spark, ansi):
    text = ["12", " 12 ", "1.5", "-1.5", ".5", "abc", "", "1e3", "3000000000", None]
    df = spark.createDataFrame([(x,) for x in text], "s string")
    got = [r[0] for r in rows(t.change_column_type(df, "s", "int"))]
    assert got == [12, 12, 1, -1, 0, None, None, None, None, None]
    got = [r[0] for r in rows(t.change_column_type(df, "s", "bigint"))]
    assert got[8] == 3000000000
    got = [r[0] for r in rows(t.change_column_type(df, "s", "decimal(6,1)"))]
    assert got[:3] == [decimal.Decimal("12.0"), decimal.Decimal("12.0"), decimal.Decimal("1.5")]
    dates = spark.createDataFrame([("2024-1-5",), ("2024-13-01",)], "s string")
    assert rows(t.change_column_type(dates, "s", "date")) == [(dt.date(2024, 1, 5),), (None,)]


def test_cast_numbers_and_dates(spark, ansi):
    df = spark.createDataFrame([(2.9, dt.date(2024, 1, 1)), (-2.9, None)], "f double, d date")
    assert [r[0] for r in rows(t.change_column_type(df, "f", "int"))] == [2, -2]
    assert [r[1] for r in rows(t.change_column_type(df, "d", "int"))] == [None, None]
    assert [r[1] for r in rows(t.change_column_type(df, "d", "string"))] == ["2024-01-01", None]


def test_cast_bad_type(nulls):
    with pytest.raises(Exception, match="(?i)no_such_type"):
        t.change_column_type(nulls, "i", "no_such_type")


def test_constants(nulls, ansi):
    out = t.constant_columns(nulls, [
        {"column": "a", "constant": "7", "isNumeric": "True"},
        {"column": "b", "constant": "2.7", "isNumeric": "true"},
        {"column": "c", "constant": 2.7, "isNumeric": "true"},
        {"column": "e", "constant": "7", "isNumeric": "false"},
        {"column": "g", "constant": "9223372036854775808", "isNumeric": "true"},
        {"column": "i", "constant": "over", "isNumeric": "false"}])
    assert out.dtypes[4:8] == [("a", "int"), ("b", "double"), ("c", "double"), ("e", "string")]
    assert out.columns[0] == "i"
    first = out.first()
    assert (first.a, first.b, first.c, first.e, first.i) == (7, 2.7, 2.7, "7", "over")
    assert int(first.g) == 2**63
    with pytest.raises(ValueError):
        t.constant_columns(nulls, [{"column": "a", "constant": "x", "isNumeric": "true"}])


def test_fill_null_skips_other_types(nulls, ansi):
    out = rows(t.fill_null(nulls, "i, f, s, d", "7.9", "true"))
    assert out[0] == (7, 7.9, None, None)
    assert out[2] == (7, 2.5, None, None)
    out = rows(t.fill_null(nulls, ["s", "i"], "none", False))
    assert out[0] == (None, None, "none", None)
    with pytest.raises(Exception, match="nope"):
        t.fill_null(nulls, "nope", "1", "true").collect()


def test_copy_over(nulls):
    out = t.set_column_value(nulls, "f", "i")
    assert out.columns == nulls.columns and out.dtypes[0] == ("i", "double")

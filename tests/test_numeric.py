import math
from decimal import Decimal

import pytest

import tabloom as t


@pytest.fixture
def divisors(spark):
    return spark.createDataFrame(
        [(10, 0, 2.5, Decimal("7.00")), (10, None, 0.0, Decimal("0.00")), (-3, -1, -1.0, None),
         (2**31 - 1, 2**31 - 1, 1e300, Decimal("1.25"))],
        "a int, b int, x double, dec decimal(10,2)")


def values(df, name):
    return [r[name] for r in df.collect()]


def constant(df, source, operation, value):
    return values(t.column_constant_numeric(
        df, [{"source": source, "target": "v", "operation": operation, "value": value}]), "v")


def columns(df, first, operation, second):
    return values(t.column_column_numeric(df, [
        {"firstColumn": first, "secondColumn": second, "targetColumn": "v",
         "operation": operation}]), "v")


def test_division(divisors, ansi):
    assert constant(divisors, "a", "devide", "0") == [None] * 4
    assert constant(divisors, "a", "divide", 4)[:2] == [2.5, 2.5]
    assert columns(divisors, "a", "divide", "b")[:3] == [None, None, 3.0]
    assert columns(divisors, "a", "divide", "x")[:3] == [4.0, None, 3.0]
    out = t.column_constant_numeric(
        divisors, [{"source": "dec", "target": "v", "operation": "divide", "value": "2"}])
    assert dict(out.dtypes)["v"].startswith("decimal")
    assert values(out, "v")[0] == Decimal("3.5")


def test_overflow_is_null(divisors, ansi):
    assert columns(divisors, "a", "multiply", "b")[3] is None
    assert constant(divisors, "a", "add", 1)[3] is None
    assert constant(divisors, "b", "substract", 1)[:2] == [-1, None]
    assert columns(divisors, "a", "subtract", "b")[3] == 0


def test_constant_types(divisors, ansi):
    assert constant(divisors, "a", "multiply", "2.5")[0] == 25.0
    assert constant(divisors, "a", "multiply", "2")[0] == 20
    assert constant(divisors, "x", "add", "1")[0] == 3.5
    with pytest.raises(ValueError):
        constant(divisors, "a", "multiply", "two")
    with pytest.raises(ValueError):
        constant(divisors, "a", "power", "2")


def test_text_column_is_read_as_double(spark, ansi):
    df = spark.createDataFrame([("4", 2), ("x", 2), (None, 2)], "s string, i int")
    assert constant(df, "s", "add", "1") == [5.0, None, None]
    assert columns(df, "s", "multiply", "i") == [8.0, None, None]


def test_sequence(divisors):
    out = t.column_constant_numeric(divisors, [
        {"source": "a", "target": "a", "operation": "add", "value": 1},
        {"source": "a", "target": "c", "operation": "multiply", "value": 2},
        {"source": "x", "target": "y", "operation": "multiply", "value": 2},
        {"source": "a", "target": "a", "operation": "multiply", "value": 10}])
    first = out.first()
    assert (first.a, first.c, first.y) == (110, 22, 5.0)


def test_functions(spark, ansi):
    df = spark.createDataFrame([(180.0, 4.0, "2"), (None, -4.0, "x")], "a double, b double, s string")
    out = t.calculate(df, [
        {"o_type": "radians", "input_column": "a", "new_column": "r"},
        {"o_type": "sin", "input_column": "r", "new_column": "sn"},
        {"o_type": "cos", "input_column": "r", "new_column": "cs"},
        {"o_type": "sqrt", "input_column": "b", "new_column": "rt"},
        {"o_type": "atan2", "input1_column": "b", "input2_column": "a", "new_column": "at"},
        {"o_type": "power", "input1_column": "b", "input2": "2", "input2_type": "value",
         "new_column": "p1"},
        {"o_type": "power", "input1_column": "b", "input2": "s", "input2_type": "column",
         "new_column": "p2"}])
    one, two = out.collect()
    assert one.r == pytest.approx(math.pi) and one.sn == pytest.approx(0, abs=1e-12)
    assert one.cs == -1.0 and one.rt == 2.0 and one["at"] == pytest.approx(math.atan2(4, 180))
    assert one.p1 == 16.0 and one.p2 == 16.0
    assert two.r is None and math.isnan(two.rt) and two.p1 == 16.0 and two.p2 is None
    with pytest.raises(ValueError):
        t.calculate(df, [{"o_type": "tan", "input_column": "a", "new_column": "x"}])

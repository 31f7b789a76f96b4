"""Column arithmetic and mathematical functions (all narrow)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.batches import add_columns
from tabloom.functions.params import (
    choose, column, number_column, number_literal, operand, operand_inputs, parse_number,
)

# Both spellings of the verbs are valid in stored step definitions.
ARITHMETIC = {
    "multiply": F.try_multiply,
    "divide": F.try_divide,
    "devide": F.try_divide,
    "add": F.try_add,
    "subtract": F.try_subtract,
    "substract": F.try_subtract,
}

ONE_INPUT = {"radians": F.radians, "sin": F.sin, "cos": F.cos, "sqrt": F.sqrt}


def column_constant_numeric(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Column with constant: ``[{source, target, operation, value}]``."""

    def item(i):
        verb = choose(ARITHMETIC, i["operation"], "operation")
        value = number_literal(parse_number(i["value"]))
        return (
            i["target"], {i["source"]},
            lambda d: verb(number_column(d, column(d, i["source"])), value),
        )

    return add_columns(df, map(item, items))


def column_column_numeric(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Column with column: ``[{firstColumn, secondColumn, targetColumn, operation}]``."""

    def item(i):
        verb = choose(ARITHMETIC, i["operation"], "operation")
        first, second = i["firstColumn"], i["secondColumn"]
        return (
            i["targetColumn"], {first, second},
            lambda d: verb(
                number_column(d, column(d, first)), number_column(d, column(d, second))
            ),
        )

    return add_columns(df, map(item, items))


def calculate(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """radians, sin, cos, sqrt, atan2 and power as an operation list."""

    def item(i):
        kind = i["o_type"]
        if kind in ONE_INPUT:
            source = i["input_column"]
            return (
                i["new_column"], {source},
                lambda d: ONE_INPUT[kind](number_column(d, column(d, source))),
            )
        if kind == "atan2":
            y, x = i["input1_column"], i["input2_column"]
            return (
                i["new_column"], {y, x},
                lambda d: F.atan2(number_column(d, column(d, y)), number_column(d, column(d, x))),
            )
        if kind == "power":
            base, exponent, how = i["input1_column"], i["input2"], i["input2_type"]
            return (
                i["new_column"], {base} | operand_inputs((exponent, how)),
                lambda d: F.pow(number_column(d, column(d, base)), _exponent(d, exponent, how)),
            )
        raise ValueError(f"unknown calculation {kind!r}")

    return add_columns(df, map(item, items))


def _exponent(df: DataFrame, value: Any, kind: str) -> Column:
    if kind == "value":
        return number_literal(parse_number(value))
    return number_column(df, operand(df, value, kind))

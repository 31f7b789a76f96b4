"""Comparisons of a column with a constant, independent of the ANSI setting."""

from __future__ import annotations

import operator
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.params import (
    choose, is_numeric, is_text, number_literal, parse_number, type_of,
)

CONDITIONS = {
    "eq": operator.eq, "neq": operator.ne, "gt": operator.gt,
    "gte": operator.ge, "lt": operator.lt, "lte": operator.le,
}

COMPARISONS = {
    "=": operator.eq, "==": operator.eq, "<>": operator.ne, "!=": operator.ne,
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
    "<=>": lambda a, b: a.eqNullSafe(b),
}

PATTERNS = {
    "like": lambda c, text: c.like(text),
    "not like": lambda c, text: ~c.like(text),
    "ilike": lambda c, text: c.ilike(text),
    "not ilike": lambda c, text: ~c.ilike(text),
    "rlike": lambda c, text: c.rlike(text),
    "not rlike": lambda c, text: ~c.rlike(text),
    "regexp": lambda c, text: c.rlike(text),
    "not regexp": lambda c, text: ~c.rlike(text),
}


def comparable(df: DataFrame, col: Column, value: Any) -> tuple[Column, Column]:
    """Column and constant brought to one type; what does not convert is NULL."""
    kind = type_of(df, col)
    if isinstance(value, str):
        if is_numeric(kind):
            try:
                return col, number_literal(parse_number(value))
            except ValueError:
                return col, F.lit(None).cast(kind)
        if is_text(kind):
            return col, F.lit(value)
        return col, F.lit(value).try_cast(kind.simpleString())
    if isinstance(value, Decimal):
        constant = F.lit(value)
    else:
        constant = number_literal(value)
    if is_text(kind):
        return col.try_cast("double"), constant
    if isinstance(kind, T.BooleanType):
        return col.cast("int"), constant
    return col, constant


def condition(df: DataFrame, col: Column, name: str, value: Any) -> Column:
    """``eq, neq, gt, gte, lt, lte`` against a constant, or ``null``."""
    if name == "null":
        return col.isNull()
    compare = choose(CONDITIONS, name, "condition")
    return compare(*comparable(df, col, value))


def comparison(df: DataFrame, col: Column, symbol: str, value: Any, text: str) -> Column:
    """A comparison symbol or pattern word; ``text`` is the constant as written."""
    symbol = " ".join(str(symbol).lower().split())
    if symbol in PATTERNS:
        return PATTERNS[symbol](col.cast("string"), text)
    compare = choose(COMPARISONS, symbol, "comparison")
    return compare(*comparable(df, col, value))

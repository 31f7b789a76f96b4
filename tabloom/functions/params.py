"""Reading operator parameters: names, flags, numbers and typed literals.

Stored step definitions carry everything as text or JSON, so every operator
goes through these helpers to turn parameters into ``Column`` objects.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT_RANGE = (-(2**31), 2**31 - 1)
LONG_RANGE = (-(2**63), 2**63 - 1)


def name_list(names: str | Iterable[str]) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` as a list of trimmed names."""
    if isinstance(names, str):
        names = names.split(",")
    out = [str(n).strip() for n in names]
    if not out or any(not n for n in out):
        raise ValueError("column list must not be empty or hold empty names")
    return out


def flag(value: Any) -> bool:
    """Flags arrive as booleans or as the text ``"true"``/``"false"``."""
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ValueError(f"expected true or false, got {value!r}")
    return text == "true"


def parse_number(value: Any) -> int | float:
    """An int where the text is one, else a float, else ``ValueError``."""
    if isinstance(value, bool):
        raise ValueError(f"not a number: {value!r}")
    if isinstance(value, (int, float)):
        return value
    try:
        return int(str(value))
    except ValueError:
        return float(str(value))


def integer(value: Any) -> int:
    """A whole number given as a number or as text."""
    number = parse_number(value)
    if number != int(number):
        raise ValueError(f"whole number expected, got {value!r}")
    return int(number)


def number_literal(value: int | float) -> Column:
    """int, then bigint, then decimal for whole numbers; double otherwise."""
    if isinstance(value, int) and not LONG_RANGE[0] <= value <= LONG_RANGE[1]:
        return F.lit(Decimal(value))
    return F.lit(value)


def literal(value: Any, numeric: Any = False) -> Column:
    if value is None:
        return F.lit(None)
    if flag(numeric):
        return number_literal(parse_number(value))
    return F.lit(value)


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in (c.lower() for c in df.columns)


def column(df: DataFrame, name: str) -> Column:
    """The column of that exact name; names with dots or blanks need no quoting."""
    if has_column(df, name):
        return F.col("`" + name.replace("`", "``") + "`")
    return F.col(name)


def column_or_expression(df: DataFrame, text: str) -> Column:
    """A column name where one fits, else a SQL expression such as ``year(d)``."""
    return column(df, text) if has_column(df, text) else F.expr(text)


def type_of(df: DataFrame, col: Column) -> T.DataType:
    return df.select(col.alias("c")).schema[0].dataType


def row_hash(df: DataFrame) -> Column:
    """A number that spreads rows: the same again wherever a row is computed again.

    Maps and variants cannot be hashed, and equal column names cannot be told apart; a table
    with them gives 0.
    """
    names = [n.lower() for n in df.columns]
    if len(set(names)) < len(names) or any(
            word in f.dataType.simpleString() for f in df.schema for word in ("map<", "variant")):
        return F.lit(0).cast("bigint")
    return F.xxhash64(*[column(df, n) for n in df.columns]) if names else F.lit(0).cast("bigint")


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def number_column(df: DataFrame, col: Column) -> Column:
    """Text is read as double (NULL where it is no number); the rest stays."""
    return col.try_cast("double") if is_text(type_of(df, col)) else col


def operand(df: DataFrame, value: Any, kind: str) -> Column:
    """An operand given as ``column`` (a name) or ``value`` (a constant)."""
    if kind == "column":
        return column(df, str(value))
    if kind == "value":
        return F.lit(value)
    raise ValueError(f"operand type must be 'column' or 'value', got {kind!r}")


def operand_inputs(*pairs: tuple[Any, str]) -> set[str]:
    """The column names among ``(value, kind)`` operands."""
    return {str(v) for v, kind in pairs if kind == "column"}


def choose(table: Mapping[str, Any], key: Any, what: str) -> Any:
    """Look a verb up; unknown verbs are errors rather than silent no-ops."""
    if key not in table:
        raise ValueError(f"unknown {what} {key!r}; expected one of {sorted(table)}")
    return table[key]


def hashable(value: Any) -> Any:
    """A collected value in a form that Python can count and compare."""
    if isinstance(value, (list, tuple)):
        return tuple(hashable(v) for v in value)
    return bytes(value) if isinstance(value, bytearray) else value

"""Choosing, naming, typing and filling columns (all narrow)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.batches import add_columns
from tabloom.functions.params import (
    column, flag, is_text, literal, name_list, parse_number, type_of,
)

# Whole part of a decimal number in text; an exponent is not accepted.
DECIMAL_TEXT = r"^(\s*[+-]?)(\d*)\.\d*\s*$"


def select_columns(df: DataFrame, columns: str | Iterable[str] = "*") -> DataFrame:
    """Keep the named columns in the given order; ``*`` stands for all."""
    return df.select(*[F.col("*") if c == "*" else column(df, c) for c in name_list(columns)])


def drop_columns(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Drop the named columns; unknown names are ignored."""
    return df.drop(*name_list(columns))


def rename_columns(df: DataFrame, items: Iterable[Mapping[str, str]]) -> DataFrame:
    """Rename ``[{column, renameColumn}]`` one after the other (a to b, b to c)."""
    for item in items:
        df = df.withColumnRenamed(item["column"], item["renameColumn"])
    return df


def cast_column(df: DataFrame, col: Column, type_name: str) -> Column:
    """``col`` as ``type_name``, NULL where the value does not fit."""
    source = type_of(df, col)
    target = df.select(F.lit(None).cast(type_name)).schema[0].dataType
    if is_text(source) and isinstance(target, T.IntegralType):
        col = F.regexp_replace(col, DECIMAL_TEXT, "$10$2")
    if isinstance(source, T.DateType) and isinstance(target, (T.NumericType, T.BooleanType)):
        return F.lit(None).cast(type_name)
    return col.try_cast(type_name)


def change_column_type(df: DataFrame, column_name: str, column_type: str) -> DataFrame:
    """Recast one column in place."""
    return df.withColumn(column_name, cast_column(df, column(df, column_name), column_type))


def constant_columns(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Add constants ``[{column, constant, isNumeric}]``."""
    return add_columns(df, [
        (i["column"], set(), lambda _, i=i: literal(i["constant"], i.get("isNumeric", False)))
        for i in items
    ])


def set_column_value(df: DataFrame, source_column: str, target_column: str) -> DataFrame:
    """Copy a column into a new or an existing one."""
    return df.withColumn(target_column, column(df, source_column))


def fill_null(
    df: DataFrame, columns: str | Iterable[str], fill_value: Any, is_numeric: Any = False
) -> DataFrame:
    """Replace NULL in the named columns whose type suits the value."""
    value = parse_number(fill_value) if flag(is_numeric) else str(fill_value)
    return df.fillna(value, subset=name_list(columns))

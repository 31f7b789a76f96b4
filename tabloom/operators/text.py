"""Text operators (all narrow)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.batches import add_columns
from tabloom.functions.params import (
    choose, column, flag, integer, name_list, operand, operand_inputs,
)

FORMATS = {"lower": F.lower, "upper": F.upper, "capitalize": F.initcap}
ENDS = {"left": F.left, "right": F.right}
TRIMS = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}
PADS = {"left": F.lpad, "right": F.rpad}


def _java_quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def replace_text(
    df: DataFrame, column_name: str, old: str, new: str, literal: bool = False
) -> DataFrame:
    """Replace in place; ``old`` is a Java regular expression unless ``literal``."""
    if literal:
        old, new = _java_quote(old), re.sub(r"([\\$])", r"\\\1", new)
    return df.withColumn(
        column_name, F.regexp_replace(column(df, column_name), F.lit(old), F.lit(new))
    )


def format_text(df: DataFrame, column_name: str, formatting: str) -> DataFrame:
    """lower, upper or capitalize in place."""
    change = choose(FORMATS, formatting, "formatting")
    return df.withColumn(column_name, change(column(df, column_name)))


def concat_columns(
    df: DataFrame, first: str, second: str, target: str,
    operation: str = "concatenate", separator: str = " ",
) -> DataFrame:
    """Join two columns as text; NULL as soon as one of them is NULL."""
    if operation != "concatenate":
        raise ValueError(f"unknown operation {operation!r}; expected 'concatenate'")
    return df.withColumn(target, F.concat(
        column(df, first).cast("string"), F.lit(separator), column(df, second).cast("string")
    ))


def split_column(
    df: DataFrame, column_name: str, delimiter: str, new_col: str | Iterable[str],
    keep: Any = False, literal: bool = False,
) -> DataFrame:
    """Split a text column into the given new columns.

    ``keep`` leaves everything after the last needed delimiter in the last new
    column; otherwise that remainder is dropped. Missing parts are NULL. The
    delimiter is a Java regular expression unless ``literal``.
    """
    names = name_list(new_col)
    pattern = _java_quote(delimiter) if literal else delimiter
    parts = F.split(column(df, column_name), pattern, len(names) if flag(keep) else -1)
    # One withColumns: all parts come from the source as it was, even where a
    # new column takes the name of the source.
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def text_operations(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """substring, left_right, trim_spaces and pad_spaces as an operation list."""
    return add_columns(df, map(_text_item, items))


def _whole(df: DataFrame, value: Any, kind: str) -> Column:
    """A position or length: a whole number, or a column of them."""
    if kind == "value":
        return F.lit(integer(value))
    return operand(df, value, kind).try_cast("int")


def _text_item(i: Mapping[str, Any]):
    kind = choose({k: k for k in ("substring", "left_right", "trim_spaces", "pad_spaces")},
                  i["o_type"], "text operation")
    inputs = operand_inputs((i["input"], i["i_type"]))

    def text(d: DataFrame) -> Column:
        return operand(d, i["input"], i["i_type"]).cast("string")

    if kind == "trim_spaces":
        trim = choose(TRIMS, i["side"], "side")
        return i["new_column"], inputs, lambda d: trim(text(d))

    def length(d: DataFrame) -> Column:
        return _whole(d, i["length"], i["l_type"])

    inputs |= operand_inputs((i["length"], i["l_type"]))
    if kind == "substring":
        inputs |= operand_inputs((i["from"], i["f_type"]))
        return (
            i["new_column"], inputs,
            lambda d: F.substr(text(d), _whole(d, i["from"], i["f_type"]), length(d)),
        )
    if kind == "left_right":
        end = choose(ENDS, i["from"], "side")
        return i["new_column"], inputs, lambda d: end(text(d), length(d))
    pad = choose(PADS, i["side"], "side")
    return i["new_column"], inputs, lambda d: pad(text(d), length(d), " ")

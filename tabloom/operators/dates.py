"""Date and time operators (all narrow).

The result type follows the operand kinds, as users of stored steps expect:

* amount in a column, days or weeks: timestamp at midnight;
* amount in a column, hours to seconds: text ``yyyy-MM-dd HH:mm:ss``;
* constant amount: the type of the date operand, time of day kept;
* differences: double rounded to two places, or whole seconds as bigint.

``keep_time`` and ``as_timestamp`` switch the first two to timestamps that keep
the time of day.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.batches import add_columns
from tabloom.functions.params import (
    choose, integer, is_text, operand, operand_inputs, parse_number, type_of,
)

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAYS_IN = {"days": 1, "weeks": 7}
SECONDS_IN = {"hours": 3600, "minutes": 60, "seconds": 1}
DIFF_SECONDS = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}
# The parts of an interval: months as a 32-bit number, microseconds as a 64-bit one.
MONTHS_IN = {"year": 12, "month": 1}
MICROSECONDS_IN = {
    "week": 604_800_000_000, "day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000,
    "second": 1_000_000, "millisecond": 1_000, "microsecond": 1,
}
INTERVAL_UNITS = {
    unit + plural: unit
    for unit in ("year", "month", "week", "day", "hour", "minute", "second",
                 "millisecond", "microsecond")
    for plural in ("", "s")
}

PARTS = {
    "year_of_date": F.year,
    "quarter_of_date": F.quarter,
    "month_of_date": F.month,
    "day_of_week": F.dayofweek,
    "week_of_year": F.weekofyear,
}
SHIFTS = {"add_to_date": 1, "sub_from_date": -1}
TEXT_PARTS = {"day_of_year": "D", "day_of_month": "d"}

MOST_DAYS = 106_751_990   # days that a timestamp, and an interval, can hold


def date_operations(
    df: DataFrame, items: Iterable[Mapping[str, Any]],
    keep_time: bool = False, as_timestamp: bool = False,
) -> DataFrame:
    """An operation list of additions, subtractions, differences and date parts."""

    def item(i):
        kind = i["o_type"]
        first = (i["value1"], i["v1_type"])
        if kind in PARTS:
            return (i["new_column"], operand_inputs(first),
                    lambda d: PARTS[kind](_as_date(d, operand(d, *first))))
        if kind in TEXT_PARTS:
            return (i["new_column"], operand_inputs(first),
                    lambda d: F.date_format(_moment(operand(d, *first)), TEXT_PARTS[kind]))
        choose(SHIFTS | {"date_diff": 0}, kind, "date operation")
        second = (i["value2"], i["v2_type"])
        inputs = operand_inputs(first, second)
        if kind == "date_diff":
            choose(DIFF_SECONDS, i["unit"], "unit")
            return i["new_column"], inputs, lambda d: _difference(d, first, second, i["unit"])
        sign = SHIFTS[kind]
        if second[1] == "value":
            step = _interval(second[0], i["unit"])
            return i["new_column"], inputs, lambda d: _shift(d, first, step, sign)
        choose(DAYS_IN | SECONDS_IN, i["unit"], "unit")
        return (i["new_column"], inputs, lambda d: _shift_by_column(
            d, first, operand(d, *second), i["unit"], sign, keep_time, as_timestamp))

    return add_columns(df, map(item, items))


def _moment(col: Column) -> Column:
    return col.try_cast("timestamp")


def _as_date(df: DataFrame, col: Column) -> Column:
    return col.try_cast("date") if is_text(type_of(df, col)) else col


def _epoch(df: DataFrame, pair: tuple[Any, str]) -> Column:
    return F.unix_timestamp(_moment(operand(df, *pair)))


def _difference(df: DataFrame, first, second, unit: str) -> Column:
    seconds = _epoch(df, first) - _epoch(df, second)
    if unit == "seconds":
        return seconds
    return F.round(seconds / F.lit(DIFF_SECONDS[unit]), 2)


def _interval(amount: Any, unit: str) -> Column:
    """A constant interval; only seconds may have a fraction. One that no interval can hold
    is an error."""
    name = choose(INTERVAL_UNITS, str(unit).strip().lower(), "unit")
    number = parse_number(amount)
    if name != "second" or number == int(number):
        number = integer(amount)
    months = name in MONTHS_IN
    if abs(number) * (MONTHS_IN | MICROSECONDS_IN)[name] >= (2**31 if months else 2**63):
        raise ValueError(f"no interval can hold {number} {name}s")
    return F.expr(f"INTERVAL {number} {name}")


def _shift(df: DataFrame, first, step: Column, sign: int) -> Column:
    if first[1] == "value":
        start, text = _moment(operand(df, *first)), False
    else:
        start = operand(df, *first)
        text = is_text(type_of(df, start))
    if text:
        start = _moment(start)
    moved = F.try_add(start, step) if sign > 0 else F.try_subtract(start, step)
    return moved.cast("string") if text else moved


def _shift_by_column(
    df: DataFrame, first, amount: Column, unit: str, sign: int,
    keep_time: bool, as_timestamp: bool,
) -> Column:
    start = operand(df, *first)
    if unit in DAYS_IN:
        days = F.try_multiply(amount.try_cast("int"), F.lit(sign * DAYS_IN[unit]))
        if keep_time:
            near = F.when(F.abs(days) <= MOST_DAYS, days)
            return F.try_add(_moment(start), F.make_dt_interval(days=near))
        # Text and constants may carry a time of day, which a date cast drops.
        day = F.try_add(F.unix_date(start.try_cast("date")), days)
        return F.date_from_unix_date(F.when(F.abs(day) <= MOST_DAYS, day)).try_cast("timestamp")
    if is_text(type_of(df, amount)):
        amount = amount.try_cast("double")
    elif isinstance(type_of(df, amount), T.IntegralType):
        amount = amount.cast("bigint")
    moved = F.try_add(F.unix_timestamp(_moment(start)),
                      F.try_multiply(amount, F.lit(sign * SECONDS_IN[unit])))
    near = F.when(moved.between(-MOST_DAYS * 86_400, MOST_DAYS * 86_400), moved)
    moved = near.try_cast("timestamp")
    return moved if as_timestamp else F.date_format(moved, TEXT_FORMAT)

"""Conditional value mapping (all narrow)."""

from __future__ import annotations

import json
import operator
from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce
from itertools import groupby
from operator import and_, or_
from typing import Any, NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.params import (
    column, column_or_expression, flag, number_literal, parse_number, type_of,
)
from tabloom.functions.predicates import comparison, condition

LOOKED_UP = 8       # branches in a row from which on they become a look-up
MASKS = {"=": operator.eq, "==": operator.eq, "<>": operator.ne, "!=": operator.ne,
         ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def map_column(
    df: DataFrame, reference_column: str, target_column: str, condition_name: str,
    single_value: Any, value_if_true: Any, value_if_false: Any = None,
    value_is_numeric: Any = False, result_is_numeric: Any = False,
) -> DataFrame:
    """One condition, two results; a NULL reference takes the false result."""
    value = parse_number(single_value) if flag(value_is_numeric) and condition_name != "null" \
        else single_value
    results = [value_if_true, value_if_false]
    if flag(result_is_numeric):
        results = _numbers_of_one_type(results)
    yes, no = (number_literal(r) if isinstance(r, (int, float)) else F.lit(r) for r in results)
    test = condition(df, column(df, reference_column), condition_name, value)
    return df.withColumn(target_column, F.when(test, yes).otherwise(no))


def _numbers_of_one_type(values: list[Any]) -> list[Any]:
    """Both whole, else both floating point."""
    numbers = [None if v is None else parse_number(v) for v in values]
    if any(isinstance(n, float) for n in numbers):
        numbers = [None if n is None else float(n) for n in numbers]
    return numbers


def case_constant(value: Any) -> Decimal | float | str:
    """What reads as a number is one: exact where it has a plain decimal form."""
    try:
        number = float(value)
    except ValueError:
        return str(value)
    shown = repr(number)
    return number if not shown.lstrip("-").replace(".", "").isdigit() else Decimal(shown)


def map_cases(
    df: DataFrame, when: Iterable[Mapping[str, Any]], otherwise: Any, new_column: str
) -> DataFrame:
    """Several branches; the first true one wins.

    ``when`` is ``[{conditions: [{column, operation, value}], relation, asValue}]``
    with ``relation`` holding ``AND``/``OR`` after each condition but the last. Many branches in a
    row that compare one number or text column with constants become one look-up
    among the sorted constants, so that their number hardly matters.
    """
    branches = list(when)
    if not branches:
        raise ValueError("at least one branch is needed")
    if len(branches) >= LOOKED_UP and not df.isStreaming:
        runs = _runs(df, branches)
        if any(r.constants is not None for r in runs):
            return _looked_up(df, branches, runs, otherwise, new_column)
    tests = [_branch(df, b) for b in branches]
    values = [case_constant(v) for v in [b["asValue"] for b in branches] + [otherwise]]
    results = [F.lit(v) for v in values]
    if any(isinstance(v, str) for v in values):
        results = [r.cast("string") for r in results]
    mapped = F.when(tests[0], results[0])
    for test, result in zip(tests[1:], results[1:-1], strict=True):
        mapped = mapped.when(test, result)
    return df.withColumn(new_column, mapped.otherwise(results[-1]))


class _Run(NamedTuple):
    """Branches from ``first`` to before ``stop``; with ``constants``, one key's comparisons."""

    first: int
    stop: int
    key: Column | None = None
    constants: list | None = None


def _kind_of_key(df: DataFrame, name: str, values: list) -> tuple[str, Column, list] | None:
    """How constants compare with a column: as ``bigint``, ``double`` or ``string``."""
    col = column_or_expression(df, name)
    kind = type_of(df, col)
    numbers = all(not isinstance(v, str) for v in values)
    if isinstance(kind, T.IntegralType) and numbers:
        whole = [int(v) for v in values if v == v and abs(v) < 2**53 and v == int(v)]
        return ("bigint", col.cast("bigint"), whole) if len(whole) == len(values) else None
    if isinstance(kind, (T.FloatType, T.DoubleType)) or (kind.simpleString() == "string" and numbers):
        floats = [float(v) + 0.0 for v in values if not isinstance(v, str)]
        if len(floats) < len(values) or any(v != v or abs(v) == float("inf") for v in floats):
            return None
        return "double", col.try_cast("double"), floats
    if kind.simpleString() == "string" and all(isinstance(v, str) for v in values):
        return "string", col, values
    return None


def _runs(df: DataFrame, branches: list[Mapping[str, Any]]) -> list[_Run]:
    """The branches in stretches that one look-up can answer, and others."""
    def subject(branch: Mapping[str, Any]) -> tuple[str, bool] | None:
        names = {c["column"] for c in branch["conditions"]}
        symbols = {" ".join(str(c["operation"]).lower().split()) for c in branch["conditions"]}
        texts = {isinstance(case_constant(c["value"]), str) for c in branch["conditions"]}
        return (names.pop(), texts.pop()) if len(names) == len(texts) == 1 and symbols <= set(
            MASKS) else None

    runs, start = [], 0
    for name, group in groupby(map(subject, branches)):
        stop = start + len(list(group))
        found = None
        if name is not None and stop - start >= LOOKED_UP:
            values = [case_constant(c["value"]) for b in branches[start:stop]
                      for c in b["conditions"]]
            found = _kind_of_key(df, name[0], values)
        runs.append(_Run(start, stop, found[1], found) if found else _Run(start, stop))
        start = stop
    return runs


def _mask(places: np.ndarray, place: int, symbol: str) -> np.ndarray:
    """The stretches of the number line where a comparison holds: constant k is stretch 2k + 1."""
    return MASKS[symbol](places, 2 * place + 1)


def _first_branch(run: _Run, branches: list[Mapping[str, Any]]) -> tuple[list, list[int]]:
    """The run's constants in order, and the first true branch of each stretch between them."""
    kind, _, values = run.constants
    order = (lambda v: v.encode()) if kind == "string" else (lambda v: v)
    known = sorted(set(values), key=order)
    place = {v: k for k, v in enumerate(known)}
    places, given = np.arange(2 * len(known) + 1), iter(values)
    answers = np.full(len(places), -1)
    for i in range(run.first, run.stop):
        masks = [_mask(places, place[next(given)], " ".join(str(c["operation"]).lower().split()))
                 for c in branches[i]["conditions"]]
        answers[(answers < 0) & _related(branches[i], masks)] = i
    return known, answers.tolist()


def _constant(values: list, kind: str) -> Column:
    """An array as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _below(constants: Column, key: Column, size: int) -> Column:
    """How many of the sorted constants are below the key, by binary search."""
    steps = [1 << k for k in reversed(range(size.bit_length()))]
    return F.aggregate(_constant(steps, "int"), F.lit(0), lambda at, step: F.when(
        F.get(constants, at + step - F.lit(1)) < key, at + step).otherwise(at))


def _looked_up(df: DataFrame, branches, runs: list[_Run], otherwise: Any,
               new_column: str) -> DataFrame:
    """The number of the first true branch, then its value out of a constant array."""
    keys, choices = {}, []
    for n, run in enumerate(runs):
        if run.constants is None:
            choices += [F.when(_branch(df, branches[i]), F.lit(i))
                        for i in range(run.first, run.stop)]
            continue
        known, answers = _first_branch(run, branches)
        constants, key = _constant(known, run.constants[0]), F.col(f"__tabloom_case{n}")
        keys[f"__tabloom_case{n}"] = run.key
        keys[f"__tabloom_below{n}"] = _below(constants, key, len(known))
        at = F.col(f"__tabloom_below{n}")
        found = F.get(_constant(answers, "int"), at * 2 + F.coalesce(
            F.get(constants, at) == key, F.lit(False)).cast("int"))
        choices.append(F.when(key.isNotNull() & (found >= 0), found))
    values = [case_constant(v) for v in [b["asValue"] for b in branches] + [otherwise]]
    results = [F.lit(v) for v in values]
    if any(isinstance(v, str) for v in values):
        results = [r.cast("string") for r in results]
    rows = df
    for name, made in keys.items():
        rows = rows.withColumn(name, made)
    return rows.withColumn(new_column, F.get(F.array(*results), F.coalesce(
        *choices, F.lit(len(branches))))).drop(*keys)


def _branch(df: DataFrame, branch: Mapping[str, Any]) -> Column:
    tests = []
    for c in branch["conditions"]:
        col = column_or_expression(df, c["column"])
        tests.append(
            comparison(df, col, c["operation"], case_constant(c["value"]), str(c["value"]))
        )
    return _related(branch, tests)


def _related(branch: Mapping[str, Any], tests: list) -> Any:
    """The conditions' tests, columns or masks, joined by the words between them."""
    words = [str(w).strip().upper() for w in branch.get("relation") or []][: len(tests) - 1]
    if len(words) < len(tests) - 1 or any(w not in ("AND", "OR") for w in words):
        raise ValueError(f"AND or OR needed between conditions, got {branch.get('relation')!r}")
    # AND binds before OR: cut at each OR, join the pieces with AND.
    groups = [[tests[0]]]
    for word, test in zip(words, tests[1:], strict=True):
        if word == "AND":
            groups[-1].append(test)
        else:
            groups.append([test])
    return reduce(or_, [reduce(and_, g) for g in groups])

"""Stored step lists.

A step is ``{"id", "op", "input" | "inputs", "params"}``. Steps only build on each
other's DataFrames: nothing runs until the caller acts on the result, so filters and
column pruning reach the source across all steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import choose
from tabloom.operators.columns import (
    change_column_type, constant_columns, drop_columns, fill_null, rename_columns,
    select_columns, set_column_value,
)
from tabloom.operators.dates import date_operations
from tabloom.operators.groups import group_rows
from tabloom.operators.joins import join_tables
from tabloom.operators.mapping import map_cases, map_column
from tabloom.operators.numeric import calculate, column_column_numeric, column_constant_numeric
from tabloom.operators.rows import (
    append_rows, filter_rows, limit_rows, order_rows, preview, top_rows,
)
from tabloom.operators.selection import group_mode, group_percentiles
from tabloom.operators.sketches import deal_values, merge_sketches, sketch_states, sketch_values
from tabloom.operators.text import (
    concat_columns, format_text, replace_text, split_column, text_operations,
)
from tabloom.operators.windows import window_columns
from tabloom.sources.views import publish_view

OPERATORS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        select_columns, drop_columns, rename_columns, change_column_type, constant_columns,
        set_column_value, fill_null, filter_rows, order_rows, limit_rows, top_rows, preview,
        append_rows, column_constant_numeric, column_column_numeric, calculate, replace_text,
        format_text, concat_columns, split_column, text_operations, date_operations,
        map_column, map_cases, join_tables, group_rows, group_percentiles, group_mode, sketch_states, merge_sketches,
        sketch_values, deal_values, window_columns,
    )
}


def run_steps(
    tables: Mapping[str, DataFrame], steps: Iterable[Mapping[str, Any]],
    client: str | None = None, results: Iterable[str] | None = None, share: bool = False,
) -> Any:
    """Build the result of the last step from named tables.

    With ``client`` every step is also published as a view of that tenant, so that
    SQL text in a later filter can refer to it. With ``results`` the outcome is a dictionary
    of these steps' DataFrames. With ``share`` a step that several later steps or results
    read is written out once when it is reached, and all of them read that; else nothing runs
    here, and such a step is computed by each of its readers.
    """
    known, steps = dict(tables), list(steps)
    if not steps:
        raise ValueError("no steps given")
    wanted = [steps[-1]["id"]] if results is None else list(results)
    readers = Counter(n for step in steps for n in _inputs(step))
    readers.update(wanted)
    made: dict[str, DataFrame] = {}
    for step in steps:
        operator = choose(OPERATORS, step["op"], "operator")
        inputs = [choose(known, n, "input") for n in _inputs(step)]
        result = operator(*inputs, **step.get("params", {}))
        if share and readers[step["id"]] > 1 and not result.isStreaming:
            result = stage(result, "step")
        known[step["id"]] = made[step["id"]] = result
        if client is not None:
            publish_view(result, client, step["id"])
    if results is None:
        return result
    return {name: choose(made, name, "result") for name in wanted}


def _inputs(step: Mapping[str, Any]) -> list[str]:
    return step["inputs"] if "inputs" in step else [step["input"]]

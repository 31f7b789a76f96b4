"""Adding many columns with few plan nodes.

An operation list is sequential: every item sees the columns made by the items
before it. Chaining ``withColumn`` per item re-analyses the whole plan each time,
so items that do not depend on each other go into one ``withColumns``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame

Item = tuple[str, set[str], Callable[[DataFrame], Column]]


def add_columns(df: DataFrame, items: Iterable[Item]) -> DataFrame:
    """Apply ``(target, input names, build)`` items in order."""
    pending: dict[str, Column] = {}

    def flush(frame: DataFrame) -> DataFrame:
        return frame.withColumns(pending) if pending else frame

    for target, inputs, build in items:
        made = {p.lower() for p in pending}
        if target.lower() in made or made & {i.lower() for i in inputs}:
            df, pending = flush(df), {}
        pending[target] = build(df)
    return flush(df)

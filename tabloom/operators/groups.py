"""Group-by with a list of named aggregates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.params import (
    column_or_expression, has_column, is_text, name_list, type_of,
)


def _total(c: Column, kind: T.DataType) -> Column:
    # Only whole numbers and decimals can overflow; doubles keep the plain sum.
    return F.sum(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.try_sum(c)


def _mean(c: Column, kind: T.DataType) -> Column:
    return F.try_avg(c) if isinstance(kind, T.DecimalType) else F.avg(c)


def _plain(fn):
    return lambda c, kind: fn(c)


# One-argument aggregates that combine on the map side and keep a state of bounded
# size per group. Text input of the first table is read as double.
NUMERIC_AGGREGATES = {
    "sum": _total,
    "avg": _mean,
    "mean": _mean,
    "stddev": _plain(F.stddev),
    "std": _plain(F.stddev),
    "stddev_samp": _plain(F.stddev_samp),
    "stddev_pop": _plain(F.stddev_pop),
    "variance": _plain(F.variance),
    "var_samp": _plain(F.var_samp),
    "var_pop": _plain(F.var_pop),
    "skewness": _plain(F.skewness),
    "kurtosis": _plain(F.kurtosis),
}
AGGREGATES = {
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "first": F.first,
    "first_value": F.first_value,
    "last": F.last,
    "last_value": F.last_value,
    "any_value": F.any_value,
    "approx_count_distinct": F.approx_count_distinct,
    "count_if": F.count_if,
    "any": F.bool_or,
    "try_sum": F.try_sum,
    "try_avg": F.try_avg,
    "hll_sketch_agg": F.hll_sketch_agg,
    "bool_and": F.bool_and,
    "every": F.every,
    "bool_or": F.bool_or,
    "some": F.some,
    "bit_and": F.bit_and,
    "bit_or": F.bit_or,
    "bit_xor": F.bit_xor,
}
DISTINCT = re.compile(r"\s*distinct\s+(.+)$", re.IGNORECASE | re.DOTALL)

# These hold all values of a group at once (median and mode: its distinct ones).
WHOLE_GROUP_AGGREGATES = {
    "collect_list": F.collect_list,
    "array_agg": F.array_agg,
    "collect_set": F.collect_set,
    "listagg": F.listagg,
    "string_agg": F.string_agg,
    "median": F.median,
    "mode": F.mode,
}


# Aggregates of an ordered group: ``x, fraction`` stands for WITHIN GROUP (ORDER BY x).
ORDERED_AGGREGATES = ("percentile_cont", "percentile_disc")
NAME = re.compile(r"[a-z_][a-z0-9_]*(\.[a-z_][a-z0-9_]*){0,2}$")


def group_rows(
    df: DataFrame, index: str | Iterable[str], agg: Iterable[Mapping[str, Any]],
    max_group_rows: int | None = None,
) -> DataFrame:
    """Aggregates ``[{agg_func, col, col_name}]`` per combination of ``index``.

    ``index`` entries and ``col`` are column names or expressions; ``col`` may also
    be ``*`` or ``distinct x``, and several arguments (``x, 0.5``) where the aggregate takes
    them. Any aggregate the session knows is allowed, registered ones too; ``percentile_cont``
    and ``percentile_disc`` take ``x, fraction``. Some aggregates hold all values of a group at once (``collect_list`` and the
    like); with ``max_group_rows`` the groups are counted first, and one that is larger is
    an error, never cut.
    """
    keys = [column_or_expression(df, k) for k in name_list(index)]
    entries = list(agg)
    if not entries:
        raise ValueError("at least one aggregate is needed")
    columns = [_aggregate(df, e).alias(e["col_name"]) for e in entries]
    held = any(e["agg_func"].strip().lower() in WHOLE_GROUP_AGGREGATES for e in entries)
    if held and max_group_rows is not None:
        _check_group_sizes(df, keys, max_group_rows)
    return df.groupBy(*keys).agg(*columns)


def _aggregate(df: DataFrame, entry: Mapping[str, Any]) -> Column:
    name, text = entry["agg_func"].strip().lower(), str(entry["col"]).strip()
    known = NUMERIC_AGGREGATES | AGGREGATES | WHOLE_GROUP_AGGREGATES
    if name not in known and name not in (*ORDERED_AGGREGATES, "product") and not (
            NAME.match(name) and df.sparkSession.catalog.functionExists(name)):
        raise ValueError(f"unknown aggregate {name!r}; the session has no function of that name")
    if name in ("grouping", "grouping_id"):
        raise ValueError(f"{name} tells grouping sets apart, and there is only one")
    if text == "*":
        if name != "count":
            raise ValueError(f"{name}(*) has no meaning")
        return F.count(F.lit(1))
    distinct = DISTINCT.match(text)
    if distinct:
        return _distinct(name, df, distinct.group(1))
    if name in ORDERED_AGGREGATES:
        value, _, fraction = text.rpartition(",")
        if not value:
            raise ValueError(f"{name} needs a value and a fraction, as in 'x, 0.5'")
        return F.expr(f"{name}({fraction}) WITHIN GROUP (ORDER BY {value})")
    if name == "product":
        return F.product(column_or_expression(df, text))
    if not has_column(df, text) and (name not in known or _several(text)):
        return F.expr(f"{name}({text})")
    col = column_or_expression(df, text)
    if name not in known:
        return F.call_function(name, col)
    if name not in NUMERIC_AGGREGATES:
        return (AGGREGATES | WHOLE_GROUP_AGGREGATES)[name](col)
    kind = type_of(df, col)
    if is_text(kind):
        col, kind = col.try_cast("double"), T.DoubleType()
    return NUMERIC_AGGREGATES[name](col, kind)


def _distinct(name: str, df: DataFrame, text: str) -> Column:
    """``name(DISTINCT text)``; SQL text is the one form that takes any aggregate."""
    if has_column(df, text):
        text = "`" + text.replace("`", "``") + "`"
    if name in NUMERIC_AGGREGATES and is_text(type_of(df, F.expr(text))):
        text = f"try_cast({text} AS DOUBLE)"
    return F.expr(f"{name}(DISTINCT {text})")


def _several(text: str) -> bool:
    """Whether SQL text holds a comma outside of brackets and quotes."""
    bare = re.sub(r"'[^']*'|\"[^\"]*\"|`[^`]*`", "", text)
    while (shorter := re.sub(r"\([^()]*\)|\[[^\[\]]*\]", "", bare)) != bare:
        bare = shorter
    return "," in bare


def _check_group_sizes(df: DataFrame, keys: list[Column], bound: int) -> None:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    if not sizes.where(F.col("rows") > bound).isEmpty():
        raise ValueError(f"a group has more than {bound} rows")

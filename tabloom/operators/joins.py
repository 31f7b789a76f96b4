"""Equi-joins of two tables.

Spark picks broadcast or shuffle by size, and its adaptive execution cuts skewed
shuffle partitions by map output, which also spreads full copies of one row. It can
do so only on the side whose unmatched rows are kept (both sides of an inner join),
never in a full join. Where the other side holds a very frequent key, the join is
written as two: the frequent keys as a join that can be cut, the rest as it was.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import (
    choose, column, flag, is_text, row_hash, type_of,
)

HOW = {"left": "left", "right": "right", "inner": "inner", "outer": "full"}

# The sides whose shuffle partitions Spark leaves whole.
CANNOT_CUT = {"left": "right", "right": "left", "full": "left right", "inner": ""}

# What a join becomes for keys that are known to occur on one side.
IN_RIGHT = {"left": "inner", "inner": "inner", "right": "right", "full": "right"}
IN_LEFT = {"left": "left", "inner": "inner", "right": "inner", "full": "left"}

HOT_ROWS = 1_000_000    # rows of one key that are too many for one task
TRACKED = 1 << 17       # counters of the summary that finds such keys: two megabytes
SUMMARIES = 64          # summaries of tasks that are merged side by side before the last merge
KEY_BYTES = 1 << 26     # bytes of frequent keys up to which their table is broadcast
LEFT_SPREAD, RIGHT_SPREAD = "__tabloom_left_spread", "__tabloom_right_spread"


def join_tables(
    left: DataFrame, right: DataFrame, how: str, on: Iterable[Mapping[str, str]],
    is_duplicate: Any = False, dataset: str = "", duplicate_col: Iterable[str] = (),
    hot_keys: str | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join on ``[{left_on, right_on}]``; both key columns stay in the result.

    With ``is_duplicate`` the left columns ``duplicate_col`` are first renamed to
    ``{dataset}_{column}``, and ``left_on`` uses the new name. NULL keys match nothing.

    The join is lazy and left to Spark's adaptive execution; rows with a NULL key are spread
    over all tasks of a full join. On request, very frequent keys are looked for and joined
    apart: ``hot_keys="auto"`` looks for keys with more than ``hot_rows`` rows on the side
    Spark cannot cut, ``"all"`` on both sides of any join, for a join whose keys are grouped
    next (Spark then keeps its partitions whole). Both inputs are then written out once, so
    that what comes before runs once and all parts see the same rows. Frequent keys are found
    by a summary of bounded size that tasks merge, counted exactly, and kept as a table: any
    number of them, none on the driver. The result is the same in each case.
    """
    kind = choose(HOW, how, "join kind")
    if flag(is_duplicate or False):
        left = left.withColumnsRenamed({c: f"{dataset}_{c}" for c in duplicate_col})
    pairs = [(p["left_on"], p["right_on"]) for p in on]
    if not pairs:
        raise ValueError("at least one key pair is needed")
    left_keys, right_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    if hot_keys not in ("auto", "all", None):
        raise ValueError("hot_keys must be 'auto', 'all' or None")
    sides = {"auto": CANNOT_CUT[kind], "all": "left right", None: ""}[hot_keys]
    if left.isStreaming or right.isStreaming:
        sides = ""
    if sides:
        left, right = _written(left, "left"), _written(right, "right")
    if sides and all(_alike(left, a, right, b) for a, b in pairs):
        found = [_frequent_keys(side, keys, hot_rows).select(
            *_wide([f"k{i}" for i in range(len(pairs))], left, left_keys),
            F.lit(name == "left").alias("in_left"), F.lit(name == "right").alias("in_right"))
            for name, side, keys in (("left", left, left_keys), ("right", right, right_keys))
            if name in sides]
        names = [f"k{i}" for i in range(len(pairs))]
        hot = stage(reduce(DataFrame.union, found).groupBy(*names).agg(
            F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right")),
            "hot-keys")
        if not hot.isEmpty():
            return _join_in_parts(left, right, left_keys, right_keys, kind, hot)
    return _join(left, right, left_keys, right_keys, kind)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a written table; equal column names are set apart meanwhile."""
    names = df.columns
    return stage(df.toDF(*[f"c{i}" for i in range(len(names))]), name).toDF(*names)


def _spread_nulls(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add a number that is 0 where all keys are set, else scattered: such rows match nothing."""
    missing = reduce(or_, [column(df, k).isNull() for k in keys])
    scattered = F.xxhash64(F.spark_partition_id(), row_hash(df))
    return df.withColumn(name, F.when(missing, scattered).otherwise(F.lit(0)))


def _join(left, right, left_keys, right_keys, kind: str) -> DataFrame:
    spread = kind == "full" and not (left.isStreaming or right.isStreaming)
    if spread:
        left = _spread_nulls(left, left_keys, LEFT_SPREAD)
        right = _spread_nulls(right, right_keys, RIGHT_SPREAD)
    # Aliases keep equal column names apart, also when a table is joined to itself.
    l, r = left.alias("l"), right.alias("r")
    tests = []
    for a, b in zip(left_keys, right_keys, strict=True):
        x, y = F.col(f"l.`{a}`"), F.col(f"r.`{b}`")
        if _mixed(left, a, right, b):
            # Text against another type: text that does not convert matches nothing.
            if is_text(type_of(left, column(left, a))):
                x = x.try_cast(type_of(right, column(right, b)))
            else:
                y = y.try_cast(type_of(left, column(left, a)))
        tests.append(x == y)
    if spread:
        tests.append(F.col(f"l.{LEFT_SPREAD}") == F.col(f"r.{RIGHT_SPREAD}"))
    return l.join(r, reduce(and_, tests), kind).drop(LEFT_SPREAD, RIGHT_SPREAD)


def _mixed(left: DataFrame, a: str, right: DataFrame, b: str) -> bool:
    return is_text(type_of(left, column(left, a))) != is_text(type_of(right, column(right, b)))


def _alike(left: DataFrame, a: str, right: DataFrame, b: str) -> bool:
    """Key types between which Spark and Python agree on what is equal."""
    x, y = type_of(left, column(left, a)), type_of(right, column(right, b))
    return x == y or (isinstance(x, T.IntegralType) and isinstance(y, T.IntegralType))


def _wide(names: list[str], df: DataFrame, keys: list[str]) -> list[Column]:
    """Key columns with whole numbers of one width, whichever side they are from."""
    return [F.col(n).cast("bigint").alias(n) if isinstance(
        type_of(df, column(df, k)), T.IntegralType) else F.col(n)
        for n, k in zip(names, keys, strict=True)]


def _frequent_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """The keys (``k0``, ``k1``, ...) with ``hot_rows`` rows or more.

    A summary of ``TRACKED`` counters finds hashes of keys that may be that frequent; it misses
    none that holds more than 3.5 / ``TRACKED`` of all rows, and a rarer one is
    no burden for a task. Rows with these hashes are then counted by their keys.
    """
    whole = reduce(and_, [column(df, k).isNotNull() for k in keys])
    names = [f"k{i}" for i in range(len(keys))]
    slim = df.where(whole).select(
        *[column(df, k).alias(n) for k, n in zip(keys, names, strict=True)])
    hashed = slim.withColumn("hash", F.xxhash64(*names))
    # Task summaries meet in a few places first, so that no task merges all of them.
    merged = hashed.groupBy((F.spark_partition_id() % SUMMARIES).alias("place")).agg(
        F.expr(f"approx_top_k_accumulate(hash, {TRACKED})").alias("state"))
    listed = merged.agg(F.expr(f"approx_top_k_combine(state, {TRACKED})").alias("state")).select(
        F.explode(F.expr(f"approx_top_k_estimate(state, {TRACKED})")).alias("top"))
    often = stage(listed.where(F.col("top.count") >= hot_rows).select("top.item"), "often")
    # At most `TRACKED` numbers, whatever the table.
    counted = hashed.join(F.broadcast(often), F.col("hash") == F.col("item"), "left_semi").groupBy(
        *names).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= hot_rows).select(*names)


def _join_in_parts(left, right, left_keys, right_keys, kind: str, hot: DataFrame) -> DataFrame:
    """Frequent keys apart from the rest, each part as a join Spark can cut.

    A key frequent on the right occurs there, so left rows with it always match:
    for these keys a left join is an inner join, and a full join is a right join.
    The mirrored statement holds for keys frequent on the left; a key frequent on
    both sides is an inner join.
    """
    names = [f"k{i}" for i in range(len(left_keys))]
    seen = hot.agg(
        F.bool_or(F.col("in_left") & F.col("in_right")), F.bool_or(~F.col("in_left")),
        F.bool_or(~F.col("in_right")),
        F.sum(sum((F.octet_length(F.col(n).cast("string")) for n in names), F.lit(0)))).first()
    groups = [
        (F.col("in_left") & F.col("in_right"), "inner"),
        (~F.col("in_left"), IN_RIGHT[kind]),
        (~F.col("in_right"), IN_LEFT[kind]),
    ]
    small = seen[3] <= KEY_BYTES

    def pick(side: DataFrame, keys: list[str], values: DataFrame, how: str) -> DataFrame:
        """Rows with one of the keys (``left_semi``) or with none (``left_anti``)."""
        # Beyond the bound Spark decides; it can cut the large side of these joins.
        table = F.broadcast(values) if small else values
        match = reduce(and_, [
            F.col(f"s.`{k}`") == F.col(f"h.{n}") for n, k in zip(names, keys, strict=True)])
        return side.alias("s").join(table.alias("h"), match, how)

    joined = [_join(pick(left, left_keys, hot, "left_anti"), pick(right, right_keys, hot, "left_anti"),
                    left_keys, right_keys, kind)]
    for there, (chosen, part_kind) in zip(seen[:3], groups, strict=True):
        if there:
            values = hot.where(chosen)
            joined.append(_join(
                pick(left, left_keys, values, "left_semi"),
                pick(right, right_keys, values, "left_semi"), left_keys, right_keys, part_kind,
            ))
    return reduce(DataFrame.union, joined)

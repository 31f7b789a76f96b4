"""Places of rows within their groups, without one task per group."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named


def ranked(rows: DataFrame, groups: list[str], order: list[str], place: str = "place",
           size: str = "size") -> tuple[DataFrame, DataFrame]:
    """``rows`` with their ``place`` (from 0) among the rows of their group and the group's
    ``size``; and the groups with their sizes.

    Rows are cut into ranges of ``groups`` and ``order`` and sorted there; a group that is cut
    goes on counting where the range before it ended, by a table of at most one row for each
    range and one for each group. So a group of any size is spread over all tasks. Nulls
    come first and form a group of their own. ``order`` must tell rows of a group apart (end it
    with a row number), or copies would share one range.
    """
    keys = [named(c) for c in (*groups, *order)]
    placed = stage(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({
            "__range": F.spark_partition_id(), "__pos": F.monotonically_increasing_id()}), "ranked")
    pieces = stage(placed.groupBy("__range", *map(named, groups)).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__n")), "ranges")
    whole = pieces.groupBy(*map(named, groups)).agg(F.sum("__n").alias(size))
    before = W.partitionBy(*map(named, groups)).orderBy("__range")
    starts = _together(
        pieces.withColumn("__before", F.sum("__n").over(
            before.rowsBetween(W.unboundedPreceding, -1))), whole, groups, [size])
    found = _together(placed, starts, ["__range", *groups], ["__first", "__before", size])
    counted = F.col("__pos") - F.col("__first") + F.coalesce("__before", F.lit(0))
    return (found.withColumn(place, counted)
            .drop("__range", "__pos", "__first", "__before"), whole)


def _together(left: DataFrame, right: DataFrame, keys: list[str], more: list[str]) -> DataFrame:
    """Inner join by keys that may be null, with ``more`` columns of the right side."""
    if not keys:
        keys, left, right = ["__one"], left.withColumn("__one", F.lit(0)), right.withColumn(
            "__one", F.lit(0))
    names = [f"__right{i}" for i in range(len(keys))]
    right = right.select(*[named(k).alias(n) for k, n in zip(keys, names, strict=True)],
                         *map(named, more))
    same = [named(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return left.join(right, reduce(and_, same)).drop(*names, "__one")

"""Exact percentiles and modes of groups that no task can hold.

Spark's ``percentile`` and ``median`` keep every distinct value of a group in one task. Here
the value at a rank is found by narrowing: a quantile sketch of the values left (of bounded size,
merged from all tasks) gives two bounds around the rank, a count confirms that the rank
lies between them, and the next round looks at the values in between only, a few thousandths of
those before. Two or three rounds leave few enough to be sorted.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import column_or_expression, name_list

HELD = 100_000      # values of a group that one task may hold
SKETCH = 4_096      # k of the quantile sketch; ranks are off by less than a thousandth
STEPS = 256         # bounds a sketch is asked for, evenly apart


def group_percentiles(df: DataFrame, index: str | Iterable[str], column: str,
                      fractions: Mapping[str, float], held: int = HELD) -> DataFrame:
    """Per combination of ``index``: the exact percentile of ``column`` for each name's fraction.

    As ``percentile``: NULLs are left out, values are read as doubles and NaN comes last,
    between two values the result is interpolated; a group without values gives NULL. Groups of up to
    ``held`` values are left to Spark; for larger ones no task holds more than about that
    many values. The result does not depend on ``held``.
    """
    names = name_list(index)
    wanted = {name: float(f) for name, f in fractions.items()}
    if not wanted or any(not 0 <= f <= 1 for f in wanted.values()):
        raise ValueError("fractions from 0 to 1 are needed")
    keys = [f"g{i}" for i in range(len(names))]
    values = df.select(
        *[column_or_expression(df, n).alias(k) for n, k in zip(names, keys, strict=True)],
        column_or_expression(df, column).try_cast("double").alias("x"))
    # Null keys are a group; as one struct, they equal each other in joins.
    values = values.select(F.struct(*keys).alias("g"), "x")
    sizes = stage(values.groupBy("g").agg(
        F.count("x").alias("n"), F.count_if(F.col("x").isNotNull() & ~F.isnan("x")).alias("m")), "sizes")
    large = sizes.where(F.col("n") > held)
    small = values.join(large.select("g"), "g", "left_anti") if not large.isEmpty() else values
    found = small.groupBy("g").agg(*[
        F.percentile("x", F.lit(f)).alias(name) for name, f in wanted.items()])
    if not large.isEmpty():
        found = found.unionByName(_selected(values, large, wanted, held))
    return found.select(*[F.col("g")[k].alias(n) for k, n in zip(keys, names, strict=True)],
                        *wanted)


def _selected(values: DataFrame, sizes: DataFrame, wanted: Mapping[str, float],
              held: int) -> DataFrame:
    """The percentiles of large groups, from the values at the ranks around each."""
    places = [F.struct(F.lit(name).alias("name"), (F.lit(f) * (F.col("n") - 1)).alias("place"))
              for name, f in wanted.items()]
    asked = sizes.select("g", "m", F.explode(F.array(*places)).alias("p")).select(
        "g", "m", "p.name", "p.place", F.explode(F.array_distinct(F.array(
            F.floor("p.place"), F.ceil("p.place")))).alias("rank"))
    asked = stage(asked, "asked")
    ranks = asked.where("rank < m").select("g", "rank").distinct()
    known = values_at(values.where(~F.isnan("x")), ranks, held)
    at = asked.join(known, ["g", "rank"], "left").withColumn(
        "x", F.coalesce("x", F.lit(float("nan"))))
    part = F.col("place") - F.floor("place")
    low, high = F.min_by("x", "rank"), F.max_by("x", "rank")
    share = F.first(part)
    both = at.groupBy("g", "name").agg(F.when(low == high, low).otherwise(
        (F.lit(1.0) - share) * low + share * high).alias("v"))
    return both.groupBy("g").agg(*[
        F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in wanted])


def _near(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with each target of their group whose bounds they are within."""
    return rows.join(targets, "g").where((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")))


def listed_values(rows: DataFrame, few: DataFrame, kind: str) -> DataFrame:
    """``g, rank, x`` for targets ``g, rank, low, high, below`` that few values are within."""
    each = _near(rows, few).groupBy("g", "rank", "below", "x").agg(F.count("x").alias("many"))
    listed = each.groupBy("g", "rank", "below").agg(
        F.sort_array(F.collect_list(F.struct("x", "many"))).alias("v"))
    passed = F.aggregate(
        "v", F.struct(F.col("below").alias("to"), F.lit(None).cast(kind).alias("x")),
        lambda a, v: F.struct((a["to"] + v["many"]).alias("to"), F.when(
            a["x"].isNotNull(), a["x"]).when(a["to"] + v["many"] > F.col("rank"), v["x"])
            .alias("x")))
    return listed.select("g", "rank", passed["x"].alias("x"))


def values_at(rows: DataFrame, ranks: DataFrame, held: int, kind: str = "double") -> DataFrame:
    """``g, rank, x``: the value at each rank (from 0) of its group's sorted values.

    Targets are a few for each large group, so that their number is bounded by the rows over
    ``held``. Values are of ``kind``, ``double`` or ``bigint``.
    """
    least, most = {"double": (float("-inf"), float("inf")), "bigint": (-2**63, 2**63 - 1)}[kind]
    open_ = stage(ranks.withColumns({"low": F.lit(least).cast(kind),
                                     "high": F.lit(most).cast(kind), "below": F.lit(0).cast("long"),
                                     "wide": F.lit(1)}), "targets")
    found: list[DataFrame] = []
    while not open_.isEmpty():
        sketched = _near(rows, open_).groupBy("g", "rank").agg(
            F.expr(f"kll_sketch_agg_{kind}(x, {SKETCH})").alias("s"), F.count("x").alias("n"),
            F.min("x").alias("least"), F.max("x").alias("most"))
        asked = ", ".join(f"{k / STEPS!r}D" for k in range(STEPS + 1))
        histogram = stage(sketched.withColumn("marks", F.expr(
            f"kll_sketch_get_quantile_{kind}(s, array({asked}))")).drop("s"), "histograms")
        at = (F.col("rank") - F.col("below")) / F.col("n") * STEPS
        down, up = F.floor(at) - F.col("wide"), F.ceil(at) + F.col("wide")
        tried = stage(histogram.join(open_, ["g", "rank"]).withColumns({
            "from": F.when(down <= 0, F.col("least")).otherwise(
                F.get("marks", down.cast("int"))),
            "to": F.when(up >= STEPS, F.col("most")).otherwise(
                F.get("marks", up.cast("int")))}).drop("marks"), "bounds")
        between = (F.col("x") >= F.col("from")) & (F.col("x") <= F.col("to"))
        counted = _near(rows, tried).groupBy("g", "rank").agg(
            F.count_if(F.col("x") < F.col("from")).alias("under"),
            F.count_if(between).alias("inside"),
            F.approx_count_distinct(F.when(between, F.col("x"))).alias("kinds"))
        at = F.col("rank") - F.col("below")
        held_in = (at >= F.col("under")) & (at < F.col("under") + F.col("inside"))
        judged = stage(tried.join(counted, ["g", "rank"]).select(
            "g", "rank", F.when(held_in, F.col("from")).otherwise(F.col("low")).alias("low"),
            F.when(held_in, F.col("to")).otherwise(F.col("high")).alias("high"),
            (F.col("below") + F.when(held_in, F.col("under")).otherwise(0)).alias("below"),
            # A rank that fell outside is tried again with wider bounds.
            F.when(held_in, F.lit(1)).otherwise(F.col("wide") * 8).alias("wide"),
            (held_in & (F.col("from") == F.col("to"))).alias("one"),
            held_in.alias("sure"), "kinds"), "targets")
        found.append(judged.where("one").select("g", "rank", F.col("low").alias("x")))
        # Values that come often count once, so they are few however many rows hold them.
        settled = F.col("sure") & (F.col("kinds") <= held)
        few = judged.where(~F.col("one") & settled)
        found.append(listed_values(rows, few, kind))
        open_ = judged.where(~F.col("one") & ~settled).drop("one", "sure", "kinds")
        if not open_.isEmpty():
            open_ = stage(open_, "targets")
            spans = open_.groupBy("g").agg(F.min("low").alias("low"), F.max("high").alias("high"))
            rows = stage(_near(rows, spans).select("g", "x"), "values")
    if not found:
        return rows.select("g", F.lit(0).cast("long").alias("rank"), "x").where("false")
    return reduce(DataFrame.unionByName, found)


def group_mode(df: DataFrame, index: str | Iterable[str], column: str, name: str) -> DataFrame:
    """Per combination of ``index``: the most frequent value of ``column``, of several the least.

    Values are counted by group and value before groups are looked at, so that no task holds a
    group. NULLs are left out; a group without values gives NULL.
    """
    names = name_list(index)
    keys = [f"g{i}" for i in range(len(names))]
    values = df.select(
        *[column_or_expression(df, n).alias(k) for n, k in zip(names, keys, strict=True)],
        column_or_expression(df, column).alias("x"))
    counted = values.groupBy(*keys, "x").agg(F.count("x").alias("n"))
    most = counted.groupBy(*keys).agg(F.max("n").alias("most"))
    same = reduce(and_, [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys])
    best = counted.where("x IS NOT NULL").alias("c").join(
        most.alias("m"), same & (F.col("c.n") == F.col("m.most"))).select("c.*")
    found = best.groupBy(*keys).agg(F.min("x").alias("x"))
    again = reduce(and_, [F.col(f"m.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys])
    return most.alias("m").join(found.alias("f"), again, "left").select(
        *[F.col(f"m.{k}").alias(n) for k, n in zip(keys, names, strict=True)],
        F.col("f.x").alias(name))

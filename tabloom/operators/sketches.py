"""Sketches: aggregate states of bounded size that are stored and merged later.

``sketch_states`` makes one state per group and sketch, ``merge_sketches`` those of coarser
groups out of them, ``sketch_values`` reads numbers off them. So a table that grows by the day
is read once: the states of its days, a few kilobytes each, give any month or year. Merging
states gives what one state over all rows would give, up to a sketch's stated error.

Where an exact number is needed of more values than a sketch keeps, ``deal_values`` cuts them into
parts that each fit one, and ``exact_quantiles`` takes a state's answer as bounds and counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import (
    choose, column_or_expression, integer, name_list, parse_number,
)
from tabloom.operators.selection import HELD, listed_values, values_at


class Sketch(NamedTuple):
    """SQL of a sketch: how to make, merge and read it; ``{x}`` is its input, ``{n}`` a size."""

    make: str
    merge: str
    size: int
    ask: Mapping[str, str]


# Bit positions count from 1; numbers that a bitmap has no bit for are an error, not another's bit.
MEMBER = ("bitmap_construct_agg(CASE WHEN {x} BETWEEN 0 AND 32767 THEN bitmap_bit_position({x} + 1) "
          "WHEN {x} IS NOT NULL THEN raise_error('a bitmap holds numbers from 0 to 32767') END)")

# A set that is not whole any more holds its nominal entries at least, and so tells of as many.
EXACT = ("CASE WHEN theta_sketch_estimate({x}) < shiftleft(1L, {n}) THEN theta_sketch_estimate({x}) "
         "WHEN {x} IS NOT NULL THEN raise_error('a set has more values than its sketch keeps') END")

# ``{a}`` is the argument of a question. Sizes: log2 of the nominal entries for the distinct
# counts, k of the quantile sketch, counters of the frequent items; a bitmap has none.
SKETCHES = {
    "distinct": Sketch("hll_sketch_agg({x}, {n})", "hll_union_agg({x})", 12, {
        "count": "hll_sketch_estimate({x})"}),
    "distinct_set": Sketch("theta_sketch_agg({x}, {n})", "theta_union_agg({x}, {n})", 12, {
        "count": "theta_sketch_estimate({x})", "exact": EXACT}),
    "common_set": Sketch("theta_sketch_agg({x}, {n})", "theta_intersection_agg({x})", 12, {
        "count": "theta_sketch_estimate({x})"}),
    "quantiles": Sketch("kll_sketch_agg_{t}({x}, {n})", "kll_merge_agg_{t}({x}, {n})", 200, {
        "quantile": "kll_sketch_get_quantile_{t}({x}, {a})",
        "rank": "kll_sketch_get_rank_{t}({x}, {a})", "count": "kll_sketch_get_n_{t}({x})"}),
    "frequent": Sketch("approx_top_k_accumulate({x}, {n})", "approx_top_k_combine({x}, {n})",
                       10_000, {"top": "approx_top_k_estimate({x}, {a})"}),
    "members": Sketch(MEMBER, "bitmap_or_agg({x})", 0, {
        "count": "bitmap_count({x})"}),
    "common_members": Sketch(MEMBER,
                             "bitmap_and_agg({x})", 0, {"count": "bitmap_count({x})"}),
}


def _entry(e: Mapping[str, Any]) -> tuple[Sketch, int]:
    sketch = choose(SKETCHES, e["sketch"].strip().lower(), "sketch")
    size = e.get("size")
    return sketch, sketch.size if size in (None, "") else integer(size)


def _kind(e: Mapping[str, Any]) -> str:
    """Quantiles of whole numbers or of doubles."""
    numbers = str(e.get("numbers") or "double").strip().lower()
    return choose({"bigint": "bigint", "double": "double"}, numbers, "kind of numbers")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _aggregated(df: DataFrame, index: str | Iterable[str], entries: Iterable[Mapping[str, Any]],
                template: str) -> DataFrame:
    entries = list(entries)
    if not entries:
        raise ValueError("at least one sketch is needed")
    inputs, made = {}, []
    for i, e in enumerate(entries):
        sketch, size = _entry(e)
        kind, name = _kind(e), f"__tabloom_input{i}"
        value = column_or_expression(df, str(e["col"]).strip())
        if template == "make" and e["sketch"] == "quantiles":
            value = value.try_cast(kind)
        inputs[name] = value
        made.append(F.expr(getattr(sketch, template).format(x=name, n=size, t=kind))
                    .alias(e["col_name"]))
    keys = [column_or_expression(df, k) for k in name_list(index)] if index else []
    return df.withColumns(inputs).groupBy(*keys).agg(*made)


def sketch_states(df: DataFrame, index: str | Iterable[str],
                  sketches: Iterable[Mapping[str, Any]]) -> DataFrame:
    """``[{sketch, col, col_name, size, numbers}]`` per combination of ``index`` (none: one row).

    ``sketch`` is one of ``SKETCHES``: ``distinct``, ``distinct_set`` and ``common_set`` count
    distinct values (merged to a union, a union that may be intersected, an intersection),
    ``quantiles`` keeps ranks of ``numbers`` (``bigint`` or ``double``), ``frequent`` the most
    frequent values, ``members`` and ``common_members`` the exact set of numbers below 32,768
    (union, intersection). NULL values are left out. States are binary, or a struct for ``frequent``.
    """
    return _aggregated(df, index, sketches, "make")


def merge_sketches(df: DataFrame, index: str | Iterable[str],
                   sketches: Iterable[Mapping[str, Any]]) -> DataFrame:
    """States ``col`` of finer groups merged per combination of ``index``, as ``col_name``."""
    return _aggregated(df, index, sketches, "merge")


def sketch_values(df: DataFrame, items: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Add ``[{sketch, col, ask, argument, numbers, size, new_column}]``, read off states ``col``.

    ``ask`` is ``count`` (of all but ``frequent``), ``exact`` (of a ``distinct_set`` of that ``size``:
    the count, an error where it would be an estimate), ``quantile`` (``argument`` is a fraction),
    ``rank`` (of a number) or ``top`` (how many values).
    """
    for e in items:
        sketch, size = _entry(e)
        form = choose(sketch.ask, e["ask"].strip().lower(), "question")
        kind, argument = _kind(e), ""
        if "{a}" in form:
            number = parse_number(e["argument"])
            argument = str(integer(number)) if e["ask"] == "top" else f"CAST({number!r} AS DOUBLE)"
            if e["ask"] == "rank":
                argument = f"CAST({number!r} AS {kind})"
        value = F.expr(form.format(x=_quoted(e["col"]), a=argument, t=kind, n=size))
        # The state of a group without values has no quantiles.
        if sketch is SKETCHES["quantiles"] and e["ask"] != "count":
            held = F.expr(sketch.ask["count"].format(x=_quoted(e["col"]), t=kind))
            value = F.when(held > 0, value)
        df = df.withColumn(e["new_column"], value)
    return df


def deal_values(df: DataFrame, col: str, most: int, new_column: str = "part",
                index: str | Iterable[str] = "") -> DataFrame:
    """``df`` with the number of a part, by a hash of ``col``, so that a part has about ``most / 2``
    distinct values of ``col``, and so fewer than ``most``.

    A value is in one part only: counts of distinct values of parts add up, the most frequent
    value is that of its part, and sketches that keep ``most`` values are exact by part, however
    many there are in all. With ``index``, each of its combinations gets a row of nulls in every
    part, so that an intersection by part meets the empty sets too.
    """
    if most < 1:
        raise ValueError("a part must be allowed a value")
    value = column_or_expression(df, col)
    kinds = df.agg(F.approx_count_distinct(value, 0.01)).first()[0]
    parts = max(1, math.ceil(2 * kinds / most))
    dealt = df.withColumn(new_column, F.pmod(F.xxhash64(value), F.lit(parts)))
    if not index:
        return dealt
    every = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    keys = [column_or_expression(df, k) for k in name_list(index)]
    return dealt.unionByName(df.select(*keys).distinct().withColumn(new_column, F.explode(every)),
                             allowMissingColumns=True)


def exact_quantiles(df: DataFrame, index: str | Iterable[str], col: str, states: DataFrame,
                    fractions: Mapping[str, float], state: str = "state", size: int | None = None,
                    numbers: str = "double", held: int = HELD) -> DataFrame:
    """Per combination of ``index`` in ``df``: for each name the value at its fraction, exactly.

    As ``percentile_disc``; NULL and NaN are left out, and a group without values gives NULL.
    ``states`` has the columns ``index`` and a ``quantiles`` state (of ``size`` and ``numbers``) of
    the group's values, which gives bounds for a value; the rows below them are counted, those within
    looked at. Where the bounds miss, or hold more than ``held`` different values, or a group has
    no state, its values are narrowed further. So the state saves work and never changes the result.
    """
    sketch, kind = SKETCHES["quantiles"], _kind({"numbers": numbers})
    names = name_list(index)
    wanted = {name: float(f) for name, f in fractions.items()}
    if not wanted or any(not 0 <= f <= 1 for f in wanted.values()):
        raise ValueError("fractions from 0 to 1 are needed")
    keys = [f"g{i}" for i in range(len(names))]

    def grouped(rows: DataFrame, *more) -> DataFrame:
        return rows.select(F.struct(*[column_or_expression(rows, n).alias(k) for n, k in zip(
            names, keys, strict=True)]).alias("g"), *more)

    x = column_or_expression(df, col).try_cast(kind)
    values = grouped(df, (F.when(~F.isnan(x), x) if kind == "double" else x).alias("x"))
    sizes = stage(values.groupBy("g").agg(F.count("x").alias("n")), "sizes")
    # Four times what a state is off in one of a hundred cases.
    off = 9.2 / (sketch.size if size is None else integer(size)) ** 0.97
    full = F.expr(sketch.ask["count"].format(x="s", t=kind)) > 0

    def bound(f: float):
        return F.when(full, F.expr(sketch.ask["quantile"].format(
            x="s", t=kind, a=f"CAST({min(1.0, max(0.0, f))!r} AS DOUBLE)")))

    asked = F.explode(F.array(*[F.struct(
        F.lit(name).alias("name"), F.greatest(F.ceil(F.lit(f) * F.col("n")) - 1, F.lit(0)).alias("rank"),
        bound(f - off).alias("low"), bound(f + off).alias("high")) for name, f in wanted.items()]))
    targets = stage(sizes.where("n > 0").join(
        grouped(states, F.col(_quoted(state)).alias("s")), "g", "left")
        .select("g", asked.alias("p")).select("g", "p.*"), "targets")
    within = (F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high"))
    judged = stage(values.join(targets, "g").groupBy("g", "name", "rank", "low", "high").agg(
        F.count_if(F.col("x") < F.col("low")).alias("below"), F.count_if(within).alias("inside"),
        F.approx_count_distinct(F.when(within, F.col("x"))).alias("kinds")).withColumn(
            "settled", (F.col("rank") >= F.col("below"))
            & (F.col("rank") < F.col("below") + F.col("inside")) & (F.col("kinds") <= held)), "judged")
    found = listed_values(values, judged.where("settled").dropDuplicates(["g", "rank"]), kind)
    missed = judged.where("NOT settled").select("g", "rank").distinct()
    if not missed.isEmpty():
        found = found.union(values_at(values.where("x IS NOT NULL"), missed, held, kind))
    at = judged.join(found.dropDuplicates(["g", "rank"]), ["g", "rank"]).groupBy("g").agg(*[
        F.max(F.when(F.col("name") == name, F.col("x"))).alias(name) for name in wanted])
    return sizes.select("g").join(at, "g", "left").select(
        *[F.col("g")[k].alias(n) for k, n in zip(keys, names, strict=True)], *wanted)

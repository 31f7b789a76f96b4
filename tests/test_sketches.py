import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

import tabloom as t

KINDS = [{"sketch": "distinct", "col": "v", "col_name": "d"},
         {"sketch": "distinct_set", "col": "v", "col_name": "t"},
         {"sketch": "quantiles", "col": "v", "col_name": "q", "numbers": "bigint", "size": 4000},
         {"sketch": "frequent", "col": "v", "col_name": "f"},
         {"sketch": "members", "col": "v", "col_name": "m"}]
ASKS = [{"sketch": "distinct", "col": "d", "ask": "count", "new_column": "nd"},
        {"sketch": "distinct_set", "col": "t", "ask": "count", "new_column": "nt"},
        {"sketch": "quantiles", "col": "q", "ask": "count", "new_column": "n", "numbers": "bigint"},
        {"sketch": "quantiles", "col": "q", "ask": "quantile", "argument": 0.5, "new_column": "mid",
         "numbers": "bigint"},
        {"sketch": "quantiles", "col": "q", "ask": "rank", "argument": "10", "new_column": "rk",
         "numbers": "bigint"},
        {"sketch": "frequent", "col": "f", "ask": "top", "argument": 2, "new_column": "top"},
        {"sketch": "members", "col": "m", "ask": "count", "new_column": "nm"}]


@pytest.fixture(scope="module")
def days(spark):
    i = F.col("id")
    return spark.range(20_000).select(
        (i % 2).alias("g"), (i % 31).alias("day"), F.when(i % 11 == 0, None).when(
            i % 3 == 0, 7).otherwise(i % 1_000).cast("int").alias("v"))


def test_merged_days_equal_all_rows(days):
    """States merged twice, by day and by group, against one state over all rows."""
    own = [{**k, "col": k["col_name"]} for k in KINDS]
    by_day = t.sketch_states(days, "g, day", KINDS)
    assert by_day.count() == 62
    merged = t.sketch_values(t.merge_sketches(t.merge_sketches(
        by_day, ["g", "day % 7"], own), "g", own), ASKS)
    whole = t.sketch_values(t.sketch_states(days, "g", KINDS), ASKS)
    a, b = ({r.g: r for r in d.collect()} for d in (merged, whole))
    for g in (0, 1):
        values = sorted(r.v for r in days.where(f"g = {g} AND v IS NOT NULL").collect())
        for r in (a[g], b[g]):
            assert r.nt == r.nm == len(set(values)) and abs(r.nd - r.nt) < 0.05 * r.nt
            assert r.n == len(values)
            assert abs(values.index(r.mid) - len(values) / 2) < 0.4 * len(values)
            assert tuple(r.top[0]) == (7, values.count(7))
        assert (a[g].nt, a[g].nm, a[g].n, a[g].top[0]) == (b[g].nt, b[g].nm, b[g].n, b[g].top[0])


def test_one_state_and_empty_ones(spark, days):
    one = t.sketch_values(t.sketch_states(days, "", KINDS), ASKS).collect()
    assert len(one) == 1 and one[0].nt == one[0].nm
    none = t.sketch_values(t.sketch_states(days.where("v IS NULL"), "g", KINDS), ASKS).collect()
    assert {(r.n, r.nt, r.mid, r.rk) for r in none} == {(0, 0, None, None)}
    assert t.sketch_states(days.where("g > 5"), "g", KINDS).count() == 0
    text = t.sketch_values(t.sketch_states(spark.createDataFrame([("7",), ("x",)], "v string"), "", [
        {"sketch": "quantiles", "col": "v", "col_name": "q"}]), [
            {"sketch": "quantiles", "col": "q", "ask": "quantile", "argument": 1, "new_column": "m"}])
    assert [r.m for r in text.collect()] == [7.0]


def test_bitmap_bounds(spark):
    ends = spark.createDataFrame([(0,), (1,), (32767,), (None,)], "v int")
    states = t.sketch_states(ends, "", KINDS[-1:])
    assert [r.nm for r in t.sketch_values(states, ASKS[-1:]).collect()] == [3]
    for v in (-1, 32768):
        with pytest.raises(Exception, match="0 to 32767"):
            t.sketch_states(ends.select(F.lit(v).alias("v")), "", KINDS[-1:]).collect()


def test_bad_arguments(days):
    for bad in ([], [{"sketch": "guess", "col": "v", "col_name": "d"}],
                [{"sketch": "quantiles", "col": "v", "col_name": "d", "numbers": "int"}]):
        with pytest.raises(ValueError):
            t.sketch_states(days, "g", bad)
    states = t.sketch_states(days, "g", KINDS)
    with pytest.raises(ValueError):
        t.sketch_values(states, [{"sketch": "members", "col": "m", "ask": "top", "new_column": "x"}])


def test_aggregates_of_any_name(spark, days):
    def run(name, col):
        return {r.g: r.x for r in t.group_rows(
            days, "g", [{"agg_func": name, "col": col, "col_name": "x"}]).collect()}

    least, most = run("min", "v"), run("max", "v")
    assert run("percentile_disc", "v, 0.0") == least and run("percentile_disc", "v, 1.0") == most
    assert run("PERCENTILE_CONT", "coalesce(v, 7), 0.5")[0] > 7
    assert run("product", "CASE WHEN day = 1 THEN 1.0 ELSE 1.0 END") == {0: 1.0, 1: 1.0}
    assert all(run("kll_sketch_agg_bigint", "cast(v AS bigint)").values())
    assert all(run("bitmap_and_agg", "to_binary('ff', 'hex')").values())

    @F.pandas_udf("double")
    def spread_of(v: pd.Series) -> float:
        return float(v.max() - v.min())

    spark.udf.register("spread_of", spread_of)
    assert run("spread_of", "v") == {g: most[g] - least[g] for g in least}
    for name, col in (("grouping", "v"), ("no_such_aggregate", "v"), ("sum(v), max", "v"),
                      ("percentile_disc", "v")):
        with pytest.raises(ValueError):
            run(name, col)


def test_dealt_values_are_counted_exactly(days):
    """Sets and frequent values of 16 entries, of groups with hundreds of values."""
    sketches = [{"sketch": "distinct_set", "col": "v", "col_name": "t", "size": 4},
                {"sketch": "frequent", "col": "v", "col_name": "f", "size": 16}]
    own = [{**k, "col": k["col_name"]} for k in sketches]
    asks = [{**own[0], "ask": "exact", "new_column": "n"},
            {**own[1], "ask": "top", "argument": 1, "new_column": "top"}]
    dealt = t.deal_values(days, "v", 8)
    found = t.sketch_values(t.merge_sketches(t.sketch_states(
        dealt, "g, day, part", sketches), "g, part", own), asks).groupBy("g").agg(
            F.sum("n").alias("n"), F.max(F.expr("get(top, 0).count")).alias("most")).collect()
    counts = days.where("v IS NOT NULL").groupBy("g", "v").count()
    want = counts.groupBy("g").agg(F.count("v").alias("n"), F.max("count").alias("most")).collect()
    assert sorted(found) == sorted(want)
    with pytest.raises(Exception, match="more values than its sketch keeps"):
        t.sketch_values(t.sketch_states(days, "g", sketches[:1]), asks[:1]).collect()


def test_dealt_intersections_meet_empty_sets(spark):
    rows = [("a", v) for v in range(200)] + [("b", v) for v in range(0, 200, 3)] + [("c", 6), ("c", 7)]
    df = t.deal_values(spark.createDataFrame(rows, "k string, v int"), "v", 8, index="k")
    common = t.merge_sketches(t.sketch_states(df, "k, part", [
        {"sketch": "common_set", "col": "v", "col_name": "s"}]), "part", [
            {"sketch": "common_set", "col": "s", "col_name": "s"}])
    found = t.sketch_values(common, [
        {"sketch": "common_set", "col": "s", "ask": "count", "new_column": "n"}]).agg(F.sum("n"))
    assert found.first()[0] == 1
    assert t.deal_values(df.where("v < 0"), "v", 8).count() == 0
    with pytest.raises(ValueError):
        t.deal_values(df, "v", 0)


@pytest.mark.parametrize("kind,size,held", [("bigint", 8, 5), ("bigint", 200, 100_000),
                                            ("double", 200, 50)])
def test_exact_quantiles(spark, kind, size, held):
    """Coarse states, bounds that miss, numbers beyond 2**53, and groups without state or values."""
    i = F.col("id")
    x = F.when(i % 13 != 0, F.lit(2**60) + F.pmod(F.xxhash64(i), F.lit(5_000))).cast(kind)
    df = spark.range(20_000).select(
        F.when(i % 4 == 0, "a").when(i % 4 == 1, "b").when(i % 4 == 2, None).otherwise("n").alias("k"),
        F.when(i % 4 != 3, x).alias("v"))
    states = t.sketch_states(df.where("k IS NULL OR k = 'a'"), "k", [
        {"sketch": "quantiles", "col": "v", "col_name": "state", "numbers": kind, "size": size}])
    asks = {"p0": 0.0, "p3": 0.3, "p5": 0.5, "p10": 1.0}
    found = t.exact_quantiles(df, "k", "v", states, asks, size=size, numbers=kind, held=held)
    values = {k: sorted(r.v for r in df.where(F.col("k").eqNullSafe(F.lit(k))).collect()
                        if r.v is not None) for k in ("a", "b", None, "n")}
    exact = {(k, *[v[max(math.ceil(f * len(v)) - 1, 0)] if v else None for f in asks.values()])
             for k, v in values.items()}
    assert {tuple(r) for r in found.collect()} == exact
    with pytest.raises(ValueError):
        t.exact_quantiles(df, "k", "v", states, {"p": 2.0})


def test_steps_read_by_several(spark, days):
    steps = [
        {"id": "a", "op": "filter_rows", "input": "days", "params": {"rules": "rand() < 0.5"}},
        {"id": "b", "op": "group_rows", "input": "a", "params": {
            "index": "g", "agg": [{"agg_func": "count", "col": "*", "col_name": "n"}]}},
        {"id": "c", "op": "group_rows", "input": "a", "params": {
            "index": "g", "agg": [{"agg_func": "count", "col": "*", "col_name": "n"}]}},
    ]
    out = t.run_steps({"days": days}, steps, results=["b", "c"], share=True)
    # Both read the rows that were drawn once.
    assert sorted(out["b"].collect()) == sorted(out["c"].collect())
    for df in out.values():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Range (" not in plan and "rand(" not in plan
    lazy = t.run_steps({"days": days}, steps, results=["a", "c"])
    assert "rand(" in lazy["c"]._jdf.queryExecution().optimizedPlan().toString()
    assert t.run_steps({"days": days}, steps).columns == ["g", "n"]
    with pytest.raises(ValueError):
        t.run_steps({"days": days}, steps, results=["days"])

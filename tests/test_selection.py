import math

import pytest
from pyspark.sql import functions as F

import tabloom as t
from tabloom.operators import selection

FRACTIONS = {"p0": 0.0, "p1": 0.137, "p5": 0.5, "p9": 0.9999, "p10": 1.0}


@pytest.fixture(scope="module")
def values(spark):
    """A large group, one of few distinct values, one with odd numbers, small ones and a NULL one."""
    i = F.col("id")
    x = F.pmod(F.xxhash64(i), F.lit(10**12)) / 7
    return spark.range(0, 60_000, numPartitions=8).select(
        F.when(i % 2 == 0, "big").when(i % 3 == 0, "few").when(i % 5 == 0, None).when(
            i % 7 == 0, "odd").otherwise(F.concat(F.lit("s"), i % 4_000)).alias("g"),
        (i % 2).alias("h"),
        F.when((i % 2 == 1) & (i % 3 == 0), i % 4).when(i % 11 == 0, None).when(
            (i % 7 == 0) & (i % 4 == 1), float("nan")).when(
            (i % 7 == 0) & (i % 8 == 3), float("-inf")).otherwise(x).alias("x"))


def same(a, b):
    return a == b or (a is not None and b is not None and (
        (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)))


@pytest.mark.parametrize("held", [50, 700, 100_000])
def test_percentiles(values, held, monkeypatch):
    monkeypatch.setattr(selection, "SKETCH", 200)
    monkeypatch.setattr(selection, "STEPS", 32)
    found = {(r.g, r.h): r for r in t.group_percentiles(values, "g, h", "x", FRACTIONS, held).collect()}
    want = values.groupBy("g", "h").agg(*[F.percentile("x", F.lit(f)).alias(n)
                                          for n, f in FRACTIONS.items()]).collect()
    assert len(found) == len(want)
    for r in want:
        assert all(same(found[r.g, r.h][n], r[n]) for n in FRACTIONS), (r, found[r.g, r.h])


def test_bounds_that_miss_are_widened(values, monkeypatch):
    monkeypatch.setattr(selection, "SKETCH", 8)
    found = t.group_percentiles(values.where("h = 0"), "h", "x", {"m": 0.37}, held=100).first()
    assert same(found.m, values.where("h = 0").agg(F.percentile("x", F.lit(0.37))).first()[0])


def test_edges(spark, values):
    assert t.group_percentiles(values.where("false"), "g", "x", {"m": 0.5}).count() == 0
    none = t.group_percentiles(values.where("x IS NULL"), "h", "x", {"m": 0.5}, held=0).collect()
    assert {r.m for r in none} == {None}
    for bad in ({}, {"m": 1.5}):
        with pytest.raises(ValueError):
            t.group_percentiles(values, "g", "x", bad)


def test_mode(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 1), ("a", None), (None, 5),
                                ("n", None), ("a", None), ("a", None)], "g string, x int")
    assert {(r.g, r.m) for r in t.group_mode(df, "g", "x", "m").collect()} == {
        ("a", 1), (None, 5), ("n", None)}

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tabloom as t
from tabloom.operators import windows

RUNNING = [
    {"func": "rank", "new_column": "rk"},
    {"func": "dense_rank", "new_column": "dr"},
    {"func": "sum", "column": "v", "new_column": "sm"},
    {"func": "avg", "column": "v", "new_column": "av"},
    {"func": "count", "column": "v", "new_column": "ct"},
    {"func": "sum", "column": "m", "new_column": "ms"},
    {"func": "avg", "column": "m", "new_column": "ma"},
    {"func": "sum", "column": "s", "new_column": "ss"},
    {"func": "avg", "column": "w", "new_column": "wa"},
]
NUMBERED = [
    {"func": "row_number", "new_column": "rn"},
    {"func": "lag", "column": "v", "offset": "1", "new_column": "l1"},
    {"func": "lag", "column": "s", "offset": 7, "new_column": "l7"},
    {"func": "lead", "column": "v", "new_column": "f1"},
    {"func": "lead", "column": "v", "offset": -2, "new_column": "b2"},
    {"func": "lag", "column": "v", "offset": 0, "new_column": "l0"},
]


def collected(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One key for a third of the rows, NULL keys, one large and one NULL partition."""
    i = F.col("id")
    return spark.range(0, 1500, numPartitions=6).select(
        i,
        F.when(i % 3 == 0, 40).when(i % 19 == 0, None).otherwise((i * 7919) % 211).alias("k"),
        F.when(i % 2 == 0, "big").when(i % 11 == 0, None).otherwise((i % 40).cast("string")).alias("p"),
        F.when(i % 5 == 0, None).otherwise((i * 31) % 100).cast("int").alias("v"),
        ((i * 17) % 1000 / 100).cast("decimal(8,2)").alias("m"),
        ((i * 29) % 3000 / 100).cast("decimal(14,3)").alias("w"),
        F.when(i % 13 == 0, "no number").otherwise((i % 50).cast("string")).alias("s"),
    )


def test_small_example(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (None, 7)], "k int, v int")
    out = t.window_columns(df, [
        {"func": "sum", "column": "v", "new_column": "total"},
        {"func": "rank", "new_column": "r"}, {"func": "dense_rank", "new_column": "d"}], "k")
    assert sorted((r.v, r.total, r.r, r.d) for r in out.collect()) == [
        (5, 42, 4, 3), (7, 7, 1, 1), (10, 37, 2, 2), (20, 37, 2, 2)]


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("partition", ["", "p"])
def test_running_functions_over_ranges(skewed, order, partition):
    plain = t.window_columns(skewed, RUNNING, "k", order, partition, "plain")
    split = t.window_columns(skewed, RUNNING, "k", order, partition, "split", ranges=12)
    assert split.dtypes == plain.dtypes
    assert collected(split) == collected(plain)


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("partition", ["", "p"])
def test_numbering_over_ranges(skewed, order, partition):
    plain = t.window_columns(skewed, NUMBERED, "k, id", order, partition, "plain")
    split = t.window_columns(skewed, NUMBERED, "k, id", order, partition, "split", ranges=12)
    assert split.dtypes == plain.dtypes
    assert collected(split) == collected(plain)


@pytest.mark.parametrize("partition", ["", "p"])
def test_numbering_with_ties(skewed, partition):
    """Ties may come in any order, but numbers, lag and lead must agree with each other."""
    out = t.window_columns(skewed, [
        {"func": "row_number", "new_column": "rn"},
        {"func": "lag", "column": "id", "offset": 2, "new_column": "back"},
        {"func": "lead", "column": "id", "offset": 1, "new_column": "ahead"},
    ], "k", "desc", partition, "split", ranges=12).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.p if partition else None, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: r.rn)
        assert [r.rn for r in members] == list(range(1, len(members) + 1))
        keys = [float("-inf") if r.k is None else r.k for r in members]
        assert keys == sorted(keys, reverse=True)
        ids = [r.id for r in members]
        assert [r.back for r in members] == ([None, None] + ids)[: len(ids)]
        assert [r.ahead for r in members] == (ids + [None])[1:]


def test_full_copies_of_one_row(spark):
    """A third of the table is one and the same row: it is numbered by several tasks."""
    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("k"))
    bounds = windows._find_bounds(df, [], ["k"], 12)
    tagged = windows._tag(df, [], ["k"], bounds)
    assert tagged.where("k = 500").select(windows.SALT).distinct().count() >= 3
    out = t.window_columns(df, [{"func": "row_number", "new_column": "rn"},
                                {"func": "rank", "new_column": "rk"}], "k", method="split",
                           ranges=12).collect()
    assert sorted(r.rn for r in out) == list(range(1, 3001))
    assert {r.rk for r in out if r.k == 500} == {min(r.rn for r in out if r.k == 500)}


def test_text_and_several_partition_columns(skewed):
    functions = [{"func": "dense_rank", "new_column": "d"}, {"func": "count", "column": "v",
                                                            "new_column": "c"}]
    args = (skewed, functions, "s", "asc", ["p", "v"])
    assert collected(t.window_columns(*args, "split", ranges=20)) == \
        collected(t.window_columns(*args, "plain"))


def test_functions_that_use_earlier_ones(skewed):
    functions = [{"func": "sum", "column": "v", "new_column": "a"},
                 {"func": "count", "column": "a", "new_column": "b"},
                 {"func": "lag", "column": "a", "offset": 1, "new_column": "v"},
                 {"func": "count", "column": "v", "new_column": "c"}]
    plain = t.window_columns(skewed, functions, "id", "asc", "", "plain")
    split = t.window_columns(skewed, functions, "id", "asc", "", "split", ranges=6)
    assert split.columns == plain.columns and collected(split) == collected(plain)


def test_reach_over_several_ranges(spark):
    df = spark.range(200)
    functions = [{"func": "lag", "column": "id", "offset": 70, "new_column": "b"},
                 {"func": "lead", "column": "id", "offset": 70, "new_column": "f"}]
    plain = t.window_columns(df, functions, "id", method="plain")
    assert collected(t.window_columns(df, functions, "id", method="split", ranges=16)) == \
        collected(plain)


def test_number_type(skewed):
    for method in ("plain", "split"):
        for kind in ("int", "bigint"):
            out = t.window_columns(skewed, [{"func": "row_number", "new_column": "n"}], "k, id",
                                   method=method, number_type=kind)
            assert dict(out.dtypes)["n"] == kind


def test_nan_keys_are_cut(spark):
    df = spark.range(0, 3000, numPartitions=6).select(
        "id", F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id")).alias("k"))
    bounds = windows._find_bounds(df, [], ["k"], 20)
    assert max(bounds.cuts) > 5
    call = (df, [{"func": "rank", "new_column": "r"}, {"func": "count", "column": "id",
                                                     "new_column": "n"}], "k", "asc", "")
    pick = lambda d: sorted(tuple(r) for r in d.select("id", "r", "n").collect())
    assert pick(t.window_columns(*call, "split", ranges=20)) == pick(t.window_columns(*call, "plain"))


def test_ansi_settings_agree(skewed, ansi):
    out = t.window_columns(skewed, RUNNING + NUMBERED, "k, id", "asc", "p", "plain")
    split = t.window_columns(skewed, RUNNING + NUMBERED, "k, id", "asc", "p", "split", ranges=6)
    assert collected(out) == collected(split)


def test_empty_table(skewed):
    none = skewed.where("id < 0")
    assert t.window_columns(none, RUNNING + NUMBERED, "k", method="split").count() == 0


def test_bad_arguments(skewed):
    rank = [{"func": "rank", "new_column": "r"}]
    for kwargs in ({"order": "up"}, {"method": "fast"}):
        with pytest.raises(ValueError):
            t.window_columns(skewed, rank, "k", **kwargs)
    with pytest.raises(ValueError):
        t.window_columns(skewed, [{"func": "ntile", "new_column": "r"}], "k")


def doubles(spark, n, parts):
    """Numbers of very different sizes, with a few that are not finite in one partition."""
    i = F.col("id")
    x = (F.pmod(F.xxhash64(i), F.lit(10**9)) - 5e8) * F.pow(F.lit(10.0), i % 19 - 9)
    return spark.range(0, n, numPartitions=7).select(
        i, (i % parts).alias("p"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(n // 3)).alias("k"),
        F.when(i % 50 == 3, None).otherwise(x).alias("x"),
        F.when((i % parts == 1) & (i % 1000 == 1), float("inf")).when(
            i % parts == 2, x * 1e292).otherwise(x / 3).alias("y"))


ADDED = [{"func": "sum", "column": "x", "new_column": "sx"},
         {"func": "avg", "column": "x", "new_column": "ax"},
         {"func": "sum", "column": "y", "new_column": "sy"}]


@pytest.mark.parametrize("partition", ["", "p"])
def test_sums_of_doubles_agree_to_the_last_bit(spark, partition):
    df = doubles(spark, 600_000 if not partition else 60_000, 3)
    one = t.window_columns(df, ADDED, "k", "asc", partition, "plain")
    two = t.window_columns(df.repartition(5), ADDED, "k", "asc", partition, "split", ranges=40)
    names = ["id", *[F.hex(F.col(f["new_column"]).cast("string").cast("binary")).alias(
        f["new_column"]) for f in ADDED]]
    assert one.dtypes == two.dtypes
    assert one.select(names).exceptAll(two.select(names)).isEmpty()


def test_sums_of_doubles_are_right(spark):
    rows = sorted(doubles(spark, 3_000, 3).where("p != 1").collect(), key=lambda r: r.k)
    found = {r.id: r for r in t.window_columns(
        doubles(spark, 3_000, 3).where("p != 1"), ADDED, "k", "asc", "", "plain").collect()}
    for at in range(0, len(rows), 37):
        own = [r.x for r in rows if r.k <= rows[at].k and r.x is not None]
        assert found[rows[at].id].sx == math.fsum(own)
        assert found[rows[at].id].ax == math.fsum(own) / len(own)
    nothing = spark.createDataFrame([(1, None), (2, None), (3, float("nan")), (4, 1.0)],
                                    "k int, x double")
    for method in ("plain", "split"):
        sums = t.window_columns(nothing, ADDED[:1], "k", method=method).orderBy("k").collect()
        assert [str(r.sx) for r in sums] == ["None", "None", "nan", "nan"]
    zeros = spark.createDataFrame([(1, 0.0), (2, -0.0)], "k int, x double")
    assert [r.sx for r in t.window_columns(zeros, ADDED[:1], "k").collect()] == [0.0, 0.0]
    fast = t.window_columns(nothing, ADDED[:1], "k", double_sums="fast")
    assert "tabloom_fold" not in fast._jdf.queryExecution().toString()


def test_far_rims(skewed, monkeypatch):
    near = t.window_columns(skewed, NUMBERED, "k, id", "asc", "p", "split", ranges=12)
    monkeypatch.setattr(windows, "MOST_RIM_ROWS", 0)
    far = t.window_columns(skewed, NUMBERED, "k, id", "asc", "p", "split", ranges=12)
    assert far.columns == near.columns and collected(far) == collected(near)


def test_second_pass_is_narrow(skewed):
    """Rows move once, before they are written; no join and no exchange after that."""
    out = t.window_columns(skewed, RUNNING + NUMBERED, "k, id", "asc", "p", "split", ranges=12)
    # Lines with a colon belong to the subqueries that give the constant arrays.
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    main = "\n".join(x for x in lines if not x.lstrip().startswith(":"))
    assert "Relation" in main and "Join" not in "\n".join(lines)
    assert "Join" not in main and "Window" not in main and "Repartition" not in main

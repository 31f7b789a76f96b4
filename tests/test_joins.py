from collections import Counter

import pytest
from pyspark.sql import functions as F

import tabloom as t
from tabloom.operators import joins

ON = [{"left_on": "k", "right_on": "j"}]


def brute(left, right, how):
    """Nested loops over plain tuples whose first field is the key."""
    out, seen = Counter(), set()
    for a in left:
        hits = [i for i, b in enumerate(right) if a[0] is not None and a[0] == b[0]]
        seen.update(hits)
        for i in hits:
            out[(*a, *right[i])] += 1
        if not hits and how in ("left", "outer"):
            out[(*a, *(None,) * len(right[0]))] += 1
    if how in ("right", "outer"):
        for i, b in enumerate(right):
            if i not in seen:
                out[(*(None,) * len(left[0]), *b)] += 1
    return out


def collected(df):
    return Counter(tuple(r) for r in df.collect())


LEFT = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (5, "e")]
RIGHT = [(1, "x"), (3, "y"), (None, "z"), (1, "w")]


@pytest.mark.parametrize("how", ["left", "right", "inner", "outer"])
def test_kinds(spark, how):
    left = spark.createDataFrame(LEFT, "k int, v string")
    right = spark.createDataFrame(RIGHT, "j int, w string")
    for hot in ("auto", None):
        out = t.join_tables(left, right, how, ON, hot_keys=hot)
        assert collected(out) == brute(LEFT, RIGHT, how)
        assert out.columns == ["k", "v", "j", "w"]


@pytest.mark.parametrize("how", ["left", "right", "outer"])
@pytest.mark.parametrize("hot", ["left", "right", "both", "differ"])
def test_frequent_keys(spark, how, hot, monkeypatch):
    """One key holds most of a side; a third side of the key is missing or NULL."""
    many = [(7, f"m{i}") for i in range(120)]
    few = [(i if i % 10 else None, f"f{i}") for i in range(60)]
    left = many + few if hot in ("left", "both", "differ") else few
    right = many[:40] + few[::2] if hot in ("right", "both") else few[::2]
    if hot == "differ":
        right = [(9, f"r{i}") for i in range(90)] + few[::2]
    parts = []
    monkeypatch.setattr(joins, "_join_in_parts", lambda *a, f=joins._join_in_parts: (
        parts.append(1), f(*a))[1])
    df1 = spark.createDataFrame(left, "k int, v string")
    df2 = spark.createDataFrame(right, "j bigint, w string")
    out = t.join_tables(df1, df2, how, ON, hot_keys="auto", hot_rows=20)
    assert collected(out) == brute(left, right, how)
    cannot_cut = {"left": ("right", "both", "differ"), "right": ("left", "both", "differ"),
                  "outer": ("left", "right", "both", "differ")}[how]
    assert bool(parts) == (hot in cannot_cut)
    out = t.join_tables(df1, df2, how, ON, hot_keys="all", hot_rows=20)
    assert collected(out) == brute(left, right, how) and len(parts) == 1 + (hot in cannot_cut)


def test_all_sides_of_an_inner_join(spark):
    """A group-by on the key after the join leaves Spark free to cut the join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        right = spark.range(0, 60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("j"),
            F.md5(F.col("id").cast("string")).alias("w"))
        left = spark.range(0, 2000).select(F.col("id").alias("k"))
        agg = [{"agg_func": "max", "col": "w", "col_name": "m"},
               {"agg_func": "count", "col": "*", "col_name": "n"}]
        found = {}
        for hot in ("all", None):
            out = t.group_rows(t.join_tables(left, right, "inner", ON, hot_keys=hot,
                                             hot_rows=1000), "k", agg)
            found[hot] = collected(out)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("skew=true" in plan) == (hot == "all")
        assert found["all"] == found[None]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_frequent_pairs(spark):
    left = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, None, 2)], "k int, k2 string, v int")
    right = spark.range(300).select(
        F.lit(1).alias("j"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string"))
        .otherwise("a").alias("j2"))
    on = [{"left_on": "k", "right_on": "j"}, {"left_on": "k2", "right_on": "j2"}]
    assert [tuple(r) for r in joins._frequent_keys(right, ["j", "j2"], 50).collect()] == [(1, "a")]
    out = t.join_tables(left, right, "outer", on, hot_keys="auto", hot_rows=50)
    plain = t.join_tables(left, right, "outer", on, hot_keys=None)
    assert collected(out) == collected(plain) and out.count() == 200 + 2 + 100


def test_spark_cuts_skewed_side(spark):
    """With thresholds set for small data, the frequent key is read by several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        right = spark.range(0, 60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("j"),
            F.md5(F.col("id").cast("string")).alias("w"))
        left = spark.range(100).select(F.col("id").alias("k"))
        out = t.join_tables(left, right, "left", ON, hot_keys="auto", hot_rows=1000)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        plain = t.join_tables(left, right, "left", ON, hot_keys=None)
        assert Counter(map(tuple, rows)) == collected(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_null_keys_of_a_full_join_are_spread(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 20_000, numPartitions=2).select(
            F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
        right = left.select(F.col("k").alias("j"), F.col("v").alias("w"))
        out = t.join_tables(left, right, "outer", ON)
        assert out.columns == ["k", "v", "j", "w"]
        assert out.count() == 2_000 + 2 * 18_000
        places = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(places) == 8 and max(r[1] for r in places) < 9_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_very_many_frequent_keys(spark, monkeypatch):
    """20,000 keys are joined apart, by a table that the driver never sees."""
    left = spark.range(0, 25_000).select(F.col("id").alias("k"))
    right = spark.range(0, 205_000).select(
        F.when(F.col("id") < 200_000, F.col("id") % 20_000).otherwise(F.col("id")).alias("j"),
        F.col("id").alias("w"))
    assert joins._frequent_keys(right, ["j"], 10).count() == 20_000
    assert joins._frequent_keys(right, ["j"], 11).count() == 0
    seen = []
    collect = type(right).collect

    def watched(self):
        rows = collect(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(type(right), "collect", watched)
    out = t.join_tables(left, right, "left", ON, hot_keys="auto", hot_rows=10)
    assert all(n <= 1 for n in seen)
    plain = t.join_tables(left, right, "left", ON)
    assert out.exceptAll(plain).isEmpty() and out.count() == plain.count() == 205_000
    monkeypatch.setattr(joins, "KEY_BYTES", 0)
    large = t.join_tables(left, right, "outer", ON, hot_keys="all", hot_rows=10)
    assert large.exceptAll(t.join_tables(left, right, "outer", ON)).isEmpty()


def test_frequent_keys_that_are_not_numbers(spark):
    right = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, -0.0).otherwise(
            F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id"))).alias("j"))
    left = spark.createDataFrame([(float("nan"),), (0.0,), (5.0,), (None,)], "k double")
    out = t.join_tables(left, right, "outer", ON, hot_keys="all", hot_rows=400)
    assert collected(out.selectExpr("CAST(k AS STRING)", "CAST(j AS STRING)")) == collected(
        t.join_tables(left, right, "outer", ON).selectExpr("CAST(k AS STRING)", "CAST(j AS STRING)"))


def test_hot_join_reads_each_input_once(spark, table):
    right = table("events").select("event_id", "event_type")
    left = right.select(F.col("event_type").alias("k")).distinct()
    out = t.join_tables(left, right, "left", [{"left_on": "k", "right_on": "event_type"}],
                        hot_keys="auto", hot_rows=50)
    assert "events.parquet" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == right.count()


def test_rename_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = t.join_tables(df, df, "inner", [{"left_on": "old_k", "right_on": "k"}],
                        "true", "old", ["k", "v"])
    assert out.columns == ["old_k", "old_v", "k", "v"] and out.count() == 2
    kept = t.join_tables(df, df, "inner", [{"left_on": "k", "right_on": "k"}], "false")
    assert kept.columns == ["k", "v", "k", "v"]
    with pytest.raises(ValueError, match="more than once"):
        t.write_jdbc(kept, "target", {"url": "jdbc:none:"})


def test_text_key_against_number(spark, ansi):
    left = spark.createDataFrame([("1",), ("x",)], "k string")
    right = spark.createDataFrame([(1,), (2,)], "j int")
    assert collected(t.join_tables(left, right, "outer", ON)) == Counter(
        [("1", 1), ("x", None), (None, 2)])


def test_bad_arguments(spark):
    df = spark.range(1)
    for how, on in (("semi", [{"left_on": "id", "right_on": "id"}]), ("left", [])):
        with pytest.raises(ValueError):
            t.join_tables(df, df, how, on)

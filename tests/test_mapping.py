import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tabloom as t
from tabloom.operators import mapping


@pytest.fixture
def df(spark):
    return spark.sql("""SELECT * FROM VALUES
        (1, 5.0D, '5', DATE'2024-01-01', true), (2, 7.5D, 'x', DATE'2024-06-01', false),
        (3, CAST(NULL AS DOUBLE), NULL, NULL, NULL) AS v(k, q, s, d, b) ORDER BY k""")


def mapped(df, column, condition, value, yes="1", no="0", numeric="true", results="true"):
    out = t.map_column(df, column, "v", condition, value, yes, no, numeric, results)
    return dict(out.dtypes)["v"], [r.v for r in out.orderBy("k").collect()]


def test_conditions(df, ansi):
    expected = {"eq": [1, 0, 0], "neq": [0, 1, 0], "gt": [0, 1, 0], "gte": [1, 1, 0],
                "lt": [0, 0, 0], "lte": [1, 0, 0], "null": [0, 0, 1]}
    for name, want in expected.items():
        assert mapped(df, "q", name, "5") == ("int", want)
    with pytest.raises(ValueError):
        mapped(df, "q", "like", "5")


def test_result_types(df, ansi):
    assert mapped(df, "q", "gt", "6", "1", "0.5") == ("double", [0.5, 1.0, 0.5])
    assert mapped(df, "q", "gt", "6", "1", "0", results="false") == ("string", ["0", "1", "0"])
    assert mapped(df, "q", "gt", "6", "1", None)[1] == [None, 1, None]


def test_text_and_number(df, ansi):
    assert mapped(df, "s", "eq", "5")[1] == [1, 0, 0]
    assert mapped(df, "s", "eq", "5", numeric="false")[1] == [1, 0, 0]
    assert mapped(df, "q", "eq", "5", numeric="false")[1] == [1, 0, 0]
    assert mapped(df, "q", "neq", "abc", numeric="false")[1] == [0, 0, 0]
    assert mapped(df, "d", "gt", "2024-03-01", numeric="false")[1] == [0, 1, 0]
    assert mapped(df, "d", "gt", "no date", numeric="false")[1] == [0, 0, 0]
    assert mapped(df, "b", "eq", "1")[1] == [1, 0, 0]


def case(df, when, otherwise):
    out = t.map_cases(df, when, otherwise, "v")
    return dict(out.dtypes)["v"], [r.v for r in out.orderBy("k").collect()]


def branch(value, *conditions, relation=()):
    return {"conditions": [dict(zip(("column", "operation", "value"), c, strict=True))
                           for c in conditions], "relation": list(relation), "asValue": value}


def test_first_true_branch(df, ansi):
    kind, got = case(df, [branch("1", ("q", ">", "4")), branch("2.25", ("q", ">", "7"))], "0")
    assert kind == "decimal(3,2)" and got == [Decimal(1), Decimal(1), Decimal(0)]


def test_and_before_or(df, ansi):
    when = [branch("yes", ("q", "=", "5"), ("q", "=", "7.5"), ("k", "=", "9"),
                   relation=["or", "AND", ""])]
    assert case(df, when, "no") == ("string", ["yes", "no", "no"])
    with pytest.raises(ValueError):
        case(df, [branch("yes", ("q", "=", "5"), ("k", "=", "1"), relation=["XOR", ""])], "no")


def test_mixed_results_are_text(df, ansi):
    when = [branch("5", ("k", "=", "1")), branch("it's", ("k", "<>", "1"))]
    assert case(df, when, "1e-7") == ("string", ["5.0", "it's", "it's"])
    when = [branch("5", ("k", "=", "9"))]
    assert case(df, when, "1e-7") == ("double", [1e-7] * 3)
    kind, got = case(df, when, "nan")
    assert kind == "double" and all(math.isnan(x) for x in got)


def test_operators(df, ansi):
    assert case(df, [branch("1", ("s", "like", "x%"))], "0")[1] == [0, 1, 0]
    assert case(df, [branch("1", ("s", "not  LIKE", "x%"))], "0")[1] == [1, 0, 0]
    assert case(df, [branch("1", ("s", "==", "x' OR '1'='1"))], "0")[1] == [0, 0, 0]
    assert case(df, [branch("1", ("s", "<=>", "x"))], "0")[1] == [0, 1, 0]
    assert case(df, [branch("1", ("month(d)", ">=", "6"))], "0")[1] == [0, 1, 0]
    for bad in ("is null", "in", "; drop"):
        with pytest.raises(ValueError):
            case(df, [branch("1", ("s", bad, "x"))], "0")
    with pytest.raises(ValueError):
        case(df, [], "0")


def many(spark):
    i = F.col("id")
    return spark.range(400).select(
        i.alias("k"), F.when(i % 17 == 0, None).otherwise(i % 60 - 5).cast("int").alias("n"),
        F.when(i % 13 == 0, float("nan")).when(i % 19 == 0, None).otherwise((i % 80) / 2 - 3).alias("x"),
        F.when(i % 11 == 0, None).when(i % 7 == 0, "é").otherwise(
            F.concat(F.lit("w"), i % 40)).alias("s"),
        F.when(i % 5 == 0, "no").otherwise((i % 30).cast("string")).alias("t"))


def random_branches(rng):
    """Runs on one column, broken by others, with repeated and contradicting constants."""
    out = []
    while len(out) < 60:
        name = rng.choice(["n", "x", "s", "t", "n + 1"])
        for _ in range(rng.choice([1, 3, 12, 25])):
            conditions = []
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                value = str(rng.randrange(-6, 60)) if name != "s" else rng.choice(
                    ["w%d" % rng.randrange(45), "é", "a", "zz"])
                if name == "x" and rng.random() < 0.5:
                    value += ".5"
                conditions.append((name, rng.choice(["=", "=", "=", "<>", "<", "<=", ">", "=="]), value))
            if rng.random() < 0.8:      # few rows each, so that later branches matter
                conditions = [(c, "=", v) for c, _, v in conditions[:1]]
            relation = [rng.choice(["AND", "or"]) for _ in conditions[1:]] + [""]
            out.append(branch(str(len(out)), *conditions, relation=relation))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_looked_up_branches(spark, ansi, seed, monkeypatch):
    df, when = many(spark), random_branches(random.Random(seed))
    looked = case(df, when, "-1")
    plan = t.map_cases(df, when, "-1", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "__tabloom" not in t.map_cases(df, when, "-1", "v").columns
    monkeypatch.setattr(mapping, "LOOKED_UP", 10**9)
    assert case(df, when, "-1") == looked


def test_many_branches_take_no_longer(spark):
    """The plan of 1,500 branches has no comparison for each."""
    when = [branch("b%d" % k, ("k", "=", str(k * 3))) for k in range(1_500)]
    out = t.map_cases(many(spark), when, "none", "v")
    assert {(r.k, r.v) for r in out.where("k < 10").select("k", "v").collect()} == {
        (k, f"b{k // 3}" if k % 3 == 0 else "none") for k in range(10)}
    assert "CASE WHEN (k" not in out._jdf.queryExecution().optimizedPlan().toString()
    ranges = [branch(str(k), ("x", "<", str(k / 4))) for k in range(300)]
    got = {r.k: (r.x, r.v) for r in t.map_cases(many(spark), ranges, "-1", "v").collect()}
    for x, v in got.values():
        want = -1 if x is None or x != x or x >= 299 / 4 else max(0, math.floor(x * 4) + 1)
        assert int(v) == want

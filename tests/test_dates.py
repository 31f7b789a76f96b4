import datetime as dt

import pytest

import tabloom as t


@pytest.fixture
def calendar(spark):
    return spark.sql("""
        SELECT * FROM VALUES
          (1, DATE'2024-01-31', TIMESTAMP'2024-01-31 23:59:59.9',
           TIMESTAMP_NTZ'2024-01-31 23:59:59.9', '2024-01-31 10:00:00', 1, 1L),
          (2, DATE'2024-12-30', TIMESTAMP'2024-12-30 00:00:00',
           TIMESTAMP_NTZ'2024-12-30 00:00:00', '2024-12-30', -1, 2L),
          (3, DATE'2021-01-01', TIMESTAMP'2021-01-01 12:00:00',
           TIMESTAMP_NTZ'2021-01-01 12:00:00', 'no date', NULL, 3L)
        AS v(k, d, ts, ntz, s, n, big) ORDER BY k""")


def run(df, kind, value1, v1, value2=None, v2=None, unit=None, **options):
    item = {"o_type": kind, "value1": value1, "v1_type": v1, "value2": value2, "v2_type": v2,
            "unit": unit, "new_column": "v"}
    out = t.date_operations(df, [item], **options)
    return dict(out.dtypes)["v"], [r.v for r in out.orderBy("k").collect()]


T = dt.datetime


def test_days_from_a_column_are_midnights(calendar, ansi):
    want = [T(2024, 2, 1), T(2024, 12, 29), None]
    for source in ("d", "ts", "ntz", "s"):
        assert run(calendar, "add_to_date", source, "column", "n", "column", "days") == \
            ("timestamp", want)
    kind, got = run(calendar, "sub_from_date", "ts", "column", "big", "column", "weeks")
    assert (kind, got) == ("timestamp", [T(2024, 1, 24), T(2024, 12, 16), T(2020, 12, 11)])
    kind, got = run(calendar, "add_to_date", "2024-02-28 10:00:00", "value", "n", "column", "days")
    assert got[:2] == [T(2024, 2, 29), T(2024, 2, 27)]


def test_keep_time(calendar):
    kind, got = run(calendar, "add_to_date", "ts", "column", "n", "column", "days", keep_time=True)
    assert (kind, got[0]) == ("timestamp", T(2024, 2, 1, 23, 59, 59, 900000))


def test_hours_from_a_column_are_text(calendar, ansi):
    for source in ("ts", "ntz"):
        assert run(calendar, "add_to_date", source, "column", "big", "column", "hours") == (
            "string", ["2024-02-01 00:59:59", "2024-12-30 02:00:00", "2021-01-01 15:00:00"])
    kind, got = run(calendar, "sub_from_date", "s", "column", "n", "column", "minutes")
    assert (kind, got) == ("string", ["2024-01-31 09:59:00", "2024-12-30 00:01:00", None])
    kind, got = run(calendar, "sub_from_date", "2024-01-01", "value", "n", "column", "seconds",
                    as_timestamp=True)
    assert (kind, got) == ("timestamp", [T(2023, 12, 31, 23, 59, 59), T(2024, 1, 1, 0, 0, 1), None])


def test_constant_intervals_keep_the_type(calendar, ansi):
    assert run(calendar, "add_to_date", "d", "column", "1", "value", "months") == \
        ("date", [dt.date(2024, 2, 29), dt.date(2025, 1, 30), dt.date(2021, 2, 1)])
    assert run(calendar, "add_to_date", "d", "column", 2, "value", "hours")[0] == "timestamp"
    kind, got = run(calendar, "sub_from_date", "ntz", "column", "-1", "value", "year")
    assert kind == "timestamp_ntz" and got[0] == T(2025, 1, 31, 23, 59, 59, 900000)
    kind, got = run(calendar, "add_to_date", "s", "column", "1", "value", "weeks")
    assert (kind, got) == ("string", ["2024-02-07 10:00:00", "2025-01-06 00:00:00", None])
    kind, got = run(calendar, "add_to_date", "2024-01-31", "value", "1", "value", "month")
    assert (kind, got[0]) == ("timestamp", T(2024, 2, 29))


def test_bad_intervals(calendar):
    for amount, unit in (("1.5", "days"), ("x", "days"), ("1", "fortnights")):
        with pytest.raises(ValueError):
            run(calendar, "add_to_date", "d", "column", amount, "value", unit)
    with pytest.raises(ValueError):
        run(calendar, "add_to_date", "d", "column", "n", "column", "months")


def test_difference(calendar, ansi):
    kind, got = run(calendar, "date_diff", "ts", "column", "2024-01-31 12:00:00", "value", "hours")
    assert (kind, got[0]) == ("double", 12.0)
    kind, got = run(calendar, "date_diff", "ts", "column", "d", "column", "seconds")
    assert (kind, got) == ("bigint", [86399, 0, 43200])
    kind, got = run(calendar, "date_diff", "2024-01-01", "value", "2024-01-02 12:00:00", "value", "days")
    assert got == [-1.5] * 3
    assert run(calendar, "date_diff", "s", "column", "d", "column", "minutes")[1] == [600.0, 0.0, None]


def test_parts(calendar, ansi):
    for source in ("d", "ts", "ntz"):
        assert run(calendar, "year_of_date", source, "column") == ("int", [2024, 2024, 2021])
        assert run(calendar, "quarter_of_date", source, "column") == ("int", [1, 4, 1])
        assert run(calendar, "month_of_date", source, "column") == ("int", [1, 12, 1])
        assert run(calendar, "day_of_year", source, "column") == ("string", ["31", "365", "1"])
        assert run(calendar, "day_of_month", source, "column") == ("string", ["31", "30", "1"])
        assert run(calendar, "day_of_week", source, "column") == ("int", [4, 2, 6])
        assert run(calendar, "week_of_year", source, "column") == ("int", [5, 1, 53])
    assert run(calendar, "year_of_date", "s", "column")[1] == [2024, 2024, None]
    assert run(calendar, "day_of_year", "s", "column")[1] == ["31", "365", None]
    assert run(calendar, "day_of_week", "2024-06-02", "value") == ("int", [1] * 3)


def test_user_column_named_temporary_stays(calendar):
    df = calendar.withColumnRenamed("s", "temporary")
    out = t.date_operations(df, [{"o_type": "year_of_date", "value1": "2024-01-01",
                                  "v1_type": "value", "new_column": "y"}])
    assert "temporary" in out.columns
    with pytest.raises(ValueError):
        t.date_operations(df, [{"o_type": "hour_of_date", "value1": "d", "v1_type": "column",
                                "new_column": "y"}])


def test_amounts_out_of_range_are_null(spark, ansi):
    df = spark.sql("""SELECT DATE'2024-01-01' d, 2147483647 i, 9223372036854775807L l,
                      '1e300' s, 400000000 m""")
    for unit, amount in (("weeks", "i"), ("days", "i"), ("days", "m"), ("days", "l"), ("hours", "l"),
                         ("minutes", "l"), ("seconds", "l"), ("hours", "s")):
        for kind in ("add_to_date", "sub_from_date"):
            for keep in (False, True):
                out = t.date_operations(df, [{
                    "o_type": kind, "value1": "d", "v1_type": "column", "value2": amount,
                    "v2_type": "column", "unit": unit, "new_column": "x"}], keep_time=keep)
                assert out.selectExpr("CAST(x AS STRING) x").first()["x"] is None, (unit, amount)


def test_append_out_of_range_is_null(spark, ansi):
    one = spark.sql("SELECT CAST(1e37 AS DECIMAL(38,0)) a")
    two = spark.sql("SELECT CAST(0.5 AS DECIMAL(20,18)) a")
    assert {r.a is None for r in t.append_rows(one, two).collect()} == {True, False}


def test_constant_intervals_that_lead_too_far(spark, ansi):
    df = spark.sql("SELECT DATE'9999-12-30' d, TIMESTAMP'9999-12-30 00:00:00' t, '9999-12-30' s")
    for kind, sign in (("add_to_date", 1), ("sub_from_date", -1)):
        out = t.date_operations(df, [
            {"o_type": kind, "value1": c, "v1_type": "column", "value2": amount, "v2_type": "value",
             "unit": unit, "new_column": f"{c}_{unit}"}
            for c in "dts" for unit, amount in (("years", sign * 10_000_000), ("months", sign * 90_000_000),
                                                ("days", 3))])
        row = out.selectExpr(*[f"CAST({c}_{u} AS STRING) AS {c}_{u}" for c in "dts"
                               for u in ("years", "months", "days")]).first().asDict()
        assert all((v is None) == (not k.endswith("days")) for k, v in row.items()), row
    for unit in ("days", "years", "hours"):
        with pytest.raises(ValueError):
            t.date_operations(df, [{
                "o_type": "add_to_date", "value1": "d", "v1_type": "column", "value2": 10**17,
                "v2_type": "value", "unit": unit, "new_column": "x"}]).collect()

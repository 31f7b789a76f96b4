import pytest

import tabloom as t


@pytest.fixture
def df(spark):
    return spark.sql("""SELECT * FROM VALUES
        ('a', 1, '1.5', DATE'2024-01-01'), ('a', 1, 'x', DATE'2023-01-01'),
        ('a', NULL, NULL, DATE'2024-05-01'), (NULL, 4, '2', NULL) AS v(g, i, s, d)""")


def grouped(df, index, *aggs, **options):
    out = t.group_rows(df, index, [
        {"agg_func": f, "col": c, "col_name": f"v{n}"} for n, (f, c) in enumerate(aggs)], **options)
    return {r[0]: tuple(r)[1:] for r in out.collect()}


def test_aggregates(df, ansi):
    out = grouped(df, "g", ("sum", "i"), ("avg", "i"), ("count", "i"), ("count", "*"),
                  ("COUNT", "distinct i"), ("min", "d"), ("stddev", "i"), ("sum", "DISTINCT i"))
    assert out["a"][:5] == (2, 1.0, 2, 3, 1) and out["a"][6:] == (0.0, 1)
    assert out[None][:5] == (4, 4.0, 1, 1, 1)


def test_text_is_read_as_double(df, ansi):
    assert grouped(df, "g", ("sum", "s"), ("sum", "distinct s"))["a"] == (1.5, 1.5)


def test_overflow_is_null(spark, ansi):
    df = spark.sql("SELECT 'a' g, 9223372036854775807L i UNION ALL SELECT 'a', 1L")
    assert grouped(df, "g", ("sum", "i"))["a"] == (None,)


def test_key_expression(df):
    out = t.group_rows(df, "year(d), g", [{"agg_func": "count", "col": "*", "col_name": "n"}])
    assert out.columns == ["year(d)", "g", "n"] and out.count() == 3


def test_several_arguments(df, ansi):
    out = grouped(df, "g", ("max_by", "s, d"), ("percentile_approx", "i, 0.5"), ("count", "i, s"),
                  ("regr_count", "i, i + 1"), ("min_by", "coalesce(s, 'a,b'), d"))
    assert out["a"][0] is None and out["a"][1:3] == (1, 2) and out["a"][4] == "x"
    assert out["a"][3] == 2
    assert out[None] == (None, 4, 1, 1, None)


def test_a_bound_on_arrays(df):
    assert sorted(grouped(df, "g", ("collect_list", "i"), max_group_rows=3)["a"][0]) == [1, 1]
    assert grouped(df, "g", ("median", "i"), ("mode", "i"), max_group_rows=3)["a"] == (1.0, 1)
    assert sorted(grouped(df, "g", ("collect_list", "i"))["a"][0]) == [1, 1]
    with pytest.raises(ValueError, match="more than 2"):
        grouped(df, "g", ("collect_set", "i"), max_group_rows=2)


def test_bad_arguments(df):
    for index, agg in (("g", []), ("", [("sum", "i")]), ("g", [("drop", "i")]), ("g", [("sum", "*")])):
        with pytest.raises(ValueError):
            grouped(df, index, *agg)

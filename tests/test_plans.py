"""Step lists, and the physical plans the operators lead to."""

import contextlib
import io

import pytest

import tabloom as t
from tabloom.functions.batches import add_columns
from tabloom.operators import windows


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


def test_steps(spark, table):
    steps = [
        {"id": "a", "op": "filter_rows", "input": "orders", "params": {"rules": "o_orderkey < 50"}},
        {"id": "b", "op": "append_rows", "inputs": ["a", "a"]},
        {"id": "c", "op": "filter_rows", "input": "b",
         "params": {"rules": "o_orderkey IN (SELECT o_orderkey FROM acme_tbl_a WHERE o_orderkey > 40)"}},
    ]
    out = t.run_steps({"orders": table("orders")}, steps, client="acme")
    assert out.count() == 2 * table("orders").where("o_orderkey > 40 and o_orderkey < 50").count()
    for bad in ([], [{"id": "a", "op": "explode", "input": "orders"}],
                [{"id": "a", "op": "preview", "input": "nowhere"}]):
        with pytest.raises(ValueError):
            t.run_steps({"orders": table("orders")}, bad)


def test_steps_reach_the_scan(table):
    out = t.run_steps({"lineitem": table("lineitem")}, [
        {"id": "a", "op": "column_constant_numeric", "input": "lineitem", "params": {"items": [
            {"source": "l_quantity", "target": "double", "operation": "multiply", "value": 2}]}},
        {"id": "b", "op": "filter_rows", "input": "a", "params": {"rules": "l_suppkey = 3"}},
        {"id": "c", "op": "select_columns", "input": "b", "params": {"columns": "double"}}])
    text = plan(out)
    assert "EqualTo(l_suppkey,3)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text
    assert "Exchange" not in text and "Python" not in text


def test_no_python_in_any_query(spark):
    import catalogue

    catalogue.load_all()
    for name, query in catalogue.QUERIES.items():
        text = plan(query(spark, "/root/testdata/sf0.001"))
        assert "PythonUDF" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_building_steps_runs_nothing(spark, table):
    """No job but those that read a file's schema."""
    tables = {n: table(n) for n in ("orders", "lineitem", "customer")}
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, "steps")
    try:
        out = t.run_steps(tables, [
            {"id": "g", "op": "group_rows", "input": "lineitem", "params": {
                "index": "l_orderkey", "agg": [
                    {"agg_func": "collect_list", "col": "l_tax", "col_name": "taxes"},
                    {"agg_func": "median", "col": "l_tax", "col_name": "middle"}]}},
            {"id": "j", "op": "join_tables", "inputs": ["orders", "g"], "params": {
                "how": "left", "on": [{"left_on": "o_orderkey", "right_on": "l_orderkey"}]}},
            {"id": "w", "op": "window_columns", "input": "j", "params": {
                "functions": [{"func": "rank", "new_column": "place"}],
                "order_by": "o_totalprice", "order": "desc", "partition": "o_custkey"}},
            {"id": "f", "op": "join_tables", "inputs": ["w", "customer"], "params": {
                "how": "outer", "on": [{"left_on": "o_custkey", "right_on": "c_custkey"}]}},
            {"id": "x", "op": "window_columns", "input": "f", "params": {
                "functions": [{"func": "sum", "column": "o_totalprice", "new_column": "total"}],
                "order_by": "o_orderdate", "partition": "c_mktsegment"}},
            {"id": "l", "op": "limit_rows", "input": "x", "params": {"row_limit": 2_000_000}}])
        assert list(tracker.getJobIdsForGroup(group)) == []
        assert out.count() > 0
        assert len(tracker.getJobIdsForGroup(group)) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_independent_items_share_one_projection(spark):
    df = spark.range(1).selectExpr("id AS a")
    calls = []

    def item(target, source):
        def build(d):
            calls.append(len(d.columns))
            return d[source] + 1
        return target, {source}, build

    out = add_columns(df, [item(f"c{i}", "a") for i in range(20)] + [item("last", "c3")])
    assert calls == [1] * 20 + [21] and out.first()["last"] == 2


def test_windows_share_one_shuffle(table):
    out = t.window_columns(table("events"), [
        {"func": f, "column": "value", "offset": 1, "new_column": f}
        for f in ("rank", "dense_rank", "row_number", "lag", "lead", "sum", "avg", "count")],
        "ts", "asc", "user_id", "plain")
    text = plan(out).split("\n\n\n")[0]
    assert text.count("Exchange (") == 1 and text.count("Sort (") == 1


def test_rank_filter_is_cut_before_the_shuffle(table):
    out = t.filter_rows(t.window_columns(
        table("orders"), [{"func": "row_number", "new_column": "n"}], "o_totalprice", "desc",
        "o_custkey", "plain"), "n <= 3")
    assert plan(out).split("\n\n\n")[0].count("WindowGroupLimit (") == 2


def test_large_window_runs_in_ranges(table, monkeypatch):
    """Only the totals, one row per range, may be in a single partition."""
    written, write = [], windows.stage
    monkeypatch.setattr(windows, "stage", lambda df, name: written.append(plan(df)) or write(df, name))
    out = t.window_columns(table("lineitem"), [{"func": "sum", "column": "l_quantity",
                                                "new_column": "total"}],
                           "l_shipdate", method="split", ranges=8)
    text = "\n\n".join([*written, plan(out)])
    found = [block for block in text.split("\n\n") if ") Window\n" in block]
    by_range = [w for w in found if "l_shipdate" in w.split("Arguments:")[1]]
    assert len(by_range) == 1
    assert "[__tabloom_bucket" in by_range[0].split("Arguments:")[1]
    single = [b for b in text.split("\n\n") if "SinglePartition" in b]
    assert all("l_shipdate" not in b for b in single)


def test_top_rows_need_no_full_sort(table):
    assert "TakeOrderedAndProject" in plan(t.top_rows(table("orders"), "o_totalprice", 5, "DESC"))


def test_row_operators_run_on_streams(spark, table, tmp_path):
    table("orders").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table("orders").schema).parquet(str(tmp_path / "in"))
    out = t.run_steps({"orders": stream}, [
        {"id": "a", "op": "filter_rows", "input": "orders", "params": {"rules": "o_custkey > 3"}},
        {"id": "b", "op": "date_operations", "input": "a", "params": {"items": [
            {"o_type": "year_of_date", "value1": "o_orderdate", "v1_type": "column",
             "new_column": "y"}]}}])
    query = out.writeStream.format("memory").queryName("streamed").trigger(availableNow=True) \
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert spark.table("streamed").count() == table("orders").where("o_custkey > 3").count()

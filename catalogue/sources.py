"""Sources, views and step lists."""

import tabloom as t
from catalogue import add, load
from tabloom.functions.checkpoints import scratch_path

ORDER_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")


def csv_scan(spark, sf):
    path = scratch_path(spark, "orders-csv")
    t.write_csv(load(spark, sf, "orders"), path, ";")
    return t.read_csv(spark, path, ORDER_SCHEMA, ";")


add("csv_scan", csv_scan, "SELECT * FROM orders")


def csv_bad_fields(spark, sf):
    """A text column read as a whole number: fields that do not fit are NULL."""
    path = scratch_path(spark, "customer-csv")
    t.write_csv(load(spark, sf, "customer"), path)
    return t.read_csv(spark, path, "c_custkey bigint, c_name int, c_nationkey int, "
                                   "c_acctbal double, c_mktsegment string")


add("csv_bad_fields", csv_bad_fields,
    """SELECT c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name, c_nationkey, c_acctbal,
       c_mktsegment FROM customer""")


def csv_some_bad_fields(spark, sf):
    """Of a column read as a whole number, every third field is text."""
    path = scratch_path(spark, "mixed-csv")
    t.write_csv(load(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE CAST(c_nationkey AS STRING) END "
        "AS mixed", "c_acctbal"), path)
    return t.read_csv(spark, path, "c_custkey bigint, mixed int, c_acctbal double")


add("csv_some_bad_fields", csv_some_bad_fields,
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS mixed, c_acctbal
       FROM customer""")


def csv_object_scan_limit(spark, sf):
    base = scratch_path(spark, "store")
    t.write_csv(load(spark, sf, "lineitem").select("l_orderkey", "l_quantity"),
                f"{base}/acme/files/lines.csv", "|")
    rows = t.read_tenant_csv(spark, "acme", "lines.csv", "l_orderkey bigint, l_quantity double",
                             "|", row_limit=5000, base=base)
    one = t.constant_columns(rows, [{"column": "k", "constant": 1, "isNumeric": "true"}])
    return t.group_rows(one, "k", [{"agg_func": "count", "col": "l_quantity", "col_name": "n"}])


add("csv_object_scan_limit", csv_object_scan_limit,
    "SELECT 1 AS k, least(count(*), 5000) AS n FROM lineitem")


def view_chain(spark, sf):
    t.publish_view(load(spark, sf, "orders"), "acme", "B001")
    t.publish_view(t.filter_rows(t.scan_view(spark, "acme", "B001"), "o_orderstatus = 'F'"),
                   "acme", "B001")
    result = t.select_columns(t.scan_view(spark, "acme", "B001"), "o_orderkey, o_totalprice")
    t.drop_view(spark, "acme", "B001")
    return result


add("view_chain", view_chain,
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")

# Revenue by return flag and line status, the flagship step list.
FLAGSHIP = [
    {"id": "B001", "op": "filter_rows", "input": "lineitem",
     "params": {"rules": "l_shipdate <= '1998-09-02'"}},
    {"id": "B002", "op": "change_column_type", "input": "B001",
     "params": {"column_name": "l_extendedprice", "column_type": "decimal(12,2)"}},
    {"id": "B003", "op": "change_column_type", "input": "B002",
     "params": {"column_name": "l_discount", "column_type": "decimal(4,2)"}},
    {"id": "B004", "op": "column_constant_numeric", "input": "B003", "params": {"items": [
        {"source": "l_discount", "target": "rest", "operation": "multiply", "value": -1},
        {"source": "rest", "target": "rest", "operation": "add", "value": 1}]}},
    {"id": "B005", "op": "column_column_numeric", "input": "B004", "params": {"items": [
        {"firstColumn": "l_extendedprice", "secondColumn": "rest",
         "targetColumn": "revenue", "operation": "multiply"}]}},
    {"id": "B006", "op": "group_rows", "input": "B005", "params": {
        "index": "l_returnflag, l_linestatus", "agg": [
            {"agg_func": "sum", "col": "l_quantity", "col_name": "sum_qty"},
            {"agg_func": "sum", "col": "revenue", "col_name": "sum_revenue"},
            {"agg_func": "avg", "col": "l_quantity", "col_name": "avg_qty"},
            {"agg_func": "count", "col": "*", "col_name": "count_order"}]}},
    {"id": "B007", "op": "change_column_type", "input": "B006",
     "params": {"column_name": "sum_revenue", "column_type": "decimal(24,4)"}},
    {"id": "B008", "op": "order_rows", "input": "B007",
     "params": {"columns": "l_returnflag, l_linestatus", "order": "ASC"}},
]


def flagship(spark, sf):
    return t.run_steps({"lineitem": load(spark, sf, "lineitem")}, FLAGSHIP)


add("flagship_steps", flagship,
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
            AS DECIMAL(24,4)) AS sum_revenue,
       avg(l_quantity) AS avg_qty, count(*) AS count_order
       FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY 1, 2 ORDER BY 1, 2""")


def customer_report(spark, sf):
    """A two-table step list: join, mapping, group, rank, order."""
    return t.run_steps(
        {"customer": load(spark, sf, "customer"), "orders": load(spark, sf, "orders")}, [
            {"id": "j", "op": "join_tables", "inputs": ["customer", "orders"], "params": {
                "how": "inner", "on": [{"left_on": "c_custkey", "right_on": "o_custkey"}]}},
            {"id": "m", "op": "map_column", "input": "j", "params": {
                "reference_column": "o_totalprice", "target_column": "big",
                "condition_name": "gt", "single_value": "250000", "value_if_true": "1",
                "value_if_false": "0", "value_is_numeric": "true",
                "result_is_numeric": "true"}},
            {"id": "g", "op": "group_rows", "input": "m", "params": {
                "index": "c_mktsegment, c_custkey", "agg": [
                    {"agg_func": "sum", "col": "big", "col_name": "big_orders"},
                    {"agg_func": "count", "col": "*", "col_name": "all_orders"}]}},
            {"id": "w", "op": "window_columns", "input": "g", "params": {
                "functions": [{"func": "rank", "new_column": "place"}],
                "order_by": "big_orders, all_orders", "order": "desc",
                "partition": "c_mktsegment", "method": "plain"}},
            {"id": "f", "op": "filter_rows", "input": "w", "params": {"rules": "place <= 10"}},
        ])


add("customer_report_steps", customer_report,
    """WITH g AS (SELECT c_mktsegment, c_custkey,
         CAST(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS big_orders,
         count(*) AS all_orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2)
       SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY c_mktsegment
         ORDER BY big_orders DESC, all_orders DESC) AS INTEGER) AS place FROM g)
       WHERE place <= 10""")

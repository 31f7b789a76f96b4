"""Joins."""

import tabloom as t
from catalogue import add, load

ON = [{"left_on": "c_custkey", "right_on": "buyer"}]
SQL_HOW = {"left": "LEFT", "right": "RIGHT", "inner": "INNER", "outer": "FULL"}


def shifted_orders(spark, sf):
    """All orders, their customers' keys moved up, so that both sides have rows without match;
    every 100th has none."""
    return load(spark, sf, "orders").selectExpr(
        "*", "CASE WHEN o_orderkey % 100 <> 0 THEN o_custkey + 40 END AS buyer")


SHIFTED = """(SELECT *, CASE WHEN o_orderkey % 100 <> 0 THEN o_custkey + 40 END AS buyer
              FROM orders)"""

for how, word in SQL_HOW.items():
    add(f"join_{how}", lambda spark, sf, how=how: t.join_tables(
        load(spark, sf, "customer"), shifted_orders(spark, sf), how, ON),
        f"SELECT * FROM customer {word} JOIN {SHIFTED} ON c_custkey = buyer")


def null_keys(spark, sf):
    """Both sides with many rows that have no key."""
    users = load(spark, sf, "events").selectExpr(
        "event_id AS e", "CASE WHEN event_id % 3 = 0 THEN user_id END AS u")
    buyers = load(spark, sf, "orders").selectExpr(
        "o_orderkey AS o", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS b")
    return t.join_tables(users, buyers, "outer", [{"left_on": "u", "right_on": "b"}])


add("join_outer_null_keys", null_keys,
    """SELECT * FROM (SELECT event_id AS e, CASE WHEN event_id % 3 = 0 THEN user_id END AS u
         FROM events)
       FULL JOIN (SELECT o_orderkey AS o, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS b
         FROM orders) ON u = b""")


def pair_totals(spark, sf):
    return t.rename_columns(t.group_rows(
        load(spark, sf, "lineitem"), "l_partkey, l_suppkey",
        [{"agg_func": "sum", "col": "l_quantity", "col_name": "pair_quantity"}]),
        [{"column": "l_partkey", "renameColumn": "pair_part"},
         {"column": "l_suppkey", "renameColumn": "pair_supplier"}])


add("join_multi_key", lambda spark, sf: t.join_tables(
    load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"),
    pair_totals(spark, sf), "left",
    [{"left_on": "l_partkey", "right_on": "pair_part"},
     {"left_on": "l_suppkey", "right_on": "pair_supplier"}]),
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, pair_part, pair_supplier, pair_quantity
       FROM lineitem LEFT JOIN (SELECT l_partkey AS pair_part, l_suppkey AS pair_supplier,
       sum(l_quantity) AS pair_quantity FROM lineitem GROUP BY 1, 2)
       ON l_partkey = pair_part AND l_suppkey = pair_supplier""")
add("join_rename_duplicates", lambda spark, sf: t.join_tables(
    load(spark, sf, "customer"),
    load(spark, sf, "customer").selectExpr(
        "c_custkey + 25 AS c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), "left",
    [{"left_on": "old_c_custkey", "right_on": "c_custkey"}], "true", "old",
    ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    """SELECT a.c_custkey AS old_c_custkey, a.c_name AS old_c_name,
       a.c_nationkey AS old_c_nationkey, a.c_acctbal AS old_c_acctbal,
       a.c_mktsegment AS old_c_mktsegment, b.* FROM customer a
       LEFT JOIN (SELECT c_custkey + 25 AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
         FROM customer) b ON a.c_custkey = b.c_custkey""")


def kinds(spark, sf):
    """One row per event type, one of them under a name that no event has."""
    return t.rename_columns(t.group_rows(
        load(spark, sf, "events"), ["replace(event_type, 'view', 'none')"],
        [{"agg_func": "count", "col": "*", "col_name": "n"}]),
        [{"column": "replace(event_type, view, none)", "renameColumn": "kind"}])


for how, word in SQL_HOW.items():
    add(f"join_{how}_frequent_keys", lambda spark, sf, how=how: t.join_tables(
        kinds(spark, sf), load(spark, sf, "events").select("event_id", "event_type", "value"),
        how, [{"left_on": "kind", "right_on": "event_type"}], hot_keys="auto", hot_rows=1000),
        f"""SELECT * FROM (SELECT replace(event_type, 'view', 'none') AS kind, count(*) AS n
              FROM events GROUP BY 1)
            {word} JOIN (SELECT event_id, event_type, value FROM events) ON kind = event_type""")

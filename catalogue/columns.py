"""Column, filter, order, append, mapping and group queries."""

import tabloom as t
from catalogue import add, load, on


def table(name, apply):
    return lambda spark, sf: apply(load(spark, sf, name))


add("select_cols", table("orders", lambda d: t.select_columns(
    d, "o_totalprice, o_orderkey , o_custkey")),
    "SELECT o_totalprice, o_orderkey, o_custkey FROM orders")
add("drop_cols", table("orders", lambda d: t.drop_columns(
    d, ["o_orderstatus", "o_orderpriority", "no_such_column"])),
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
add("rename_cols", table("customer", lambda d: t.rename_columns(d, [
    {"column": "c_name", "renameColumn": "label"},
    {"column": "label", "renameColumn": "customer"},
    {"column": "c_acctbal", "renameColumn": "balance"}])),
    """SELECT c_custkey, c_name AS customer, c_nationkey, c_acctbal AS balance, c_mktsegment
       FROM customer""")
add("cast_type", table("orders", lambda d: t.change_column_type(
    d, "o_totalprice", "decimal(12,2)")),
    """SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders""")
add("cast_double_to_int", table("lineitem", lambda d: t.change_column_type(
    d.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", "int")),
    """SELECT l_orderkey, l_linenumber,
       CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice FROM lineitem""")
add("cast_text_fraction", table("lineitem", lambda d: t.change_column_type(
    t.change_column_type(d.select("l_orderkey", "l_extendedprice"), "l_extendedprice", "string"),
    "l_extendedprice", "bigint")),
    "SELECT l_orderkey, CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice FROM lineitem")
add("cast_bad_to_null", table("customer", lambda d: t.change_column_type(d, "c_name", "int")),
    """SELECT c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name, c_nationkey, c_acctbal,
       c_mktsegment FROM customer""")
add("cast_some_to_null", lambda spark, sf: t.change_column_type(load(spark, sf, "orders").selectExpr(
    "o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 1 THEN NULL "
    "ELSE CAST(o_custkey AS STRING) END AS mixed"), "mixed", "int"),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey AS INTEGER) END AS mixed
       FROM orders""")
on("constant_cols", "orders", "o_orderkey",
   lambda d: t.constant_columns(d, [
       {"column": "whole", "constant": "7", "isNumeric": "true"},
       {"column": "wide", "constant": "3000000000", "isNumeric": "true"},
       {"column": "part", "constant": "2.5", "isNumeric": "true"},
       {"column": "words", "constant": "7", "isNumeric": "false"}]),
   "7 AS whole, 3000000000 AS wide, CAST(2.5 AS DOUBLE) AS part, '7' AS words")
on("copy_col", "customer", "c_custkey c_name c_mktsegment",
   lambda d: t.set_column_value(d, "c_name", "copy"), "c_name AS copy")
add("copy_col_over", table("customer", lambda d: t.set_column_value(
    d.select("c_custkey", "c_name", "c_mktsegment"), "c_name", "c_mktsegment")),
    "SELECT c_custkey, c_name, c_name AS c_mktsegment FROM customer")


def with_gaps(spark, sf):
    return t.join_tables(
        load(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        load(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"),
        "left", [{"left_on": "o_orderkey", "right_on": "l_orderkey"}])


GAPS = "FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"
add("fill_null_num", lambda spark, sf: t.fill_null(
    with_gaps(spark, sf), "l_linenumber, l_quantity, l_returnflag, l_shipdate", "7.9", "true"),
    f"""SELECT o_orderkey, o_orderdate, l_orderkey, coalesce(l_linenumber, 7) AS l_linenumber,
        coalesce(l_quantity, 7.9) AS l_quantity, l_returnflag, l_shipdate {GAPS}""")
add("fill_null_text", lambda spark, sf: t.fill_null(
    with_gaps(spark, sf), ["l_linenumber", "l_returnflag"], "none", "false"),
    f"""SELECT o_orderkey, o_orderdate, l_orderkey, l_linenumber, l_quantity,
        coalesce(l_returnflag, 'none') AS l_returnflag, l_shipdate {GAPS}""")

# Filters, order, limit, append.
add("filter_simple", table("lineitem", lambda d: t.filter_rows(d, "l_quantity > 30")),
    "SELECT * FROM lineitem WHERE l_quantity > 30")
COMPOUND = ("l_quantity BETWEEN 10 AND 30 AND (l_returnflag = 'R' OR l_linestatus IN ('F')) "
            "AND NOT l_shipdate < '1996-01-01' AND l_returnflag LIKE '%R%'")
add("filter_compound", table("lineitem", lambda d: t.filter_rows(d, COMPOUND)),
    f"SELECT * FROM lineitem WHERE {COMPOUND}")
add("filter_default", table("orders", t.filter_rows), "SELECT * FROM orders WHERE 1 = 0")


def filter_subquery(spark, sf):
    rich = t.publish_view(load(spark, sf, "customer"), "demo", "rich")
    return t.filter_rows(
        load(spark, sf, "orders"),
        f"o_custkey IN (SELECT c_custkey FROM {rich} WHERE c_acctbal > 5000)")


add("filter_subquery", filter_subquery,
    """SELECT * FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
add("order_asc", table("orders", lambda d: t.order_rows(d, "o_orderdate, o_orderkey", "ASC")),
    "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey")
add("order_desc", table("lineitem", lambda d: t.order_rows(
    d, ["year(l_shipdate)", "l_quantity"], "DESC")),
    "SELECT * FROM lineitem ORDER BY year(l_shipdate) DESC, l_quantity DESC")
add("limit_topk", table("orders", lambda d: t.top_rows(
    d, "o_totalprice, o_orderkey", 100, "DESC")),
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 100")


def limited(spark, sf, spread):
    """How many rows a limit gives, and how many of them are different rows of the table."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    some = t.constant_columns(t.limit_rows(lines, 5000, spread),
                              [{"column": "k", "constant": "1", "isNumeric": "true"}])
    marked = t.join_tables(t.rename_columns(some, [
        {"column": c, "renameColumn": c[2:]} for c in lines.columns]), lines.distinct(), "left",
        [{"left_on": c[2:], "right_on": c} for c in lines.columns])
    return t.group_rows(marked, "k", [
        {"agg_func": "count", "col": "*", "col_name": "n"},
        {"agg_func": "count", "col": "distinct l_orderkey, l_linenumber, l_extendedprice",
         "col_name": "found"}])


LIMITED = """SELECT 1 AS k, least(count(*), 5000) AS n, least(count(*), 5000) AS found
             FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_extendedprice FROM lineitem)"""
add("limit_rows", lambda spark, sf: limited(spark, sf, False), LIMITED)
add("limit_rows_spread", lambda spark, sf: limited(spark, sf, True), LIMITED)
add("preview_rows", lambda spark, sf: t.preview(
    t.order_rows(load(spark, sf, "events"), "event_id"), 20),
    "SELECT * FROM events ORDER BY event_id LIMIT 20")
add("append_rows", lambda spark, sf: t.append_rows(
    load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"),
    load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")),
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
add("append_type_widen", lambda spark, sf: t.append_rows(
    load(spark, sf, "lineitem").select("l_linenumber", "l_returnflag", "l_suppkey"),
    load(spark, sf, "orders").select("o_totalprice", "o_custkey", "o_orderkey")),
    """SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_returnflag, l_suppkey
       FROM lineitem UNION ALL
       SELECT o_totalprice, CAST(o_custkey AS VARCHAR), o_orderkey FROM orders""")

# Conditional mapping.
for name, symbol in {"eq": "=", "neq": "<>", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}.items():
    on(f"map_{name}", "lineitem", "l_orderkey l_linenumber l_quantity",
       lambda d, name=name: t.map_column(
           d, "l_quantity", "flag", name, "25", "1", "0", "true", "true"),
       f"CASE WHEN l_quantity {symbol} 25 THEN 1 ELSE 0 END AS flag")
on("map_text_results", "orders", "o_orderkey o_orderstatus",
   lambda d: t.map_column(d, "o_orderstatus", "state", "eq", "F", "done", "open"),
   "CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state")
on("map_float_results", "orders", "o_orderkey o_totalprice",
   lambda d: t.map_column(d, "o_totalprice", "rate", "gt", "1000.5", "0.5", "1", "true", "true"),
   "CASE WHEN o_totalprice > 1000.5 THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS rate")
add("map_null", lambda spark, sf: t.map_column(
    with_gaps(spark, sf), "l_orderkey", "lines", "null", "", "no", "yes"),
    f"""SELECT o_orderkey, o_orderdate, l_orderkey, l_linenumber, l_quantity, l_returnflag,
        l_shipdate, CASE WHEN l_orderkey IS NULL THEN 'no' ELSE 'yes' END AS lines {GAPS}""")
BRANCHES = [
    {"conditions": [{"column": "l_quantity", "operation": ">", "value": "40"},
                    {"column": "l_tax", "operation": "<", "value": "0.05"}],
     "relation": ["AND", ""], "asValue": "10.25"},
    {"conditions": [{"column": "l_returnflag", "operation": "=", "value": "R"},
                    {"column": "l_linestatus", "operation": "like", "value": "F%"},
                    {"column": "l_linenumber", "operation": "<=", "value": "2"}],
     "relation": ["OR", "AND", ""], "asValue": "5"},
    {"conditions": [{"column": "year(l_shipdate)", "operation": "==", "value": "1997"}],
     "relation": [], "asValue": "2"},
]
CASES = """CASE WHEN l_quantity > 40 AND l_tax < 0.05 THEN {a}
    WHEN l_returnflag = 'R' OR l_linestatus LIKE 'F%' AND l_linenumber <= 2 THEN {b}
    WHEN year(l_shipdate) = 1997 THEN {c} ELSE {d} END"""
MAPPED = "l_orderkey l_linenumber l_quantity l_tax l_returnflag l_linestatus l_shipdate"
on("map_multi_case", "lineitem", MAPPED,
   lambda d: t.map_cases(d, BRANCHES, "0", "score"),
   f"CAST({CASES.format(a='10.25', b='5.0', c='2.0', d='0.0')} AS DECIMAL(4,2)) AS score")
on("map_multi_mixed_type", "lineitem", MAPPED,
   lambda d: t.map_cases(d, BRANCHES, "it's small", "score"),
   CASES.format(a="'10.25'", b="'5.0'", c="'2.0'", d="'it''s small'") + " AS score")

# Group-by.
for func, col, sql in (
    ("sum", "l_quantity", "sum(l_quantity)"),
    ("avg", "l_quantity", "avg(l_quantity)"),
    ("min", "l_shipdate", "min(l_shipdate)"),
    ("max", "l_extendedprice", "max(l_extendedprice)"),
    ("count", "l_returnflag", "count(l_returnflag)"),
):
    add(f"group_{func}", table("lineitem", lambda d, func=func, col=col: t.group_rows(
        d, "l_suppkey, l_linestatus", [{"agg_func": func, "col": col, "col_name": "v"}])),
        f"SELECT l_suppkey, l_linestatus, {sql} AS v FROM lineitem GROUP BY ALL")
add("group_count_star", table("lineitem", lambda d: t.group_rows(
    d, ["l_orderkey"], [{"agg_func": "count", "col": "*", "col_name": "n"}])),
    "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey")
add("group_count_distinct", table("lineitem", lambda d: t.group_rows(
    d, "l_returnflag", [{"agg_func": "count", "col": "distinct l_partkey", "col_name": "parts"},
                        {"agg_func": "sum", "col": "DISTINCT l_suppkey", "col_name": "supp"}])),
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts,
       CAST(sum(DISTINCT l_suppkey) AS BIGINT) AS supp FROM lineitem GROUP BY l_returnflag""")


def rounded(df, **places):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


add("group_stddev", table("lineitem", lambda d: rounded(t.group_rows(
    d, "l_returnflag", [
        {"agg_func": "stddev", "col": "l_quantity", "col_name": "sd"},
        {"agg_func": "variance", "col": "l_quantity", "col_name": "var"},
        {"agg_func": "stddev_pop", "col": "l_quantity", "col_name": "sdp"}]),
    sd=6, var=6, sdp=6)),
    """SELECT l_returnflag, round(stddev(l_quantity), 6) AS sd,
       round(variance(l_quantity), 6) AS var, round(stddev_pop(l_quantity), 6) AS sdp
       FROM lineitem GROUP BY l_returnflag""")
add("group_multi", table("orders", lambda d: t.group_rows(
    t.change_column_type(d, "o_totalprice", "decimal(12,2)"), "o_orderstatus, o_orderpriority", [
        {"agg_func": "sum", "col": "o_totalprice", "col_name": "total"},
        {"agg_func": "sum", "col": "o_custkey", "col_name": "keys"},
        {"agg_func": "min", "col": "o_orderdate", "col_name": "first_day"},
        {"agg_func": "max", "col": "o_orderpriority", "col_name": "top"},
        {"agg_func": "count", "col": "distinct o_custkey", "col_name": "customers"},
        {"agg_func": "count", "col": "*", "col_name": "n"}])),
    """SELECT o_orderstatus, o_orderpriority,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total,
       CAST(sum(o_custkey) AS BIGINT) AS keys, min(o_orderdate) AS first_day,
       max(o_orderpriority) AS top, count(DISTINCT o_custkey) AS customers, count(*) AS n
       FROM orders GROUP BY o_orderstatus, o_orderpriority""")
add("group_key_expr", table("orders", lambda d: t.group_rows(
    d, "year(o_orderdate), o_orderstatus", [
        {"agg_func": "count", "col": "*", "col_name": "n"},
        {"agg_func": "sum", "col": "o_custkey % 10", "col_name": "digits"}]
    ).withColumnRenamed("year(o_orderdate)", "y")),
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus, count(*) AS n,
       CAST(sum(o_custkey % 10) AS BIGINT) AS digits FROM orders GROUP BY 1, 2""")
add("group_distinct_text", table("documents", lambda d: t.group_rows(
    d, "lang, source", [
        {"agg_func": "sum", "col": "n_chars", "col_name": "chars"},
        {"agg_func": "max", "col": "length(text)", "col_name": "longest"},
        {"agg_func": "count", "col": "distinct text", "col_name": "texts"}])),
    """SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS chars,
       CAST(max(length(text)) AS INTEGER) AS longest, count(DISTINCT text) AS texts
       FROM documents GROUP BY lang, source""")
for key, func, col, sql in (
    ("group_max_by", "max_by", "o_orderkey, o_totalprice", "arg_max(o_orderkey, o_totalprice)"),
    ("group_count_pair", "count", "o_custkey, nullif(o_orderstatus, 'F')",
     "count(CASE WHEN o_custkey IS NOT NULL AND o_orderstatus <> 'F' THEN 1 END)"),
    ("group_median", "median", "o_totalprice", "round(median(o_totalprice), 6)"),
    ("group_percentile", "percentile", "o_totalprice, 0.25",
     "round(quantile_cont(o_totalprice, 0.25), 6)"),
    ("group_corr", "corr", "o_totalprice, o_orderkey + o_custkey",
     "round(corr(o_totalprice, o_orderkey + o_custkey), 6)"),
):
    add(key, lambda spark, sf, func=func, col=col: t.group_rows(
        load(spark, sf, "orders"), "o_orderpriority",
        [{"agg_func": func, "col": col, "col_name": "v"}]).selectExpr(
            "o_orderpriority", "round(v, 6) AS v" if func in ("median", "percentile", "corr") else "v"),
        f"SELECT o_orderpriority, {sql} AS v FROM orders GROUP BY 1")
add("group_arrays", lambda spark, sf: t.group_rows(
    load(spark, sf, "lineitem"), "l_orderkey",
    [{"agg_func": "collect_set", "col": "l_returnflag", "col_name": "flags"}],
    max_group_rows=10_000).selectExpr(
        "l_orderkey", "array_join(array_sort(flags), '') AS flags"),
    """SELECT l_orderkey, list_aggregate(list_sort(list(DISTINCT l_returnflag)),
       'string_agg', '') AS flags FROM lineitem GROUP BY l_orderkey""")

"""Window functions: Spark's own window, and the range form for large windows."""

import tabloom as t
from catalogue import add, load

CALLS = {
    "rank": ({"func": "rank"}, "rank()"),
    "dense_rank": ({"func": "dense_rank"}, "dense_rank()"),
    "row_number": ({"func": "row_number"}, "row_number()"),
    "lag": ({"func": "lag", "column": "amount", "offset": 1}, "lag(amount, 1)"),
    "lead": ({"func": "lead", "column": "amount", "offset": "2"}, "lead(amount, 2)"),
    "sum": ({"func": "sum", "column": "amount"}, "CAST(sum(amount) {w} AS BIGINT)"),
    "avg": ({"func": "avg", "column": "amount"}, "CAST(sum(amount) {w} AS DOUBLE) / count(amount) {w}"),
    "count": ({"func": "count", "column": "amount"}, "count(amount)"),
}
UNIQUE = ("row_number", "lag", "lead")


def over(sql, window):
    return sql.replace("{w}", f"OVER ({window})") if "{w}" in sql else f"{sql} OVER ({window})"


def int_type(name, sql):
    return f"CAST({sql} AS INTEGER)" if name in ("rank", "dense_rank", "row_number") else sql


def events(spark, sf):
    d = t.set_column_value(load(spark, sf, "events"), "value", "amount")
    return t.change_column_type(d, "amount", "bigint").select(
        "event_id", "ts", "user_id", "amount")


def orders(spark, sf):
    d = t.set_column_value(load(spark, sf, "orders"), "o_totalprice", "amount")
    return t.change_column_type(d, "amount", "bigint").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "amount")


EVENTS = """(SELECT event_id, ts, user_id, CAST(trunc(value) AS BIGINT) AS amount FROM events)"""
ORDERS = """(SELECT o_orderkey, o_orderstatus, o_orderdate,
             CAST(trunc(o_totalprice) AS BIGINT) AS amount FROM orders)"""

for name, (call, sql) in CALLS.items():
    call = [{**call, "new_column": "v"}]
    order = "asc" if name in ("rank", "lag", "sum", "count") else "desc"
    nulls = "NULLS FIRST" if order == "asc" else "NULLS LAST"

    def add_window(key, source, text, call, sql, parts, keys, order, nulls, method, name=name):
        window = f"PARTITION BY {', '.join(parts)} " if parts else ""
        window += "ORDER BY " + ", ".join(f"{k} {order} {nulls}" for k in keys)
        add(key, lambda spark, sf: t.window_columns(
            source(spark, sf), call, keys, order, parts or "", method),
            f"SELECT *, {int_type(name, over(sql, window))} AS v FROM {text}")

    # One user's events are few: Spark's window. An order status holds a third of
    # all orders, and a window without partition all of them: the range form.
    add_window(f"win_{name}_part", events, EVENTS, call, sql, ["user_id"], ["ts"], order, nulls,
               "plain")
    keys = ["o_orderdate", "o_orderkey"] if name in UNIQUE else ["o_orderdate"]
    add_window(f"win_{name}_large_part", orders, ORDERS, call, sql, ["o_orderstatus"], keys,
               order, nulls, "split")
    add_window(f"win_{name}_global", orders, ORDERS, call, sql, [], keys, order, nulls, "split")

MULTI = [
    {**call, "new_column": f"w_{name}"} for name, (call, _) in CALLS.items()
]
WINDOW = "PARTITION BY user_id ORDER BY ts ASC NULLS FIRST"
add("win_multi_fn", lambda spark, sf: t.window_columns(
    events(spark, sf), MULTI, "ts", "asc", "user_id"),
    "SELECT *, " + ", ".join(
        f"{int_type(n, over(s, WINDOW))} AS w_{n}" for n, (_, s) in CALLS.items()
    ) + f" FROM {EVENTS}")
GLOBAL = "ORDER BY ts ASC NULLS FIRST"
add("win_multi_fn_global", lambda spark, sf: t.window_columns(
    events(spark, sf), MULTI, "ts", "asc", "", "split"),
    "SELECT *, " + ", ".join(
        f"{int_type(n, over(s, GLOBAL))} AS w_{n}" for n, (_, s) in CALLS.items()
    ) + f" FROM {EVENTS}")
add("win_topk", lambda spark, sf: t.filter_rows(t.window_columns(
    load(spark, sf, "orders"), [{"func": "row_number", "new_column": "place"}],
    "o_totalprice, o_orderkey", "desc", "o_custkey", "plain"), "place <= 3"),
    """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_totalprice DESC, o_orderkey DESC) AS INTEGER) AS place FROM orders)
       WHERE place <= 3""")
add("win_turns", lambda spark, sf: t.window_columns(
    load(spark, sf, "conversations").select("conv_id", "turn", "role", "text"),
    [{"func": "lag", "column": "text", "offset": 1, "new_column": "asked"},
     {"func": "lead", "column": "role", "offset": 1, "new_column": "next_role"}],
    "turn", "asc", "conv_id"),
    """SELECT conv_id, turn, role, text, lag(text) OVER w AS asked, lead(role) OVER w AS next_role
       FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")

"""Sketch states that are stored by day and merged, and aggregates of any name."""

import tabloom as t
from catalogue import add, load

DAY = "date_trunc('day', ts)"


def kept_events(spark, sf):
    return t.filter_rows(load(spark, sf, "events"), "event_type IS NOT NULL").selectExpr(
        "event_type", f"{DAY} AS day", "user_id", "value", "event_id")


def merged_states(spark, sf, sketches, most=None):
    """States per day and type of event, merged by type; also by part, where ``most`` values of
    ``user_id`` are allowed in one."""
    events, part = kept_events(spark, sf), "" if most is None else ", part"
    if most is not None:
        events = t.deal_values(events, "user_id", most)
    daily = t.sketch_states(events, "event_type, day" + part, sketches)
    return t.merge_sketches(daily, "event_type" + part, [
        {**e, "sketch": e.get("merge", e["sketch"]), "col": e["col_name"]} for e in sketches])


def merged(spark, sf, sketch, col, asks, merge=None, most=None, **more):
    """Numbers read off the merged states."""
    whole = merged_states(spark, sf, [{"sketch": sketch, "merge": merge or sketch, "col": col,
                                       "col_name": "state", **more}], most)
    return t.drop_columns(t.sketch_values(whole, [
        {"sketch": merge or sketch, "col": "state", "new_column": name, **more, **ask}
        for name, ask in asks.items()]), "state")


def most_frequent(spark, sf):
    """The parts' numbers of users are known to be below what a state keeps, or an error."""
    whole = merged_states(spark, sf, [
        {"sketch": "frequent", "col": "user_id", "col_name": "state"},
        {"sketch": "distinct_set", "col": "user_id", "col_name": "held", "size": 13}], most=2**13)
    read = t.sketch_values(whole, [
        {"sketch": "frequent", "col": "state", "ask": "top", "argument": 1, "new_column": "top"},
        {"sketch": "distinct_set", "col": "held", "ask": "exact", "size": 13, "new_column": "users"}])
    return t.group_rows(t.filter_rows(read, "users >= 0"), "event_type", [
        {"agg_func": "max", "col": "get(top, 0).count", "col_name": "most"}])


def users_of_all_types(spark, sf):
    """Intersections by part, of sets that are known to be whole, or an error."""
    events = t.deal_values(load(spark, sf, "events").select("event_type", "user_id"), "user_id",
                           2**16, index="event_type")
    states = t.sketch_states(events, "event_type, part", [
        {"sketch": "common_set", "col": "user_id", "col_name": "state", "size": 16}])
    whole = t.filter_rows(t.sketch_values(states, [
        {"sketch": "distinct_set", "col": "state", "ask": "exact", "size": 16, "new_column": "held"}]),
        "held >= 0")
    common = t.merge_sketches(whole, "part", [
        {"sketch": "common_set", "col": "state", "col_name": "state"}])
    return t.sketch_values(common, [
        {"sketch": "common_set", "col": "state", "ask": "count", "new_column": "users"}]).selectExpr(
            "coalesce(sum(users), 0L) AS users")


def middle_user(spark, sf):
    sketch = {"sketch": "quantiles", "col": "user_id", "col_name": "state", "numbers": "bigint",
              "size": 65535}
    return t.exact_quantiles(
        kept_events(spark, sf), "event_type", "user_id", merged_states(spark, sf, [sketch]),
        {"middle": 0.5}, numbers="bigint", size=65535)


# Sketches are exact as long as a group has fewer distinct values than they have entries, which
# parts of the values see to; the ends of a quantile sketch and its count always are.
add("group_kll_merge", lambda spark, sf: merged(
    spark, sf, "quantiles", "user_id", {
        "n": {"ask": "count"}, "least": {"ask": "quantile", "argument": 0},
        "most": {"ask": "quantile", "argument": 1}}, numbers="bigint"),
    """SELECT event_type, count(user_id) AS n, min(user_id) AS least, max(user_id) AS most
       FROM events GROUP BY 1""")
add("group_kll_exact", middle_user,
    """SELECT event_type, percentile_disc(0.5) WITHIN GROUP (ORDER BY user_id) AS middle
       FROM events GROUP BY 1""")
add("group_theta_union", lambda spark, sf: t.group_rows(merged(
    spark, sf, "distinct_set", "user_id", {"users": {"ask": "exact"}}, most=2**16, size=16),
    "event_type", [{"agg_func": "sum", "col": "users", "col_name": "users"}]),
    "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
add("group_theta_common", users_of_all_types,
    """SELECT count(*) AS users FROM (SELECT user_id FROM events GROUP BY 1
       HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events))""")
add("group_bitmap_or", lambda spark, sf: merged(
    spark, sf, "members", "user_id % 32000", {"users": {"ask": "count"}}),
    "SELECT event_type, count(DISTINCT user_id % 32000) AS users FROM events GROUP BY 1")
add("group_bitmap_and", lambda spark, sf: merged(
    spark, sf, "common_members", "user_id % 32000", {"users": {"ask": "count"}}),
    """SELECT event_type, count(*) FILTER (days = all_days) AS users FROM (
         SELECT event_type, user_id % 32000 AS u, count(DISTINCT date_trunc('day', ts)) AS days
         FROM events GROUP BY 1, 2) JOIN (
         SELECT event_type, count(DISTINCT date_trunc('day', ts)) AS all_days FROM events GROUP BY 1)
       USING (event_type) GROUP BY 1""")
add("group_frequent_merge", most_frequent,
    """SELECT event_type, max(n) AS most FROM (
       SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")

for name, sql in (("percentile_disc", "CAST(percentile_disc(0.25) WITHIN GROUP (ORDER BY o_totalprice) AS DOUBLE)"),
                  ("percentile_cont", "round(percentile_cont(0.25) WITHIN GROUP (ORDER BY o_totalprice), 6)")):
    add(f"group_{name}", lambda spark, sf, name=name: t.group_rows(
        load(spark, sf, "orders"), "o_orderstatus", [
            {"agg_func": name, "col": "o_totalprice, 0.25", "col_name": "v"}]).selectExpr(
                "o_orderstatus", "round(v, 6) AS v" if name == "percentile_cont" else "v"),
        f"SELECT o_orderstatus, {sql} AS v FROM orders GROUP BY 1")
add("group_product", lambda spark, sf: t.group_rows(
    load(spark, sf, "lineitem"), "l_orderkey", [
        {"agg_func": "product", "col": "1 - l_discount", "col_name": "v"}]).selectExpr(
            "l_orderkey", "round(v, 9) AS v"),
    "SELECT l_orderkey, round(product(1 - l_discount), 9) AS v FROM lineitem GROUP BY 1")

# All groups but the small ones of the test tables are found by narrowing.
add("group_percentiles_large", lambda spark, sf: t.group_percentiles(
    load(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice",
    {"low": 0.1, "middle": 0.5, "most": 1.0}, held=200).selectExpr(
        "l_returnflag", "round(low, 6) AS low", "round(middle, 6) AS middle", "most"),
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS low,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS middle, max(l_extendedprice) AS most
       FROM lineitem GROUP BY 1""")
add("group_mode_large", lambda spark, sf: t.group_mode(
    load(spark, sf, "lineitem"), "l_returnflag, l_linestatus", "l_partkey", "part"),
    """SELECT l_returnflag, l_linestatus, l_partkey AS part FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
           ORDER BY n DESC, l_partkey) AS r FROM (
           SELECT l_returnflag, l_linestatus, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2, 3))
       WHERE r = 1""")

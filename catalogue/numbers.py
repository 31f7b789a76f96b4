"""Arithmetic and mathematical functions."""

from pyspark.sql import functions as F

import tabloom as t
from catalogue import add, load, on

VERBS = {"multiply": "*", "divide": "/", "add": "+", "subtract": "-"}
SPELLED = {"divide": "devide", "subtract": "substract"}

for verb, sign in VERBS.items():
    stored = SPELLED.get(verb, verb)
    on(f"num_const_{verb}", "lineitem", "l_orderkey l_linenumber l_quantity",
       lambda d, verb=verb, stored=stored: t.column_constant_numeric(d, [
           {"source": "l_quantity", "target": "a", "operation": stored, "value": "4"},
           {"source": "l_linenumber", "target": "b", "operation": verb, "value": 3},
           {"source": "b", "target": "c", "operation": verb, "value": 2.5}]),
       f"l_quantity {sign} 4 AS a, l_linenumber {sign} 3 AS b, "
       f"(l_linenumber {sign} 3) {sign} CAST(2.5 AS DOUBLE) AS c")
    on(f"num_cols_{verb}", "lineitem", "l_orderkey l_linenumber l_extendedprice l_quantity",
       lambda d, verb=verb, stored=stored: t.column_column_numeric(d, [
           {"firstColumn": "l_extendedprice", "secondColumn": "l_quantity",
            "targetColumn": "a", "operation": stored},
           {"firstColumn": "a", "secondColumn": "l_linenumber",
            "targetColumn": "b", "operation": verb}]),
       f"l_extendedprice {sign} l_quantity AS a, "
       f"(l_extendedprice {sign} l_quantity) {sign} l_linenumber AS b")
add("num_divide_by_zero", lambda spark, sf: t.column_constant_numeric(
    t.column_column_numeric(
        load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"),
        [{"firstColumn": "l_quantity", "secondColumn": "l_tax", "targetColumn": "a",
          "operation": "devide"}]),
    [{"source": "l_linenumber", "target": "b", "operation": "devide", "value": "0"}]),
    """SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_quantity / nullif(l_tax, 0) AS a,
       CAST(NULL AS DOUBLE) AS b FROM lineitem""")
add("num_decimal", lambda spark, sf: t.column_constant_numeric(
    t.change_column_type(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                         "o_totalprice", "decimal(12,2)"),
    [{"source": "o_totalprice", "target": "triple", "operation": "multiply", "value": "3"}]),
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 3 AS DECIMAL(14,2)) AS triple FROM orders""")

for name in ("radians", "sin", "cos", "sqrt"):
    on(f"math_{name}", "events", "event_id value",
       lambda d, name=name: t.calculate(d, [
           {"o_type": name, "input_column": "value", "new_column": "y"}]
       ).withColumn("y", F.round("y", 8)),
       f"round({name}(value), 8) AS y")
on("math_atan2", "lineitem", "l_orderkey l_linenumber l_quantity",
   lambda d: t.calculate(d, [{"o_type": "atan2", "input1_column": "l_quantity",
                              "input2_column": "l_linenumber", "new_column": "y"}]
                         ).withColumn("y", F.round("y", 8)),
   "round(atan2(l_quantity, l_linenumber), 8) AS y")
on("math_power_value", "lineitem", "l_orderkey l_linenumber l_quantity",
   lambda d: t.calculate(d, [{"o_type": "power", "input1_column": "l_quantity",
                              "input2": "3", "input2_type": "value", "new_column": "y"}]),
   "pow(l_quantity, 3) AS y")
on("math_power_column", "lineitem", "l_orderkey l_linenumber l_quantity",
   lambda d: t.calculate(d, [{"o_type": "power", "input1_column": "l_quantity",
                              "input2": "l_linenumber", "input2_type": "column",
                              "new_column": "y"}]),
   "pow(l_quantity, l_linenumber) AS y")

HAVERSINE = [
    {"o_type": "radians", "input_column": "lat1", "new_column": "r1"},
    {"o_type": "radians", "input_column": "lat2", "new_column": "r2"},
    {"o_type": "cos", "input_column": "r1", "new_column": "c1"},
    {"o_type": "cos", "input_column": "r2", "new_column": "c2"},
    {"o_type": "radians", "input_column": "dlat", "new_column": "h1"},
    {"o_type": "radians", "input_column": "dlon", "new_column": "h2"},
    {"o_type": "sin", "input_column": "h1", "new_column": "s1"},
    {"o_type": "sin", "input_column": "h2", "new_column": "s2"},
    {"o_type": "power", "input1_column": "s1", "input2": "2", "input2_type": "value",
     "new_column": "q1"},
    {"o_type": "power", "input1_column": "s2", "input2": "2", "input2_type": "value",
     "new_column": "q2"},
]


def haversine(spark, sf):
    """Distance on a sphere between two made-up places per line item."""
    d = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    d = t.column_constant_numeric(d, [
        {"source": "l_quantity", "target": "lat1", "operation": "add", "value": "10"},
        {"source": "l_linenumber", "target": "lat2", "operation": "multiply", "value": "7.5"},
        {"source": "l_tax", "target": "dlon", "operation": "multiply", "value": "500"}])
    d = t.column_column_numeric(d, [{"firstColumn": "lat1", "secondColumn": "lat2",
                                     "targetColumn": "dlat", "operation": "substract"}])
    d = t.column_constant_numeric(d, [
        {"source": "dlat", "target": "dlat", "operation": "devide", "value": "2"},
        {"source": "dlon", "target": "dlon", "operation": "devide", "value": "2"}])
    d = t.calculate(d, HAVERSINE)
    d = t.column_column_numeric(d, [
        {"firstColumn": "c1", "secondColumn": "c2", "targetColumn": "cc", "operation": "multiply"},
        {"firstColumn": "cc", "secondColumn": "q2", "targetColumn": "cc", "operation": "multiply"},
        {"firstColumn": "q1", "secondColumn": "cc", "targetColumn": "a", "operation": "add"}])
    d = t.column_constant_numeric(d, [
        {"source": "a", "target": "rest", "operation": "multiply", "value": "-1"},
        {"source": "rest", "target": "rest", "operation": "add", "value": "1"}])
    d = t.calculate(d, [
        {"o_type": "sqrt", "input_column": "a", "new_column": "ya"},
        {"o_type": "sqrt", "input_column": "rest", "new_column": "xa"},
        {"o_type": "atan2", "input1_column": "ya", "input2_column": "xa", "new_column": "angle"}])
    d = t.column_constant_numeric(
        d, [{"source": "angle", "target": "km", "operation": "multiply", "value": "12742"}])
    return t.select_columns(d, "l_orderkey, l_linenumber, l_quantity, l_tax, km").withColumn(
        "km", F.round("km", 4))


add("haversine", haversine,
    """WITH g AS (
         SELECT *, radians(l_quantity + 10) AS r1, radians(l_linenumber * 7.5::DOUBLE) AS r2,
                radians((l_quantity + 10 - l_linenumber * 7.5::DOUBLE) / 2) AS h1,
                radians(l_tax * 500 / 2) AS h2 FROM lineitem),
       a AS (SELECT *, pow(sin(h1), 2) + cos(r1) * cos(r2) * pow(sin(h2), 2) AS a FROM g)
       SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
              round(atan2(sqrt(a), sqrt(1 - a)) * 12742, 4) AS km FROM a""")

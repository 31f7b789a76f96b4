"""Text operators."""

import tabloom as t
from catalogue import add, load, on

on("split_keep", "part", "p_partkey p_name",
   lambda d: t.split_column(d, "p_name", "[aeiou]", "a, b", keep="true"),
   r"""regexp_extract(p_name, '^([^aeiou]*)', 1) AS a,
       CASE WHEN regexp_matches(p_name, '[aeiou]')
            THEN regexp_extract(p_name, '^[^aeiou]*[aeiou](.*)$', 1) END AS b""")
on("split_drop", "orders", "o_orderkey o_orderpriority",
   lambda d: t.split_column(d, "o_orderpriority", "-", ["code", "word", "none"], keep=False),
   """string_split(o_orderpriority, '-')[1] AS code, string_split(o_orderpriority, '-')[2] AS word,
      string_split(o_orderpriority, '-')[3] AS "none" """)
on("split_literal", "pages", "page_id url",
   lambda d: t.split_column(d, "url", ".", ["host", "domain"], keep=False, literal=True),
   "string_split(url, '.')[1] AS host, string_split(url, '.')[2] AS domain")

add("replace_text", lambda spark, sf: t.replace_text(
    load(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "widget", "part"),
    "SELECT p_partkey, replace(p_name, 'widget', 'part') AS p_name FROM part")
add("replace_regex_group", lambda spark, sf: t.replace_text(
    load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
    "o_orderpriority", r"(\d)-([A-Z]+)", "$2/$1"),
    r"""SELECT o_orderkey, regexp_replace(o_orderpriority, '(\d)-([A-Z]+)', '\2/\1', 'g')
        AS o_orderpriority FROM orders""")
add("replace_markup", lambda spark, sf: t.replace_text(
    load(spark, sf, "pages").select("page_id", "html"), "html", "<[^>]*>", ""),
    "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS html FROM pages")
add("replace_literal", lambda spark, sf: t.replace_text(
    load(spark, sf, "pages").select("page_id", "url"), "url", "?page=", "$", literal=True),
    "SELECT page_id, replace(url, '?page=', '$') AS url FROM pages")

for name in ("lower", "upper"):
    add(f"case_{name}", lambda spark, sf, name=name: t.format_text(
        load(spark, sf, "documents").select("doc_id", "lang", "source"), "source", name),
        f"SELECT doc_id, lang, {name}(source) AS source FROM documents")
add("case_capitalize", lambda spark, sf: t.format_text(
    load(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "capitalize"),
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS p_name FROM part""")
on("concat_cols", "part", "p_partkey p_name p_size",
   lambda d: t.concat_columns(d, "p_name", "p_size", "label", "concatenate", " / "),
   "p_name || ' / ' || CAST(p_size AS VARCHAR) AS label")

# substring, left, right and pad, with constants and columns for position and length.
WORD = "'hello world of tables'"


def step(kind, source, i_type, **more):
    return [{"o_type": kind, "input": source, "i_type": i_type, "new_column": "v", **more}]


for i_name, source, i_type, sql_text in (
    ("col", "l_text", "column", "l_text"), ("lit", "hello world of tables", "value", WORD),
):
    def base(spark, sf):
        d = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
        d = t.constant_columns(d, [{"column": "tag", "constant": "supplier", "isNumeric": False}])
        return t.drop_columns(t.concat_columns(d, "tag", "l_suppkey", "l_text"), "tag")

    def query(name, steps, expression, base=base):
        add(name, lambda spark, sf: t.text_operations(base(spark, sf), steps),
            f"""SELECT *, {expression} AS v FROM (SELECT l_orderkey, l_linenumber, l_suppkey,
                'supplier ' || CAST(l_suppkey AS VARCHAR) AS l_text FROM lineitem)""")

    for f_type in ("value", "column"):
        for l_type in ("value", "column"):
            start = "3" if f_type == "value" else "l_linenumber"
            length = 4 if l_type == "value" else "l_linenumber"
            query(f"substring_{i_name}_{f_type[0]}{l_type[0]}",
                  step("substring", source, i_type, length=length, l_type=l_type,
                       f_type=f_type, **{"from": start}),
                  f"substring({sql_text}, {start}, {length})")
    for l_type, length in (("value", "5"), ("column", "l_linenumber")):
        for side in ("left", "right"):
            query(f"{side}_{i_name}_{l_type}",
                  step("left_right", source, i_type, length=length, l_type=l_type,
                       **{"from": side}),
                  f"{side}({sql_text}, {length})")
    for l_type, length in (("value", "12"), ("column", "l_linenumber")):
        for side in ("left", "right"):
            query(f"pad_{side}_{i_name}_{l_type}",
                  step("pad_spaces", source, i_type, side=side, length=length, l_type=l_type),
                  f"{side[0]}pad({sql_text}, {length}, ' ')")

TRIM = {"both": "trim", "left": "ltrim", "right": "rtrim"}
for side, fn in TRIM.items():
    add(f"trim_{side}", lambda spark, sf, side=side: t.text_operations(
        load(spark, sf, "part").select("p_partkey", "p_name"), [
            {"o_type": "pad_spaces", "input": "p_name", "i_type": "column", "side": "left",
             "length": 20, "l_type": "value", "new_column": "wide"},
            {"o_type": "pad_spaces", "input": "wide", "i_type": "column", "side": "right",
             "length": 30, "l_type": "value", "new_column": "wide2"},
            {"o_type": "trim_spaces", "input": "wide2", "i_type": "column", "side": side,
             "new_column": "v"},
            {"o_type": "trim_spaces", "input": "  two  ", "i_type": "value", "side": side,
             "new_column": "w"}]),
        f"""SELECT p_partkey, p_name, lpad(p_name, 20, ' ') AS wide,
            rpad(lpad(p_name, 20, ' '), 30, ' ') AS wide2,
            {fn}(rpad(lpad(p_name, 20, ' '), 30, ' '), ' ') AS v, {fn}('  two  ', ' ') AS w
            FROM part""")
add("string_op_list", lambda spark, sf: t.text_operations(
    load(spark, sf, "customer").select("c_custkey", "c_name"), [
        {"o_type": "substring", "input": "c_name", "i_type": "column", "from": 1,
         "f_type": "value", "length": "8", "l_type": "value", "new_column": "word"},
        {"o_type": "left_right", "input": "c_name", "i_type": "column", "from": "right",
         "length": 4, "l_type": "value", "new_column": "digits"},
        {"o_type": "pad_spaces", "input": "word", "i_type": "column", "side": "right",
         "length": 10, "l_type": "value", "new_column": "wide"},
        {"o_type": "trim_spaces", "input": "wide", "i_type": "column", "side": "right",
         "new_column": "word"}]),
    """SELECT c_custkey, c_name, left(c_name, 8) AS word, right(c_name, 4) AS digits,
       rpad(left(c_name, 8), 10, ' ') AS wide FROM customer""")

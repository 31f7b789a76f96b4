"""Date and time operators."""

import tabloom as t
from catalogue import add, load, on

MOMENT = "2024-01-30 10:20:30"
UNITS = ("days", "weeks", "hours", "minutes", "seconds")
VERB = {"add": ("add_to_date", "+"), "sub": ("sub_from_date", "-")}
TEXT = "%Y-%m-%d %H:%M:%S"

for verb, (o_type, sign) in VERB.items():
    for unit in UNITS:
        for form, value1, v1_type, start in (
            ("cc", "ts", "column", "ts"),
            ("vc", MOMENT, "value", f"TIMESTAMP '{MOMENT}'"),
        ):
            if unit in ("days", "weeks"):
                n = "user_id" if unit == "days" else "7 * user_id"
                sql = f"CAST(CAST({start} AS DATE) {sign} CAST({n} AS INTEGER) AS TIMESTAMP)"
            else:
                sql = (f"strftime(date_trunc('second', {start}) {sign} to_{unit}(user_id), "
                       f"'{TEXT}')")
            on(f"date_{verb}_{unit}_{form}", "events", "event_id ts user_id",
               lambda d, o_type=o_type, value1=value1, v1_type=v1_type, unit=unit:
               t.date_operations(d, [
                   {"o_type": o_type, "value1": value1, "v1_type": v1_type,
                    "value2": "user_id", "v2_type": "column", "unit": unit,
                    "new_column": "moved"}]),
               f"{sql} AS moved")
    INTERVALS = [(unit, n) for unit, n in (
        ("years", 1), ("months", "13"), ("weeks", 2), ("days", "3"), ("hours", -5),
        ("minutes", "90"), ("seconds", 45))]
    on(f"date_{verb}_interval_cv", "orders", "o_orderkey o_orderdate",
       lambda d, o_type=o_type, intervals=INTERVALS: t.date_operations(d, [
           {"o_type": o_type, "value1": "o_orderdate", "v1_type": "column", "value2": n,
            "v2_type": "value", "unit": unit, "new_column": unit} for unit, n in intervals]),
       ", ".join(f"o_orderdate {sign} INTERVAL ({n}) {unit} AS {unit}"
                 for unit, n in INTERVALS))
    on(f"date_{verb}_interval_vv", "orders", "o_orderkey",
       lambda d, o_type=o_type, intervals=INTERVALS: t.date_operations(d, [
           {"o_type": o_type, "value1": "2024-01-31 10:20:30", "v1_type": "value", "value2": n,
            "v2_type": "value", "unit": unit, "new_column": unit} for unit, n in intervals]),
       ", ".join(f"TIMESTAMP '2024-01-31 10:20:30' {sign} INTERVAL ({n}) {unit} AS {unit}"
                 for unit, n in INTERVALS))
on("date_add_interval_date", "orders", "o_orderkey o_orderdate",
   lambda d: t.date_operations(t.change_column_type(
       t.set_column_value(d, "o_orderdate", "day"), "day", "date"), [
       {"o_type": "add_to_date", "value1": "day", "v1_type": "column", "value2": "1",
        "v2_type": "value", "unit": "month", "new_column": "later"},
       {"o_type": "add_to_date", "value1": "day", "v1_type": "column", "value2": "7",
        "v2_type": "value", "unit": "hours", "new_column": "hour"}]),
   """CAST(o_orderdate AS DATE) AS day,
      CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 month AS DATE) AS later,
      CAST(o_orderdate AS DATE) + INTERVAL 7 hour AS hour""")

SECONDS = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}
OTHER = "2024-01-15 12:00:00"


def epoch(sql):
    return f"CAST(floor(epoch({sql})) AS BIGINT)"


def line_dates(spark, sf):
    return t.select_columns(t.join_tables(
        load(spark, sf, "lineitem"), load(spark, sf, "orders"), "inner",
        [{"left_on": "l_orderkey", "right_on": "o_orderkey"}]),
        "l_orderkey, l_linenumber, l_shipdate, o_orderdate")


for unit, seconds in SECONDS.items():
    def shown(a, b, seconds=seconds, unit=unit):
        gap = f"({epoch(a)} - {epoch(b)})"
        if unit == "seconds":
            return gap
        # Rounded half up on whole numbers, as a double quotient may miss a tie.
        return (f"sign({gap}) * ((abs({gap}) * 200 + {seconds}) // {2 * seconds}) "
                "/ CAST(100 AS DOUBLE)")

    def diff(value1, v1_type, value2, v2_type, unit=unit):
        return lambda d: t.date_operations(d, [
            {"o_type": "date_diff", "value1": value1, "v1_type": v1_type, "value2": value2,
             "v2_type": v2_type, "unit": unit, "new_column": "gap"}])

    add(f"date_diff_{unit}_cc",
        lambda spark, sf, apply=diff("l_shipdate", "column", "o_orderdate", "column"):
        apply(line_dates(spark, sf)),
        f"""SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate,
            {shown('l_shipdate', 'o_orderdate')} AS gap
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
    on(f"date_diff_{unit}_cv", "events", "event_id ts", diff("ts", "column", OTHER, "value"),
       f"{shown('ts', f'TIMESTAMP {chr(39)}{OTHER}{chr(39)}')} AS gap")
    on(f"date_diff_{unit}_vc", "events", "event_id ts", diff(OTHER, "value", "ts", "column"),
       f"{shown(f'TIMESTAMP {chr(39)}{OTHER}{chr(39)}', 'ts')} AS gap")
    on(f"date_diff_{unit}_vv", "events", "event_id", diff(OTHER, "value", MOMENT, "value"),
       f"{shown(f'TIMESTAMP {chr(39)}{OTHER}{chr(39)}', f'TIMESTAMP {chr(39)}{MOMENT}{chr(39)}')}"
       " AS gap")

PARTS = {
    "year": ("year_of_date", "CAST(year({0}) AS INTEGER)"),
    "quarter": ("quarter_of_date", "CAST(quarter({0}) AS INTEGER)"),
    "month": ("month_of_date", "CAST(month({0}) AS INTEGER)"),
    "doy": ("day_of_year", "CAST(dayofyear({0}) AS VARCHAR)"),
    "dom": ("day_of_month", "CAST(dayofmonth({0}) AS VARCHAR)"),
    "dow": ("day_of_week", "CAST(dayofweek({0}) + 1 AS INTEGER)"),
    "woy": ("week_of_year", "CAST(weekofyear({0}) AS INTEGER)"),
}
for short, (o_type, sql) in PARTS.items():
    on(f"date_part_{short}_col", "orders", "o_orderkey o_orderdate",
       lambda d, o_type=o_type: t.date_operations(d, [
           {"o_type": o_type, "value1": "o_orderdate", "v1_type": "column",
            "new_column": "piece"}]),
       f"{sql.format('o_orderdate')} AS piece")
    on(f"date_part_{short}_lit", "orders", "o_orderkey",
       lambda d, o_type=o_type: t.date_operations(d, [
           {"o_type": o_type, "value1": "2024-12-30", "v1_type": "value",
            "new_column": "piece"}]),
       sql.format("DATE '2024-12-30'") + " AS piece")

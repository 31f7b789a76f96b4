"""Ready-made table operators for Spark DataFrames."""

from tabloom.operators.columns import (
    change_column_type, constant_columns, drop_columns, fill_null, rename_columns,
    select_columns, set_column_value,
)
from tabloom.operators.dates import date_operations
from tabloom.operators.groups import group_rows
from tabloom.operators.joins import join_tables
from tabloom.operators.mapping import map_cases, map_column
from tabloom.operators.numeric import calculate, column_column_numeric, column_constant_numeric
from tabloom.operators.rows import (
    append_rows, filter_rows, limit_rows, order_rows, preview, top_rows,
)
from tabloom.operators.selection import group_mode, group_percentiles
from tabloom.operators.sketches import (
    deal_values, exact_quantiles, merge_sketches, sketch_states, sketch_values,
)
from tabloom.operators.text import (
    concat_columns, format_text, replace_text, split_column, text_operations,
)
from tabloom.operators.windows import window_columns
from tabloom.plans.steps import OPERATORS, run_steps
from tabloom.sources.csv import read_csv, read_tenant_csv, write_csv
from tabloom.sources.jdbc import connection_options, read_jdbc, write_jdbc
from tabloom.sources.views import drop_view, publish_view, scan_view

__all__ = [
    "OPERATORS", "append_rows", "calculate", "change_column_type", "column_column_numeric",
    "column_constant_numeric", "concat_columns", "connection_options", "constant_columns",
    "date_operations", "deal_values", "drop_columns", "drop_view", "exact_quantiles", "fill_null", "filter_rows", "format_text",
    "group_mode", "group_percentiles", "group_rows", "join_tables", "limit_rows", "map_cases", "map_column", "merge_sketches",
    "order_rows",
    "preview", "publish_view", "read_csv", "read_jdbc", "read_tenant_csv", "rename_columns",
    "replace_text", "run_steps", "scan_view", "select_columns", "set_column_value",
    "sketch_states", "sketch_values",
    "split_column", "text_operations", "top_rows", "window_columns", "write_csv", "write_jdbc",
]

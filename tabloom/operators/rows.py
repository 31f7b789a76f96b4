"""Filtering, ordering, limiting and appending rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import (
    choose, column_or_expression, flag, is_text, name_list, row_hash,
)

SAMPLED_KEYS = 4_096     # keys that one round of looking for the last of the best rows draws

DIRECTIONS = {
    "ASC": Column.asc,
    "ASC NULLS FIRST": Column.asc_nulls_first,
    "ASC NULLS LAST": Column.asc_nulls_last,
    "DESC": Column.desc,
    "DESC NULLS FIRST": Column.desc_nulls_first,
    "DESC NULLS LAST": Column.desc_nulls_last,
}


def filter_rows(df: DataFrame, rules: str = "1 = 0") -> DataFrame:
    """Keep rows for which the SQL condition is true."""
    return df.where(rules)


def order_rows(
    df: DataFrame, columns: str | Iterable[str], order: str = "ASC",
    spread_ties: bool | str = True,
) -> DataFrame:
    """Sort by columns or expressions, one direction for all of them.

    A range sort sends equal keys to one task, which a very frequent key would
    overload. ``spread_ties`` appends the input partition number and a hash of the row to
    the sort key, so that rows with equal keys are cut into ranges as well, also where an
    earlier shuffle has brought them together, and full copies of one row by where they
    come from. Both are the same again when a lost task is repeated. The hash reads all
    columns; ``spread_ties="partition"`` appends the partition number alone, so that columns
    nobody asks for are not read. Rows with equal keys that were in one task before the
    sort then stay in one.
    """
    spread = spread_ties == "partition" or flag(spread_ties)
    direction = choose(DIRECTIONS, " ".join(order.upper().split()), "direction")
    keys = [direction(column_or_expression(df, c)) for c in name_list(columns)]
    if spread and not df.isStreaming:
        keys.append(F.spark_partition_id().asc())
        if spread_ties != "partition":
            keys.append(row_hash(df).asc())
    return df.orderBy(*keys)


def limit_rows(df: DataFrame, row_limit: int, spread: bool = False) -> DataFrame:
    """``row_limit`` rows: the first ones after ``order_rows``, else any.

    Spark's limit is lazy and lets a scan stop early, but its rows pass through one task.
    For a limit too large for that, ``spread`` writes the rows out once (of each partition
    no more than the limit), then takes whole partitions in their order and a piece of the
    last one.
    """
    limit = int(row_limit)
    if not spread or df.isStreaming:
        return df.limit(limit)
    part, place = "__tabloom_part", "__tabloom_place"
    numbered = stage(df.withColumns({
        part: F.spark_partition_id(),
        # The lower 33 bits count the rows of a partition.
        place: F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)),
    }).where(F.col(place) < limit), "limit")
    left = limit
    # One row per partition.
    for last, rows in sorted(tuple(r) for r in numbered.groupBy(part).count().collect()):
        if rows >= left:
            kept = (F.col(part) < last) | ((F.col(part) == last) & (F.col(place) < left))
            return numbered.where(kept).drop(part, place)
        left -= rows
    return numbered.drop(part, place)


def top_rows(
    df: DataFrame, columns: str | Iterable[str], row_limit: int, order: str = "ASC",
    spread: bool = False,
) -> DataFrame:
    """Order and limit in one step: every task keeps only its own best rows.

    They meet in one task. For a limit too large for that, ``spread`` looks for the key of the
    last row that is kept, by sampled keys and counts, and moves and sorts the rows up to that
    key only: about ``row_limit`` of them, whatever the size of the table. ``df`` is read
    several times then (the sort columns, but for the last time) and must give the same rows.
    """
    if not spread or df.isStreaming:
        return limit_rows(order_rows(df, columns, order, spread_ties=False), row_limit)
    limit = int(row_limit)
    direction = " ".join(order.upper().split())
    choose(DIRECTIONS, direction, "direction")
    key = _sort_key(df, columns, direction)
    up_to = _last_key(df, key, limit, direction.startswith("DESC"))
    if up_to is None:
        return order_rows(df, columns, order)
    last, before, through = up_to
    ahead = key > last if direction.startswith("DESC") else key < last
    if through > 2 * limit > 0:
        # One key holds more rows than there is room for; any of them will do.
        some = limit_rows(df.where(key == last), limit - before, spread=True)
        return order_rows(df.where(ahead).union(some), columns, order)
    found = limit_rows(order_rows(df.where(ahead | (key == last)), columns, order), limit, True)
    return order_rows(found, columns, order)


def _sort_key(df: DataFrame, columns: str | Iterable[str], direction: str) -> Column:
    """One value that sorts as the columns do: structs have nulls first, the larger ones last."""
    flagged = direction in ("ASC NULLS LAST", "DESC NULLS FIRST")
    fields = []
    for i, name in enumerate(name_list(columns)):
        value = column_or_expression(df, name)
        if flagged:
            fields.append(value.isNull().alias(f"n{i}"))
        fields.append(value.alias(f"k{i}"))
    return F.struct(*fields)


def _last_key(df: DataFrame, key: Column, limit: int,
              descending: bool) -> tuple[Column, int, int] | None:
    """A key at or a little behind that of row number ``limit``, with the rows before it and
    those through it; None where there are no more rows than that.

    Each round samples the keys that are left, counts the rows up to a few of them in one
    pass, and goes on with the rows up to the best.
    """
    keys = df.select(key.alias("key"))
    rows, within = keys.count(), F.lit(True)
    if rows <= limit:
        return None
    best = None
    while True:
        held = best[2] if best else rows
        sample = keys.where(within).sample(min(1.0, SAMPLED_KEYS / held), seed=held % 997)
        drawn = sample.agg(F.sort_array(F.collect_list("key"), asc=not descending).alias("k"))
        size = drawn.select(F.size("k")).first()[0]
        at = limit * size / held
        # The likely place with room for chance, and some further behind.
        places = sorted({min(size - 1, int(at + 3 * at**0.5 + 1) + step)
                         for step in (0, *(1 << j for j in range(12)))}) if size else []
        picked = stage(drawn.select(F.explode(F.array(*[F.get("k", F.lit(p)) for p in places]))
                                    .alias("key")), "picked") if places else None
        if picked is None:
            break
        listed = picked.agg(F.sort_array(F.collect_list("key")).alias("k")).scalar()
        tests = []
        for j in range(len(places)):
            pick = F.get(listed, F.lit(j))
            ahead = F.col("key") > pick if descending else F.col("key") < pick
            tests += [F.count_if(ahead).alias(f"before{j}"),
                      F.count_if(ahead | (F.col("key") == pick)).alias(f"through{j}")]
        counted = keys.where(within).agg(*tests).first()
        found = [(counted[f"through{j}"], counted[f"before{j}"], j) for j in range(len(places))
                 if counted[f"through{j}"] >= limit]
        if not found or min(found)[0] >= held:
            break
        through, before, j = min(found)
        last = F.get(listed, F.lit(j))
        best = (last, before, through)
        within = F.col("key") >= last if descending else F.col("key") <= last
        if through <= 2 * limit or before < limit:
            break
    return best or _whole(keys, descending, rows)


def _whole(keys: DataFrame, descending: bool, rows: int) -> tuple[Column, int, int]:
    """The last key of all, for a table whose sample told nothing."""
    end = keys.agg((F.min("key") if descending else F.max("key")).alias("k")).scalar()
    return end, rows - keys.where(F.col("key") == end).count(), rows


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows as a DataFrame; nothing is run or printed."""
    return df.limit(rows)


INTEGRAL_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}
INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def append_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, matched by position and named as in ``first``.

    Differing types widen; where one side is text the column becomes text.
    """
    if len(first.columns) != len(second.columns):
        raise ValueError(
            f"column counts differ: {len(first.columns)} and {len(second.columns)}"
        )
    targets = [_wider(a.dataType, b.dataType) for a, b in zip(first.schema, second.schema,
                                                              strict=True)]
    return _cast_all(first, targets).union(_cast_all(second, targets))


def _cast_all(df: DataFrame, targets: list[T.DataType | None]) -> DataFrame:
    if all(t is None or t == f.dataType for t, f in zip(targets, df.schema, strict=True)):
        return df
    return df.select(*[
        c if t is None or t == f.dataType else c.try_cast(t).alias(f.name)
        for t, f, c in zip(
            targets, df.schema,
            [F.col("`" + n.replace("`", "``") + "`") for n in df.columns], strict=True,
        )
    ])


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The common type of two columns, or None where Spark's union decides."""
    if a == b:
        return a
    if is_text(a) or is_text(b):
        return T.StringType()
    kinds = (type(a), type(b))
    if all(k in INTEGRAL_WIDTH for k in kinds):
        return a if INTEGRAL_WIDTH[kinds[0]] >= INTEGRAL_WIDTH[kinds[1]] else b
    if isinstance(a, T.FractionalType) and isinstance(b, T.FractionalType) and \
            not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType):
        return T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if T.DoubleType in kinds:
            return T.DoubleType()
        if T.FloatType in kinds:
            # Whole numbers stay float, decimals become double.
            return T.DoubleType() if T.DecimalType in kinds else T.FloatType()
        da, db = _as_decimal(a), _as_decimal(b)
        scale = max(da.scale, db.scale)
        whole = max(da.precision - da.scale, db.precision - db.scale)
        return T.DecimalType(min(whole + scale, 38), scale)
    return None


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(
        INTEGRAL_DIGITS[type(kind)], 0
    )

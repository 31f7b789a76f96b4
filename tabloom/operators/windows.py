"""Ranking, offset and running functions over a window.

Spark's own window puts every partition of the window into one task. That is fine
for many small partitions, but a window without partition columns, or one whose
partition holds a large share of the rows, ends in a single task. For those the
rows are cut into ranges of the sort key, and move once:

1. A bounded sample gives range bounds, which become constants of the plan.
2. Each row finds its range by binary search; one exchange brings the rows of a range
   together, the window runs inside the range, and rows and values are written out.
3. Totals per range (a few rows per bound) give what came before each range, and its
   rim rows what ``lag`` and ``lead`` reach for in other ranges. Both become constant
   arrays, indexed by range, so that the second pass over what was written is narrow:
   no join and no exchange.

Rows with equal sort keys share a range, so ranks and running totals are exact. One
sort key that is itself too frequent gets a range of its own: ranks and running
totals are the same for all its rows, and for numbering it is cut by where the rows
came from.

Sums of doubles do not depend on the order of addition: each number is split into
three parts on grids that the window partition's largest number and its row count fix, so
coarse that sums of such parts are never rounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.checkpoints import stage
from tabloom.functions.params import (
    choose, column, has_column, hashable, integer, is_text, name_list, type_of,
)
from tabloom.operators.groups import NUMERIC_AGGREGATES

RANKS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}
OFFSETS = {"lag": -1, "lead": 1}
RUNNING = ("sum", "avg", "count")
KINDS = {name: name for name in (*RANKS, *OFFSETS, *RUNNING)}

ROWS_PER_RANGE = 500_000
RANGES_PER_CORE = 4        # several per core even out ranges that hash to one task
MOST_RANGES = 20_000
SAMPLE_PER_RANGE = 16
SAMPLE_BYTES = 1 << 28     # size of the sample where keys are text
NARROW_DECIMAL = 11        # digits up to which Spark averages decimals as doubles
MOST_RIM_ROWS = 200_000    # rim rows up to which they become a constant array

PART, BUCKET, SALT = "__tabloom_part", "__tabloom_bucket", "__tabloom_salt"
PIECE, NUMBER = "__tabloom_piece", "__tabloom_rn"
FOLDS = 3                  # grids a double is split on
HUGE, SHRINK = 1e280, 2.0**-120     # numbers that large are scaled down before they are split


class Function(NamedTuple):
    kind: str
    column: str | None
    new_column: str
    offset: int


def window_columns(
    df: DataFrame, functions: Iterable[Mapping[str, Any]], order_by: str | Iterable[str],
    order: str = "asc", partition: str | Iterable[str] = "", method: str = "plain",
    ranges: int | None = None, number_type: str = "int", double_sums: str = "same",
) -> DataFrame:
    """Add ``[{func, column, offset, new_column}]`` over one window.

    ``order`` is ``asc`` (NULLs first) or ``desc`` (NULLs last); without ``partition``
    the whole table is one window. The caller chooses the form, never the data:
    ``plain`` is Spark's own window, lazy, with each window partition in one task;
    ``split`` is the range form for windows that no task can hold. Row numbers and ranks
    are of ``number_type``: ``int`` as in Spark, or ``bigint`` for more rows than that.

    ``double_sums`` says how doubles are added: ``same`` gives the same sum to the last bit
    in both forms, in every run and for any number of tasks; ``fast`` is Spark's own addition,
    whose last digits depend on the order.

    The range form samples the keys of ``df`` and writes the rows out once, range by range,
    before it returns.
    """
    parts = name_list(partition) if partition else []
    orders = name_list(order_by)
    descending = choose({"asc": False, "desc": True}, order.strip().lower(), "direction")
    choose({m: m for m in ("plain", "split")}, method, "method")
    choose({m: m for m in ("int", "bigint")}, number_type, "number type")
    same = choose({"same": True, "fast": False}, double_sums, "way to add doubles")
    entries = [_entry(f) for f in functions]
    form = _Form(parts, orders, descending, number_type, same)
    if method == "plain":
        return _plain(df, entries, form)
    for run in _independent_runs(entries, {*parts, *orders}):
        bounds = _find_bounds(df, parts, orders, ranges)
        df = _plain(df, run, form) if bounds is None else _split(df, run, form, bounds)
    return df


class _Form(NamedTuple):
    """What all functions of a call share."""

    parts: list[str]
    orders: list[str]
    descending: bool
    number: str
    same: bool      # doubles are added without rounding

    def keys(self, df: DataFrame) -> list[Column]:
        return [column(df, p) for p in self.parts]

    def directed(self, df: DataFrame) -> list[Column]:
        return [column(df, o).desc() if self.descending else column(df, o).asc()
                for o in self.orders]


def _entry(f: Mapping[str, Any]) -> Function:
    kind = choose(KINDS, f["func"], "window function")
    source = None if kind in RANKS else f["column"]
    distance = f.get("offset")
    distance = 1 if distance in (None, "") else integer(distance)
    return Function(kind, source, f["new_column"], OFFSETS.get(kind, 0) * distance)


def _independent_runs(entries: list[Function], keys: set[str]) -> list[list[Function]]:
    """Cut the list where an entry needs, or replaces, what an earlier one made."""
    runs: list[list[Function]] = [[]]
    for e in entries:
        made = {x.new_column.lower() for x in runs[-1]}
        clash = e.new_column.lower() in made or (e.column or "").lower() in made \
            or made & {k.lower() for k in keys}
        if clash:
            runs.append([])
        runs[-1].append(e)
    return runs


def _value(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """Input of a running sum or average: text is read as double."""
    col = column(df, name)
    kind = type_of(df, col)
    return (col.try_cast("double"), T.DoubleType()) if is_text(kind) else (col, kind)


def _running(df: DataFrame, e: Function) -> Column:
    if e.kind == "count":
        return F.count(column(df, e.column))
    return NUMERIC_AGGREGATES[e.kind](*_value(df, e.column))


def _shifted(df: DataFrame, e: Function) -> Column:
    col = column(df, e.column)
    return F.lead(col, e.offset) if e.offset >= 0 else F.lag(col, -e.offset)


def _folded(df: DataFrame, e: Function, form: _Form) -> bool:
    """Whether this sum or average adds doubles on grids."""
    return form.same and e.kind in ("sum", "avg") and isinstance(
        _value(df, e.column)[1], (T.DoubleType, T.FloatType))


def _double(df: DataFrame, name: str) -> Column:
    return _value(df, name)[0].cast("double")


def _finite(x: Column) -> Column:
    return F.when(F.abs(x) < float("inf"), x)


def _fold(df: DataFrame, name: str, prefix: str, peak: Column, n: Column) -> tuple[
        DataFrame, list[str]]:
    """A double column in parts that add up without rounding, and what is not finite as the last.

    ``peak`` is the largest magnitude there is and ``n`` how many numbers there are. The first
    grid is so coarse that any sum of n numbers on it fits a double's 53 bits; what is left of
    the number goes onto the next grid, finer by 52 bits less those that n takes.
    """
    def own(what: str) -> str:
        return f"{prefix}_{what}"

    x = _double(df, name)
    # One projection for each step, so that nothing is written out twice.
    df = df.withColumns({own("peak"): peak, own("room"): F.pow(
        F.lit(2.0), F.ceil(F.log2(n.cast("double"))) + 1)})
    df = df.withColumn(own("scale"), F.when(F.col(own("peak")) > HUGE, SHRINK).otherwise(1.0))
    df = df.withColumns({
        own("left"): _finite(x) * F.col(own("scale")),
        own("pull"): F.coalesce(F.pow(F.lit(2.0), F.ceil(F.log2(
            F.col(own("peak")) * F.col(own("scale")))) + 1), F.lit(1.0)) * F.col(own("room")) * 1.5})
    names = [own(str(k)) for k in range(FOLDS + 1)]
    for part in names[:-1]:
        # Adding and taking away rounds to a multiple of the last digit of this number.
        df = df.withColumn(part, (F.col(own("left")) + F.col(own("pull"))) - F.col(own("pull")))
        df = df.withColumns({
            own("left"): F.col(own("left")) - F.col(part),
            own("pull"): F.col(own("pull")) * F.col(own("room")) * 2.0**-52,
            part: F.col(part) / F.col(own("scale"))})
    df = df.withColumn(names[-1], F.when(F.abs(x) < float("inf"), None).otherwise(x))
    return df.drop(*[own(w) for w in ("peak", "room", "scale", "left", "pull")]), names


def _unfolded(sums: list[Column]) -> Column:
    """The sum of the parts' sums; what is not finite decides where there is any."""
    *parts, odd = sums
    total = parts[-1]
    for p in reversed(parts[:-1]):
        total = p + total
    return F.coalesce(odd, total)


def _with_folds(df: DataFrame, entries: list[Function], form: _Form, grid) -> tuple[
        DataFrame, dict[str, list[str]]]:
    """The parts of each column that is added, as columns of their own.

    ``grid`` gives the largest magnitude and the count of such a column.
    """
    parts = {}
    for i, name in enumerate(sorted({e.column for e in entries if _folded(df, e, form)})):
        df, parts[name] = _fold(df, name, f"__tabloom_fold{i}", *grid(name))
    return df, parts


def _peak(df: DataFrame, name: str) -> Column:
    return F.max(F.abs(_finite(_double(df, name))))


def _many(df: DataFrame, name: str) -> Column:
    return F.count(_finite(_double(df, name)))


def _plain(df: DataFrame, entries: list[Function], form: _Form) -> DataFrame:
    for e in entries:
        window = W.partitionBy(*form.keys(df)).orderBy(*form.directed(df))
        if e.kind in RANKS:
            made = RANKS[e.kind]().over(window)
            made = made if form.number == "int" else made.cast(form.number)
        elif e.kind in OFFSETS:
            made = _shifted(df, e).over(window)
        elif _folded(df, e, form):
            # The same order for the whole frame saves a second sort.
            whole = window.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
            outer = df.columns
            df, folds = _with_folds(df, [e], form, lambda c, d=df: (
                _peak(d, c).over(whole), _many(d, c).over(whole)))
            names = folds[e.column]
            sums = {f"__tabloom_sum{k}": F.sum(n).over(window) for k, n in enumerate(names)}
            if e.kind == "avg":
                sums["__tabloom_n"] = F.count(_double(df, e.column)).over(window)
            df = df.withColumns(sums).drop(*names)
            made = _unfolded([F.col(f"__tabloom_sum{k}") for k in range(len(names))])
            if e.kind == "avg":
                made = F.try_divide(made, F.col("__tabloom_n"))
            df = df.withColumn(e.new_column, made)
            df = df.select(*[column(df, c) for c in outer],
                           *[column(df, e.new_column)][:0 if e.new_column in outer else 1])
            continue
        else:
            made = _running(df, e).over(window)
        df = df.withColumn(e.new_column, made)
    return df


class Bounds(NamedTuple):
    """Sorted sort keys, each with the number of cuts its own rows need (0: none).

    ``parts`` numbers the window partitions the keys belong to.
    """

    keys: list[tuple]
    cuts: list[int]
    parts: list[int]
    schema: T.StructType

    def single(self) -> bool:
        """One sort column and no NULL bound: plain values compare faster than structs."""
        return len(self.schema) == 1 and all(k[0] is not None for k in self.keys)

    def starts(self) -> list[int]:
        """The number of the first piece of each range, and of one range more.

        A range between two bounds may hold the end of one partition and the begin of the next.
        """
        sizes = [n for cut in self.cuts for n in (2, max(cut, 1))]
        return [0, *accumulate([*sizes, 2])]

    def pieces(self) -> int:
        """How many there are."""
        return self.starts()[-1]

    def arrays(self, df: DataFrame) -> list[Column]:
        """Keys, cuts, partition numbers and piece numbers as constants of the plan."""
        kind = self.schema[0].dataType if self.single() else self.schema
        keys = [k[0] for k in self.keys] if self.single() else self.keys
        table = df.sparkSession.createDataFrame(
            [(keys, self.cuts, self.parts, self.starts())], T.StructType([
                T.StructField("keys", T.ArrayType(kind)),
                *[T.StructField(n, T.ArrayType(T.IntegerType()))
                  for n in ("cuts", "parts", "starts")],
            ]))
        return [table.select(name).scalar() for name in table.columns]


def _sort_key(df: DataFrame, parts: list[str], orders: list[str]) -> Column:
    fields = [column(df, c).alias(f"k{i}") for i, c in enumerate([*parts, *orders])]
    return F.struct(*fields)


def _find_bounds(df, parts, orders, ranges: int | None) -> Bounds | None:
    """Range bounds from a bounded sample, or None where there are no rows."""
    texts = [
        F.octet_length(column(df, c)) for c in [*parts, *orders]
        if isinstance(type_of(df, column(df, c)), (T.StringType, T.BinaryType))
    ]
    size = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(f"w{i}") for i, c in enumerate(texts)]
    ).first()
    rows, width = size["rows"], sum(w or 0 for w in size[1:])
    if rows == 0:
        return None
    if ranges is None:
        least = RANGES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
        ranges = min(max(rows // ROWS_PER_RANGE, least), MOST_RANGES)
    wanted = ranges * SAMPLE_PER_RANGE
    if wanted * width > SAMPLE_BYTES:
        wanted = max(int(SAMPLE_BYTES / width), 2)
        ranges = min(ranges, max(wanted // 4, 1))
    keys = df.select(_sort_key(df, parts, orders).alias("key"))
    schema = keys.schema[0].dataType
    sample = keys if rows <= wanted else keys.sample(wanted / rows, seed=1)
    drawn = sample.agg(F.sort_array(F.collect_list("key")).alias("keys")).first()["keys"]
    step = max(len(drawn) // ranges, 1)
    picks = [hashable(k) for k in drawn[step - 1::step]]
    nan = float("nan")  # one object for all, so that equal keys are found to be equal
    picks = [tuple(nan if isinstance(v, float) and v != v else v for v in p) for p in picks]
    counts: dict[tuple, int] = {}
    for p in picks:
        counts[p] = counts.get(p, 0) + 1
    if not counts:
        return None
    cuts = [n if n > 1 and step > 1 else 0 for n in counts.values()]
    numbers: dict[tuple, int] = {}
    owners = [numbers.setdefault(k[: len(parts)], len(numbers)) for k in counts]
    return Bounds(list(counts), cuts, owners, schema)


def _tag(df, parts, orders, bounds: Bounds) -> DataFrame:
    """Add partition, range, cut and piece number (-1 for partitions that are not cut)."""
    keys, cuts, owners, starts = bounds.arrays(df)
    key, position = "__tabloom_key", "__tabloom_position"
    step = 1 << (len(bounds.keys).bit_length() - 1)
    sort_key = column(df, orders[0]) if bounds.single() else _sort_key(df, parts, orders)
    tagged = df.withColumns({key: sort_key, position: F.lit(0)})
    while step:
        # Binary search, one halving per projection: counts the bounds below the key.
        below = F.get(keys, F.col(position) + F.lit(step - 1)) < F.col(key)
        tagged = tagged.withColumn(position, F.col(position) + F.when(below, step).otherwise(0))
        step >>= 1
    at, at_cuts, before = "__tabloom_at", "__tabloom_cuts", "__tabloom_before"
    tagged = tagged.withColumns({
        at: F.get(keys, F.col(position)), at_cuts: F.get(cuts, F.col(position))
    })
    tied = F.coalesce((F.col(at_cuts) > 0) & (F.col(at) == F.col(key)), F.lit(False))
    part, bucket, second = F.lit(0), F.col(position) * 2 + tied.cast("int"), F.lit(0)
    if parts:
        def same(bound: str) -> Column:
            test = F.col(bound).isNotNull()
            for i in range(len(parts)):
                test = test & F.col(bound)[f"k{i}"].eqNullSafe(F.col(key)[f"k{i}"])
            return test

        tagged = tagged.withColumn(before, F.get(keys, F.col(position) - 1))
        part = F.when(same(at), F.get(owners, F.col(position))).when(
            same(before), F.get(owners, F.col(position) - 1)).otherwise(-1)
        bucket = F.when(same(at) | same(before), bucket).otherwise(-1)
        second = F.when(same(at), 0).otherwise(1)
    # The partition number also keeps Spark from pushing filters on the range number
    # below the search, where each halving would be written out twice.
    salt = F.when(tied, F.pmod(F.spark_partition_id(), F.col(at_cuts))).otherwise(0)
    tagged = tagged.withColumns({PART: part, BUCKET: bucket, SALT: salt, PIECE: second})
    return tagged.withColumn(PIECE, F.coalesce(
        F.get(starts, F.col(BUCKET)) + F.col(SALT) + F.col(PIECE), F.lit(-1))).drop(
            key, position, at, at_cuts, before)


def _array_by(rows: DataFrame, number: str, value: Column, size: int) -> Column:
    """``value`` by ``number`` (0 to ``size`` - 1) as a constant array, null where there is none."""
    known = rows.select(F.col(number).cast("int").alias("at"), value.alias("value"))
    none = rows.sparkSession.range(0, size, 1, 1).select(
        F.col("id").cast("int").alias("at"),
        F.lit(None).cast(known.schema["value"].dataType).alias("value"))
    whole = known.unionByName(none).groupBy("at").agg(
        F.first("value", ignorenulls=True).alias("value"))
    listed = F.array_sort(F.collect_list(F.struct("at", "value")), lambda a, b: a["at"] - b["at"])
    return whole.agg(F.transform(listed, lambda x: x["value"]).alias("listed")).scalar()


def _split(df: DataFrame, entries: list[Function], form: _Form, bounds: Bounds) -> DataFrame:
    tagged = _tag(df, form.parts, form.orders, bounds)
    here = W.partitionBy(*form.keys(df), BUCKET, SALT).orderBy(*form.directed(df))
    tagged, folds = _with_folds(tagged, entries, form, _grids(tagged, entries, form, here, bounds))
    local = {NUMBER: F.row_number().over(here)}
    for i, e in enumerate(entries):
        name = f"__tabloom_local{i}"
        if e.kind in ("rank", "dense_rank"):
            local[name] = RANKS[e.kind]().over(here)
        elif e.kind in OFFSETS:
            local[name] = _shifted(df, e).over(here)
        elif e.kind in RUNNING:
            for suffix, total in _totals(df, e, folds).items():
                local[name + suffix] = total.over(here)
    # The one exchange of the rows: everything after it is a narrow pass over what is written.
    ranged = stage(tagged.withColumns(local), "window")
    before = _carry(ranged, df, entries, form, folds)
    fields = [c for c in before.columns if c != PIECE]
    if any(e.kind in OFFSETS for e in entries):
        before = stage(before, "totals")    # read for the rims, too
    around = _array_by(before, PIECE, F.struct(*fields), bounds.pieces())
    rows = ranged.withColumn("__c", F.get(around, F.col(PIECE)))
    if any(e.kind in OFFSETS for e in entries):
        rows = _with_rims(rows, df, entries, form, bounds)
    made = {e.new_column: _combine(df, e, i, form, folds) for i, e in enumerate(entries)}
    result = rows.withColumns(made)
    return result.select(*[
        column(result, c) for c in
        [*df.columns, *[e.new_column for e in entries if not has_column(df, e.new_column)]]
    ])


def _grids(tagged: DataFrame, entries: list[Function], form: _Form, here, bounds: Bounds):
    """The largest magnitude and the count of a column in the row's whole window partition.

    A partition that is cut into ranges is looked up by its number, others lie whole
    in one range.
    """
    whole = here.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    names = sorted({e.column for e in entries if _folded(tagged, e, form)})
    if names:
        # No filter here: pushed below the search, it would write each halving out twice.
        cut = tagged.groupBy((F.col(PART) + 1).alias("__number")).agg(F.struct(
            *[_peak(tagged, n).alias(f"peak{i}") for i, n in enumerate(names)],
            *[_many(tagged, n).alias(f"many{i}") for i, n in enumerate(names)]).alias("grid"))
        known = F.get(_array_by(cut, "__number", F.col("grid"), max(bounds.parts) + 2),
                      F.col(PART) + 1)

    def grid(name: str) -> tuple[Column, Column]:
        i = names.index(name)
        peak, many = known[f"peak{i}"], known[f"many{i}"]
        if not form.parts:
            return peak, many
        inside = F.col(BUCKET) < 0
        return (F.when(inside, _peak(tagged, name).over(whole)).otherwise(peak),
                F.when(inside, _many(tagged, name).over(whole)).otherwise(many))

    return grid


def _totals(df: DataFrame, e: Function, folds: dict[str, list[str]]) -> dict[str, Column]:
    """The sums and counts that a running function is made of, by suffix."""
    if e.kind == "count":
        return {"": _running(df, e)}
    if e.column in folds:
        sums = {f"f{k}": F.sum(n) for k, n in enumerate(folds[e.column])}
    else:
        sums = {"": _running(df, e) if e.kind == "sum" else _sum_for_avg(df, e)}
    return sums | ({"n": F.count(_value(df, e.column)[0])} if e.kind == "avg" else {})


def _sum_for_avg(df: DataFrame, e: Function) -> Column:
    """The sum an average is made of: decimal for decimals, else double."""
    col, kind = _value(df, e.column)
    return F.try_sum(col) if isinstance(kind, T.DecimalType) else F.sum(col.cast("double"))


def _carry(ranged: DataFrame, df: DataFrame, entries: list[Function], form: _Form,
           folds: dict[str, list[str]]) -> DataFrame:
    """Per piece: what lies before its range in its partition, and the range's own totals."""
    totals: dict[str, Column] = {"__t_rows": F.count(F.lit(1))}
    for i, e in enumerate(entries):
        if e.kind == "dense_rank":
            totals["__t_keys"] = F.max(f"__tabloom_local{i}")
        elif e.kind in RUNNING:
            for suffix, total in _totals(df, e, folds).items():
                totals[f"__t_{i}{suffix}"] = total
    grouped = ranged.where(F.col(BUCKET) >= 0).groupBy(PART, BUCKET, SALT, PIECE).agg(
        *[c.alias(n) for n, c in totals.items()])
    # One row per bound and cut: small, whatever the size of the table.
    step = F.col(BUCKET).desc() if form.descending else F.col(BUCKET).asc()
    whole = W.partitionBy(PART)
    before = whole.orderBy(step).rangeBetween(W.unboundedPreceding, -1)
    before_cut = whole.orderBy(step, F.col(SALT).asc()).rowsBetween(W.unboundedPreceding, -1)
    same = W.partitionBy(PART, BUCKET)
    columns = {
        "__c_rows": F.sum("__t_rows").over(before),
        "__c_rows_salt": F.sum("__t_rows").over(before_cut),
        "__c_size": F.col("__t_rows"),
    }
    for name in totals:
        if name == "__t_rows":
            continue
        if name == "__t_keys":
            # All cuts of one range hold the same single key; count it once.
            first_cut = F.when(F.col(SALT) == F.min(SALT).over(same), F.col(name)).otherwise(0)
            grouped = grouped.withColumn("__t_keys1", first_cut)
            columns["__c_keys"] = F.sum("__t_keys1").over(before)
            continue
        columns["__c" + name[3:]] = F.sum(name).over(before)
        columns["__s" + name[3:]] = F.sum(name).over(same)
    return grouped.withColumns(columns).select(PIECE, *columns)


def _combine(df: DataFrame, e: Function, i: int, form: _Form,
             folds: dict[str, list[str]]) -> Column:
    """The window value: what came before the range, with the value inside it."""
    local, carried = F.col(f"__tabloom_local{i}"), F.col("__c")
    tied = F.col(BUCKET) % 2 == 1
    if e.kind == "row_number":
        return (F.coalesce(carried["__c_rows_salt"], F.lit(0)) + F.col(NUMBER)).cast(form.number)
    if e.kind == "rank":
        return (F.coalesce(carried["__c_rows"], F.lit(0)) + local).cast(form.number)
    if e.kind == "dense_rank":
        return (F.coalesce(carried["__c_keys"], F.lit(0)) + local).cast(form.number)
    if e.kind in OFFSETS:
        side = _side(e.offset)
        return F.when(_outside(e.offset), F.col(f"`__rim_{side}`")[e.column]).otherwise(local)

    def running(suffix: str) -> Column:
        # Rows of a too frequent key share its total, whichever cut they are in.
        inside = F.when(tied, carried[f"__s_{i}{suffix}"]).otherwise(
            F.col(f"__tabloom_local{i}{suffix}"))
        past = carried[f"__c_{i}{suffix}"]
        return F.when(past.isNull(), inside).when(inside.isNull(), past).otherwise(
            F.try_add(past, inside))

    if e.column in folds and e.kind in ("sum", "avg"):
        total = _unfolded([running(f"f{k}") for k in range(FOLDS + 1)])
        return F.try_divide(total, running("n")) if e.kind == "avg" else total
    if e.kind == "avg":
        col, kind = _value(df, e.column)
        target = type_of(df, F.avg(col))
        # The total in the type of a single sum leaves the division enough decimals.
        total = running("").try_cast(type_of(df, _sum_for_avg(df, e)))
        if isinstance(kind, T.DecimalType) and kind.precision <= NARROW_DECIMAL:
            # Spark averages narrow decimals as unscaled doubles; round as it does.
            unit = F.lit(float(10**kind.scale))
            whole = (total * F.lit(Decimal(10**kind.scale))).cast("double")
            return F.try_divide(F.try_divide(whole, running("n")), unit).try_cast(target)
        return F.try_divide(total, running("n")).try_cast(target)
    if e.kind == "count":
        return running("")
    return running("").try_cast(type_of(df, _running(df, e)))


def _side(offset: int) -> str:
    return f"{'back' if offset < 0 else 'ahead'}{abs(offset)}"


def _outside(offset: int) -> Column:
    """Whether the partner row lies in another range (or nowhere)."""
    at = F.col(NUMBER) + offset
    return (F.col(BUCKET) >= 0) & ((at < 1) | (at > F.col("__c")["__c_size"]))


def _with_rims(rows: DataFrame, df: DataFrame, entries: list[Function], form: _Form,
               bounds: Bounds) -> DataFrame:
    """Add the partner rows of ``lag`` and ``lead`` that lie in other ranges.

    Such a partner is within ``reach`` rows of the rim of its range. As long as all rims
    together are few, each range gets the rows around it as constant arrays.
    """
    offsets = sorted({e.offset for e in entries if e.kind in OFFSETS})
    names = sorted({e.column for e in entries if e.kind in OFFSETS})
    reach = max(map(abs, offsets))
    size, number = F.col("__c")["__c_size"], F.col(NUMBER)
    near = rows.where((F.col(BUCKET) >= 0) & ((number <= reach) | (number > size - reach))).select(
        PART, PIECE, NUMBER, size.alias("__size"),
        (F.coalesce(F.col("__c")["__c_rows_salt"], F.lit(0)) + number).alias("__row"),
        F.struct(*[column(df, c).alias(c) for c in names]).alias("__values"))
    near = stage(near, "rims")
    if reach * bounds.pieces() > MOST_RIM_ROWS:
        return _with_far_rims(rows, near, offsets)
    # Around a range, the rims hold every row within reach, without a gap.
    order = W.partitionBy(PART).orderBy("__row")
    listed = F.collect_list("__values")
    near = near.withColumns({"__back": listed.over(order.rowsBetween(-reach, -1)),
                             "__ahead": listed.over(order.rowsBetween(1, reach))})
    back = _array_by(near.where(number == 1), PIECE, F.col("__back"), bounds.pieces())
    ahead = _array_by(near.where(number == F.col("__size")), PIECE, F.col("__ahead"),
                      bounds.pieces())
    rows = rows.withColumns({"__back": F.get(back, F.col(PIECE)),
                             "__ahead": F.get(ahead, F.col(PIECE))})
    return rows.withColumns({f"__rim_{_side(k)}": F.get(
        F.col("__back"), F.size("__back") + number + k - 1) if k < 0 else F.get(
            F.col("__ahead"), number + k - size - 1) for k in offsets})


def _with_far_rims(rows: DataFrame, near: DataFrame, offsets: list[int]) -> DataFrame:
    """The same for rims of many rows: only rows with a partner elsewhere look it up by number."""
    apart = F.lit(False)
    for k in offsets:
        apart = apart | F.coalesce(_outside(k), F.lit(False))
    empty = F.lit(None).cast(near.schema["__values"].dataType)
    inner = rows.where(~apart).withColumns({f"__rim_{_side(k)}": empty for k in offsets})
    outer = rows.where(apart)
    row = F.coalesce(F.col("__c")["__c_rows_salt"], F.lit(0)) + F.col(NUMBER)
    for k in offsets:
        partner = near.select(F.col(PART).alias("__part"), F.col("__row").alias("__at"),
                              F.col("__values").alias(f"__rim_{_side(k)}"))
        outer = outer.join(partner, (F.col(PART) == F.col("__part")) & (
            row + k == F.col("__at")), "left").drop("__part", "__at")
    return inner.unionByName(outer)
